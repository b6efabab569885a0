"""The daily indicators and the burst alerts on a stream of transactions."""
