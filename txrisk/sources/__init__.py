"""Reading the input tables and writing results."""
