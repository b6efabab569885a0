"""The registered queries, the test tables they run on, and the SQL they are compared with."""
