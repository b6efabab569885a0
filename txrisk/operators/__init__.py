"""The analyses. Every function takes DataFrames and returns a DataFrame; none runs a job."""
