"""Column expressions: cleaning, rounding and banding. All built-in, none in Python."""
