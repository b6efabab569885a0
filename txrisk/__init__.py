"""Card-transaction analysis and rule-based risk detection on PySpark DataFrames."""
