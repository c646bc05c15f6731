"""Public-funding records as Spark DataFrames: harmonise, prove, merge, classify, query."""
