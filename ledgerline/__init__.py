"""ledgerline: entity-resolution auditing and evaluation on Spark DataFrames."""
