"""courtledger: box scores, fantasy scores and validity history as Spark DataFrames."""
