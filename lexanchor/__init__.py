"""Analytics over a corpus of decisions anchored to a tree of norms, on Spark DataFrames."""
