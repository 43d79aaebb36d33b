"""Document segmentation, retrieval and evaluation over many documents at once, on Spark DataFrames."""
