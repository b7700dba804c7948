"""Transaction-risk analytics on Spark: clean, featurise, score and report payments."""
