"""Panel time-series work on Spark: cleaning, features, windows, baselines, scoring."""
