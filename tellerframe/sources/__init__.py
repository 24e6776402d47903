"""Reading: raw CSV, staged Parquet, seeds and the feeds derived from the test tables."""
