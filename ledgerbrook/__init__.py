"""Transaction analytics on Spark DataFrames: cleansing, quality, fraud rules,
a star schema, summaries and incremental loads."""
