"""Message analytics on Spark: clean, score, store and serve short text messages.

Every operator is a function from DataFrame to DataFrame; the jobs in
``murmura.plans`` chain them over date-partitioned Parquet.
"""
