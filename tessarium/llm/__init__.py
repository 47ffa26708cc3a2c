"""Training-data operators: dedup, search, quality, mixing and packing on Spark.

Nothing outside this subpackage imports it.
"""
