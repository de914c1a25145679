"""Training-data operators: filters, de-duplication, tokenisation, packing and search on Spark.

Nothing else in the library imports this package.
"""
