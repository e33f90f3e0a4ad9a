"""Customer-purchase analytics and item ranking on Spark DataFrames.

``sources``    readers, writers and stored dictionaries/models
``functions``  column expressions (no shuffles, no actions)
``operators``  DataFrame -> DataFrame building blocks
``plans``      composite jobs: training universes, scoring and blending
``catalog``    the registered queries and the SQL they are checked against
"""
