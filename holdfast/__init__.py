"""Customer-retention analytics as Spark jobs.

Every operator is a function from DataFrames and parameters to a DataFrame
built from Spark SQL expressions; see ``README.md`` for the map.
"""
