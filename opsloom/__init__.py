"""opsloom: operational analytics jobs written for Spark.

Every operator is a plain function from DataFrames to a DataFrame; column names
are parameters, so the same code runs on the sample relations and on real tables.
"""
