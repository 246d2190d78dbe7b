"""Product-catalogue analytics on PySpark.

Every operator is a function from DataFrames (plus plain parameters) to a DataFrame.
Sources and sinks live in ``sources``; nothing else reads or writes storage.
"""
