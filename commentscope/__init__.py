"""Comment analytics on Spark DataFrames.

Every operator takes a DataFrame and returns a lazy DataFrame; Catalyst plans the work.
"""
