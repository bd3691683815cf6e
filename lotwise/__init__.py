"""Batch analytics over marketplace listings, written as Spark DataFrame operators.

Every operator takes DataFrames and parameters and returns a lazy DataFrame (or
a Column), so operators compose into one plan that Catalyst optimises whole.
"""
