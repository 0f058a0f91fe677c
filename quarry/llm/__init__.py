"""Operators of a training-data pipeline on Spark DataFrames.

One module per operator; ``queries`` holds the registered queries and their SQL twins.
Nothing outside this folder imports it.
"""
