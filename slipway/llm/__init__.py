"""Operators for building training corpora from Spark tables.

Nothing outside this folder imports it. Each module holds one operator over
DataFrames; ``queries`` registers one query per operator.
"""
