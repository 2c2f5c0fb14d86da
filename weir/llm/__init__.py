"""Operators of a training-data pipeline, each written as a Spark job.

Nothing outside this package imports it.  :mod:`weir.llm.queries` registers one
query per operator.
"""
