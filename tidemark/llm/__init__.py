"""Operators for building text training corpora on Spark.

Nothing outside this folder imports it; ``__spark_entry__`` registers its
queries when it is present.
"""
