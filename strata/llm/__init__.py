"""Operators for preparing large text corpora on Spark.

Each module holds one operator with its own general interface;
``strata.llm.queries`` registers one query per operator, and
``corpus_pipeline`` (repository top) chains five of them.  Nothing else in
the library imports this subpackage.
"""
