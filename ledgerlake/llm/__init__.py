"""Operators for preparing language-model training data, as Spark jobs.

Each module holds one operator with its own general interface; :mod:`ledgerlake.llm.queries`
registers the thin ``opN_<name>`` queries. Nothing else in the library imports this package.
"""
