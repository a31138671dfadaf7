"""Operators for large text corpora: de-duplication, scoring, extraction, packing, sharding.

Every operator is a module with one general entry point on DataFrames; the thin
``opN_<name>`` queries over the standard tables are in ``queries``.  Nothing outside
this package imports it.
"""
