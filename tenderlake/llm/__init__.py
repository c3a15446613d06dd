"""Operators for training-data pipelines (packing, decontamination, near and
exact dedup, licences, URL policy, toxicity, main text, sharding, language).

Nothing outside this subpackage imports it; ``queries.py`` registers its
queries.  Every operator selects the columns it needs first, so extra input
columns, whatever their names, neither clash nor travel along.
"""
