"""Training-data operators: near-dedup, mixing, token output, classifiers,
cleaning rules, tokenising, language identification, HTML extraction.

Each operator lives in its own module and takes DataFrames; ``queries``
applies them to the given tables.  Nothing outside this subpackage imports it.
"""
