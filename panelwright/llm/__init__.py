"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``corpus_pipeline.py`` at the repository top chains five of
its operators. Every operator takes DataFrames with the columns it names,
ignores any other column, and states its handling of nulls, empty and very
long texts, ties and repeated rows in its docstring.
"""
