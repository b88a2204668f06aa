"""Operators for building language-model training corpora.

Nothing else in the package imports this subpackage; its queries and SQL are
in ``recspark.llm.queries``.
"""
