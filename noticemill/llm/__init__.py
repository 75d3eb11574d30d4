"""Operators that prepare training data for language models.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries if it is there.
"""
