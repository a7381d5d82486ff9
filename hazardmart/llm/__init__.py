"""Operators that prepare a training corpus: token counts, search, deduplication, filters, mixing."""
