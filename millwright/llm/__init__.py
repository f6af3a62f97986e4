"""Operators that prepare training text: cleaning, matching, indexing and packing of documents."""
