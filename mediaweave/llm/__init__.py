"""Training-data operators: cleaning, deduplication, tokenisation and packing of text corpora.

Nothing else in the library imports this subpackage.
"""
