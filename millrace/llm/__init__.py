"""Operators for text corpora of language models. Nothing else in millrace imports this subpackage."""
