"""Operators for building text corpora: archives, filters, fingerprints, joins, mixing, tokens."""
