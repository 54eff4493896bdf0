"""Operators of a training-data pipeline: vector search, deduplication, URL and
quality filters, tokenisation and packing.  Nothing outside this package
imports it."""
