"""Operators of a training-data pipeline: duplicates, quality, licences, tokens, search, packing, URLs, benchmark leaks."""
