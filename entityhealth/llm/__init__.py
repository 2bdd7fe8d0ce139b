"""Operators of a training-data pipeline: near copies, page text, secrets, quality, packing, search, mixing."""
