"""Operators for training-data pipelines: quality, tokens, toxicity, urls, duplicates, secrets, pages, benchmarks, search."""
