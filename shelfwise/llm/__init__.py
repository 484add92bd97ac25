"""Corpus preparation: extraction, deduplication, classification, mixing and token files for training text."""
