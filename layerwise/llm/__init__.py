"""Operators on text corpora (language, reputation, decontamination, duplicates, private data,
quality, shards, secrets, subword pieces).  Nothing else in the library imports this package."""
