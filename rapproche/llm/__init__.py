"""Operators of a training-data pipeline: cleaning, scoring, deduplication, mixing and tokenizing of documents."""
