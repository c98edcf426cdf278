"""Operators for large text corpora: cleaning, linking, scoring and mixing documents."""
