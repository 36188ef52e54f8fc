"""Corpus curation and authorship classification as Spark DataFrame jobs."""
