"""Reading and writing corpora, splits, feeds, statistics and models."""
