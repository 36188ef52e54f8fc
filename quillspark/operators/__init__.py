"""Relational operators over corpora, features and scores."""
