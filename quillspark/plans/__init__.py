"""Whole jobs: prepare, train, evaluate, predict."""
