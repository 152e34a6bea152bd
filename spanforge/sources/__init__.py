"""Readers and writers for the corpus, lexicon and metric formats."""
