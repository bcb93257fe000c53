"""Readers of dialogue corpora and writers of results."""
