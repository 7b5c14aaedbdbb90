"""Readers: labelled records, keyword lists, training logs, saved models."""
