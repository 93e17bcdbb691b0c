"""Operators for training data: filters, extraction, near duplicates, pseudonyms, classifiers, packing.

Nothing else in the library imports this folder.
"""
