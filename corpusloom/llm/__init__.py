"""Operators for preparing training text: scans, classifiers, duplicates, packing.

Every operator is a function from DataFrames to a DataFrame in a module of its own.
``queries`` registers one query for each over the synthetic tables.
"""
