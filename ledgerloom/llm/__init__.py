"""Operators for preparing training text: mixing, deduplication, classification, filtering, counting, packing.

Nothing else in the library imports this package. ``queries`` names one query per operator.
"""
