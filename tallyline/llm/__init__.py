"""Operators of a training-data pipeline: scoring, filtering, deduplication, packing.

Nothing outside this package imports it. ``queries`` registers one query per operator.
"""
