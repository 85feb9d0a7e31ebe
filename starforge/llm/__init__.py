"""Operators of a training-data pipeline: mixing, token counts, quality rules,
URL filters, language identification, near duplicates, fingerprints, packing,
a quality classifier and chat formatting.

Nothing else in the library imports this subpackage.
"""
