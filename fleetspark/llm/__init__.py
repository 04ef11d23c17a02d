"""Operators for preparing training data: mixing, packing, near-duplicate
search, nearest neighbours, token counts, personal data, repeated passages,
piece encoding and quality scores. Nothing else in the library imports this
subpackage."""
