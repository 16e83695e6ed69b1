"""Queries of the operators for training data."""

from lexgrain.llm import lexicon, markup, neardup, packing, private, scans, splitting, variants, vectors

QUERIES: dict[str, tuple] = {}
for _m in (variants, scans, neardup, splitting, vectors, markup, lexicon, packing, private):
    QUERIES.update(_m.QUERIES)
