"""Operators for large training-data pipelines: scoring, filtering, near duplicates,
mixing, packing, archives and vector search.  Nothing outside this folder imports it."""
