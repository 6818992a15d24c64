"""Operators of a training-data pipeline: mixing, toxicity, near and exact
duplicates, packing, fingerprints, URL lists, languages, shards, token counts."""
