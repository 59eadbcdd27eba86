"""Operators that large training-data pipelines need: near and exact dedup, packing, secrets, PII, quality, BPE, media, URLs."""
