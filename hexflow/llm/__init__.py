"""Operators of a training-data pipeline: token counts, quality rules,
toxicity, BPE, exact and near-duplicate detection, sharding, personal data,
source mixing, vector codes, search and fingerprints. Nothing else in the library imports this subpackage."""
