"""Pair-data curation engine on Spark: entity resolution, pair dedup, splits, contracts."""
