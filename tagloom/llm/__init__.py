"""Operators for preparing training data: filtering, deduplication, decontamination, packing and sharding."""
