"""Operators for training data: nearest vectors, top N per group, token ids, packing, page spam."""
