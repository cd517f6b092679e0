"""Operators for building training data: archives, de-duplication, quality, mixing, packing, chat."""
