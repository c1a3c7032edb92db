"""Operators of a training-data pipeline: cleaning, mixing, packing and searching documents."""
