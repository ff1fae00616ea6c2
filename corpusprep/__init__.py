"""Spark jobs that prepare text corpora and instruction data for training."""
