"""Preparing text, vectors and conversations for training, as Spark jobs."""
