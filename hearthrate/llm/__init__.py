"""Operators for building training corpora, each an independent Spark job."""
