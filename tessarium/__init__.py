"""Tessarium: a Spark-first engine for evidence-grounded document corpora."""
