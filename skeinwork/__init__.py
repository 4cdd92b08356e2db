"""Spark-first analytics over forum records: cleaning, rule-based enrichment, scoring, evaluation and storage."""
