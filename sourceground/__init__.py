"""Spark jobs that turn marked-up books into a source-grounded question set."""
