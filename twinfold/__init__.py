"""Spark jobs that keep a large, linked, multilingual document collection in step with a second copy of it."""
