"""Evidence-bound documentation analytics as Spark jobs."""
