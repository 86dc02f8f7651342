"""Text and vector similarity search as Spark jobs."""
