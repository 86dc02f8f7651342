"""Reading and writing text, vectors, index tables and metrics."""
