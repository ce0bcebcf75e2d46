"""Live-commerce analytics as plain PySpark DataFrame and Structured Streaming code."""
