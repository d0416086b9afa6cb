"""The same job as a Structured Streaming query."""
