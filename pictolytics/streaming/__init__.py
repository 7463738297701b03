"""The live questions as Structured Streaming queries."""
