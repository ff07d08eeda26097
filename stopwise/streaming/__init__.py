"""The bronze/silver pipeline on Structured Streaming."""
