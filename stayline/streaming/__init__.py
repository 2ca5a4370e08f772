"""Event normalisation, scoring and sinks for Structured Streaming."""
