"""The same column logic over Structured Streaming."""
