"""Incremental (Structured Streaming) form of the row-wise feature step."""
