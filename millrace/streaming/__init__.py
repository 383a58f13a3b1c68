"""Repeated polling as Structured Streaming: the checkpoint takes the place of the watermark table."""
