"""Readers: each turns a source config into a lazy DataFrame."""

from millrace.sources.registry import POSITION, extract, register_source, source_types

__all__ = ["POSITION", "extract", "register_source", "source_types"]
