"""Millrace: a Spark-native engine for trustworthy batch ingestion.

Rows only ever move through DataFrame plans. The driver parses small JSON-like specs, starts
actions, and reads back results whose size depends on the number of columns, rules or runs,
never on the number of rows.
"""
