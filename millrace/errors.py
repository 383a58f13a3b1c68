"""Typed failures of an ingest run."""

from __future__ import annotations


class EtlError(Exception):
    """Base class of every failure a run can end with."""


class ExtractError(EtlError):
    """The source could not be read or does not have the promised shape."""


class TransformError(EtlError):
    """A reshape step named a missing column or met a value it cannot cast."""


class LoadError(EtlError):
    """The target rejected the batch."""


class ValidationFailed(EtlError):
    """A blocking rule failed; ``outcome`` still carries the full scorecard."""

    def __init__(self, message, violations=None, outcome=None):
        super().__init__(message)
        self.violations = list(violations or [])
        self.outcome = outcome


def first_line(exc: Exception) -> str:
    """The telling part of a Spark error, whose text may go on for a page."""
    lines = [line.strip() for line in str(exc).splitlines() if line.strip()]
    return lines[0] if lines else type(exc).__name__
