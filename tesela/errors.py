"""Failures that scorers and translators raise."""

from __future__ import annotations


class StructuralFailure(RuntimeError):
    """A failure that every row would have; it ends the run."""


class PartialResult(RuntimeError):
    """The scorer left criteria out."""
