"""Errors raised by strict operators."""

from __future__ import annotations


class IngestError(RuntimeError):
    """A condition that must stop an ingest instead of being passed over."""


class LayoutError(IngestError):
    """A source file does not have the declared layout."""


class UnknownCodeError(IngestError):
    """A value is not part of a closed vocabulary."""


class ScopeError(IngestError):
    """A row crosses the scope boundary."""


class PublishError(IngestError):
    """A snapshot may not be published as asked."""
