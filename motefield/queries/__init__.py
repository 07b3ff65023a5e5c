"""Registered queries with their SQL counterparts."""

from . import checks, files, joins, models, parsing, reports, streams, windows  # noqa: F401
from .base import REGISTRY

__all__ = ["REGISTRY"]
