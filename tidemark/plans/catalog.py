"""Imports every query module so that the registry is complete."""

from tidemark.plans import core_queries  # noqa: F401
from tidemark.plans import event_queries  # noqa: F401
from tidemark.plans import governance_queries  # noqa: F401
from tidemark.plans import storage_queries  # noqa: F401
from tidemark.plans import stream_queries  # noqa: F401
