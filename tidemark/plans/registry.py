"""All registered queries (importing the modules registers them)."""

from tidemark.plans import ml_queries as _ml  # noqa: F401
from tidemark.plans import queries as _batch  # noqa: F401
from tidemark.plans import stream_queries as _stream  # noqa: F401
from tidemark.plans.queries import REGISTRY

__all__ = ["REGISTRY"]
