"""Tidemark: point-in-time research tables and operators on Spark DataFrames.

Every dated row carries ``known_at`` (when a decision maker could first use it)
and ``observed_at`` (when our side saw it).  All operators are lazy functions
from DataFrames to DataFrames and compose with ``DataFrame.transform``.
"""

from tidemark.session import configure, local_session

__all__ = ["configure", "local_session"]
