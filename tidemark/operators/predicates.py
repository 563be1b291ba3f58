"""Shared predicates on event names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def feature_predicate(prefix: str, match: str = "prefix", column: str = "event_name") -> Column:
    """Feature events by name prefix.

    ``match="prefix"`` tests a literal prefix; ``match="like"`` keeps SQL ``LIKE`` meaning,
    where ``_`` in the prefix matches any one character.
    """
    if match == "prefix":
        return F.startswith(F.col(column), F.lit(prefix))
    if match == "like":
        return F.col(column).like(prefix + "%")
    raise ValueError(f"match must be 'prefix' or 'like', got {match!r}")
