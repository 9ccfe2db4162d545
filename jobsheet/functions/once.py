"""A column that is evaluated once a row.

The optimizer copies a projected expression into every filter above it, also into those that an ``explode``
of it implies, so a costly one (parsed JSON, tokens of a text) runs several times a row.  What a generator
makes is not copied.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column) -> Column:
    """``c`` as a generator of exactly one row (nulls too); one per ``select``."""
    return F.explode(F.array(c))
