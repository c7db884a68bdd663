"""Buckets of keys for Python operators with state.

Spark calls such an operator once for each key of a micro-batch, and a call with its reads and writes
of state takes some milliseconds, whatever is in it. So the operators group by buckets of
keys, and one value of state holds those of all keys in a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Buckets of keys. Each is read and written whole when rows of it come: take more for a hundred million keys.
BUCKETS = 1024


def bucket(key: str | Column, buckets: int) -> Column:
    """The bucket of a key, from 0."""
    return F.pmod(F.xxhash64(key), F.lit(buckets))
