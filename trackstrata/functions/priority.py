"""Sampling order.

A row's place in a sample depends only on the seed, a salt and the row's own key, never on the
partition it sits in, so samples survive repartitioning, retries and lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_priority(seed: int, salt: str | Column, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt) if isinstance(salt, str) else salt, *[F.col(k).cast("string") for k in keys]))
