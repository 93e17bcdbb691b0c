"""Randomness keyed by a row identity.

``rand`` and ``randomSplit`` draw per partition, so a retried task or another file layout gives
another answer. A hash of (seed, key) gives every row the same draw wherever it runs. Steps that
follow each other on the same rows need different seeds, or the second one repeats the first's draws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_md5(seed: int, *keys: str) -> Column:
    """Hex md5 of ``seed:key``; uniform, so its order is a shuffle of the rows.

    In a key of several parts each is led by its length, or is ``-`` if missing, so different keys
    never read alike.
    """
    parts = [F.col(k).cast("string") for k in keys]
    if len(keys) == 1:
        parts = [F.coalesce(parts[0], F.lit(""))]
    else:
        parts = [F.when(p.isNull(), "-").otherwise(F.concat_ws(":", F.length(p).cast("string"), p)) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hash01(seed: int, *keys: str) -> Column:
    """Uniform double in [0, 1) made of the first 32 bits of ``keyed_md5``."""
    head = F.conv(F.substring(keyed_md5(seed, *keys), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(4294967296.0)
