"""Joins with small derived frames (per-category dates, brand lists).

Catalyst estimates an aggregate's size from its input, so a per-category
aggregate of a huge table is never broadcast statically, and the big side
is shuffled before AQE can notice the small side.  ``checked_broadcast``
materialises the small frame once as a reliable checkpoint (in the
cluster's ``spark.checkpoint.dir``), measures it, and hints a broadcast only
under ``max_bytes``; above that it returns the frame unhinted and the join
shuffles (AQE still splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.session import checkpoint_folder

# Bytes of a broadcast side, as text: categories, brands — dimension sizes, not data sizes.
MAX_BROADCAST_BYTES = 16 << 20
_MARK = "_rivalry_checked"


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` computed once and hinted for broadcast if it is small; a failing frame fails here.

    Where the session names no checkpoint folder, no job runs and the choice
    is left to Catalyst and AQE.
    """
    if getattr(df, _MARK, False) or checkpoint_folder(df.sparkSession) is None:
        return df
    small = df.checkpoint(eager=True)
    size = small.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    out = F.broadcast(small) if size <= max_bytes else small
    setattr(out, _MARK, True)
    return out
