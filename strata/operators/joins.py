"""Dimension joins; Spark decides from measured sizes whether to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str] | None = None,
           how: str = "left") -> DataFrame:
    """``df ⟕ dim USING (on)``, keeping ``cols`` of the dimension.

    No hint and no extra job: at planning the dimension's estimated size is
    compared with ``spark.sql.autoBroadcastJoinThreshold``; at run time AQE
    measures the shuffled bytes and broadcasts only below its own threshold.
    Above both it stays a shuffle join.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if cols is not None:
        dim = dim.select(*keys, *[c for c in cols if c not in keys])
    return df.join(dim, keys, how)
