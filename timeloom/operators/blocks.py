"""Every row of one table against every row of another, where no join finds the pairs: in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.session import shuffle_partitions


def in_blocks(asked: DataFrame, listed: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str, block: int, share: int = 20_000, asked_rows: int | None = None) -> DataFrame:
    """``run(share of asked, block of listed)`` for every share and every block; the first column of each spreads its rows.

    Both tables must be materialised: they are counted (``asked_rows``: how many there are, where that is known). A group holds about ``share`` rows of the one and ``block`` of the
    other, so no task grows with either table, and neither passes through the driver or is broadcast.
    """
    n = shuffle_partitions(asked.sparkSession)
    blocks = -(-listed.count() // block) or 1
    shares = max(-(-(asked.count() if asked_rows is None else asked_rows) // share), -(-n // blocks))
    spread = lambda df, k: F.pmod(F.xxhash64(df.columns[0]), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = asked.withColumn("_s", spread(asked, shares)).withColumn("_b", every(blocks))
    right = listed.withColumn("_b", spread(listed, blocks)).withColumn("_s", every(shares))
    left, right = (df.repartition(max(1, min(blocks * shares, 4 * n)), "_b", "_s") for df in (left, right))
    drop = lambda t: t.drop_columns([c for c in ("_s", "_b") if c in t.column_names])
    return left.groupBy("_b", "_s").cogroup(right.groupBy("_b", "_s")).applyInArrow(lambda a, b: run(drop(a), drop(b)), schema)
