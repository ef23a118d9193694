"""What the queries share: tables, and events as per-user timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators.numbering import numbered_within


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Events as frames: user_id, event_id, idx (place in the user's timeline, from 0), t_ms since 2024, and ``columns``."""
    t_ms = F.unix_millis(F.col("ts").cast("timestamp")) - 1704067200000
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", t_ms.alias("t_ms"), *columns)
    return numbered_within(rows, "user_id", "ts", "event_id").select("user_id", "event_id", "idx", "t_ms", *columns)


FRAMES_SQL = """frames AS (
    SELECT user_id, event_id, event_type, value, props, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
        epoch_us(ts) // 1000 - 1704067200000 AS t_ms, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events)"""


def k_of(column: str = "props") -> F.Column:
    return F.get_json_object(column, "$.k").cast("bigint")
