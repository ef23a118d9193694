from __future__ import annotations

import random

from timeloom.operators.intervals import periods_and_gaps
from timeloom.streaming import keyed


def drained(stream, name, mode):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return stream.sparkSession.table(name).collect()


def test_last_kept_over_batches(spark, tmp_path):
    from tests.test_operators import kept_by_hand

    rng = random.Random(4)
    rows = [(i, rng.randint(0, 40) / 4, rng.randint(0, 30)) for i in range(40)]
    for part in range(4):
        spark.createDataFrame([("k", i, b, float(f)) for i, b, f in rows[part * 10 : part * 10 + 10]], "k string, t bigint, b double, f double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t bigint, b double, f double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = drained(keyed.last_kept_stream(stream, "k", "t", "b", "f", 4.0, 0.3, 2), "kept", "append")
    assert sorted(r.t for r in found) == [i for i, _, keep, _ in kept_by_hand(rows, 4.0, 0.3, 2) if keep]


def test_interval_state_agrees_with_batch(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), s := rng.randint(0, 500), s + rng.randint(0, 20)) for _ in range(60)]
    schema = "slug string, s bigint, e bigint"
    for part in range(3):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = drained(keyed.interval_stream(stream, "slug", "s", "e", 10_000), "periods", "update")
    want = periods_and_gaps(spark.createDataFrame(rows, schema), "slug", "s", "e").filter("kind = 'period'").collect()
    assert {(r.slug, r.s, r.e) for r in want} <= {(r.slug, r.s, r.e) for r in found}
