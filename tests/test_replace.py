from __future__ import annotations

from timeloom.streaming import keyed

SCHEMA = "slug string, run bigint, n bigint"


def test_delivery_over_several_batches_is_kept_whole(spark, tmp_path):
    def deliver(*files):
        for rows in files:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = keyed.replace_in_batches(stream, str(tmp_path / "out"), "slug", "run", str(tmp_path / "state"))
        assert query.awaitTermination(120) and query.exception() is None
        found = spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).collect()
        return sorted((r.slug, r.run, r.n) for r in found)

    first = deliver([("a/b", 9, 1), ("c", 9, 2)], [("a/b", 9, 3), (None, 9, 0)], [("a/b", 9, 4)])
    assert first == [("a/b", 9, 1), ("a/b", 9, 3), ("a/b", 9, 4), ("c", 9, 2)]
    second = deliver([("a/b", 10, 5)], [("a/b", 10, 6), ("d", 1, 7)])
    assert second == [("a/b", 10, 5), ("a/b", 10, 6), ("c", 9, 2), ("d", 1, 7)]
    assert deliver([("a/b", 9, 8), ("c", 9, 9)]) == sorted([*second, ("c", 9, 9)])
