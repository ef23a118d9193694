"""The ledger outlives the job that made it."""

from __future__ import annotations

import random

import pytest

from timeloom.llm import ledger


def test_ledger_opened_again_goes_on(spark, tmp_path):
    path, schema = str(tmp_path / "ledger"), "key binary, id bigint"
    first = ledger.Ledger(spark, path, buckets=5)
    first.add(spark.createDataFrame([(bytearray(b"x"), 1), (bytearray(b"y"), 2)], schema))
    ledger.Ledger(spark, path).add(spark.createDataFrame([(bytearray(b"x"), 3), (bytearray(b"z"), 4)], schema))
    ledger.Ledger(spark, path, buckets=9).add(spark.createDataFrame([], schema))
    again = ledger.Ledger(spark, path)
    assert again.buckets == 5 and again.generation == 3
    assert {bytes(r.key): (r.n, r.first_id) for r in again.read().collect()} == {b"x": (2, 1), b"y": (1, 2), b"z": (1, 4)}

    first.generation = 1  # opened before the others wrote
    with pytest.raises(RuntimeError, match="another job"):
        first.add(spark.createDataFrame([(bytearray(b"x"), 9)], schema))
    assert sum(r.n for r in ledger.Ledger(spark, path).read().collect()) == 4


def test_batches_that_share_keys_count_as_one(spark, tmp_path):
    rng = random.Random(3)
    rows = [(bytearray(bytes([rng.randint(0, 30)])), i) for i in range(300)]
    for n in range(5):
        ledger.Ledger(spark, str(tmp_path), buckets=4).add(spark.createDataFrame([r for r in rows if r[1] % 5 == n], "key binary, id bigint"))
    want = {}
    for key, i in rows:
        n, first = want.get(bytes(key), (0, i))
        want[bytes(key)] = (n + 1, min(first, i))
    assert {bytes(r.key): (r.n, r.first_id) for r in ledger.Ledger(spark, str(tmp_path)).read().collect()} == want


def test_only_touched_buckets_are_written(spark, tmp_path):
    kept = ledger.Ledger(spark, str(tmp_path), buckets=8)
    kept.add(spark.createDataFrame([(bytearray(bytes([i])), i) for i in range(64)], "key binary, id bigint"))
    kept.add(spark.createDataFrame([(bytearray(b"\x05"), 100)], "key binary, id bigint"))
    assert sorted(kept.written.values()) == [1] * 7 + [2]
    assert {bytes(r.key): r.n for r in kept.read().collect()} == {bytes([i]): 1 + (i == 5) for i in range(64)}


def test_buckets_grow_with_the_ledger(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "PER_BUCKET", 10)
    kept = ledger.Ledger(spark, str(tmp_path))
    for part in range(4):
        kept.add(spark.createDataFrame([(bytearray(bytes([part, i])), i) for i in range(60)], "key binary, id bigint"))
        assert kept.rows <= 4 * ledger.PER_BUCKET * kept.buckets
    again = ledger.Ledger(spark, str(tmp_path))
    assert again.buckets == kept.buckets > 4 and again.read().count() == 240
