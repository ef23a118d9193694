from __future__ import annotations

import pytest

from timeloom.operators import manifest
from timeloom.operators.snapshot_diff import SnapshotIndex
from timeloom.plans import general
from tests.test_general import SNAPSHOT, changes, day, snap


def test_index_opened_again_goes_on(spark, tmp_path):
    rows = [
        snap(1, "a", day(1), "P"), snap(2, "a", day(1), "Q"), snap(3, "b", day(1), "P"), snap(4, "a", day(2), "P", "stub"), snap(5, "a", day(2), "R"),
        snap(6, "a", day(3), "R"), snap(7, "b", day(3), "S"),
    ]
    index = general.inventory_index(spark.createDataFrame(rows, SNAPSHOT)).cache()
    found = []
    for d in (1, 2, 3):
        new = index.filter(index.snapshot == day(d))
        kept = SnapshotIndex(spark, str(tmp_path), buckets=4 + d)  # the buckets of the first one hold
        assert kept.generation == d - 1 and kept.buckets == 5
        found += [(r.row_id, r.change) for r in kept.probe(new).collect()]
        kept.swap(new)
    assert sorted(found) == changes(spark, rows) and found
    late = SnapshotIndex(spark, str(tmp_path))
    late.generation = 1  # a job that opened the folder before others wrote to it
    with pytest.raises(RuntimeError, match="another job"):
        late.swap(index.filter(index.snapshot == day(3)))
    assert SnapshotIndex(spark, str(tmp_path)).probe(index.filter(index.snapshot == day(3))).count() == 0


def test_unfinished_generation_does_not_hold(spark, tmp_path):
    assert manifest.read_manifest(spark, str(tmp_path / "nothing")) is None
    for n in (9, 10):
        manifest.write_manifest(spark, str(tmp_path), n, x=n)
    (tmp_path / "_manifest-11.part").write_text("{")
    (tmp_path / "g11").mkdir()
    assert manifest.read_manifest(spark, str(tmp_path)) == {"generation": 10, "x": 10}


def test_only_touched_buckets_are_written_and_old_ones_go(spark, tmp_path):
    rows = [snap(10 * d + i, p, day(d), f"L{i}", "stub" if d == 3 and i == 1 else "built") for d in (1, 2, 3, 4) for p in "abcdef" for i in range(3)]
    index = general.inventory_index(spark.createDataFrame(rows, SNAPSHOT)).cache()
    kept = SnapshotIndex(spark, str(tmp_path), buckets=6)
    kept.swap(index.filter(index.snapshot == day(1)))
    whole = dict(kept.written)
    one = index.filter((index.snapshot == day(2)) & (index.entity == "a"))
    kept.swap(one)
    changed = {b for b, g in kept.written.items() if g == 2}
    assert len(changed) == 1 and {b: g for b, g in kept.written.items() if b not in changed} == {b: 1 for b in whole if b not in changed}
    assert kept.read().count() == 18
    for d in (3, 4):
        kept.swap(index.filter((index.snapshot == day(d)) & (index.entity == "a")))
    bucket = f"bucket={changed.pop()}"
    assert [g for g in ("g1", "g2", "g3", "g4") if (tmp_path / g / bucket).exists()] == ["g3", "g4"]  # the last two
    assert sorted(p.name for p in tmp_path.glob("manifest-*.json")) == ["manifest-3.json", "manifest-4.json"]
    assert SnapshotIndex(spark, str(tmp_path)).read().count() == 18


def test_failed_swap_leaves_the_table(spark, tmp_path, monkeypatch):
    from timeloom.operators import buckets

    index = general.inventory_index(spark.createDataFrame([snap(1, "a", day(1), "P"), snap(2, "a", day(2), "Q")], SNAPSHOT)).cache()
    SnapshotIndex(spark, str(tmp_path), buckets=3).swap(index.filter(index.snapshot == day(1)))

    def fails(*args, **kept):
        raise OSError("the job was lost")

    with monkeypatch.context() as patched:
        patched.setattr(buckets, "write_manifest", fails)
        with pytest.raises(OSError, match="lost"):
            SnapshotIndex(spark, str(tmp_path)).swap(index.filter(index.snapshot == day(2)))
    again = SnapshotIndex(spark, str(tmp_path))
    assert sorted((r.row_id, r.change) for r in again.probe(index.filter(index.snapshot == day(2))).collect()) == [(1, "removed"), (2, "added")]
    again.swap(index.filter(index.snapshot == day(2)))
    assert [r.row_id for r in SnapshotIndex(spark, str(tmp_path)).read().collect()] == [2]
