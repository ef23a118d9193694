"""What is read on the driver: commits of a working copy, slugs, a failing exporter."""

from __future__ import annotations

import subprocess

import pytest
from pyspark.sql import functions as F

from timeloom.operators.state import commits_agree
from timeloom.plans import driver


def test_head_is_read_from_files(tmp_path):
    git = lambda *args: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=a", "-c", "user.email=a@b", *args], check=True, capture_output=True, text=True).stdout.strip()
    git("init", "-q")
    assert driver.head_commit(str(tmp_path)) is None  # nothing is committed yet
    git("commit", "-q", "--allow-empty", "-m", "x")
    head = git("rev-parse", "HEAD")
    (tmp_path / "deep" / "er").mkdir(parents=True)
    assert driver.head_commit(str(tmp_path)) == head == driver.head_commit(str(tmp_path / "deep" / "er"))
    git("pack-refs", "--all")
    assert driver.head_commit(str(tmp_path)) == head
    git("worktree", "add", "-q", str(tmp_path / "linked"), "-b", "other")
    assert driver.head_commit(str(tmp_path / "linked")) == head
    git("checkout", "-q", "--detach")
    assert driver.head_commit(str(tmp_path)) == head


@pytest.mark.parametrize("slug", ["a", "-x", "Lobby_Wall", "été-1", "7"])
def test_slugs(slug):
    assert driver.check_slug(slug) == slug
    for bad in ("", slug + " ", slug + "/", slug + "."):
        with pytest.raises(ValueError, match="not a slug"):
            driver.check_slug(bad)


def test_commits_as_columns_and_as_text(spark):
    pairs = [("ABCDEF1", "abcdef1234"), ("abc", "abc"), (None, "abcdef1"), ("abcdef1", "abcdef2"), ("", "")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", commits_agree(F.col("a"), F.col("b")).alias("same")).collect()
    assert {(r.a, r.b): r.same for r in rows} == {p: None if None in p else driver.same_commit(*p) for p in pairs}


def test_exporter_that_hangs_or_fails(tmp_path):
    with pytest.raises(RuntimeError, match="longer"):
        driver.run_exporter("sleep 5", str(tmp_path), timeout_s=0.2)
    with pytest.raises(RuntimeError, match=r"\(4\): last"):
        driver.run_exporter("sh -c 'echo first >&2; echo last >&2; echo >&2; exit 4'", str(tmp_path))
