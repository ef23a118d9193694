"""What happens on the driver around a run: registering sources, refreshing and gating the inventory, listing runs."""

from __future__ import annotations

import math
import os
import re
import shlex
import subprocess
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.state import LEAST_COMMIT_DIGITS


def check_slug(slug: str) -> str:
    """Letters, digits, hyphens and underscores of any alphabet."""
    if not re.fullmatch(r"[\w-]+", slug):
        raise ValueError(f"not a slug: {slug!r}")
    return slug


def register(videos: DataFrame, slug: str, probe: dict, sha256: str, force: bool = False) -> DataFrame:
    """``videos`` with a source added or renewed; a source whose digest changed is an error unless ``force``."""
    known = videos.filter(F.col("slug") == check_slug(slug)).select("sha256").first()
    if known is not None and known.sha256 != sha256 and not force:
        raise ValueError(f"{slug}: the source is not the one registered")
    row = videos.sparkSession.createDataFrame([{**probe, "slug": slug, "sha256": sha256}], videos.schema)
    return videos.filter(F.col("slug") != slug).unionByName(row)


def config_template(duration_s: float) -> str:
    """A first configuration layer of a video: only what depends on it."""
    return f"sample:\n  max_frames: {math.ceil(duration_s) + 1}\n"


def listed(root: str, name: str = "config.yaml") -> list[str]:
    """Folders of ``root`` that hold a file ``name``, sorted."""
    return sorted(p.parent.name for p in Path(root).glob(f"*/{name}"))


def run_exporter(command: str, cwd: str, timeout_s: int = 600) -> None:
    """Runs the inventory's exporter; a failure is an error with the last line it wrote."""
    with tempfile.TemporaryFile("w+", errors="replace") as told, subprocess.Popen(shlex.split(command), cwd=cwd, stdout=subprocess.DEVNULL, stderr=told) as running:
        try:
            code = running.wait(timeout_s)
        except subprocess.TimeoutExpired:
            running.kill()
            raise RuntimeError(f"exporter took longer than {timeout_s} s") from None
        told.seek(0)
        last = "no message"
        for line in told:  # kept line by line, however much it wrote
            last = line.strip() or last
    if code:
        raise RuntimeError(f"exporter failed ({code}): {last}")


def head_commit(path: str) -> str | None:
    """The commit a working copy is at, read from its files; None where there is none."""
    for folder in (Path(path), *Path(path).absolute().parents):
        git = folder / ".git"
        if git.is_file():  # a linked working copy names its folder
            git = folder / git.read_text().removeprefix("gitdir:").strip()
        if (git / "HEAD").is_file():
            break
    else:
        return None
    head = (git / "HEAD").read_text().strip()
    if not head.startswith("ref:"):
        return head or None
    name = head.removeprefix("ref:").strip()
    common = git / (git / "commondir").read_text().strip() if (git / "commondir").is_file() else git
    for place in (git / name, common / name):
        if place.is_file():
            return place.read_text().strip() or None
    packed = common / "packed-refs"
    lines = packed.read_text().splitlines() if packed.is_file() else []
    return next((line.split()[0] for line in lines if line.endswith(f" {name}")), None)


def same_commit(a: str | None, b: str | None) -> bool:
    """Whether two commits agree as far as both are given (columns: :func:`timeloom.operators.state.commits_agree`)."""
    both = [(c or "").lower() for c in (a, b)]
    return len(os.path.commonprefix(both)) == min(map(len, both)) >= LEAST_COMMIT_DIGITS


def require_fresh(inventory_commit: str | None, head: str | None) -> None:
    if not same_commit(inventory_commit, head):
        raise ValueError(f"the inventory was made at {inventory_commit or 'an unknown commit'}, the project is at {head or 'an unknown commit'}")
