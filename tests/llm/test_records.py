from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from timeloom.llm import ledger, matching, mixture, nearest, runs
from timeloom.llm.names import ReferenceList, misreading, same_heading

ENTRIES = [
    (1, "Silo Allocation", ["Silo Distribution", "TL-850"]), (2, "Silo Allocation Editor", None), (3, "Tanker 4 Settlement", []), (4, "Tanker 2 Settlement", ["Tanker 2 Payout"]),
    (5, "Dépôt Planner", ["Dépôt Planning Desk"]), (6, "Signal Box 6 Handover", []), (7, "Hangar Clearance", ["Hangar Release", None]), (8, "Reservoir Dispatch", ["Reservoir Send-off"]), (9, None, None),
]
READ = {
    "Silo Allocation": 1, "SILO – ALLOCATION *": 1, "Silo Allo.": 1, "tl850": 1, "(TL-850)": 1, "Silo Dstrbtn": 1, "Silo Allocation [18598]": 1, "Silo Allocation | terminal 13551": 1,
    "Silo Allocation Edi…": 2, "Settlement - Tanker 4": 3, "Tankcr 4 Settlemnet": 3, "Tanker2 Payout": 4, ">> Tanker 4 Settlement <84816>": 3, "Depot Planning Desk": 5, "DépôtPlanner": 5,
    "Signal Box 6 Hando": 6, "Box 6 Handover, Signal": 6, "Наngаr Clearance": 7, "Reservoir Send-…": 8, "* Hangar Release #58188": 7,
    "Tanker 5 Settlement": -1, "Old Silo Allocation": -1, "Hangar 3 Clearance": -1, "Silo Allocation Vault": -1, "Sign in to continue 5": -1, "TL-851": -1, "— —": -1, "Unknown": -1,
}


def entries(spark, rows=ENTRIES):
    return spark.createDataFrame([(*r, "clash") for r in rows], "entry_id bigint, label string, aliases array<string>, key string")


def reads(spark, names):
    return spark.createDataFrame([(i, n, "clash") for i, n in enumerate(names)], "reading_id bigint, name string, entry_id string")


@pytest.mark.parametrize("block", [20_000, 3])
def test_names_find_their_entry(spark, block):
    names = [*READ, None, "", " \t\n", "Silo Allocation", "x" * 400_000]
    found = {r.reading_id: r.entry_id for r in matching.match_names(reads(spark, names), entries(spark), "reading_id", "name", block=block).collect()}
    assert found == {**{i: e for i, e in enumerate(READ.values())}, len(READ) + 3: 1, len(READ) + 4: -1}


def test_matching_of_nothing(spark):
    none = matching.match_names(reads(spark, ["Silo"]), entries(spark, []), "reading_id", "name").collect()
    assert [tuple(r) for r in none] == [(0, -1)]
    assert matching.match_names(reads(spark, []), entries(spark), "reading_id", "name").collect() == []


def test_automaton_finds_what_brute_force_finds():
    rng = random.Random(3)
    words = ["".join(rng.choices("abco0", k=rng.randint(2, 6))) for _ in range(60)]
    reference = ReferenceList([])
    for w in words:
        reference.whole.add(w, w)
    for _ in range(60):
        text = "".join(rng.choices("abco0", k=rng.randint(1, 7)))
        got = {p: d for d, p, _ in reference.whole.within(text, 4)}
        assert got == {w: d for w in words if (d := misreading(text, w, 4)) <= 4}


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Tanker 2 Forecast", " TANKER – 2   forecast.", True), ("Dépôt 5 Forecast", "Depof 5 F0recast", True), ("Cannery 4 Intake", "Cannery 6 Intake", False), ("Silo Tariff", "Silo Roster", False),
        ("Old Berth Ledger", "Berth Ledger", False), ("Hangar 5 Logbook", "Hangar5 Logbook", True), ("Emergency Ferry", "Ernergency Ferry", True), ("", "", False), ("—", "—", False),
    ],
)
def test_same_heading(a, b, same):
    assert same_heading(a, b) is same and same_heading(b, a) is same


def test_very_long_headings():
    a = "Silo " * 60_000
    assert same_heading(a + "Tariff", a + "Torlff") and not same_heading(a + "Tariff", a + "Roster") and same_heading("y" * 200_000, "y" * 100_000 + "x" + "y" * 99_999)


def plain_distance(a, b):
    from timeloom.llm.names import _CLOSE

    d = {(i, j): 2 * (i + j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            cost = 0 if a[i - 1] == b[j - 1] else 1 if b[j - 1] in _CLOSE.get(a[i - 1], "") else 2
            d[i, j] = min(d[i - 1, j - 1] + cost, d[i - 1, j] + 2, d[i, j - 1] + 2)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 2)
    return d[len(a), len(b)]


@pytest.mark.parametrize("most", [0, 1, 2, 5, 6, 9])
def test_misreading_is_the_plain_distance(most):
    rng = random.Random(most)
    for _ in range(400):
        a, b = ("".join(rng.choices("abco0l1", k=rng.randint(0, 7))) for _ in range(2))
        assert misreading(a, b, most) == min(plain_distance(a, b), most + 1)


SCREEN = (
    "slug string, id string, t_ms_start bigint, t_ms_end bigint, frame_ids array<string>, identity struct<name:string,section:string>, received_at timestamp, head int, gid int"
)
NOON = dt.datetime(2026, 1, 1, 12)


def screen(slug, n, start, end, name, section=None, frames=None, received=NOON):
    return (slug, n if n is None else f"s_{n:04d}", start, end, frames, (name, section), received, 0, 0)


def runs_by_hand(rows):
    once = {}
    for r in sorted(rows, key=lambda r: (r[6], r[2] or 0)):
        if r[0] is not None and r[1] is not None and r[2] is not None:
            once.setdefault(r[:2], r)
    out, run = [], []
    for r in sorted(once.values(), key=lambda r: (r[0], r[2], r[1])):
        end = lambda p: p[3] if p[3] is not None else p[2]
        same = run and r[0] == run[-1][0] and r[5][1] == run[-1][5][1] and r[5][0] and run[-1][5][0] and r[2] <= end(run[-1]) + 10_000 and same_heading(run[-1][5][0], r[5][0])
        if not same:
            if len(run) > 1:
                out.append((run[0][0], run[0][1], run[-1][1], len(run)))
            run = []
        run.append(r)
    return sorted(out + ([(run[0][0], run[0][1], run[-1][1], len(run))] if len(run) > 1 else []))


def test_runs_by_pointer_doubling(spark):
    rng = random.Random(9)
    names = ["Silo Tariff", "SILO TARIFF", "Silo Torlff", "Berth 4 Ledger", "Berth 6 Ledger", None, " "]
    rows = [screen("hot", n, n * 1000, n * 1000 + rng.choice([0, 900]), "Silo Tariff" if 100 <= n < 250 else rng.choice(names), rng.choice([None, None, "a"]) if n < 100 else None) for n in range(300)]
    rows += [screen("b", n, n * 9000, None if n == 1 else n * 9000, "Same") for n in range(4)] + [screen("c", 1, 0, 0, "x y z"), screen("c", 2, 20_000, 20_000, "x y z")]
    rows += [screen(None, 1, 0, 0, "q"), screen("d", None, 0, 0, "q"), screen("d", 1, None, 0, "q"), screen("d", 2, 5, 5, "ww"), screen("d", 3, 5, 5, "ww")]
    rows += rows[40:60] + [screen("b", 0, 777_777, 777_777, "late copy", received=NOON + dt.timedelta(days=1))]
    df = spark.createDataFrame(rows, SCREEN)
    found, members = runs.collapse(df)
    got = sorted((r.entity, r.first_id, r.last_id, r.screens) for r in found.collect())
    assert got == runs_by_hand(rows)
    assert members.count() == sum(g[3] for g in got) and max(g[3] for g in got) >= 150
    assert runs.collapse(df.limit(0))[0].collect() == []


def test_run_record(spark):
    rows = [screen("a", 1, 0, 500, "N", frames=["f1", "f2", "f2"]), screen("a", 2, 600, 900, "n.", frames=["f2", "f3"]), screen("a", 3, 1000, 950, "N", frames=None)]
    r = runs.collapsed_runs(spark.createDataFrame(rows, SCREEN)).collect()
    assert [tuple(x) for x in r] == [("a", "s_0001", "s_0003", 3, 3, 0, 950, 950)]


def nearest_by_hand(rows, records, tol):
    out = []
    for key, entity, t in rows:
        if None in (key, entity, t):
            continue
        best = None
        for e, i, s, f in records:
            if e != entity or i is None or (s is None and f is None):
                continue
            s, f = (f if s is None else s), (s if f is None else f)
            s, f = min(s, f), max(s, f)
            d = max(0, s - t, t - f)
            if d <= tol and (best is None or (d, s, i) < best):
                best = (d, s, i)
        if best:
            out.append((key, entity, best[2], best[0]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_nearest_is_brute_force(spark, seed):
    rng = random.Random(seed)
    records = []
    for n in range(300):
        s = rng.randint(-2000, 40_000)
        records.append(("hot" if n % 2 else rng.choice("abc"), f"i{n:03d}", s, s + rng.choice([0, 0, 50, 400, 9000, -30])))
    records += [("hot", "dup", 100, 200)] * 3 + [("hot", "one", None, 50), ("hot", "two", 60, None), ("hot", "no", None, None), (None, "x", 1, 2), ("hot", None, 1, 2), ("a", "wide", -5000, 90_000)]
    rows = [(i, rng.choice(["hot", "a", "b", "c", "none"]), rng.randint(-4000, 60_000)) for i in range(500)] + [(900, None, 5), (901, "hot", None), (None, "hot", 5), (902, "hot", 7), (902, "hot", 7)]
    r = spark.createDataFrame([(*x, 1) for x in rows], "key bigint, entity string, t bigint, kind int")
    s = spark.createDataFrame([(*x, 1) for x in records], "entity string, id string, t_start bigint, t_end bigint, kind int")
    found = sorted(tuple(x) for x in nearest.nearest(r, s, 300).select("key", "entity", "id", "distance").collect())
    assert found == nearest_by_hand(rows, records, 300)


def test_nearest_of_nothing(spark):
    r = spark.createDataFrame([(1, "a", 5)], "key bigint, entity string, t bigint")
    s = spark.createDataFrame([], "entity string, id string, t_start bigint, t_end bigint")
    assert nearest.nearest(r, s, 10).collect() == [] and nearest.nearest(r.limit(0), s, 10).collect() == []


IDENTITY = "identity_id bigint, slug string, frame_id string, name string, other_fields string, key string, id int"


def other(spaced=False, **fields):
    said = {"record": None, "module": None, "tabs": [], "section": None, "dialog": None, "description": None} | fields
    items = list(said.items())
    return json.dumps(dict(items[::-1] if spaced else items), indent=1 if spaced else None)


def identity(n, name="A b", other_fields=None, slug="v", frame="f_1"):
    return (n, slug, frame, name, other_fields, "clash", 5)


def test_identity_keys(spark):
    same = [
        (identity(1, other_fields=other(module="Yard", tabs=["X", "Y"])), identity(2, " a-B! ", other(True, module=" yard.", tabs=["x", " Y"]), frame="F-1")),
        (identity(3, None, None), identity(4, None, None)), (identity(5, "", "not json {"), identity(6, "…", "NOT json{")), (identity(7, "Straße", "{}"), identity(8, "STRASSE", other(tabs=None))),
    ]
    for pair in same:
        df = spark.createDataFrame(list(pair), IDENTITY)
        assert df.select(ledger.identity_key("t")).distinct().count() == 1
    apart = [
        identity(1, "A"), identity(2, "B"), identity(3, None), identity(4, ""), identity(5, "A", "{}"), identity(6, "A", other()), identity(7, "A", other(tabs=["x", "y"])), identity(8, "A", other(tabs=["y", "x"])),
        identity(9, "A", other(tabs=["xy"])), identity(10, "Á"), identity(11, "A", other(module="x")), identity(12, "A", other(section="x")), identity(13, "A", other(tabs=[""])), identity(14, "A", other(tabs=["", ""])),
    ]
    assert spark.createDataFrame(apart, IDENTITY).select(ledger.identity_key("t")).distinct().count() == len(apart)


def test_ledger_adds_batches(spark, tmp_path):
    rng = random.Random(8)
    kept, rows = ledger.Ledger(spark, str(tmp_path / "ledger"), buckets=5), []
    for part in range(4):
        batch = [(bytearray(str(0 if rng.random() < 0.4 else rng.randint(1, 30)).encode()), part * 100 + i) for i in range(80 if part != 2 else 0)]
        rows += batch
        kept.add(spark.createDataFrame(batch + [(None, 1), (bytearray(b"q"), None)], "key binary, id bigint"))
    want = {}
    for k, i in rows:
        n, first = want.get(bytes(k), (0, i))
        want[bytes(k)] = (n + 1, min(first, i))
    assert {bytes(r.key): (r.n, r.first_id) for r in kept.read().collect()} == want
    found = ledger.copies(spark.createDataFrame(rows, "key binary, id bigint"), kept.read()).collect()
    assert sorted((r.first_id, r.copy_id) for r in found) == sorted((want[bytes(k)][1], i) for k, i in rows if i != want[bytes(k)][1])


def test_empty_ledger(spark, tmp_path):
    kept = ledger.Ledger(spark, str(tmp_path / "ledger"))
    empty = spark.createDataFrame([], "key binary, id bigint")
    kept.add(empty)
    assert kept.read().collect() == [] and ledger.copies(empty, kept.read()).collect() == []


def test_raking_meets_sources_and_caps():
    cells = pd.DataFrame([("a", "x", "p", 1000), ("a", "y", "q", 3000), ("b", "x", "p", 100), ("b", "y", "p", 300), ("c", "x", "q", 50)], columns=["source", "lang", "topic", "tokens"])
    plan = {"a": (0.5, 1.0), "b": (0.3, 2.0), "c": (0.1, 3.0), "none": (0.1, 1.0)}
    uses = mixture.rake(cells, plan)
    weight = uses * cells.tokens
    by = weight.groupby(cells.source).sum()
    assert np.allclose(by / by.sum(), [0.5 / 0.9, 0.3 / 0.9, 0.1 / 0.9], atol=1e-6)
    assert (uses <= cells.source.map(lambda s: plan[s][1]) + 1e-9).all()
    assert max(by["b"] / 800, by["c"] / 150, by["a"] / 4000) == pytest.approx(1.0)
    assert len(mixture.rake(cells.iloc[:0], plan)) == 0 and (mixture.rake(cells, {"a": (0, 1), "b": (0, 1), "c": (1, 0)}) == 0).all()


DOCS = "doc_id bigint, text string, source string, lang string, path string, licence_file string, n_tokens int, repeats int, id string"


def test_mixture_reaches_its_shares(spark):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(1, 60), rng.choice(["a"] * 8 + ["b"] * 2 + ["c", None, "other"]), rng.choice(["py", "md", None]), rng.choice(["src/x.py", "docs/y.md", None]), None, 1, 1, "clash") for i in range(1500)]
    rows += [(9001, None, "a", "py", None, None, 1, 1, ""), (9002, "", "a", "py", None, None, 1, 1, ""), (9003, "long " * 3000, "a", "py", None, None, 1, 1, "")]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 4), ("missing", 0.1, 1), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    used, report = mixture.mixture(spark.createDataFrame(rows, DOCS).repartition(6), targets)
    shares = {r.source: r for r in report.collect()}
    assert set(shares) == {"a", "b", "c", "missing"} and shares["missing"].reached_share == 0.0
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert shares[s].reached_share == pytest.approx(share / 0.9, abs=0.03) and shares[s].most_repeats <= {"a": 1, "b": 2, "c": 4}[s]
    got = used.collect()
    assert len({r.doc_id for r in got}) == len(got) and all(r.repeats > 0 and r.n_tokens > 0 for r in got)
    assert sum(r.repeats * r.n_tokens for r in got if r.source == "b") == shares["b"].tokens_used
    again, _ = mixture.mixture(spark.createDataFrame(rows, DOCS).repartition(3), targets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_mixture_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    used, report = mixture.mixture(docs, targets)
    assert used.collect() == [] and [(r.source, r.reached_share, r.docs_used) for r in report.collect()] == [("a", 0.0, 0)]
    assert mixture.mixture(docs, targets.limit(0))[1].collect() == []
