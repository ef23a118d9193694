"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in tokens; the cells (source, language, topic) are raked so that the token weights of the
mixture meet the target share of each source exactly and the language and topic shares of the eligible corpus as
nearly as the repeat caps allow. A cell's weight over its tokens is the calibrated number of uses of each of its
documents; documents are then drawn systematically along (source, size, seeded hash), so that every document is used the
rounded-down or rounded-up number of times. What a source then has too little or too much is closed by single uses of
documents no larger than what is missing, never beyond the cap.

The topic is a column or expression of the caller's, or found from all texts (:mod:`timeloom.llm.topics`). The total is the
largest at which every source that occurs can have its share under its cap. A source of the targets without tokens keeps
share 0 and the others share the whole in proportion; the report shows both, and :func:`marginals` what languages and
topics reached. Up to ``few`` cells are raked on the driver, more of them as a table by the same steps.

Defined results: documents with a null or unlisted source, and documents without tokens, stay out; null language
is a language of its own; repeated target rows count once (their largest share and smallest cap); negative or
null shares and caps count as 0; empty tables give an empty mixture and a report of zeros.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.llm import topics as topics_of
from timeloom.llm.tokens import VOCABULARY, encoder
from timeloom.operators.ordered import range_sorted, scan
from timeloom.session import materialise

FEW = 100_000  # cells raked on the driver
ROUNDS = 200
UNIT = 1 << 24  # uses are summed as whole multiples of 1 / UNIT, so that sums are exact in any order
TOPICS = 8  # clusters of texts
SLOTS = 16  # documents of each size class that may close what a source is off its share
CELL = ["source", "lang", "topic"]


@dataclass(frozen=True)
class Goals:
    """What each source is to have: share and cap, and once the tokens are known, its goal."""

    plan: dict[str, tuple[float, float]]
    goal: dict[str, float]
    total: float

    @classmethod
    def of(cls, plan: dict[str, tuple[float, float]], tokens: dict[str, float]) -> Goals:
        limits = {s: plan[s][1] * n for s, n in tokens.items()}
        present = {s: plan[s][0] for s in limits if plan[s][0] > 0 and limits[s] > 0}
        whole = sum(present.values())
        total = min((limits[s] / (share / whole) for s, share in present.items()), default=0.0)
        return cls(plan, {s: total * present.get(s, 0.0) / whole if whole else 0.0 for s in limits}, total)


def rake(cells: pd.DataFrame, targets: dict[str, tuple[float, float]], rounds: int = ROUNDS) -> np.ndarray:
    """Calibrated uses per document for each cell (columns source, lang, topic, tokens).

    ``targets``: share and cap of each source. Language and topic marginals are those of the cells themselves.
    """
    tokens = cells.tokens.to_numpy(float)
    if not len(tokens):
        return np.zeros(0)
    source = cells.source.to_numpy(object)
    cap = np.array([targets[s][1] for s in source]) * tokens
    goals = Goals.of(targets, {s: tokens[source == s].sum() for s in dict.fromkeys(source)})
    if not goals.total:
        return np.zeros(len(tokens))
    hard = [(source == s, goal) for s, goal in goals.goal.items()]
    soft = []
    for column in ("lang", "topic"):
        values = cells[column].to_numpy(object)
        soft += [((m := values == v), goals.total * tokens[m].sum() / tokens.sum()) for v in dict.fromkeys(values)]
    weight = np.minimum(tokens, cap)
    for at in range(rounds):
        before = weight.copy()
        for mask, goal in soft:
            have = weight[mask].sum()
            if have > 0:
                weight[mask] = np.minimum(weight[mask] * (goal / have), cap[mask])
        for mask, goal in hard:
            weight[mask] = _fill(weight[mask], cap[mask], goal)
        if np.abs(weight - before).max() <= 1e-9 * max(goals.total, 1.0) and at:
            break
    return np.divide(weight, tokens, out=np.zeros_like(weight), where=tokens > 0)


def _fill(weight: np.ndarray, cap: np.ndarray, goal: float) -> np.ndarray:
    """``weight`` scaled to sum to ``goal`` with no element above its cap (the excess goes to the others)."""
    if goal <= 0:
        return np.zeros_like(weight)
    if goal >= cap.sum():
        return cap.copy()
    weight, fixed = np.maximum(weight, 1e-9 * cap), np.zeros(len(weight), bool)
    while True:
        free = ~fixed & (cap > 0)
        scaled = np.where(fixed, cap, weight * ((goal - cap[fixed].sum()) / weight[free].sum()))
        over = free & (scaled > cap)
        if not over.any():
            return np.minimum(scaled, cap)
        fixed |= over


def rake_table(cells: DataFrame, plan: dict[str, tuple[float, float]], rounds: int = 30) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with uses: :func:`rake` by joins, for any number of cells."""
    sums = cells.groupBy("source").agg(F.sum("tokens").alias("n")).collect()  # sources of the targets, a parameter list
    goals = Goals.of(plan, {r.source: float(r.n) for r in sums})
    known = cells.sparkSession.createDataFrame([(s, float(plan[s][1]), float(g)) for s, g in goals.goal.items()] or [("", 0.0, 0.0)], "source string, most double, goal double")
    state = cells.join(F.broadcast(known), "source").withColumn("cap", F.col("most") * F.col("tokens"))
    state = state.select(*CELL, "tokens", "cap", "goal", F.least(F.col("tokens").cast("double"), "cap").alias("weight"))
    share = goals.total / max(sum(float(r.n) for r in sums), 1.0)
    for _ in range(rounds):
        state = materialise(state)
        following = state
        for column in ("lang", "topic"):
            have = following.groupBy(column).agg(F.sum("weight").alias("_have"), (F.sum("tokens") * F.lit(share)).alias("_due"))
            scaled = F.when(F.col("_have") > 0, F.least(F.col("weight") * F.col("_due") / F.col("_have"), "cap")).otherwise(F.col("weight"))
            following = following.join(have, column).select(*CELL, "tokens", "cap", "goal", scaled.alias("weight"))
        following = materialise(following.withColumn("weight", F.greatest("weight", F.col("cap") * 1e-9)).withColumn("fixed", F.lit(False)))
        while True:  # each source to its goal; what a cap cuts off goes to the others
            by = following.groupBy("source").agg(F.sum(F.when(F.col("fixed"), F.col("cap")).otherwise(0.0)).alias("_full"), F.sum(F.when(F.col("fixed"), 0.0).otherwise(F.col("weight"))).alias("_free"), F.sum("cap").alias("_caps"))
            factor = F.try_divide(F.col("goal") - F.col("_full"), F.col("_free"))
            fitted = F.when(F.col("goal") <= 0, 0.0).when(F.col("goal") >= F.col("_caps"), F.col("cap")).when(F.col("fixed"), F.col("cap")).otherwise(F.col("weight") * F.coalesce(factor, F.lit(0.0)))
            tried = materialise(following.join(F.broadcast(by), "source").withColumn("fitted", fitted).drop("_full", "_free", "_caps"))
            if tried.filter("fitted > cap * (1 + 1e-12) and not fixed").isEmpty():
                break
            following = tried.withColumn("fixed", F.col("fixed") | (F.col("fitted") > F.col("cap"))).drop("fitted")
        moved = tried.select(*CELL, "tokens", "cap", "goal", F.least("fitted", "cap").alias("weight"))
        change = tried.join(state.select(*CELL, F.col("weight").alias("_w")), CELL).agg(F.max(F.abs(F.least("fitted", "cap") - F.col("_w")))).first()[0]
        state = moved
        if (change or 0.0) <= 1e-9 * max(goals.total, 1.0):
            break
    return state.select(*CELL, F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0).alias("uses"))


def _counted(docs: DataFrame, vocabulary: str, vectors: bool) -> DataFrame:
    """(id, source, lang, topic, n_tokens) of (id, source, lang, topic, body), and with ``vectors`` what topics are found by:
    every text is read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            counts, seen, ids, held = [], [], [], 0
            for body in batch.column(4):
                text = body.as_py()
                ids.append(coder.packed(text) if text else b"")
                counts.append(len(ids[-1]) // 4)
                held += counts[-1]
                if len(ids) == topics_of.ROWS or held >= topics_of.IDS:
                    if vectors:
                        seen.append(topics_of.packed(ids))
                    ids, held = [], 0
            more = {topics_of.SEEN: pa.concat_arrays([*seen, topics_of.packed(ids)])} if vectors else {}
            yield pa.record_batch([*batch.columns[:4], pa.array(counts, pa.int64()), *more.values()], ["id", *CELL, "n_tokens", *more])

    return docs.mapInArrow(run, _counted_schema(docs) + (f", {topics_of.SEEN} binary" if vectors else ""))


def _counted_schema(docs: DataFrame) -> str:
    return f"id {docs.schema['id'].dataType.simpleString()}, source string, lang string, topic string, n_tokens bigint"


def _with_topics(counted: DataFrame, topics: int, seed: int) -> DataFrame:
    """``counted`` with the topics found on all of its texts, without the vectors."""
    found = topics_of.fit(topics_of.hashed(counted, "id", seed), topics)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = pa.array(found.given(batch.column(5))).cast(pa.string())
            yield pa.record_batch([*batch.columns[:3], said, batch.column(4)], ["id", *CELL, "n_tokens"])

    return counted.mapInArrow(run, _counted_schema(counted))


NEAR, TRIES = 0.001, 8  # how near to its goal a source is left as it is, and how often others are tried to bring nearer


def _closing(drawn: DataFrame, plan: dict[str, tuple[float, float]], goals: Goals, seed: int) -> DataFrame:
    """``drawn`` with further or fewer uses by which each source comes nearer to its goal.

    What a source is off is about its largest document. Of every size class of a source a few documents that may be used
    more, and less, are fetched (their number does not grow with the documents); the largest that fit into what is missing are
    taken. Where all of them do not suffice, others are fetched, up to ``TRIES`` times.
    """
    off = {s: goal - n for s, goal, n in _reached(drawn, goals)}
    most = F.create_map(*(F.lit(x) for s, (_, cap) in plan.items() for x in (s, int(cap))))[F.col("source")] if plan else F.lit(0)
    size = F.floor(F.log2(F.col("n_tokens").cast("double")) * 2)
    kind = drawn.schema["id"].dataType.simpleString()
    changed: dict = {}
    now = drawn
    for at in range(TRIES):
        open_ = [s for s, d in off.items() if abs(d) > NEAR * max(goals.goal[s], 1.0)]
        if not open_:
            break
        here = now.filter(F.col("source").isin(open_))
        slot = F.pmod(F.xxhash64(F.lit(seed), F.lit(at), "id"), F.lit(SLOTS))

        def pick(way: int, room: Column, here=here, slot=slot) -> DataFrame:
            offered = here.withColumn("room", room.cast("bigint")).filter("room > 0").groupBy("source", size.alias("c"), slot.alias("s"))
            return offered.agg(F.min(F.struct(F.xxhash64(F.lit(at), "id"), "n_tokens", "id", "room")).alias("d")).select("source", "d.n_tokens", "d.id", "d.room", F.lit(way).alias("way"))

        found = pick(1, most - F.col("repeats")).unionByName(pick(-1, F.col("repeats"))).collect()
        before = dict(off)
        for r in sorted(found, key=lambda r: (-r.n_tokens, r.id)):
            times = min(r.room, int(abs(off[r.source]) / r.n_tokens + 0.5)) if r.way * off[r.source] > 0 else 0
            if times:
                changed[r.id] = changed.get(r.id, 0) + r.way * times
                off[r.source] -= r.way * times * r.n_tokens
        if off == before:
            break
        more = drawn.sparkSession.createDataFrame([(i, w) for i, w in changed.items()], f"id {kind}, way bigint")  # a bounded number for each source
        now = drawn.join(F.broadcast(more), "id", "left").withColumn("repeats", F.col("repeats") + F.coalesce("way", F.lit(0))).drop("way")
    return now


def _reached(drawn: DataFrame, goals: Goals) -> list[tuple[str, float, int]]:
    sums = {r.source: int(r.n) for r in drawn.groupBy("source").agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("n")).collect()}
    return [(s, goal, sums.get(s, 0)) for s, goal in goals.goal.items()]


def mixture_with_marginals(
    docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    topic: Column | str | None = None, vocabulary: str = VOCABULARY, seed: int = 0, topics: int = TOPICS, few: int = FEW,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mixture, report, marginals). mixture: key, source, repeats, n_tokens of every document used at least once; report: one row
    per source of ``targets`` with target and reached share, tokens and documents; marginals: kind (source, lang, topic),
    value, due_share, reached_share. ``seed`` decides which documents of a cell are drawn and where the clusters begin."""
    spark = docs.sparkSession
    wanted = targets.filter(f"{source} is not null").groupBy(F.col(source).alias("source")).agg(
        F.max(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"),
        F.min(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats"),
    )
    plan = {r.source: (r.target_share, float(r.max_repeats)) for r in wanted.collect()}  # the targets are a parameter list
    eligible = docs.filter(F.col(source).isin(list(plan)) & (F.length(text) > 0)) if plan else docs.limit(0)
    said = F.lit("") if topic is None else F.coalesce((F.col(topic) if isinstance(topic, str) else topic).cast("string"), F.lit(""))
    rows = eligible.select(F.col(key).alias("id"), F.col(source).alias("source"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), said.alias("topic"), F.col(text).alias("body"))
    counted = materialise(_counted(rows, vocabulary, topic is None).filter("n_tokens > 0"))
    if topic is None:
        counted = materialise(_with_topics(counted, topics, seed))
    cells = counted.groupBy(*CELL).agg(F.sum("n_tokens").alias("tokens"))
    head = cells.limit(few + 1).toPandas()
    if len(head) <= few:
        head = head.sort_values(CELL).reset_index(drop=True)
        head["uses"] = rake(head, plan)
        uses = F.broadcast(spark.createDataFrame(head[[*CELL, "uses"]])) if len(head) else spark.createDataFrame([], "source string, lang string, topic string, uses double")
    else:
        uses = rake_table(materialise(cells), plan)
    each = F.floor(F.col("uses") * UNIT + 0.5).cast("bigint")
    order = F.xxhash64(F.lit(seed), "id")
    sized = range_sorted(counted.join(uses, CELL).select("source", "n_tokens", order.alias("h"), "id", *CELL[1:], each.alias("each")), "source", "n_tokens", "h", "id")
    start = {s: int(np.random.default_rng([seed, n]).integers(UNIT)) if seed else UNIT // 2 for n, s in enumerate(sorted(plan))}

    def summarise(batches: Iterator[pa.RecordBatch]):
        last, expected, whole = None, 0, True
        for batch in batches:
            for name, low, high in _stretches(batch):
                if name != last:
                    whole, last, expected = last is None, name, 0
                expected += int(batch.column("each").to_numpy()[low:high].sum())
        return None if last is None else (last, expected, whole)

    def combine(a, b):
        return (b[0], a[1] + b[1], a[2]) if b[2] and a[0] == b[0] else (b[0], b[1], False)

    def apply(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        last, expected = carry[:2] if carry else (None, 0)
        for batch in batches:
            repeats = np.empty(batch.num_rows, np.int64)
            for name, low, high in _stretches(batch):
                sums = (expected if name == last else 0) + np.r_[0, np.cumsum(batch.column("each").to_numpy()[low:high])]
                repeats[low:high] = np.diff((sums + start[name]) // UNIT)
                last, expected = name, int(sums[-1])
            yield pa.record_batch([*(batch.column(c) for c in ("id", *CELL, "n_tokens")), pa.array(repeats)], ["id", *CELL, "n_tokens", "repeats"])

    kind = docs.schema[key].dataType.simpleString()
    drawn = materialise(scan(sized, summarise, combine, apply, f"id {kind}, source string, lang string, topic string, n_tokens bigint, repeats bigint"))
    have = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens_available"), F.count("*").alias("docs_available"))
    goals = Goals.of(plan, {r.source: float(r.tokens_available) for r in have.collect()})
    drawn = _closing(drawn, plan, goals, seed)
    used = materialise(drawn.filter("repeats > 0"))
    got = used.groupBy("source").agg(
        F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens_used"), F.count("*").alias("docs_used"), F.max("repeats").alias("most_repeats")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    report = wanted.join(F.broadcast(have), "source", "left").join(F.broadcast(got), "source", "left").select(
        "source", "target_share", F.col("max_repeats").cast("bigint").alias("max_repeats"),
        *(zero(c) for c in ("docs_available", "tokens_available", "docs_used", "tokens_used", "most_repeats")),
    )
    whole = got.agg(F.sum("tokens_used").alias("_all"))
    report = report.crossJoin(F.broadcast(whole)).withColumn("reached_share", F.coalesce(F.try_divide("tokens_used", "_all"), F.lit(0.0))).drop("_all")
    out = used.select(F.col("id").alias(key), "source", "repeats", "n_tokens")
    return out, report, marginals(counted, used, goals)


def marginals(counted: DataFrame, used: DataFrame, goals: Goals) -> DataFrame:
    """(kind, value, due_share, reached_share): what each source, language and topic was to have of the tokens, and has."""
    parts = []
    total = counted.agg(F.sum("n_tokens").alias("_t"))
    reached = used.agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("_r"))
    due = F.create_map(*(F.lit(x) for s, g in (goals.goal or {"": 0.0}).items() for x in (s, float(g / goals.total) if goals.total else 0.0)))
    for kind in CELL:
        here = counted.groupBy(F.col(kind).alias("value")).agg(F.sum("n_tokens").alias("n"))
        there = used.groupBy(F.col(kind).alias("value")).agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("u"))
        both = here.join(there, "value", "left").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(reached))
        wanted = due[F.col("value")] if kind == "source" else F.col("n") / F.col("_t")
        parts.append(both.select(F.lit(kind).alias("kind"), "value", wanted.alias("due_share"), F.coalesce(F.try_divide(F.col("u").cast("double"), F.col("_r").cast("double")), F.lit(0.0)).alias("reached_share")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _stretches(batch: pa.RecordBatch) -> list[tuple[str, int, int]]:
    """(source, first row, beyond its last) of a sorted batch."""
    if not batch.num_rows:
        return []
    coded = batch.column(0).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    edges = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes)].tolist()
    names = coded.dictionary.to_pylist()
    return [(names[codes[low]], low, high) for low, high in zip(edges[:-1], edges[1:], strict=True)]


def mixture(docs: DataFrame, targets: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """(mixture, report) of :func:`mixture_with_marginals`."""
    return mixture_with_marginals(docs, targets, **how)[:2]
