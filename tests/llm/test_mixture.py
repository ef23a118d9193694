"""Mixing: shares within a hundredth, marginals reached, seeds, raking as a table, topics from texts."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from timeloom.llm import mixture, tokens, topics

DOCS = "doc_id bigint, text string, source string, lang string, subject string, id string, repeats int"
TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 4), ("none", 0.1, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["code ", "prose ", "table "]) * min(int(1 + rng.paretovariate(1.1)), 400), rng.choice("aaaaaaaabbc"), rng.choice(["py", "md", None]), rng.choice(["x", "y"]), "clash", 1) for i in range(1200)]
    rows += [(5000, None, "a", None, None, "", 1), (5001, "", "b", None, None, "", 1), (5002, "big " * 4000, "c", "py", "x", "", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache(), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


@pytest.mark.parametrize("how", [{}, {"seed": 7}, {"topic": "subject"}, {"few": 1}])
def test_every_source_has_its_share(spark, tables, how):
    docs, targets = tables
    used, report, reached = mixture.mixture_with_marginals(docs, targets, **how)
    for r in report.collect():
        due = dict((s, share / 0.9) for s, share, _ in TARGETS if s != "none").get(r.source, 0.0)
        assert r.reached_share == pytest.approx(due, rel=0.01) and r.most_repeats <= r.max_repeats
    got = used.collect()
    assert len({r.doc_id for r in got}) == len(got) and all(1 <= r.repeats <= {"a": 1, "b": 2, "c": 4}[r.source] for r in got)
    for kind in ("source", "lang", "topic"):
        rows = reached.filter(F.col("kind") == kind).collect()
        assert sum(r.due_share for r in rows) == pytest.approx(1) and sum(r.reached_share for r in rows) == pytest.approx(1)
        if kind != "source" and "seed" in how:  # one document of 29 % of all tokens cannot have its share where its source has a tenth
            small = mixture.mixture_with_marginals(docs.filter("doc_id < 5000"), targets, **how)[2].filter(F.col("kind") == kind).collect()
            assert all(abs(r.due_share - r.reached_share) < 0.05 for r in small)


def test_seeds_draw_other_documents_and_the_same_again(spark, tables):
    docs, targets = tables
    drawn = {seed: sorted(tuple(r) for r in mixture.mixture(docs.repartition(n), targets, seed=seed, topic=F.lit("t"))[0].collect()) for seed, n in ((1, 3), (2, 3))}
    assert drawn[1] != drawn[2]
    assert sorted(tuple(r) for r in mixture.mixture(docs.repartition(7), targets, seed=1, topic=F.lit("t"))[0].collect()) == drawn[1]


def test_raking_as_a_table_is_raking(spark):
    rng = np.random.default_rng(3)
    cells = pd.DataFrame([(s, lang, t, int(rng.integers(1, 5000))) for s in "abc" for lang in "wxyz" for t in "pq" if rng.random() < 0.8], columns=["source", "lang", "topic", "tokens"])
    plan = {"a": (0.5, 1.0), "b": (0.3, 2.0), "c": (0.2, 3.0), "d": (0.1, 1.0)}
    want = mixture.rake(cells, plan, rounds=30)
    found = mixture.rake_table(spark.createDataFrame(cells), plan, rounds=30).toPandas()
    both = cells.assign(want=want).merge(found, on=mixture.CELL)
    assert len(both) == len(cells) and np.allclose(both.want, both.uses, atol=1e-6)


def test_topics_part_texts_by_what_they_say(spark):
    rng = random.Random(2)
    kinds = ["def return import class self", "however therefore because although", "select where group having join"]
    rows = [(i, " ".join(rng.choices(kinds[i % 3].split(), k=60))) for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = topics.fitted(docs.repartition(4), "doc_id", "text", 3, 60)
    ids = lambda t: np.array(tokens.encoder(tokens.VOCABULARY).ids(t), np.int32)
    said = {i: found.of(ids(t)) for i, t in rows}
    assert len({(i % 3, said[i]) for i in range(300)}) == 3 and {said[i] for i in range(300)} == {0, 1, 2} and {said[i] for i in (900, 901)} == {-1}
    again = topics.fitted(docs.repartition(2), "doc_id", "text", 3, 60)
    assert np.array_equal(found.centres, again.centres)
    assert topics.fitted(docs.limit(0), "doc_id", "text", 3, 60).of(ids("word")) == -1


def test_topics_are_found_on_all_texts_by_a_table_as_on_the_driver(spark):
    rng = random.Random(8)
    words = "def return import class self however therefore because although select where group having join".split()
    rows = [(i, " ".join(rng.choices(words[i % 5 :: 5] + words[:2], k=rng.randint(1, 40)))) for i in range(2500)] + [(9000, None), (9001, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = topics.fitted(docs, "doc_id", "text", 4, seed=3)
    as_table = topics.fitted(docs.repartition(3), "doc_id", "text", 4, few=1, seed=3)
    assert np.array_equal(found.mean, as_table.mean) and np.array_equal(found.centres, as_table.centres) and len(found.centres) == 4
    coder = tokens.encoder(tokens.VOCABULARY)
    vectors = []
    for _, t in rows[:2500]:
        ids = np.array(coder.ids(t), np.int32)
        vectors.append(np.sqrt(np.bincount((ids.astype(np.uint32) * np.uint32(2_654_435_761)) >> np.uint32(23), minlength=512) / len(ids)))
    mean = np.mean(vectors, axis=0)
    assert np.allclose(found.mean / np.linalg.norm(found.mean), mean / np.linalg.norm(mean), atol=5e-5)
    away = np.array(vectors) - mean
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    centres = found.centres / np.linalg.norm(found.centres, axis=1, keepdims=True)
    nearest = (away @ centres.T).argmax(axis=1)
    means = np.array([away[nearest == k].sum(axis=0) for k in range(4)])
    assert np.allclose(centres, means / np.linalg.norm(means, axis=1, keepdims=True), atol=1e-3)  # of all texts, none left out
