from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from timeloom.llm import lookalike, tokens

TEXTS = ["", " ", "a", "the the", "don't stop\n\n  now ", "x" * 3000, "é中🦀   z", "<|endoftext|> is text", "\r\n\t \n", "1234567890 12３", "ab\x1ccd\x85ef"]


@pytest.fixture(scope="module")
def coder():
    return tokens.encoder(tokens.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    tk = pytest.importorskip("tokenizers").Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    tk.encode_special_tokens = True
    return lambda t: tk.encode(t, add_special_tokens=False).ids


def test_ids_are_the_library_s(coder, library):
    rng = random.Random(1)
    bits = list("ab \n\t'x1é９中🦀\x1c\x85 ̀st") + ["the", "  ", "re", "<|endoftext|>", "ing", "====", "\r\n"]
    for text in TEXTS + ["".join(rng.choices(bits, k=rng.randint(0, 60))) for _ in range(3000)]:
        assert coder.ids(text) == library(text)
        assert coder.decode(coder.ids(text)) == text
    assert coder.ids(None) == []


def test_long_texts_are_split_where_no_piece_reaches_over(coder, monkeypatch):
    rng = random.Random(2)
    bits = list("ab1 _\n\t'é中\x1c\x85 ̀st!") + ["the", "   ", "'re", "12ab", "----"]
    texts = ["".join(rng.choices(bits, k=400)) for _ in range(200)]
    want = [coder.packed(t) for t in texts]
    for chunk in (1, 7, 50):
        monkeypatch.setattr(tokens, "CHUNK", chunk)
        assert [coder.packed(t) for t in texts] == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30), st.text(max_size=12), st.integers(0, 30), st.integers(0, 30))
def test_appends_and_edits_stay_exact(text, new, a, b):
    coder = tokens.encoder(tokens.VOCABULARY)
    a, b = min(a, len(text)), min(b, len(text))
    held = tokens.EncodedText(coder, text)
    held.edit(min(a, b), max(a, b), new)
    assert held.text == text[: min(a, b)] + new + text[max(a, b) :]
    assert held.ids() == coder.ids(held.text)
    held.append(new)
    assert held.ids() == coder.ids(held.text)


@given(st.binary(max_size=24), st.binary(max_size=8), st.integers(0, 24))
@settings(max_examples=200, deadline=None)
def test_prefix_table_grows_and_is_cut(data, more, size):
    vocabulary = tokens.encoder(tokens.VOCABULARY).vocabulary
    table = tokens.PrefixTable(vocabulary, data)
    for n in range(len(data) + 1):
        assert tokens.PrefixTable(vocabulary, data[:n]).ids() == _walk(table, n)
    table.cut(min(size, len(data)))
    table.extend(more)
    assert table.ids() == tokens.PrefixTable(vocabulary, data[:size] + more).ids()


def _walk(table, n):
    found = []
    while n:
        found.append(table.last[n])
        n -= len(table.vocabulary.token[table.last[n]])
    return found[::-1]


def test_an_edit_encodes_only_near_it(coder):
    text = "one two\n" * 500
    held = tokens.EncodedText(coder, text)
    assert held.edit(2000, 2003, "six") < 40


def test_encode_documents(spark, library, monkeypatch):
    rows = [(i, t, "clash", 1) for i, t in enumerate([*TEXTS, None])]
    df = spark.createDataFrame(rows + rows[:2], "doc_id bigint, text string, key string, body int")
    found = tokens.encode(df)
    assert found.columns == ["doc_id", "ids"] and found.count() == len(rows) + 2
    assert {r.doc_id: r.ids for r in found.collect()} == {i: library(t) if t else [] for i, t, *_ in rows}
    counted = tokens.with_token_counts(df)
    assert counted.columns == ["doc_id", "key", "body", "n_tokens"]
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {i: len(library(t)) if t else 0 for i, t, *_ in rows}
    assert tokens.encode(df.limit(0)).collect() == [] and tokens.with_token_counts(df.select("text").limit(0)).collect() == []


SAME = [
    ("file", "ﬁle"), ("ABC", "ＡＢＣ"), ("a b", "a b"), ("a b", "a　b"), ("é", "é"), ("cope", "соре"), ("ёж", "ёж"), ("ë", "ё"), ("x", "﻿x​"),
    ("so­ft", "soft"), ("Ａ́", "Á"), ("Тор", "Top"), ("ɡo", "gο"), ("カ", "ｶ"), ("e͏́", "é"), ("⚓", "⚓️"),
]
OTHER = [("0", "O"), ("I", "l"), ("a", "A"), ("e", "é"), ("a b", "a  b"), ("a\n", "a\r\n"), ("a\tb", "a b"), ("𝔢", "e"), ("²", "2"), ("в", "b"), ("½", "1/2")]


def pairs(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, form string")
    return sorted((r.doc_id_a, r.doc_id_b) for r in lookalike.lookalike_pairs(df, block=3).collect())


@pytest.mark.parametrize(("group", "equal"), [(SAME, True), (OTHER, False)])
def test_what_looks_the_same(spark, group, equal):
    texts = [f"{n} {t}" for n, pair in enumerate(group) for t in pair]
    assert pairs(spark, texts) == ([(2 * i, 2 * i + 1) for i in range(len(group))] if equal else [])


def test_pairs_of_large_classes_and_empty_texts(spark):
    texts = ["", None, " ", "​", " ", "ab", "ab", "аb", "a​b", "ａb", "ab", "z" * 5000, "ｚ" + "z" * 4999]
    same = [i for i, t in enumerate(texts) if t and len(t) < 5 and t.strip("​  ")]
    want = sorted([(i, j) for i in same for j in same if i < j and texts[i] != texts[j]] + [(11, 12)])
    assert pairs(spark, texts) == want
    assert pairs(spark, []) == []


def test_classes_and_forms(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "аb"), (3, "ab"), (4, "c"), (5, None)], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in lookalike.lookalike_classes(df).collect()) == [(1, 1, 3, 2), (2, 1, 3, 2), (3, 1, 3, 2), (4, 4, 1, 1)]
    assert {r.doc_id: r.canonical for r in lookalike.canonical_text(df).collect()} == {1: "ab", 2: "ab", 3: "ab", 4: "c", 5: None}
