from __future__ import annotations

import unicodedata

from timeloom.llm import lookalike


def test_accented_lookalikes_meet_their_latin_letters(spark):
    base = dict(zip(lookalike.CYRILLIC + lookalike.GREEK + lookalike.OTHER, lookalike.CYRILLIC_AS + lookalike.GREEK_AS + lookalike.OTHER_AS, strict=True))
    marks = ["̀", "́", "̂", "̄", "̆", "̈", "̓", "̔", "̓́", "̣", "​́"]
    rows = []
    for letter, latin in base.items():
        for mark in marks:
            rows += [(len(rows), f"x{letter}{mark}"), (len(rows) + 1, unicodedata.normalize("NFC", f"x{letter}{mark}")), (len(rows) + 2, f"x{latin}{mark}")]
    forms = {r.doc_id: r.canonical for r in lookalike.canonical_text(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [rows[i : i + 3] for i in range(0, len(rows), 3) if len({forms[i], forms[i + 1], forms[i + 2]}) > 1] == []


def test_documents_of_accented_lookalikes_are_paired(spark):
    texts = ["mό", "mó", "Άlpha", "Álpha", "bўz", "by̆z", "bӱz", "bÿz", "ά", "á"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted((r.doc_id_a, r.doc_id_b) for r in lookalike.lookalike_pairs(docs).collect()) == [(0, 1), (2, 3), (4, 5), (6, 7)]
    classes = {r.doc_id: (r.class_id, r.members, r.spellings) for r in lookalike.lookalike_classes(docs).collect()}
    assert classes[1] == (0, 2, 2) and classes[9] == (9, 1, 1)
