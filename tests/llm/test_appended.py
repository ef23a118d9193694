"""Appending encodes only the end again, and gives what encoding the whole gives."""

from __future__ import annotations

from timeloom.llm import tokens
from timeloom.plans.tables import table


def test_appended_is_the_whole_encoded(spark, sf):
    coder = tokens.encoder(tokens.VOCABULARY)
    docs = table(spark, sf, "documents").selectExpr("doc_id", "text", "case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then '' when doc_id % 5 = 2 then ' ' || path else path end as more")
    found = {r.doc_id: r for r in tokens.appended(docs, "doc_id", "text", "more").collect()}
    rows = docs.collect()
    assert len(found) == len(rows) == docs.count()
    for r in rows:
        text, more = r.text or "", r.more or ""
        assert found[r.doc_id].n_tokens == len(coder.ids(text + more)) and found[r.doc_id].n_before == len(coder.ids(text))
    assert sum(f.again for f in found.values()) < 0.2 * sum(len(r.text or "") for r in rows)


def test_appending_piece_by_piece():
    coder = tokens.encoder(tokens.VOCABULARY)
    for text in ("", "a", " a", "word  two\n\n  three's 1234 é漢字 <|endoftext|> x", "\n\n\n", "tab\t\tx   "):
        for size in (1, 2, 5):
            held = tokens.EncodedText(coder)
            for at in range(0, len(text), size):
                held.append(text[at : at + size])
            assert held.ids() == coder.ids(text) and held.size() == len(held.ids())
