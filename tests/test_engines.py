"""Outside engines: answers kept between runs, words of a reader, replies of endpoints, prompts by version."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from timeloom.sources import engines


class Counting:
    label = "m"

    def __init__(self, path):
        self.path = path

    def ask(self, payload, prompt):
        with open(self.path, "a") as f:
            f.write(payload.decode() + "\n")
        return ("refusal", "no") if payload == b"bad" else ("reading", f"{prompt}:{payload.decode()}")


def test_answers_outlive_a_run(spark, tmp_path):
    log = str(tmp_path / "asked")
    ask = lambda *payloads: {bytes(r.n).decode(): (r.status, r.answer) for r in engines.answer_stored(questions(*payloads), engines.StoredAnswers(spark, str(tmp_path / "kept"), 4), lambda: Counting(log)).collect()}
    questions = lambda *payloads: spark.createDataFrame([(bytearray(p), bytearray(p), "q") for p in payloads], "n binary, payload binary, prompt string")
    assert ask(b"a", b"b", b"bad", b"a") == {"a": ("reading", "q:a"), "b": ("reading", "q:b"), "bad": ("refusal", "no")}
    assert ask(b"a", b"c", b"bad") == {"a": ("cached", "q:a"), "c": ("reading", "q:c"), "bad": ("refusal", "no")}
    assert sorted(open(log).read().split()) == ["a", "b", "bad", "bad", "c"]  # a refusal is asked again
    kept = engines.StoredAnswers(spark, str(tmp_path / "kept"))
    kept.add(kept.read().selectExpr("key", "'later' as answer"))
    assert {r.answer for r in kept.read().collect()} == {"later"} and kept.read().count() == 3
    kept.add(kept.read().limit(0))
    assert kept.read().count() == 3


TABLE = "level\tleft\ttop\twidth\theight\tconf\ttext\n5\t10\t2\t30\t12\t96.123456\tSilo\n5\t50\t2\t5\t12\t-1\t\n5\t60\t2\t9\t12\t-1\tghost\n5\t70\t2\t9\t12\t50\t  \n5\t80\t2\t9\t11\t-0.5\tdim\n"


def test_words_of_a_reader(spark, tmp_path):
    words = [("Silo", 10, 40, 12, 0.9612), ("dim", 80, 89, 11, 0.0)]
    assert [tuple(w.values()) for w in engines.words_of_table(TABLE)] == words and engines.words_of_table("") == []
    (tmp_path / "table").write_text(TABLE)
    images = spark.createDataFrame([(1, bytearray(b"x")), (2, None)], "id int, image binary")
    found = {r.id: r.words for r in engines.read_words(images, "image", ["cat", str(tmp_path / "table")]).collect()}
    assert [tuple(w) for w in found[1]] == words and found[2] is None
    with pytest.raises(Exception, match="not installed"):
        engines.read_words(images, "image", ["no-such-reader"]).collect()


def test_replies_of_endpoints():
    part = lambda kind, **said: {"output": [{"type": "reasoning"}, {"type": "message", "content": [{"type": kind, **said}]}]}
    assert engines.from_items(part("output_text", text="a")) == ("reading", "a") and engines.from_items(part("refusal", refusal="no")) == ("refusal", "no")
    assert engines.from_blocks({"content": [{"type": "text", "text": "a"}], "stop_reason": "end_turn"}) == ("reading", "a") and engines.from_blocks({"content": [], "stop_reason": "refusal"}) == ("refusal", "refused")
    for read, reply in ((engines.from_items, {"status": "incomplete", "incomplete_details": {"reason": "max"}}), (engines.from_blocks, {"content": [], "stop_reason": "max_tokens"})):
        with pytest.raises(RuntimeError, match="cut off"):
            read(reply)


def test_a_question_over_http():
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["content-length"])))
            body = json.dumps({"content": [{"type": "text", "text": f"{asked['q']}/{self.headers['x-key']}"}], "stop_reason": "end_turn"}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        backend = engines.HttpBackend("b", f"http://127.0.0.1:{server.server_port}/", lambda payload, prompt: {"q": prompt + payload.decode()}, engines.from_blocks, {"x-key": "k"})
        assert backend.ask(b"1", "p") == ("reading", "p1/k")
    finally:
        server.shutdown()


def test_prompts_by_version():
    prompts = engines.Prompts({1: "one", 2: "two", 3: "three"}, superseded=(3,))
    assert prompts.text(2) == "two" and prompts.current() == 2
    with pytest.raises(ValueError, match="known: 1, 2, 3"):
        prompts.text(4)
