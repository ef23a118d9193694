"""Outside engines (readers of text or of screens) behind one interface, called once per question and cached."""

from __future__ import annotations

import json
import subprocess
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators.buckets import BucketStore
from timeloom.operators.state import cache_key
from timeloom.session import materialise


class Backend(Protocol):
    """``ask`` returns ("reading", text), ("refusal", reason) or raises; ``label`` names provider and model."""

    label: str

    def ask(self, payload: bytes, prompt: str) -> tuple[str, str]: ...


def with_key(questions: DataFrame, payload: str, prompt: str, label: str, version: str) -> DataFrame:
    """``questions`` with the key of everything an answer depends on."""
    return questions.withColumn("key", cache_key(F.sha2(payload, 256), F.lit(version), F.lit(label), F.col(prompt)))


def answer(questions: DataFrame, cache: DataFrame, backend: Callable[[], Backend], payload: str = "payload", prompt: str = "prompt", version: str = "1", batch_rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """(answers, new cache rows). Cached keys are not asked again; each missing key is asked once; refusals are answers
    but are not cached. ``backend`` builds the engine inside the worker, so that no client has to be sent there."""
    keyed = with_key(questions, payload, prompt, backend().label, version)
    known = cache.groupBy("key").agg(F.max("answer").alias("answer"))
    open_ = keyed.join(known, "key", "left_anti").groupBy("key").agg(F.first(payload).alias("p"), F.first(prompt).alias("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = backend()
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                said = [engine.ask(p, q) for p, q in zip(part.column("p").to_pylist(), part.column("q").to_pylist(), strict=True)]
                yield pa.record_batch({"key": part.column("key"), "status": pa.array([s for s, _ in said], pa.string()), "answer": pa.array([a for _, a in said], pa.string())})

    asked = materialise(open_.mapInArrow(run, "key string, status string, answer string"))  # never asked twice
    found = known.select("key", F.lit("cached").alias("status"), "answer").unionByName(asked)
    return keyed.join(found, "key", "left").drop(payload), asked.filter("status = 'reading'").select("key", "answer")


class StoredAnswers(BucketStore):
    """Answers by key, kept in buckets between runs; of a key that is answered again the later answer holds."""

    SCHEMA = "key string, answer string"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        super().__init__(spark, path, self.SCHEMA, buckets)

    def _touched(self, keys: DataFrame) -> list[int]:
        return [r[0] for r in keys.select(self.bucket("key")).distinct().collect()]  # at most the number of buckets

    def known(self, keys: DataFrame) -> DataFrame:
        """The stored answers in the buckets of ``keys``."""
        return self.read(self._touched(keys))

    def add(self, answers: DataFrame) -> None:
        new = materialise(answers.filter("key is not null and answer is not null").groupBy("key").agg(F.max("answer").alias("answer")))
        size, touched = new.count(), self._touched(new)
        if not size:
            return
        self.rows += size
        self.replace(self.read(touched).join(new.select("key"), "key", "left_anti").unionByName(new), touched, self.rows * len(touched) // self.buckets + size, "key", "key")


def answer_stored(questions: DataFrame, store: StoredAnswers, backend: Callable[[], Backend], payload: str = "payload", prompt: str = "prompt", version: str = "1") -> DataFrame:
    """:func:`answer` from a store, which is given the new readings; questions answered before are never asked again."""
    keyed = materialise(with_key(questions, payload, prompt, backend().label, version).select("key"))
    answers, new = answer(questions, store.known(keyed), backend, payload, prompt, version)
    answers = materialise(answers)
    store.add(new)
    return answers


class Prompts:
    """Prompt texts by version; asking for one that is not there is an error that names those that are."""

    def __init__(self, texts: dict[int, str], superseded: tuple[int, ...] = ()) -> None:
        self.texts, self.superseded = dict(texts), frozenset(superseded)

    def text(self, version: int) -> str:
        if version not in self.texts:
            raise ValueError(f"unknown prompt version {version}; known: {', '.join(map(str, sorted(self.texts)))}")
        return self.texts[version]

    def current(self) -> int:
        return max(v for v in self.texts if v not in self.superseded)


WORD = "struct<text:string,left:int,right:int,height:int,confidence:double>"


def words_of_table(table: str) -> list[dict]:
    """Words of a reader's table (tab-separated, with a heading): blank ones and those without a confidence left out,
    confidences of 0 to 100 as shares."""
    lines = [line.split("\t") for line in table.splitlines() if line.strip()]
    if not lines:
        return []
    at = {name: i for i, name in enumerate(lines[0])}
    out = []
    for row in lines[1:]:
        text = row[at["text"]].strip() if len(row) > at["text"] else ""
        sure = float(row[at["conf"]])
        if text and sure != -1:
            left, width = int(row[at["left"]]), int(row[at["width"]])
            out.append({"text": text, "left": left, "right": left + width, "height": int(row[at["height"]]), "confidence": round(max(sure / 100, 0.0), 4)})
    return out


def read_words(images: DataFrame, image: str, command: list[str], timeout_s: int = 60) -> DataFrame:
    """``images`` with words: what an outside reader says of each image, which it is given on its input. A reader that is
    not there, or fails, is an error; a null image has null words."""

    def read(data: bytes) -> list[dict]:
        try:
            done = subprocess.run(command, input=data, capture_output=True, timeout=timeout_s, check=True)
        except FileNotFoundError:
            raise RuntimeError(f"{command[0]} is not installed") from None
        return words_of_table(done.stdout.decode("utf-8", "replace"))

    @F.arrow_udf(f"array<{WORD}>")
    def run(values: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("text", pa.string()), ("left", pa.int32()), ("right", pa.int32()), ("height", pa.int32()), ("confidence", pa.float64())]))
        return pa.array([None if v is None else read(v) for v in values.to_pylist()], kind)

    return images.withColumn("words", run(F.col(image)))


class HttpBackend:
    """A model behind an HTTP endpoint: ``build(payload, prompt)`` makes the question, ``read(reply)`` tells what the answer is
    (:func:`from_items`, :func:`from_blocks`). Nothing is sent unless a pipeline is given one."""

    def __init__(self, label: str, url: str, build: Callable[[bytes, str], dict], read: Callable[[dict], tuple[str, str]], headers: dict[str, str] | None = None, timeout_s: int = 120) -> None:
        self.label, self.url, self.build, self.read, self.headers, self.timeout_s = label, url, build, read, headers or {}, timeout_s

    def ask(self, payload: bytes, prompt: str) -> tuple[str, str]:
        body = json.dumps(self.build(payload, prompt)).encode()
        with urllib.request.urlopen(urllib.request.Request(self.url, body, {"content-type": "application/json", **self.headers}), timeout=self.timeout_s) as reply:
            return self.read(json.load(reply))


def from_items(reply: dict) -> tuple[str, str]:
    """A reply of output items with parts: a refusal part refuses, an incomplete reply is an error."""
    if reply.get("status") == "incomplete":
        raise RuntimeError(f"the reply was cut off: {(reply.get('incomplete_details') or {}).get('reason')}")
    parts = [p for item in reply.get("output", []) for p in item.get("content") or []]
    refused = next((p["refusal"] for p in parts if p.get("type") == "refusal"), None)
    return ("refusal", refused) if refused is not None else ("reading", "".join(p["text"] for p in parts if p.get("type") == "output_text"))


def from_blocks(reply: dict) -> tuple[str, str]:
    """A reply of content blocks with a reason why it stopped: it may have refused, or been cut off (an error)."""
    text = "".join(b["text"] for b in reply.get("content", []) if b.get("type") == "text")
    if reply.get("stop_reason") == "refusal":
        return "refusal", text or "refused"
    if reply.get("stop_reason") == "max_tokens":
        raise RuntimeError("the reply was cut off: max_tokens")
    return "reading", text
