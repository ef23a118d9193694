"""The stages of a run, over all videos at once: each gives its rows, its warnings and the spans that need review.

A video is never handled alone: tables are keyed by slug and every stage is one plan over all of them. What a stage could
not settle becomes a span (slug, t_ms_start, t_ms_end, reason ``NN:why``, detail, frames), what changes how its result is
to be read becomes a warning (slug, stage, message). :func:`stages` puts them into a :class:`timeloom.plans.stages.Pipeline`.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions.geometry import BORDER_PX
from timeloom.functions.labels import normalise_label, normalise_label_text
from timeloom.functions.similarity import similarity
from timeloom.operators import confidence, folds, numbering, resolve, timeline
from timeloom.plans.stages import Pipeline, Stage
from timeloom.session import materialise

# Bucket of a matched entry by its status; weight of a name that matches nothing, with and without a likely entry.
STATUS_BUCKET = {"built": "built", "lookup_scoped": "built", "patient_scoped": "built", "disabled": "new", "stub": "new"}
UNMATCHED_LIKELY, UNMATCHED_UNLIKE = 0.25, 0.5
SPAN = "slug string, t_ms_start bigint, t_ms_end bigint, reason string, detail string, frames string"
WARNING = "slug string, stage string, message string"


@dataclass
class Result:
    rows: DataFrame
    spans: DataFrame
    warnings: DataFrame

    def parts(self) -> dict[str, DataFrame]:
        return {"rows": self.rows, "spans": self.spans, "warnings": self.warnings}


def _spans(rows: DataFrame, start: Column, end: Column, reason: Column | str, detail: Column, frames: Column) -> DataFrame:
    why = F.lit(reason) if isinstance(reason, str) else reason
    columns = {"t_ms_start": start.cast("bigint"), "t_ms_end": end.cast("bigint"), "reason": why, "detail": detail.cast("string"), "frames": frames.cast("string")}
    return rows.select("slug", *(c.alias(n) for n, c in columns.items()))


def _warnings(rows: DataFrame, stage: str, message: Column) -> DataFrame:
    return rows.select("slug", F.lit(stage).alias("stage"), message.alias("message"))


def _none(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def _at_ms(idx: Column, fps: float) -> Column:
    return F.bround(idx * 1000.0 / fps).cast("bigint")


def _required(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def probe(videos: DataFrame) -> Result:
    """00: videos with the size they are shown at; a rotated one is warned of."""
    turned = F.pmod(F.abs("rotation"), F.lit(180)) == 90
    shown = videos.withColumn("shown_width", F.when(turned, F.col("height")).otherwise(F.col("width"))).withColumn("shown_height", F.when(turned, F.col("width")).otherwise(F.col("height")))
    message = F.format_string("rotated by %d degrees, shown as %dx%d", "rotation", "shown_width", "shown_height")
    return Result(shown, _none(videos, SPAN), _warnings(shown.filter("rotation <> 0"), "00", message))


def sample(videos: DataFrame, fps: float, max_frames: int, skip_ranges: list[tuple[int, int]], sizes: DataFrame | None = None) -> Result:
    """01: the grid of every video (slug, idx, t_ms, frame_id) up to ``max_frames``, without the ranges to skip. ``sizes``
    (slug, frame_width, frame_height) are those that frames came out with."""
    expected = timeline.expected_samples(F.col("duration_s"), fps)
    counted = videos.withColumn("_n", F.coalesce(F.least(expected, F.lit(max_frames)), F.lit(0))).withColumn("_all", F.coalesce(expected, F.lit(0)))
    grid = timeline.grid(counted.filter("_n > 0").select("slug", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("idx")), "idx", fps)
    cut = counted.filter("_all > _n")
    since = _at_ms(F.col("_n"), fps)
    last = F.bround(F.col("duration_s") * 1000).cast("bigint")
    spans = _spans(cut, since, last, "01:not-sampled", F.format_string("%d of %d frames are sampled", "_n", "_all"), F.lit(None))
    warned = _warnings(cut, "01", F.format_string("only %d of %d frames are sampled", "_n", "_all"))
    if sizes is not None:
        w, h, fw, fh = F.col("shown_width"), F.col("shown_height"), F.col("frame_width"), F.col("frame_height")
        said = F.when((w == fw) & (h == fh), "equal").when((w == fh) & (h == fw), "swapped").otherwise("other")
        wrong = counted.join(sizes, "slug").withColumn("_said", said).filter("_said <> 'equal' and _n > 0")
        detail = F.format_string("frames are %dx%d where %dx%d was due (%s)", "frame_width", "frame_height", "shown_width", "shown_height", "_said")
        spans = spans.unionByName(_spans(wrong, F.lit(0), _at_ms(F.col("_n") - 1, fps), "01:orientation-mismatch", detail, F.lit(None)))
        warned = warned.unionByName(_warnings(wrong, "01", detail))
    return Result(timeline.skip_ranges(grid, "t_ms", skip_ranges), spans, warned)


def _runs(rows: DataFrame, kind: Column, position: str, frame: str) -> DataFrame:
    """(slug, kind, first, last, n, frames, t_ms_start, t_ms_end) of runs of neighbours of one kind; null kinds are in none."""
    marked = rows.select("slug", kind.alias("kind"), position, frame, "t_ms").filter("kind is not null")
    runs = timeline.islands(marked, ["slug", "kind"], position)
    at = lambda c, name: marked.select("slug", "kind", F.col(position).alias(c), F.col(frame).alias(f"{c}_frame"), F.col("t_ms").alias(name))
    found = runs.join(at("first", "t_ms_start"), ["slug", "kind", "first"]).join(at("last", "t_ms_end"), ["slug", "kind", "last"])
    frames = F.when(F.col("n") == 1, F.col("first_frame")).otherwise(F.concat_ws("–", "first_frame", "last_frame"))
    return found.withColumn("frames", frames).drop("first_frame", "last_frame")


def rectify(
    frames: DataFrame, detections: DataFrame, size: tuple[int, int], window: int, diagonal: float, max_jump: float, min_confidence: float, after: int, in_order: bool = False
) -> Result:
    """02: the centre of the screen in every frame: (slug, position, idx, t_ms, frame_id, x, y, method, framing).

    ``frames``: slug, position (dense), idx, t_ms, frame_id; ``detections``: slug, idx, x, y, sure, by_hand, at most one a
    frame; None where ``frames`` has these columns. Detections that jump are dropped unless enough of them agree, positions
    are smoothed over ``window`` rows and gaps of at most so many filled.
    """
    seen = frames if detections is None else frames.join(detections, ["slug", "idx"], "left")
    seen = seen.withColumn("by_hand", F.coalesce("by_hand", F.lit(False)))
    track = folds.reanchored(seen, "slug", ["position"], "position", "x", "y", "sure", "by_hand", diagonal, max_jump, min_confidence, after, in_order)
    placed = materialise(seen.drop("x", "y", "sure", "by_hand").join(track, ["slug", "position"]))
    for c in ("x", "y"):
        placed = timeline.median_smooth(placed, "slug", "position", c, window, F.col("method") == "manual", name=f"_{c}")
        placed = timeline.interpolate_gaps(placed, "slug", "position", f"_{c}", window, name=f"{c}_").withColumnRenamed("interpolated", f"_i{c}")
    how = F.when(F.col("x_").isNull(), "failed").when(F.col("method") == "manual", "manual").when(F.col("_ix"), "interpolated").otherwise("auto")
    edge = (F.least("x_", "y_") <= BORDER_PX) | (F.col("x_") >= size[0] - 1 - BORDER_PX) | (F.col("y_") >= size[1] - 1 - BORDER_PX)
    framing = F.when(F.col("x_").isNull(), "lost").when(edge, "partial").otherwise("full")
    rows = placed.select(
        "slug", "position", "idx", "t_ms", "frame_id", F.col("x_").alias("x"), F.col("y_").alias("y"), F.col("method").alias("_track"), how.alias("method"), framing.alias("framing")
    )
    rows = materialise(rows)
    bad = _runs(rows, F.when(F.col("framing") != "full", F.col("framing")), "position", "frame_id")
    why = F.when(F.col("kind") == "lost", "02:screen-not-found").otherwise("02:screen-partial")
    spans = _spans(bad, F.col("t_ms_start"), F.col("t_ms_end"), why, F.format_string("%d frames", "n"), F.col("frames"))
    anew = _runs(rows, F.when(F.col("_track") == "reanchor", F.lit("reanchor")), "position", "frame_id").select("slug", F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(max(after, 2)))).alias("position"))
    ends = anew.select("slug", "position", (F.col("position") + max(after, 2) - 1).alias("last"))  # each took as many frames as had to agree
    at = rows.select("slug", "position", F.col("t_ms").alias("t0"), F.col("frame_id").alias("f0"))
    to = rows.select("slug", F.col("position").alias("last"), F.col("t_ms").alias("t1"), F.col("frame_id").alias("f1"))
    moved = ends.join(at, ["slug", "position"]).join(to, ["slug", "last"])
    spans = spans.unionByName(_spans(moved, F.col("t0"), F.col("t1"), "02:reanchor", F.lit("found again elsewhere: was the camera moved?"), F.concat_ws("–", "f0", "f1")))
    counts = rows.groupBy("slug").agg(F.count_if(F.col("_track") == "jump").alias("jumps"), F.count_if(F.col("method") == "failed").alias("failed"), F.count("*").alias("n"))
    warned = _warnings(counts.filter("jumps > 0"), "02", F.format_string("%d detections jumped and were dropped", "jumps"))
    warned = warned.unionByName(_warnings(counts.filter("failed > 0"), "02", F.format_string("%d of %d frames without a screen", "failed", "n")))
    return Result(rows.drop("_track"), spans, warned)


def clean(frames: DataFrame) -> Result:
    """03: the frames that can be cleaned, those with a position (pixels: :func:`timeloom.sources.images.cleaned`)."""
    return Result(_required(frames.filter("method <> 'failed'"), "no frame can be cleaned"), _none(frames, SPAN), _none(frames, WARNING))


def dedupe(frames: DataFrame, threshold: float, weight: float, min_gap: int, in_order: bool = False) -> Result:
    """04: screens (slug, id, t_ms_start, t_ms_end, representative_frame, n, frame_ids as text) of ``frames`` (slug, position,
    idx, t_ms, frame_id, band, whole): from each kept frame to the next."""
    kept = materialise(folds.last_kept(frames, "slug", ["position"], "position", "band", "whole", threshold, weight, min_gap, "frame_id", in_order))
    _required(kept.filter("kept"), "no frame is kept")
    joined = folds.segments(folds.last_kept(frames, "slug", ["position"], "position", "band", "whole", threshold, weight, min_gap, "frame_id", in_order), "slug", "position", "frame_id")
    at = lambda c, name: frames.select("slug", F.col("position").alias(c), F.col("t_ms").alias(name))
    screens = joined.join(at("first_idx", "t_ms_start"), ["slug", "first_idx"]).join(at("last_idx", "t_ms_end"), ["slug", "last_idx"]).select(
        "slug", F.format_string("s_%03d", "segment").alias("id"), "t_ms_start", "t_ms_end", F.col("representative").alias("representative_frame"), "n", F.col("members").alias("frame_ids"), "segment"
    )
    held = kept.filter("suppressed").select("slug", "position", "frame_id", "distance").join(at("position", "t_ms"), ["slug", "position"])
    spans = _spans(held, F.col("t_ms"), F.col("t_ms"), "04:gap-suppressed", F.format_string("differs by %s from the last kept frame", F.col("distance").cast("string")), F.col("frame_id"))
    counts = held.groupBy("slug").agg(F.count("*").alias("n"))
    return Result(screens, spans, _warnings(counts, "04", F.format_string("%d frames differ but came too early to be kept", "n")))


def read_text(screens: DataFrame, words: DataFrame, least: float) -> Result:
    """05: screens with what was read on their representative frame: title, title_confidence, labels of the tabs. ``words``:
    (slug, frame_id, region, words: array of struct(text, left, right, height, confidence)), at most one row a region."""
    _required(screens, "no screens to read")
    lines = words.groupBy("slug", "frame_id").agg(*(F.max(F.when(F.col("region") == r, F.col("words"))).alias(r) for r in ("title", "tabs")))
    title = timeline.join_words(F.coalesce("title", F.array().cast(words.schema["words"].dataType)), least)
    tabs = timeline.labels_by_gaps(F.coalesce("tabs", F.array().cast(words.schema["words"].dataType)), least)
    read = lines.select("slug", F.col("frame_id").alias("representative_frame"), title.alias("t"), tabs.alias("ocr_tabs"))
    read = read.select("slug", "representative_frame", F.col("t.text").alias("title"), F.col("t.confidence").alias("title_confidence"), "ocr_tabs")
    rows = screens.join(read, ["slug", "representative_frame"], "left")
    blind = rows.filter("title is null")
    spans = _spans(blind, F.col("t_ms_start"), F.col("t_ms_end"), "05:title-unreadable", F.lit("no word of the title was read with confidence"), F.col("representative_frame"))
    return Result(rows, spans, _warnings(blind.groupBy("slug").agg(F.count("*").alias("n")), "05", F.format_string("%d screens without a readable title", "n")))


def unresolved(screens: DataFrame, every: bool) -> DataFrame:
    """The screens whose whole frame is to be read: all, or those without a name."""
    return screens if every else screens.filter("name is null")


def identify(screens: DataFrame, readings: DataFrame, corroborating: DataFrame, framing: DataFrame, weights: dict[str, float], threshold: float) -> Result:
    """06: screens with identity (name, module, tabs, dialog, description) and confidence (score, coverage, verdict, missing).

    ``readings``: (slug, frame_id, name, module, tabs, dialog, description, at), of several of a frame the last by ``at``;
    ``corroborating``: (slug, id, other_name), what another frame of the screen was read as; ``framing``: (slug, id,
    framing_quality). Readings of frames that no screen stands for are told as misattributed.
    """
    last = readings.groupBy("slug", F.col("frame_id").alias("representative_frame")).agg(F.max_by(F.struct("name", "module", "tabs", "dialog", "description"), "at").alias("identity"))
    rows = screens.join(last, ["slug", "representative_frame"], "left").join(corroborating, ["slug", "id"], "left").join(framing, ["slug", "id"], "left")
    rows = rows.select("*", "identity.*")
    blank = F.coalesce("name", F.lit("")) == ""
    why = F.when(F.col("identity").isNull(), "no reading").when(F.col("name").isNull(), "the title could not be read")
    both = (~blank) & (F.coalesce("other_name", F.lit("")) != "")
    # of two names the first is the most frequent one: the mean of its likeness to itself and of the other's to it
    cross = F.when(both, F.rint((1 + similarity(F.col("other_name"), F.col("name"))) * 5_000) / 10_000)
    signals = {"ocr_agreement": confidence.text_agreement(F.col("name"), F.col("title")), "cross_frame": cross, "framing": F.col("framing_quality")}
    rows = materialise(rows.withColumn("confidence", confidence.combine(signals, weights, threshold, why)).withColumn("unreadable", why).drop("identity", "other_name"))
    poor = rows.filter("confidence.verdict = 'review'")
    detail = F.concat(F.coalesce("name", F.lit("unidentified")), F.lit(": "), confidence.reason_of(F.col("confidence"), F.col("unreadable"), threshold))
    spans = _spans(poor, F.col("t_ms_start"), F.col("t_ms_end"), "06:low-confidence", detail, F.col("representative_frame"))
    foreign = readings.join(screens.select("slug", F.col("representative_frame").alias("frame_id")), ["slug", "frame_id"], "left_anti").groupBy("slug").agg(F.count("*").alias("n"))
    return Result(rows, spans, _warnings(foreign, "06", F.format_string("%d readings of frames that were not asked for", "n")))


def bucket_of(status: Column, module: Column, label: Column, scope: list[str], partial: list[str]) -> Column:
    """The bucket of a matched entry: out of scope is ``other``, a label named as partial is so if it is built."""
    known = F.create_map(*(F.lit(x) for kv in STATUS_BUCKET.items() for x in kv))
    inside = F.coalesce(normalise_label(module), F.lit("")).isin([normalise_label_text(m) for m in scope]) if scope else F.lit(True)
    named = F.coalesce(normalise_label(label), F.lit("")).isin([normalise_label_text(p) for p in partial]) if partial else F.lit(False)
    bucket = F.get(F.transform(F.array(status), lambda s: known[s]), F.lit(0))
    return F.when(~inside, "other").when((bucket == "built") & named, "partial").otherwise(bucket)


def inventory_signal(kind: Column, score: Column, possible: Column) -> Column:
    """What a match says for a reading: its score; where nothing matched a little, less if an entry was near."""
    return F.when(kind == "none", F.when(possible.isNotNull(), UNMATCHED_LIKELY).otherwise(UNMATCHED_UNLIKE)).otherwise(score)


def classify(screens: DataFrame, entries: DataFrame, corrections: dict[str, str], threshold: float, margin: float, scope: list[str], partial: list[str], entry: str = "entry_id") -> Result:
    """07: screens (slug, id, t_ms_start, t_ms_end, representative_frame, name, tabs, dialog, ...) with match_kind, match_score,
    matched_label, possible_label, bucket, route, entry_module, component_paths, evidence. A reviewer is asked once per subject."""
    named = screens.withColumn("_norm", normalise_label(F.col("name")))
    found = resolve.match_cascade(named, resolve.reference_names(entries, entry, "label", "aliases"), corrections, threshold, "_norm")
    evidence = F.concat_ws(" · ", "status", F.nullif("source", F.lit("")))
    known = entries.select(
        F.col(entry).alias("matched_ord"), bucket_of(F.col("status"), F.col("module"), F.col("label"), scope, partial).alias("_bucket"), "route", F.col("module").alias("entry_module"),
        "component_paths", evidence.alias("evidence"),
    )
    rows = found.join(known, "matched_ord", "left").withColumn("bucket", F.when(F.col("matched_ord").isNull(), "new").otherwise(F.col("_bucket")))
    rows = materialise(rows.drop("_bucket").withColumn("inventory_match", inventory_signal(F.col("match_kind"), F.col("match_score"), F.col("possible_label"))))
    near = rows.filter("matched_ord is null and possible_label is not null").filter((F.col("match_kind") == "subset") | (F.col("match_score") >= threshold - margin))
    subject = F.when(F.coalesce("name", F.lit("")) != "", F.col("_norm")).otherwise(F.col("id"))
    shown = F.array_join(F.coalesce("tabs", F.array().cast("array<string>")), ", ")
    asks = near.select(
        "slug", F.lit("near-miss").alias("question"), subject.alias("subject"), "t_ms_start", "id", "t_ms_end", "representative_frame",
        F.when(F.col("match_kind") == "subset", "07:contained-name").otherwise("07:near-miss-match").alias("reason"),
        F.concat(F.lit("read as "), F.coalesce("name", F.lit("")), F.lit("; nearest entry "), "possible_label").alias("detail"),
    )
    built = rows.filter((F.col("bucket") == "built") & ((F.size("tabs") > 0) | (F.coalesce("dialog", F.lit("")) != "")))
    asks = asks.unionByName(built.select(
        "slug", F.lit("confirm-partial").alias("question"), normalise_label(F.col("matched_label")).alias("subject"), "t_ms_start", "id", "t_ms_end", "representative_frame",
        F.lit("07:confirm-partial").alias("reason"), F.concat(F.col("matched_label"), F.lit(" is built; seen: "), shown, F.lit("; "), F.coalesce("dialog", F.lit(""))).alias("detail"),
    ))
    first = asks.groupBy("slug", "question", "subject").agg(F.min(F.struct("t_ms_start", "id", "t_ms_end", "representative_frame", "reason", "detail")).alias("f")).select("slug", "f.*")
    spans = _spans(first, F.col("t_ms_start"), F.col("t_ms_end"), F.col("reason"), F.col("detail"), F.col("representative_frame"))
    return Result(rows.drop("_norm"), spans, _none(screens, WARNING))


def rescored(screens: DataFrame, weights: dict[str, float], threshold: float) -> DataFrame:
    """Confidence once more with the inventory as a signal, where it has a weight; ``screens`` have the signals as columns."""
    if weights.get("inventory_match", 0) <= 0:
        return screens
    signals = {n: F.col(n) for n in weights if n in screens.columns}
    return screens.withColumn("confidence", confidence.combine(signals, weights, threshold, F.col("unreadable")))


def emit(screens: DataFrame, spans: DataFrame, warnings: DataFrame, done: list[str], expected: list[str]) -> dict[str, DataFrame]:
    """08: the documents as rows of lines: catalogue, queue and review, each (slug, n, line), and counts (slug, bucket, screens)."""
    from timeloom.plans import documents

    _required(screens, "no screens to emit")
    missing = [s for s in expected if s not in done]
    if missing:
        slugs = screens.select("slug").distinct()
        warnings = warnings.unionByName(_warnings(slugs, "08", F.lit(f"stages that have not run: {', '.join(missing)}")))
    return {
        "catalogue": documents.catalogue(screens), "queue": documents.queue(screens), "review": documents.review(spans), "warnings": documents.warnings(warnings),
        "counts": screens.groupBy("slug", "bucket").agg(F.count("*").alias("screens")),
    }


def stages(pipeline: Pipeline, tables: dict[str, DataFrame]) -> Pipeline:
    """The nine stages over ``tables``: videos, detections, measures, words, readings, corroborating, inventory."""
    numbered = lambda df: numbering.numbered_within(df, "slug", "idx", name="position")

    def all_of(inputs: dict[str, Any], part: str) -> DataFrame:
        out = None
        for name in pipeline.stages:
            if name in inputs and name != "08":
                df = inputs[name][part]
                out = df if out is None else out.unionByName(df)
        return out

    def quality(inputs, screens):
        """The least framing quality of the frames of each screen."""
        members = screens.select("slug", "id", F.explode(F.split("frame_ids", ",")).alias("frame_id"))
        framed = members.join(inputs["02"]["rows"].select("slug", "frame_id", "method", "framing"), ["slug", "frame_id"]).withColumn("_k", F.struct("slug", "id"))
        return confidence.framing_quality(framed, "_k", F.col("method"), F.col("framing")).select("_k.slug", "_k.id", "framing_quality")

    add = lambda name, run, requires, sections=(): pipeline.add(Stage(name, run, requires, sections))
    add("00", lambda i, c: probe(tables["videos"]).parts(), ())
    add("01", lambda i, c: sample(i["00"]["rows"], c["sample"].fps, c["sample"].max_frames, list(c["sample"].skip_ranges), tables.get("sizes")).parts(), ("00",), ("sample",))

    def stage02(i, c):
        r, size = c["rectify"], c["rectify"].canonical_size
        diagonal = (size[0] ** 2 + size[1] ** 2) ** 0.5
        frames = numbered(_required(i["01"]["rows"], "no frames to rectify"))
        return rectify(frames, tables["detections"], size, r.smooth_window, diagonal, r.max_jump_fraction, r.min_quad_confidence, r.reanchor_after_frames).parts()

    add("02", stage02, ("01",), ("rectify",))
    add("03", lambda i, c: clean(i["02"]["rows"]).parts(), ("02",), ("clean",))

    def stage04(i, c):
        measured = i["03"]["rows"].drop("position").join(tables["measures"], ["slug", "idx"])
        return dedupe(materialise(numbered(measured)), c["dedupe"].hash_distance, c["dedupe"].full_frame_weight, c["dedupe"].min_gap_frames).parts()

    add("04", stage04, ("03",), ("dedupe",))
    add("05", lambda i, c: read_text(i["04"]["rows"], tables["words"], c["ocr"].min_word_confidence).parts(), ("04",), ("ocr",))

    def stage06(i, c):
        screens = i["05"]["rows"]
        return identify(screens, tables["readings"], tables["corroborating"], quality(i, screens), dict(c["confidence"].weights), c["confidence"].accept_threshold).parts()

    add("06", stage06, ("05", "02"), ("identify", "confidence"))

    def stage07(i, c):
        k = c["classify"]
        return classify(i["06"]["rows"], tables["inventory"], dict(k.aliases), k.fuzzy_threshold, k.near_miss_margin, list(k.modules_in_scope), list(k.partial_labels)).parts()

    add("07", stage07, ("06",), ("classify",))
    expected = ["01", "02", "03", "04", "05", "06"]
    add("08", lambda i, c: emit(i["07"]["rows"], all_of(i, "spans"), all_of(i, "warnings"), list(pipeline.stages), expected), ("00", "01", "02", "03", "04", "05", "06", "07"))
    return pipeline
