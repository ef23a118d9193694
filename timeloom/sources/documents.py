"""JSON, YAML and Markdown at the edges: manifests, inventories, fixtures, probe results, review documents."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.functions.timecode import format_timecode, parse_timecode
from timeloom.operators.resolve import duplicate_labels

IDENTITY = "struct<name:string,record:string,module:string,tabs:array<string>,section:string,dialog:string,description:string>"
SCREEN = f"struct<id:string,representative_frame:string,frame_ids:array<string>,t_ms_start:bigint,t_ms_end:bigint,identity:{IDENTITY},confidence:struct<score:double,signals:map<string,double>,verdict:string>>"
FRAME = "struct<id:string,t_ms:bigint,path:string,rectify:struct<method:string,quad_confidence:double,framing:string>,dedupe:struct<band_hash:string,distance_from_last_kept:double,kept:boolean>>"
SPAN = "struct<t_ms_start:bigint,t_ms_end:bigint,reason:string,detail:string,frame_ids:array<string>>"
WARNING = "struct<stage:string,message:string,t_ms_start:bigint,t_ms_end:bigint>"
VIDEO = "struct<slug:string,source_path:string,sha256:string,duration_s:double,width:int,height:int,fps:double,rotation:int,codec:string>"
MANIFEST = f"schema_version int, video {VIDEO}, stages_completed array<string>, stage_inputs map<string,map<string,string>>, frames array<{FRAME}>, screens array<{SCREEN}>, warnings array<{WARNING}>, review_spans array<{SPAN}>"
ENTRY = "struct<label:string,status:string,aliases:array<string>,route:string,module:string,source:string,component_paths:array<string>>"
INVENTORY = f"schema_version int, project string, generated_from struct<commit:string,sources:array<string>>, entries array<{ENTRY}>"
# The states an inventory entry may have; the last is an old spelling.
STATUSES = ("built", "lookup_scoped", "disabled", "stub", "patient_scoped")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per manifest; one that cannot be read is an error."""
    return spark.read.schema(T.StructType.fromDDL(MANIFEST)).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def entity(manifests: DataFrame, name: str) -> DataFrame:
    """The rows of one list of the manifests, with their slug."""
    return manifests.select(F.col("video.slug").alias("slug"), F.explode(name).alias("e")).select("slug", "e.*")


def write_manifests(manifests: DataFrame, path: str) -> None:
    """One line of JSON per manifest, null fields kept, the same text for the same rows."""
    lines = manifests.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"), F.col("video.slug").alias("slug"))
    lines.orderBy("slug").select("value").write.mode("overwrite").text(path)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(project, commit, entry_ord, entry fields) in file order; unknown fields are dropped."""
    whole = spark.read.schema(T.StructType.fromDDL(INVENTORY)).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    rows = whole.select("project", F.col("generated_from.commit").alias("commit"), F.posexplode("entries").alias("entry_ord", "e")).select("project", "commit", "entry_ord", "e.*")
    return rows.withColumn("status", F.when(F.col("status") == "patient_scoped", "lookup_scoped").otherwise(F.col("status")))


def check_inventory(entries: DataFrame) -> None:
    """Raises where a label is empty or not unique once normalised, or a status is unknown."""
    bad = entries.filter(~F.col("status").isin(*STATUSES) | F.col("status").isNull()).limit(5).collect()
    if bad:
        raise ValueError(f"unknown status: {[(r.label, r.status) for r in bad]}")
    double = duplicate_labels(entries, "entry_ord", "label").limit(5).collect()
    if double:
        raise ValueError(f"labels empty or not unique: {[r.norm for r in double]}")


def parse_probe(text: Column) -> Column:
    """struct(width, height, fps, duration_s, rotation, codec) of a container probe's JSON; null parts where missing."""
    said = F.from_json(
        text,
        "streams array<struct<codec_type:string,codec_name:string,width:int,height:int,avg_frame_rate:string,r_frame_rate:string,duration:string,"
        "tags:map<string,string>,side_data_list:array<struct<rotation:double>>>>, format struct<duration:string>",
    )
    video = F.get(F.filter(said["streams"], lambda s: s["codec_type"] == "video"), F.lit(0))

    def rate(value: Column) -> Column:
        parts = F.split(value, "/")
        found = F.try_divide(F.get(parts, F.lit(0)).try_cast("double"), F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).try_cast("double"))
        return F.when(found > 0, found)

    positive = lambda value: F.when(value.try_cast("double") > 0, value.try_cast("double"))
    side = F.get(F.filter(F.transform(video["side_data_list"], lambda s: s["rotation"]), lambda r: r.isNotNull()), F.lit(0))
    turn = F.coalesce(side, F.try_element_at(video["tags"], F.lit("rotate")).try_cast("double"), F.lit(0.0))
    return F.struct(
        video["width"].alias("width"), video["height"].alias("height"), F.coalesce(rate(video["avg_frame_rate"]), rate(video["r_frame_rate"])).alias("fps"),
        F.coalesce(positive(video["duration"]), positive(said["format"]["duration"])).alias("duration_s"), F.pmod(turn.cast("int"), F.lit(360)).alias("rotation"), video["codec_name"].alias("codec"),
    )


def sibling_path(path: Column, frames: str) -> Column:
    """The path of the same frame in another set of frames (raw, rect, clean, kept)."""
    return F.regexp_replace(path, r"(^|/)raw/", f"$1{frames}/")


FIXTURE_SCREENS = "slug string, ord bigint, t string, name string, module string, bucket string, note string"
FIXTURE_GAPS = "slug string, ord bigint, from_ string, to_ string, note string"


def read_fixture(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(screens, gaps) of a YAML fixture, with t_ms; of a repeated key the last counts."""
    import yaml

    said = yaml.load(Path(path).read_text(), Loader=yaml.BaseLoader) or {}
    text = lambda v: None if v in (None, "", "null", "~") else str(v)
    screens = [(said.get("slug"), i, *(text(s.get(c)) for c in ("t", "name", "module", "bucket", "note"))) for i, s in enumerate(said.get("screens") or [])]
    gaps = [(said.get("slug"), i, *(text(s.get(c)) for c in ("from", "to", "note"))) for i, s in enumerate(said.get("missed_spans") or [])]
    return (
        spark.createDataFrame(screens, FIXTURE_SCREENS).withColumn("t_ms", parse_timecode(F.col("t"))),
        spark.createDataFrame(gaps, FIXTURE_GAPS).withColumn("t_ms_start", parse_timecode(F.col("from_"))).withColumn("t_ms_end", parse_timecode(F.col("to_"))),
    )


def yaml_scalar(value: Column) -> Column:
    quoted = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.coalesce(F.concat(F.lit('"'), quoted, F.lit('"')), F.lit("null"))


def fixture_lines(screens: DataFrame) -> DataFrame:
    """(slug, t_ms_start, block): the fixture entry of each screen."""
    block = F.concat_ws(
        "\n", F.concat(F.lit("  - t: "), yaml_scalar(format_timecode(F.col("t_ms_start")))), F.concat(F.lit("    name: "), yaml_scalar(F.col("name"))),
        F.concat(F.lit("    module: "), yaml_scalar(F.col("module"))),
    )
    return screens.select("slug", "t_ms_start", block.alias("block"))


def markdown_cell(value: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(value, F.lit("—")), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " ")


def markdown_table(rows: DataFrame, columns: dict[str, Column], *order: str) -> DataFrame:
    """Lines (value) of a Markdown table with its rows in order."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(markdown_cell(c.cast("string")) for c in columns.values())), F.lit(" |"))
    head = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    top = rows.sparkSession.createDataFrame([(i - 2, h) for i, h in enumerate(head)], "n long, value string")
    from timeloom.operators.numbering import numbered

    keys = [f"_o{i}" for i in range(len(order))]
    keyed = rows.select(*(F.col(c).alias(k) for c, k in zip(order, keys, strict=True)), line.alias("value"))
    body = numbered(keyed, *keys, "value", name="n").select("n", "value")
    return top.unionByName(body).orderBy("n").select("value")


def write_lines(lines: DataFrame, path: str) -> None:
    """Ordered lines as text files whose names keep the order."""
    lines.write.mode("overwrite").text(path)


def write_documents(lines: DataFrame, path: str, heads: dict[str, str] | None = None) -> None:
    """(slug, document, n, line) as text under ``path/slug=…/document=…``, the lines of a document in the order of n.

    Documents are written side by side; one longer than a task is continued in further files, whose names keep the order.
    ``heads``: the first line of each kind of document.
    """
    if heads:
        titles = F.create_map(*(F.lit(x) for kv in heads.items() for x in kv))
        tops = lines.select("slug", "document").distinct().select("slug", "document", F.lit(0).cast("bigint").alias("n"), titles[F.col("document")].alias("line"))
        lines = lines.select("slug", "document", F.col("n").cast("bigint").alias("n"), "line").unionByName(tops.filter("line is not null"))
    spread = lines.repartitionByRange("slug", "document", "n").sortWithinPartitions("slug", "document", "n")
    spread.select("slug", "document", F.col("line").alias("value")).write.mode("overwrite").partitionBy("slug", "document").text(path)


def publish(lines: DataFrame, path: str) -> str | None:
    """A second copy; a failure is returned as a warning, not raised."""
    try:
        write_lines(lines, path)
    except Exception as e:
        return f"could not publish to {path}: {e}"
    return None
