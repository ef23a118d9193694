"""Text that looks the same brought to one form: DuckDB inside Arrow partitions.

Every Arrow batch is handed to an embedded DuckDB and normalised by one SQL statement of ``nfc_normalize``,
``translate``, ``replace`` and ``regexp_replace``:

1. characters that draw nothing are dropped (zero-width, directional, soft hyphen, variation selectors, ...);
2. accents are composed (NFC), so that what follows sees one spelling of an accented letter;
3. full- and half-width forms, kinds of space and letters of other alphabets drawn like Latin ones are mapped, with
   every accent that is composed with them;
4. joined letters are taken apart;
5. accents are composed again, now over the mapped letters.

Not mapped, because they do not look the same: mathematical alphabets, superscripts, fractions, letters against
digits, ``I`` against ``l``, upper against lower case, tabs and line ends.

Defined results: a null text has a null form and is visible in no pair; an empty or blank text keeps its form
and is in no pair; repeated rows and exact copies are in no pair with each other (their texts are equal).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.ordered import join_unique
from timeloom.session import materialise

# Letters of other alphabets (and one Latin variant) drawn like the Latin letter below them.
CYRILLIC = "аесорхуѕіјһԁԛԝӏүАВЕКМНОРСТУХЅІЈԚԜҮӀ"
CYRILLIC_AS = "aecopxysijhdqwlyABEKMHOPCTYXSIJQWYI"
CYRILLIC_ACCENTED = "ёїѐЁЇЀӓӑӗӧӒӐӖӦ"
CYRILLIC_ACCENTED_AS = "ëïèËÏÈäăĕöÄĂĔÖ"
GREEK = "ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳϹ"
GREEK_AS = "ovABEZHIKMNOPTYXcjC"
OTHER = "օսɡ"
OTHER_AS = "oug"
# Joined letters and what they join.
JOINED = {
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ",
    "ǆ": "dž", "ǅ": "Dž", "Ǆ": "DŽ", "ǉ": "lj", "ǈ": "Lj", "Ǉ": "LJ", "ǌ": "nj", "ǋ": "Nj", "Ǌ": "NJ",
    "ǳ": "dz", "ǲ": "Dz", "Ǳ": "DZ",
}
# Code points that draw nothing, as ranges of a regular expression class.
NOTHING = (
    r"\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}\x{AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}"
    r"\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}"
    r"\x{FFA0}\x{FFF0}-\x{FFFB}\x{1BCA0}-\x{1BCA3}\x{1D173}-\x{1D17A}\x{E0000}-\x{E0FFF}"
)


def translations() -> tuple[str, str]:
    """Source and target characters of the one-to-one mapping: widths, spaces and look-alikes."""
    pairs = dict(zip(CYRILLIC + CYRILLIC_ACCENTED + GREEK + OTHER, CYRILLIC_AS + CYRILLIC_ACCENTED_AS + GREEK_AS + OTHER_AS, strict=True))
    for code in range(0xFF01, 0xFFEF):
        wide = unicodedata.normalize("NFKC", chr(code))
        if wide != chr(code) and len(wide) == 1:
            pairs[chr(code)] = wide
    for code in range(0x80, 0x3001):
        if unicodedata.category(chr(code)) == "Zs":
            pairs[chr(code)] = " "
    return "".join(pairs), "".join(pairs.values())


def accented() -> dict[str, str]:
    """Every letter that NFC composes of a look-alike letter and accents, and what the Latin letter with them becomes."""
    base = dict(zip(CYRILLIC + GREEK + OTHER, CYRILLIC_AS + GREEK_AS + OTHER_AS, strict=True))
    found = {}
    for code in range(0x80, 0x30000):
        letter = chr(code)
        apart = unicodedata.normalize("NFD", letter)
        if len(apart) > 1 and apart[0] in base:
            found[letter] = unicodedata.normalize("NFC", base[apart[0]] + apart[1:])
    return found


def consistent_sql(column: str) -> str:
    """:func:`canonical_sql`, and the accented look-alike letters that it does not list. What draws nothing is
    dropped and accents are composed first, so that letter and accent are seen as one however they are written."""
    letters = {a: b for a, b in accented().items() if a not in CYRILLIC_ACCENTED}
    single = {a: b for a, b in letters.items() if len(b) == 1}
    composed = f"nfc_normalize(regexp_replace({column}, '[{NOTHING}]', '', 'g'))"
    inner = f"translate({composed}, '{''.join(single)}', '{''.join(single.values())}')"
    for letter, apart in letters.items():
        if len(apart) > 1:  # there is no such Latin letter, so it stays a letter and its accents
            inner = f"replace({inner}, '{letter}', '{apart}')"
    found = f"strlen({column}) > length({column}) AND regexp_matches({composed}, '[{''.join(letters)}]')"
    return f"CASE WHEN {found} THEN {canonical_sql(f'({inner})')} ELSE {canonical_sql(column)} END"


def canonical_sql(column: str) -> str:
    """The DuckDB expression of the consistent form of ``column``, with the accented letters of CYRILLIC_ACCENTED only."""
    source, target = (x.replace("'", "''") for x in translations())
    inner = f"translate(nfc_normalize(regexp_replace({column}, '[{NOTHING}]', '', 'g')), '{source}', '{target}')"
    for joined, letters in JOINED.items():
        inner = f"replace({inner}, '{joined}', '{letters}')"
    plain = f"strlen({column}) = length({column}) AND NOT regexp_matches({column}, '[\\x00-\\x08\\x0E-\\x1F\\x7F]')"
    return f"CASE WHEN {plain} THEN {column} ELSE nfc_normalize({inner}) END"


VISIBLE = r"[^\s\x{85}\x{A0}\x{2028}\x{2029}]"


def _duck(sql: str):
    """An Arrow map that runs ``sql`` over each batch, registered as ``batch``, in one single-threaded DuckDB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
        try:
            for batch in batches:
                con.register("batch", pa.Table.from_batches([batch]))
                yield from con.sql(sql).to_arrow_table().to_batches()
                con.unregister("batch")
        finally:
            con.close()

    return run


def canonical_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key and the consistent form of its text."""
    sql = f'SELECT "key" AS "{key}", {consistent_sql("body")} AS canonical FROM batch'
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    return rows.mapInArrow(_duck(sql), f"`{key}` {docs.schema[key].dataType.simpleString()}, canonical string")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, form, body) of every text with a visible character: 128-bit digests of its consistent form and of itself."""
    sql = f"""
        SELECT "key" AS id, unhex(md5(form)) AS form, unhex(md5(body)) AS body
        FROM (SELECT "key", body, {consistent_sql("body")} AS form FROM batch WHERE body IS NOT NULL)
        WHERE regexp_matches(form, '{VISIBLE}')"""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    return rows.mapInArrow(_duck(sql), f"id {docs.schema[key].dataType.simpleString()}, form binary, body binary")


def lookalike_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with a visible text: its class (smallest key of the same form), members and spellings."""
    prints = materialise(fingerprints(docs, key, text))  # 32 bytes a text, so that the texts are read once
    per = prints.groupBy("form", "body").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    classes = per.groupBy("form").agg(F.min("first").alias("class_id"), F.sum("n").alias("members"), F.count("*").alias("spellings"))
    found = join_unique(prints.select("form", "id"), materialise(classes), "form", "members", prints.count())
    return found.select(F.col("id").alias(key), "class_id", "members", "spellings")


def lookalike_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = 2000) -> DataFrame:
    """All pairs (key_a < key_b) of rows whose texts differ but have one form.

    Only different spellings are paired, so copies of one text are never held against each other; then each pair of
    spellings is expanded to its rows. A class of many spellings is paired block by block, and so are the rows of a
    spelling of many copies: no task holds more than two blocks of about ``block``, however large the class is.
    """
    prints = materialise(fingerprints(docs, key, text))  # 32 bytes a text, so that the texts are read once
    per = prints.groupBy("form", "body").agg(F.count("*").alias("n"))
    classes = per.groupBy("form").agg(F.count("*").alias("spellings")).filter("spellings > 1")
    several = materialise(per.join(classes, "form"))
    cut = lambda n: F.ceil(F.col(n) / block).cast("int")
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")

    spelled = several.select("form", "body", cut("n").alias("parts"), cut("spellings").alias("blocks")).withColumn("at", place("body", "blocks"))
    left = spelled.select("form", "at", F.explode(F.sequence("at", F.col("blocks") - 1)).alias("to"), F.col("body").alias("body_a"), F.col("parts").alias("parts_a"))
    right = spelled.select("form", F.col("at").alias("to"), F.explode(F.sequence(F.lit(0), "at")).alias("at"), F.col("body").alias("body_b"), F.col("parts").alias("parts_b"))
    both = left.join(right, ["form", "at", "to"]).filter("at <> to OR body_a < body_b")
    both = both.withColumn("part_a", F.explode(F.sequence(F.lit(0), F.col("parts_a") - 1))).withColumn("part_b", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)))

    rows = join_unique(prints.select("body", "id"), several.select("body", "n"), "body", "n", prints.count())
    rows = rows.withColumn("parts", cut("n")).select("id", "body", place("id", "parts").alias("part"))
    a = rows.select(F.col("id").alias("a"), F.col("body").alias("body_a"), F.col("part").alias("part_a"))
    b = rows.select(F.col("id").alias("b"), F.col("body").alias("body_b"), F.col("part").alias("part_b"))
    pairs = both.select("body_a", "part_a", "body_b", "part_b").join(a, ["body_a", "part_a"]).join(b, ["body_b", "part_b"])
    return pairs.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b"))
