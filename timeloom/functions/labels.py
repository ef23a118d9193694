"""Labels in a comparable form."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_BREAK = re.compile(r"[^\w\s]+")
_BREAK_ALL = re.compile(r"[\W_]+")


def normalise_label_text(label: str, underscore_breaks: bool = False) -> str:
    """Without accents and case, punctuation as a space, white space collapsed and trimmed."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", label) if not unicodedata.combining(c))
    return " ".join((_BREAK_ALL if underscore_breaks else _BREAK).sub(" ", bare).split()).casefold()


def _over(values: pa.Array, underscore_breaks: bool) -> pa.Array:
    """Each distinct string of a batch is normalised once."""
    coded = values.dictionary_encode()
    words = [None if w is None else normalise_label_text(w, underscore_breaks) for w in coded.dictionary.to_pylist()]
    return pa.DictionaryArray.from_arrays(coded.indices, pa.array(words, pa.string())).cast(pa.string())


def normalise_label(label: Column, underscore_breaks: bool = False) -> Column:
    """Arrow UDF over whole batches (Spark has no compatibility decomposition of its own); null stays null."""

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return _over(values, underscore_breaks)

    return run(label)
