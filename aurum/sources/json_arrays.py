"""JSON array documents, element by element: a broken element or line is set aside, its neighbours stay.

One array lies on one line, so files of any size are read in splits.  A line that is one
JSON array is parsed once and its elements are exploded by built-in functions.  Only lines
that are not go to Python: ``split_elements`` cuts them where a comma lies outside
strings and brackets, or, where that leaves a broken piece, at the first comma with a whole
element behind it.  Every piece is then judged by the engine's own parser.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.functions import clean as C
from aurum.sources.ranges import numbered_lines

# ---- fixed reason labels ----
R_ELEMENT = "element is not valid json"
R_LINE = "line is not a json array"

#: Bytes of lines that Python cuts at a time: a task's memory follows neither its lines nor the split's size.
BATCH_BYTES = 4 << 20

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},]', re.S)
_OBJECT = re.compile(r",\s*(?=\{)")


def _whole(text: str) -> bool:
    try:
        json.loads(text, strict=False)
        return True
    except ValueError:
        return False


def _comma(body: str, start: int, stop: int) -> int:
    """Where the element that starts at ``start`` ends by its brackets."""
    depth = 0
    for m in _TOKEN.finditer(body, start, stop):
        t = m.group()
        if t in "[{":
            depth += 1
        elif t in "]}":
            depth = max(0, depth - 1)
        elif t == "," and depth == 0:
            return m.start()
    return stop


def split_elements(line: str) -> list[str]:
    """The elements of a broken array, each as its text.  A line that does not open an
    array is one piece; a closing bracket may be missing."""
    body = line.strip()
    if not body.startswith("["):
        return [line]
    stop = len(body) - 1 if body.endswith("]") and len(body) > 1 else len(body)
    out, start = [], 1

    def goes_on(at: int) -> bool:
        """Whether a whole element follows the comma before ``at``."""
        return _whole(body[at:_comma(body, at, stop)])
    while start < stop:
        end = _comma(body, start, stop)
        if not _whole(body[start:end]):
            later = [(end, end + 1)] if end < stop else []
            later += [(m.start(), m.end()) for m in _OBJECT.finditer(body, start, stop)]
            end = next((comma for comma, at in sorted(later) if goes_on(at)), end)
        out.append(body[start:end].strip())
        start = end + 1
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split(lines: pd.Series) -> pd.Series:
    return lines.map(lambda s: None if s is None else split_elements(s))


def land_json_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_file, _line_no, _element_no, _raw, _reject_reason): one row per element written.

    Accepted elements have no reason.  Blank lines and empty arrays hold no element; null
    never vanishes: it is an element like any other."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    lines = numbered_lines(spark, path).filter(F.trim("_raw") != "")
    parsed = lines.select("*", C.once(C.one_json_value("_raw")).alias("_v"))
    items = F.when(C.is_one_value("_v"), F.try_variant_get("_v", "$[0]", "array<variant>"))
    whole = parsed.select("_file", "_line_no", "_raw", C.once(items).alias("_items"))
    known = F.transform("_items", lambda v: F.coalesce(F.to_json(v), F.lit("null")))
    no_array = ~F.ltrim("_raw").startswith("[")
    pieces = whole.select("_file", "_line_no", F.col("_items").isNotNull().alias("_sound"), no_array.alias("_no_array"),
                          known.alias("_known"), _split(F.when(F.col("_items").isNull(), F.col("_raw"))).alias("_cut"))
    each = pieces.select("_file", "_line_no", "_sound", "_no_array", F.posexplode(F.coalesce("_known", "_cut")).alias("_element_no", "_raw"))
    judged = each.select("*", C.once(F.when(~F.col("_sound") & ~F.col("_no_array"), C.one_json_value("_raw"))).alias("_v"))
    reason = F.when(F.col("_sound"), None).when(F.col("_no_array"), R_LINE).when(~C.is_one_value("_v"), R_ELEMENT)
    return judged.select("_file", "_line_no", "_element_no", "_raw", reason.alias("_reject_reason"))
