"""Semi-structured and free-text feeds: the application log and documents.

Log lines are parsed by path with tolerant casts (keys drift, types are
unstable, nested objects are sparse); lines that are not one JSON value go
to quarantine.  Free text is *described* (length, words), not cleaned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.functions import clean as C

R_NOT_JSON = "not valid json"


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Log lines with ``_v``, the one parse of each (a VARIANT), from which validity and every
    field are read."""
    return lines.select("_file", "_line_no", "_raw", C.once(C.one_json_value("_raw")).alias("_v"))


def app_events(lines: DataFrame) -> DataFrame:
    """Valid JSON lines -> typed events (path lookups on the binary value, tolerant casts)."""
    ok = parsed_lines(lines).filter(C.is_one_value("_v"))
    v = F.col("_v")
    return ok.select("_file", "_line_no",
                     C.parse_iso_timestamp(C.variant_field(v, "$[0].ts", "string")).alias("event_at"),
                     C.variant_field(v, "$[0].level", "string").alias("level"),
                     C.variant_field(v, "$[0].user", "bigint").alias("user_id"),
                     C.variant_field(v, "$[0].value", "double").alias("value"),
                     C.variant_field(v, "$[0].ctx.k", "bigint").alias("ctx_k"),
                     C.variant_field(v, "$[0].ctx.lat", "double").alias("ctx_lat"))


def app_log_quarantine(lines: DataFrame) -> DataFrame:
    bad = parsed_lines(lines).filter(~C.is_one_value("_v"))
    return bad.select("_file", "_line_no", "_raw", F.lit(R_NOT_JSON).alias("_reject_reason"))


def log_counts(lines: DataFrame) -> DataFrame:
    """Lines per verdict, from one pass."""
    ok = C.is_one_value("_v")
    return (parsed_lines(lines).groupBy(F.when(ok, "events").otherwise("quarantine").alias("part"))
                               .agg(F.count(F.lit(1)).alias("n")))


def describe_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: characters and whitespace-separated words of the whole text."""
    return docs.select(F.col(id_col),
                       C.char_count(text_col).alias("body_chars"),
                       C.word_count(text_col).alias("body_words"))


def text_profile(docs: DataFrame, labels: DataFrame, runaway_chars: int = 10000) -> DataFrame:
    """Corpus profile in one aggregate: empty, runaway, unlabelled, longest.

    Labels are looked up per document; the lookup is reduced to the
    distinct labelled ids first so duplicate label rows cannot inflate it.
    """
    labelled = labels.select(F.col("doc_id").alias("_lid")).distinct().withColumn("_has", F.lit(1))
    d = describe_text(docs).join(labelled, F.col("doc_id") == F.col("_lid"), "left")
    z = F.lit(0)
    return d.agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.when(F.col("body_chars") == 0, 1).otherwise(z)).cast("bigint").alias("empty_docs"),
        F.sum(F.when(F.col("body_chars") > runaway_chars, 1).otherwise(z)).cast("bigint").alias("runaway_docs"),
        F.sum(F.when(F.col("_has").isNull(), 1).otherwise(z)).cast("bigint").alias("unlabelled_docs"),
        F.max("body_chars").cast("bigint").alias("max_chars"),
        F.sum("body_words").cast("bigint").alias("total_words"),
    )


def _document_items(docs: DataFrame, size: int) -> DataFrame:
    """(chunk, doc_id, j): a document's JSON text and the array it is delivered in; documents
    without an id are spread by their text.  By id modulo 4 the date has one of three shapes
    or none of them."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("doc_id"), F.lit(366)).cast("int"))
    k = F.pmod(F.col("doc_id"), F.lit(4))
    submitted = (F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "M/d/yyyy"))
                  .when(k == 2, F.date_format(day, "dd-MM-yyyy")).otherwise(F.date_format(day, "yyyy.MM.dd")))
    rating = F.when(F.pmod(F.col("doc_id"), F.lit(7)) != 0, F.pmod(F.col("doc_id"), F.lit(5)) + 1)
    item = F.struct(F.col("doc_id").alias("id"), rating.alias("rating"), submitted.alias("submitted"), F.col("text").alias("body"))
    chunk = F.coalesce(F.floor(F.col("doc_id") / F.lit(size)), F.xxhash64("text"))
    return docs.select(chunk.alias("chunk"), "doc_id", F.to_json(item).alias("j"))


def _joined(items: DataFrame) -> DataFrame:
    arrays = items.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("doc_id", "j"))).alias("a"))
    return arrays.select("chunk", F.concat(F.lit("["), F.array_join("a.j", ","), F.lit("]")).alias("value"))


def document_arrays(docs: DataFrame, size: int) -> DataFrame:
    """Documents as the delivering system writes them: JSON arrays of ``size`` ids' documents,
    one array per line."""
    return _joined(_document_items(docs, size)).select("value")


#: Damage by id modulo 17, by array modulo 11 and 13 (``damaged_arrays``).
NO_BRACE, NO_QUOTE, NO_JSON, NO_BRACKET, STRAY = 3, 5, 7, 4, 6


def damaged_arrays(docs: DataFrame, size: int) -> DataFrame:
    """``document_arrays`` as a failing system writes them: elements without their closing brace or
    the quote before the body, elements that are no JSON, arrays without the closing
    bracket, and lines of other text."""
    k = F.coalesce(F.pmod(F.col("doc_id"), F.lit(17)), F.lit(-1))
    j = F.col("j")
    hurt = (F.when(k == NO_BRACE, F.expr("substring(j, 1, length(j) - 1)"))
             .when(k == NO_QUOTE, F.replace(j, F.lit('"body":"'), F.lit('"body":')))
             .when(k == NO_JSON, F.lit("<html>")).otherwise(j))
    arrays = _joined(_document_items(docs, size).withColumn("j", hurt))
    cut = F.when(F.pmod("chunk", F.lit(11)) == NO_BRACKET, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    stray = arrays.filter(F.pmod("chunk", F.lit(13)) == STRAY).select(F.lit("service unavailable").alias("value"))
    return arrays.select(cut.alias("value")).unionByName(stray)


def typed_documents(elements: DataFrame, formats: list[str]) -> DataFrame:
    """Accepted elements (``land_json_arrays``) as typed documents that know where they came from."""
    accepted = elements.filter(F.col("_reject_reason").isNull())
    v = accepted.select("_file", "_line_no", "_element_no", C.once(F.try_parse_json("_raw")).alias("v"))
    body = C.variant_field("v", "$.body", "string")
    return v.select("_file", "_line_no", "_element_no",
                    C.variant_field("v", "$.id", "bigint").alias("doc_id"), C.variant_field("v", "$.rating", "int").alias("rating"),
                    C.parse_date_any(C.variant_field("v", "$.submitted", "string"), formats).alias("submitted_on"),
                    C.char_count(body).alias("body_chars"), C.word_count(body).alias("body_words"))
