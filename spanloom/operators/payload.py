"""JSON answers of language models read into the fixed schema, and codes chosen from candidates.

The answers are read as VARIANT values by the JVM; only finding the first JSON value inside free
text needs a parser that native functions lack, and runs in Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators.alignment import ASSERTION_ORDER, TYPES
from spanloom.operators.validation import sanitize_codes

TRUE_WORDS = ("true", "1", "yes", "y", "có", "co")


def _first_json(value: str | None, objects_only: bool = False) -> str | None:
    if value is None:
        return None
    text = value.strip()
    if text.startswith("```"):
        begin, last = text.find("\n"), text.rfind("```")
        if 0 <= begin < last:
            text = text[begin + 1 : last].strip()
    reader = json.JSONDecoder()
    for i, c in enumerate(text):
        if c in ("{" if objects_only else "[{"):
            try:
                found, _ = reader.raw_decode(text[i:])
            except (json.JSONDecodeError, RecursionError):
                continue
            return json.dumps(found, ensure_ascii=False)
    return None


@F.pandas_udf(T.StringType())
def extract_json(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The first JSON object or array inside a text, without a code fence around it; else NULL."""
    for s in values:
        yield s.map(_first_json)


@F.pandas_udf(T.StringType())
def extract_json_object(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The first JSON object inside a text; else NULL."""
    for s in values:
        yield s.map(lambda v: _first_json(v, True))


def is_complete_json(text: Column) -> Column:
    """True if the trimmed text is one whole JSON object or array."""
    return F.coalesce(F.trim(text).rlike(r"^[\[{]") & F.try_parse_json(F.trim(text)).isNotNull(), F.lit(False))


def _rows(json_text: Column, keys: tuple[str, ...], bare: tuple[str, ...]) -> Column:
    """The array of row strings under the first of ``keys``, or the value itself; NULL if neither."""
    v = F.try_parse_json(json_text)
    out = F.when(json_text.startswith("["), json_text)
    for k in keys:
        inner = F.get_json_object(json_text, f"$.{k}")
        out = out.when(inner.isNotNull(), inner)
    whole = F.lit(True)
    for k in bare:
        whole = whole & F.get_json_object(json_text, f"$.{k}").isNotNull()
    out = out.when(whole, json_text)
    as_list = F.when(out.startswith("{"), F.concat(F.lit("["), out, F.lit("]"))).otherwise(out)
    return F.when(v.isNotNull(), F.from_json(as_list, "array<string>"))


def coerce_assertions(json_text: Column) -> Column:
    """Known assertions in a JSON value: names, lists of names, or objects with true-like flags; each
    once, in the order of first mention where the names are listed, else in the known order."""
    flags = [F.lower(F.trim(F.get_json_object(json_text, f"$.{a}"))) for a in ASSERTION_ORDER]
    nested = [F.lower(F.trim(F.regexp_extract(json_text, rf'"{a}"\s*:\s*"?([^",}}\]]*)', 1))) for a in ASSERTION_ORDER]
    named = F.regexp_extract_all(json_text, F.lit(r'"(' + "|".join(ASSERTION_ORDER) + r')"(?!\s*:)'), F.lit(1))
    number = lambda x: F.coalesce(x.try_cast("double") != 0, F.lit(False))
    on = [F.when(F.coalesce(f, F.nullif(n, F.lit(""))).isin(*TRUE_WORDS) | number(F.coalesce(f, F.nullif(n, F.lit("")))), F.lit(a)) for a, f, n in zip(ASSERTION_ORDER, flags, nested, strict=True)]
    plain = F.when(F.btrim(json_text, F.lit('"')).isin(*ASSERTION_ORDER), F.array(F.btrim(json_text, F.lit('"')))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(plain, F.coalesce(named, F.array().cast("array<string>")), F.array_compact(F.array(*on))))


def coerce_mentions(answers: DataFrame, col: str = "answer") -> DataFrame:
    """(record_id, ord, text, type, assertions, start_hint) of answers (record_id, answer): rows under
    ``entities``, ``entity`` or ``concepts``, or bare; unknown types and rows without text are
    dropped, negative and unreadable hints are 0. Answers without JSON give no rows."""
    found = answers.select("record_id", extract_json(F.col(col)).alias("j"))
    rows = found.select("record_id", F.posexplode(_rows(F.col("j"), ("entities", "entity", "concepts"), ("text", "type"))).alias("ord", "r"))
    text, kind = F.get_json_object("r", "$.text"), F.trim(F.get_json_object("r", "$.type"))
    hint = F.coalesce(F.get_json_object("r", "$.start_hint").try_cast("double").cast("int"), F.lit(0))
    return rows.where(kind.isin(*TYPES) & (F.trim(text) != "")).select(
        "record_id", "ord", text.alias("text"), kind.alias("type"), coerce_assertions(F.coalesce(F.get_json_object("r", "$.assertions"), F.lit("[]"))).alias("assertions"), F.greatest(hint, F.lit(0)).alias("start_hint")
    )


def coerce_mappings(answers: DataFrame, col: str = "answer") -> DataFrame:
    """(record_id, ord, entity_index, candidates) of answers: rows under ``mappings`` or ``mapping``, or
    bare; a single code counts as a list. Rows without an index are dropped."""
    found = answers.select("record_id", extract_json(F.col(col)).alias("j"))
    rows = found.select("record_id", F.posexplode(_rows(F.col("j"), ("mappings", "mapping"), ("entity_index",))).alias("ord", "r"))
    raw = F.get_json_object("r", "$.candidates")
    codes = F.when(raw.startswith("["), F.filter(F.from_json(raw, "array<string>"), lambda c: c.isNotNull())).when(raw.startswith("{") | raw.isNull(), F.array().cast("array<string>")).otherwise(F.array(raw))
    index = F.get_json_object("r", "$.entity_index").try_cast("int")
    return rows.where(index.isNotNull()).select("record_id", "ord", index.alias("entity_index"), codes.alias("candidates"))


def restrict_codes(mappings: DataFrame, retrieved: DataFrame, most: int = 1, entities: DataFrame | None = None) -> DataFrame:
    """(record_id, entity_index, candidates): per retrieved entity the first mapping's codes that were
    retrieved, ``most`` at most; an entity without a mapping takes its first exact hit.

    ``retrieved``: record_id, entity_index, code, exact, rank. With ``entities`` (record_id, entity_index and
    the columns that were retrieved for, such as the text) it has those columns in place of the ids, and
    every entity has a row: its list is empty where nothing was retrieved."""
    ids = ["record_id", "entity_index"]
    keys = ids if entities is None else [c for c in entities.columns if c not in ids] or ids
    w = Window.partitionBy("record_id", "entity_index").orderBy("ord")
    first = mappings.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("record_id", "entity_index", F.col("candidates").alias("wanted"))
    have = retrieved.groupBy(*keys).agg(
        F.collect_set("code").alias("codes"), F.min_by("code", F.when(F.col("exact"), F.col("rank"))).alias("exact")
    )
    if entities is not None:
        have = entities.join(have, keys, "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))
    chosen = F.slice(F.array_distinct(F.filter("wanted", lambda c: F.array_contains(F.col("codes"), c))), 1, most)
    fallback = F.array_compact(F.array("exact"))
    return have.join(first, ["record_id", "entity_index"], "left").select("record_id", "entity_index", F.when(F.col("wanted").isNotNull(), chosen).otherwise(fallback).alias("candidates"))


def apply_mappings(entities: DataFrame, mappings: DataFrame, most: int = 1) -> DataFrame:
    """Entities (record_id, entity_index, type, ...) with the clean codes of their first mapping; mappings
    of other indexes are ignored."""
    w = Window.partitionBy("record_id", "entity_index").orderBy("ord")
    first = mappings.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("record_id", "entity_index", F.col("candidates").alias("_wanted"))
    none = F.array().cast("array<string>")
    codes = F.when(F.col("type").isin("CHẨN_ĐOÁN", "THUỐC"), sanitize_codes(F.col("type"), F.coalesce("_wanted", none), most))
    return entities.join(first, ["record_id", "entity_index"], "left").withColumn("candidates", codes).drop("_wanted")


def candidate_payload(retrieved: DataFrame, labels: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(query, *extra, payload): the retrieved entries of a query as one JSON list of code, label, score and exact in
    rank order, scores rounded. ``labels``: code, extra, label, one row per code. A query has as many entries as were
    retrieved for it, a fixed number; an entry without a label has none in the list."""
    row = F.struct("rank", F.struct("code", "label", F.round("score", 5).alias("score"), "exact").alias("c"))
    named = retrieved.join(labels.select("code", *extra, "label").dropDuplicates(["code", *extra]), ["code", *extra], "left")
    return named.groupBy("query", *extra).agg(F.to_json(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["c"])).alias("payload"))
