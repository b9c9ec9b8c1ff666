"""Readers: records, concept files, dictionaries, allow lists, vocabulary archives."""

from __future__ import annotations

import csv
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators.spans import first_per
from spanloom.operators.terminology import rrf_rows

CONCEPT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("candidates", T.ArrayType(T.StringType())),
        T.StructField("assertions", T.ArrayType(T.StringType())),
        T.StructField("position", T.ArrayType(T.IntegerType())),
    ]
)
TERM = T.StructType([T.StructField(c, T.StringType()) for c in ("code", "label", "aliases")])


def parse_ids(raw: str | None) -> list[str] | None:
    """Comma-separated numbers without leading zeros; None for None, an error for anything else."""
    if raw is None:
        return None
    out = []
    for part in raw.split(","):
        part = part.strip()
        if part:
            if not part.isdigit():
                raise ValueError(f"not a record number: {part!r}")
            out.append(str(int(part)))
    return sorted(set(out), key=int)


def _stem(ext: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), rf"^(\d+)\.{ext}$", 1)


def read_records(spark: SparkSession, folder: str, ids: list[str] | None = None) -> DataFrame:
    """(record_id, raw_text) of the ``<digits>.txt`` files of a folder, whole, with line breaks as ``\\n``.

    Raises FileNotFoundError if the folder or an asked id is missing, ValueError if nothing is found.
    """
    if "://" not in folder and not os.path.isdir(folder):
        raise FileNotFoundError(folder)
    df = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(_stem("txt").alias("record_id"), F.regexp_replace("value", "\r\n?", "\n").alias("raw_text"))
    df = df.where("record_id != ''")
    if ids is not None:
        wanted = spark.createDataFrame([(i,) for i in ids], "record_id string")
        missing = [r[0] for r in wanted.join(df.select("record_id"), "record_id", "left_anti").collect()]
        if missing:
            raise FileNotFoundError(f"records not found: {sorted(missing, key=int)}")
        df = df.where(F.col("record_id").isin(ids))
    if df.isEmpty():
        raise ValueError(f"no records in {folder}")
    return df


def read_concept_files(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, value): the ``<digits>.json`` files of a folder as they are."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(_stem("json").alias("record_id"), "value").where("record_id != ''")


def read_concepts(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, ord, text, type, candidates, assertions, position) of ``<digits>.json`` lists; a key that
    is absent is NULL. A file that isn't a list of concepts gives no rows; ``validation.file_violations`` tells."""
    raw = read_concept_files(spark, folder)
    return raw.select("record_id", F.posexplode(F.from_json("value", T.ArrayType(CONCEPT))).alias("ord", "c")).select("record_id", "ord", "c.*")


def span_set(concepts: DataFrame) -> DataFrame:
    """Distinct (record_id, start, end, type)."""
    return concepts.select("record_id", F.get("position", F.lit(0)).alias("start"), F.get("position", F.lit(1)).alias("end"), "type").distinct()


def concept_spans(concepts: DataFrame, order: str = "ord") -> DataFrame:
    """Concepts in the form that the metrics read: record_id, id, text, type, candidates, assertions, start, end."""
    return concepts.select("record_id", F.col(order).cast("long").alias("id"), "text", "type", "candidates", "assertions", F.get("position", F.lit(0)).alias("start"), F.get("position", F.lit(1)).alias("end"))


def _aliases(c: Column) -> Column:
    parts = F.when(c.startswith("["), F.from_json(c, "array<string>")).otherwise(F.split(c, r"\|"))
    return F.coalesce(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""), F.array().cast("array<string>"))


def _with_line_order(df: DataFrame) -> DataFrame:
    return df.withColumn("ord", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))


def read_terms_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(code, label, aliases, ord) of JSON lines; aliases are a list or joined by ``|``. Blank lines and
    rows without code or label are passed over; a line that isn't JSON raises ValueError."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    bad = lines.where(F.try_parse_json("value").isNull()).select("value").first()
    if bad:
        raise ValueError(f"{path}: not JSON: {bad[0][:80]}")
    rows = _with_line_order(lines).select("ord", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("code", "label", "aliases")])
    return rows.where("trim(code) != '' and trim(label) != ''").select(F.trim("code").alias("code"), F.trim("label").alias("label"), _aliases(F.col("aliases")).alias("aliases"), "ord")


def sniff_delimiter(path: str) -> str:
    """The delimiter of the first lines; by the suffix if they don't tell."""
    with open(path, encoding="utf-8-sig") as f:
        head = f.read(8192)
    try:
        return csv.Sniffer().sniff(head, delimiters=",;\t|").delimiter
    except csv.Error:
        return "\t" if path.endswith(".tsv") else ","


def read_terms_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """(code, label, aliases, ord) of a table with a header, whose names count in any case; a row with
    a blank code or label raises ValueError."""
    df = spark.read.csv(path, sep=sep or sniff_delimiter(path), header=True, encoding="UTF-8", quote='"', escape='"', multiLine=False)
    by = {c.strip().lstrip("﻿").lower(): c for c in df.columns}
    if "code" not in by or "label" not in by:
        raise ValueError(f"{path}: needs the columns code and label")
    name = lambda c: F.trim(F.coalesce(F.col(f"`{by[c]}`"), F.lit("")))
    rows = _with_line_order(df).select(name("code").alias("code"), name("label").alias("label"), _aliases(name("aliases") if "aliases" in by else F.lit("")).alias("aliases"), "ord")
    if not rows.where("code = '' or label = ''").isEmpty():
        raise ValueError(f"{path}: a row without code or label")
    return rows


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary by its suffix, the first row of each code; an empty one raises ValueError."""
    rows = read_terms_jsonl(spark, path) if path.endswith((".jsonl", ".ndjson")) else read_terms_delimited(spark, path)
    out = first_per(rows, ["code"], ["ord"]).select("code", "label", "aliases")
    if out.isEmpty():
        raise ValueError(f"{path}: no entries")
    return out


def read_code_list(spark: SparkSession, path: str, low: int = 0, first_label: bool = True) -> DataFrame:
    """(code, label) of lines ``CODE label``; the first label of a code counts; fewer than ``low`` codes
    raise ValueError."""
    lines = _with_line_order(spark.read.text(path))
    rows = lines.select(F.upper(F.regexp_extract("value", r"^([A-Za-z][0-9A-Za-z]{2,6})\s+(\S.*)$", 1)).alias("code"), F.trim(F.regexp_extract("value", r"^([A-Za-z][0-9A-Za-z]{2,6})\s+(\S.*)$", 2)).alias("label"), "ord").where("code != ''")
    out = first_per(rows, ["code"], ["ord"]).select("code", "label") if first_label else rows.select("code", "label")
    if low and out.count() < low:
        raise ValueError(f"{path}: fewer than {low} codes")
    return out


def read_allow_list(spark: SparkSession, path: str, upper: bool = False) -> DataFrame:
    """(code): the first field of each line; blank lines and ``#`` comments are passed over."""
    first = F.trim(F.get(F.split("value", ","), F.lit(0)))
    rows = spark.read.text(path).select((F.upper(first) if upper else first).alias("code"))
    return rows.where((F.col("code") != "") & ~F.col("code").startswith("#")).distinct()


def read_rrf_archive(spark: SparkSession, path: str, unpack_to: str, member: str = "RXNCONSO.RRF") -> DataFrame:
    """(code, tty, name, ord) of the vocabulary member of a ZIP archive; it is unpacked to the shared
    folder ``unpack_to`` once, so that the lines are read in parallel. Undecodable bytes are replaced."""
    target = os.path.join(unpack_to, member)
    if not os.path.exists(target):
        with zipfile.ZipFile(path) as z:
            name = next(n for n in z.namelist() if n.upper().endswith(member.upper()))
            os.makedirs(unpack_to, exist_ok=True)
            with z.open(name) as src, open(target + ".tmp", "wb") as dst:
                while part := src.read(1 << 20):
                    dst.write(part)
            os.replace(target + ".tmp", target)
    return rrf_rows(_with_line_order(spark.read.text(target)))


def read_code_sheet(spark: SparkSession, path: str, header: str = "MÃ BỆNH", within: int = 15) -> DataFrame:
    """A spreadsheet as strings, with the header row that has the cell ``header`` among the first rows;
    column names in upper case. Exports with the suffix ``.csv`` or ``.tsv`` are read the same way."""
    import pandas as pd

    if path.endswith((".csv", ".tsv")):
        sheet = pd.read_csv(path, header=None, dtype=str, keep_default_na=False, sep="\t" if path.endswith(".tsv") else ",")
    else:
        sheet = pd.read_excel(path, header=None, dtype=str).fillna("")
    at = next((i for i in range(min(within, len(sheet))) if header in [str(c).strip().upper() for c in sheet.iloc[i]]), None)
    if at is None:
        raise ValueError(f"{path}: no header row")
    names = [str(c).strip().upper() for c in sheet.iloc[at]]
    keep = [i for i, n in enumerate(names) if n and names.index(n) == i]
    rows = [(k, *[str(sheet.iat[r, i]).strip() for i in keep]) for k, r in enumerate(range(at + 1, len(sheet)))]
    return spark.createDataFrame(rows, T.StructType([T.StructField("ord", T.LongType()), *[T.StructField(names[i], T.StringType()) for i in keep]]))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(id, role, declared_parameters, load_mode) of a model manifest; raises ValueError if the declared
    total isn't the sum or exceeds the limit."""
    m = spark.read.json(path, multiLine=True)
    models = m.select(F.explode("models").alias("m")).select("m.*")
    head = m.first().asDict()
    total = models.agg(F.sum("declared_parameters")).first()[0] or 0
    declared = next((v for k, v in head.items() if "total" in k and isinstance(v, int)), total)
    limit = next((v for k, v in head.items() if "limit" in k and isinstance(v, int)), None)
    if total != declared or (limit is not None and total > limit):
        raise ValueError(f"{path}: declared {declared}, summed {total}, limit {limit}")
    return models
