"""Writers: concept files, dictionaries, packages, side reports."""

from __future__ import annotations

import json
import os
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.operators.alignment import CODED
from spanloom.operators.scoring import numeric_order


def concept_struct() -> Column:
    """The output form of a concept: text, type, candidates (coded types only), assertions, position."""
    none = F.array().cast("array<string>")
    return F.struct(
        "text", "type", F.when(F.col("type").isin(*CODED), F.coalesce("candidates", none)).alias("candidates"),
        F.coalesce("assertions", none).alias("assertions"), F.array("start", "end").alias("position"),
    )


def concept_lists(concepts: DataFrame, records: DataFrame) -> DataFrame:
    """(record_id, json): one list per record in order of (start, end, type); a record without concepts
    has an empty list. Keys that are NULL are absent. A record's list is its output file, so it is
    brought together; its size is that of the file."""
    row = F.struct("start", "end", "type", concept_struct().alias("c"))
    lists = concepts.groupBy("record_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["c"])).alias("json"))
    return records.select("record_id").distinct().join(lists, "record_id", "left").select("record_id", F.coalesce("json", F.lit("[]")).alias("json"))


def _replace(path: str, text: str) -> None:
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(path + ".tmp", path)


def write_concept_files(lists: DataFrame, folder: str) -> None:
    """One ``<id>.json`` per record in a shared folder, indented, replaced atomically, written by the executors."""
    os.makedirs(folder, exist_ok=True)

    def write(rows) -> None:  # noqa: ANN001
        for r in rows:
            _replace(os.path.join(folder, f"{r['record_id']}.json"), json.dumps(json.loads(r["json"]), ensure_ascii=False, indent=2) + "\n")

    lists.foreachPartition(write)


def write_package(lists: DataFrame, path: str) -> int:
    """A ZIP of ``output/<id>.json`` in numeric order, read again and checked; returns the number of
    members. Rows are streamed to the driver one partition at a time."""
    names = []
    with zipfile.ZipFile(path + ".tmp", "w", zipfile.ZIP_DEFLATED) as z:
        for r in lists.orderBy(*numeric_order("record_id")).toLocalIterator():
            names.append(f"output/{r['record_id']}.json")
            z.writestr(names[-1], json.dumps(json.loads(r["json"]), ensure_ascii=False, indent=2) + "\n")
    with zipfile.ZipFile(path + ".tmp") as z:
        if z.namelist() != names or z.testzip() is not None:
            raise RuntimeError(f"{path}: the package isn't what was written")
    os.replace(path + ".tmp", path)
    return len(names)


def terms_table(terms: DataFrame, numeric: bool) -> DataFrame:
    """(code, label, aliases joined by ``|``) in code order: by number (others first) or as strings."""
    order = [F.coalesce(F.col("code").try_cast("bigint"), F.lit(0)), F.col("code")] if numeric else [F.col("code")]
    return terms.orderBy(*order).select("code", "label", F.array_join("aliases", "|").alias("aliases"))


def write_terms(terms: DataFrame, path: str, numeric: bool = False) -> None:
    terms_table(terms, numeric).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="", emptyValue="")


def write_side(df: DataFrame, path: str) -> None:
    """Issues, provenance, margins: a JSON-lines side table next to the output."""
    df.write.mode("overwrite").json(path)


def provenance(records: DataFrame, signature: str, model: str) -> DataFrame:
    """(record_id, run_signature, model)."""
    return records.select("record_id", F.lit(signature).alias("run_signature"), F.lit(model).alias("model"))


def run_report(concepts: DataFrame) -> DataFrame:
    """One row: records, concepts, least and most concepts of a record, and a checksum of the rows."""
    per = concepts.groupBy("record_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("text", "type", "start", "end").cast("decimal(38,0)")).alias("h"))
    return per.agg(F.count("*").alias("records"), F.sum("n").alias("concepts"), F.min("n").alias("least"), F.max("n").alias("most"), F.sha2(F.sum("h").cast("string"), 256).alias("checksum"))
