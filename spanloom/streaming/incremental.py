"""Resuming: only records without a valid result of the same run signature are computed again.

In batch that is an anti-join on (record, signature). As a stream, new record files are picked up by
a file source whose checkpoint remembers those done.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, is_dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def run_signature(config: object) -> Column:
    """SHA-256 of the sorted compact JSON of a configuration."""
    value = asdict(config) if is_dataclass(config) else config
    return F.sha2(F.lit(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)), 256)


def file_fingerprint(path: Column, size: Column, modified: Column) -> Column:
    """``path:size:mtime``, hashed."""
    return F.sha2(F.concat_ws(":", path, size.cast("string"), modified.cast("string")), 256)


def pending(records: DataFrame, done: DataFrame, signature: Column, key: str = "record_id") -> DataFrame:
    """Records without a row in ``done`` (key, run_signature) of this signature."""
    wanted = records.withColumn("run_signature", signature)
    return wanted.join(done.select(key, "run_signature").distinct(), [key, "run_signature"], "left_anti").drop("run_signature")


def conflicts(records: DataFrame, done: DataFrame, signature: Column, key: str = "record_id") -> DataFrame:
    """Records that only have results of other signatures: an error unless they may be overwritten."""
    mine = done.where(F.col("run_signature") == signature).select(key).distinct()
    return records.join(done.select(key).distinct(), key, "left_semi").join(mine, key, "left_anti")


def follow_records(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None], trigger: dict | None = None):  # noqa: ANN201
    """Stream the record files of a folder, each once: ``handle`` gets (record_id, raw_text) batches.

    The default trigger works off what is there and ends; the checkpoint makes the next call go on.
    """
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.txt").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    rows = files.select(F.regexp_extract("path", r"(\d+)\.txt$", 1).alias("record_id"), F.regexp_replace(F.decode("content", "UTF-8"), "\r\n?", "\n").alias("raw_text")).where("record_id != ''")
    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
