"""Differences between two copies of one keyed data set, by content-defined chunks.

Both copies are put into key order, cut into chunks wherever a hash rolling over the last few
keys meets a condition, and compared by chunk fingerprint first. Because the cuts depend on the
keys only, a row that is missing or changed disturbs its own chunk and lets the following
chunks fall in step again. Only rows of chunks without an equal partner are compared field by
field.

What is moved is thin: a row travels as its key, its version and one 64-bit hash per field. Both
copies are read once and moved twice, first to find the current row of each key (with map-side
combination, so a key that is repeated very often costs nothing), then by key block. A block
holds both copies' rows of a range of keys, so the chunks, their anti-join and the comparison of
fields all happen where the block is. Two values of one key and field that differ go unnoticed
only if their 64-bit hashes are equal, once in about 10**19 differences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A cut comes on average after so many rows.
MEAN_CHUNK_ROWS = 8
#: The hash rolls over so many successive keys.
ROLL_ROWS = 4
#: Width of a key block in bits: unique integer keys put at most 2**13 rows of a copy into one
#: window partition, however the keys are distributed.
BLOCK_BITS = 13

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def field_hash(df: DataFrame, name: str) -> Column:
    """64-bit hash of a field that tells NULL from every value and looks at every element."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType)):
        c = F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"})
    return F.xxhash64(F.col(f"`{name}`").isNull(), c)


def current_rows(df: DataFrame, key: str, version: str | None, fields: Sequence[str]) -> DataFrame:
    """Key, version and field hashes of each row that has a key; ``latest`` picks one per key."""
    order = [
        (F.col(f"`{version}`") if version else F.lit(None).cast("timestamp")).alias("v"),
        *[field_hash(df, f).alias(f"f{i}") for i, f in enumerate(fields)],
    ]
    return df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), F.struct(*order).alias("o"))


def key_order(key: Column, integral: bool) -> tuple[Column, Column]:
    """Block and order of a key; other types than integers are put into order of a hash."""
    if integral:
        return F.shiftright(key.cast("long"), BLOCK_BITS), key.cast("long")
    h = F.xxhash64(key)
    return F.shiftright(h, 64 - 24), h


def chunk(rows: DataFrame, integral: bool, hashes: Sequence[str], mean_rows: int, roll: int) -> DataFrame:
    """Cut each side's key-sorted rows into chunks: block, side, first, n, x1, x2 and the rows.

    A row ends a chunk if the sum of the key hashes of the last ``roll`` rows is a multiple of
    ``mean_rows``. Chunks end with their block, which is a range of keys common to both copies.
    x1 and x2 are the chunk's fingerprint.
    """
    block, order = key_order(F.col("key"), integral)
    by_key = Window.partitionBy("block", "side").orderBy("ord", "key")
    rolling = F.sum(F.pmod(F.xxhash64("key"), F.lit(1 << 31))).over(by_key.rowsBetween(-(roll - 1), 0))
    cut_before = F.sum("cut").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(block.alias("block"), "side", order.alias("ord"), "key", *hashes)
    return (
        rows.repartition("block")
        .withColumn("cut", (F.pmod(rolling, F.lit(mean_rows)) == 0).cast("long"))
        .withColumn("piece", F.coalesce(cut_before, F.lit(0)))
        .groupBy("block", "side", "piece")
        .agg(
            F.min("ord").alias("first"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64(F.lit(1), "key", *hashes)).alias("x1"),
            F.bit_xor(F.xxhash64(F.lit(2), "key", *hashes)).alias("x2"),
            F.collect_list(F.struct("key", *hashes)).alias("rows"),
        )
    )


def diff_copies(
    a: DataFrame,
    b: DataFrame,
    key: str,
    fields: Sequence[str],
    version: str | None = None,
    mean_rows: int = MEAN_CHUNK_ROWS,
    roll: int = ROLL_ROWS,
) -> DataFrame:
    """Rows ``(key, diff)``: keys held by one copy only and the fields that differ.

    ``diff`` is ``only_a``, ``only_b`` or a field's name. Values are compared exactly: strings by
    code point, arrays by element, NULL equal to NULL only.

    Defined cases: of several rows of a key the one with the latest ``version`` counts (NULL is
    the oldest, equal versions are decided by content, exact repeats are one); rows whose key is
    NULL can't be matched and are left out; an empty copy makes every key of the other one
    ``only_*``; columns other than those named are ignored, whatever their names; keys of two
    types are compared in the wider of the two.
    """
    integral = all(isinstance(df.schema[key].dataType, _INTEGRAL) for df in (a, b))
    hashes = [f"f{i}" for i in range(len(fields))]
    rows = None
    for side, df in ((1, a), (2, b)):
        one = current_rows(df, key, version, fields).withColumn("side", F.lit(side))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.groupBy("key", "side").agg(F.max("o").alias("o")).select("key", "side", *[F.col(f"o.{h}") for h in hashes])
    # the anti-join of the fingerprints, both ways at once: chunks that one side has and the other has not
    unmatched = (
        chunk(rows, integral, hashes, mean_rows, roll)
        .groupBy("block", "first", "n", "x1", "x2")
        .agg(F.count("*").alias("sides"), F.min("side").alias("side"), F.first("rows").alias("rows"))
        .where("sides = 1")
        .select("block", "side", F.explode("rows").alias("r"))
    )
    values = F.struct(*[F.col(f"r.{h}").alias(h) for h in hashes])
    both = unmatched.groupBy("block", F.col("r.key").alias("key")).agg(
        F.max(F.when(F.col("side") == 1, values)).alias("a"), F.max(F.when(F.col("side") == 2, values)).alias("b")
    )
    in_both = F.col("a").isNotNull() & F.col("b").isNotNull()
    found = [
        F.when(F.col("b").isNull(), F.lit("only_a")),
        F.when(F.col("a").isNull(), F.lit("only_b")),
        *[F.when(in_both & (F.col(f"a.{h}") != F.col(f"b.{h}")), F.lit(f)) for h, f in zip(hashes, fields, strict=True)],
    ]
    return both.select(F.col("key").alias(key), F.explode(F.array_compact(F.array(*found))).alias("diff"))


def diff_values(diff: DataFrame, a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], version: str | None = None) -> DataFrame:
    """``diff_copies`` with the two values as strings, ``value_a`` and ``value_b``.

    Reads both copies again for the keys in ``diff`` only. NULL stands for NULL and, in rows of
    ``only_a`` and ``only_b``, for the side that has no row.
    """
    out = diff
    keys = diff.select(key).distinct()
    for side, df in (("a", a), ("b", b)):
        order = F.struct(
            (F.col(f"`{version}`") if version else F.lit(None).cast("timestamp")).alias("v"),
            *[field_hash(df, f).alias(f"f{i}") for i, f in enumerate(fields)],
            *[F.col(f"`{f}`").cast("string").alias(f"s{i}") for i, f in enumerate(fields)],
        )
        now = (
            df.select(F.col(f"`{key}`").alias(key), order.alias("o"))
            .join(keys, key, "left_semi")
            .groupBy(key)
            .agg(F.max("o").alias(f"o_{side}"))
        )
        out = out.join(now, key, "left")
    for side in ("a", "b"):
        value = F.lit(None).cast("string")
        for i, f in enumerate(fields):
            value = F.when(F.col("diff") == f, F.col(f"o_{side}.s{i}")).otherwise(value)
        out = out.withColumn(f"value_{side}", value)
    return out.drop("o_a", "o_b")
