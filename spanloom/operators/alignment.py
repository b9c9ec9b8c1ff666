"""Quoted mentions aligned to exact positions of their record.

Mentions are placed one after another: each takes, of the occurrences that no earlier mention of its
type has taken, the one nearest to its hint. Exact spelling is tried first, then any letter case,
then any white space between the words. Occurrences are found by the regular-expression engine and
the choice is a fold over the record's mentions; no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import WS, bind

ASSERTION_ORDER = ("isNegated", "isFamily", "isHistorical")
ASSERTABLE = ("TRIỆU_CHỨNG", "CHẨN_ĐOÁN", "THUỐC")
CODED = ("CHẨN_ĐOÁN", "THUỐC")
TYPES = ("TRIỆU_CHỨNG", "TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM", "CHẨN_ĐOÁN", "THUỐC")


def quoted(c: Column) -> Column:
    """A pattern that matches the text literally."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def occurrences(text: Column, pattern: Column) -> Column:
    """Start and end of every non-overlapping match, as an array of structs."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["pos"] + F.length(pair["0"])
        end = start + F.length(pair["1"])
        return F.struct(end.cast("int").alias("pos"), F.array_append(acc["out"], F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))).alias("out"))

    pairs = F.filter(F.arrays_zip(pieces.alias("0"), hits.alias("1")), lambda x: x["1"].isNotNull())
    return F.aggregate(pairs, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step, lambda a: a["out"])


def sanitize_assertions(type_: Column, assertions: Column) -> Column:
    """The known assertions in their order, each once; none for types that carry none."""
    kept = F.filter(F.array(*map(F.lit, ASSERTION_ORDER)), lambda x: F.array_contains(F.coalesce(assertions, F.array().cast("array<string>")), x))
    return F.when(type_.isin(*ASSERTABLE), kept).otherwise(F.array().cast("array<string>"))


def align_mentions(mentions: DataFrame, records: DataFrame) -> DataFrame:
    """Rows (record_id, ord, text, type, assertions, start, end, tier); tier 1 to 3 as above, NULL
    position and tier for mentions without a free occurrence.

    ``mentions``: record_id, ord, text, type, assertions, start_hint; ``records``: record_id,
    raw_text. ``text`` is the record's wording. Mentions of records that don't exist, blank texts and
    NULL texts are unplaced; a NULL hint is 0; equal distances take the earlier occurrence. The fold
    holds the mentions of one record and (lower-cased) type and text group at a time, so its size is
    that of the repetitions of one phrase in one record.
    """
    ws = f"{WS}+"
    words = F.filter(F.split(F.col("text"), ws), lambda w: w != "")
    # mentions compete only if their loosest forms agree
    m = mentions.withColumn("phrase", F.lower(F.array_join(words, " ")))
    row = F.struct("ord", "text", "assertions", F.coalesce("start_hint", F.lit(0)).alias("hint"))
    grouped = m.groupBy("record_id", "type", "phrase").agg(F.array_sort(F.collect_list(F.struct(F.col("ord").alias("o"), row.alias("r")))).alias("rows"))
    # the texts come to the groups, so they aren't moved once per mention
    grouped = grouped.join(records.select("record_id", "raw_text"), "record_id", "left")
    empty = F.array().cast("array<struct<ord:long,start:int,end:int,tier:int>>")
    nowhere = F.lit(None).cast("struct<start:int,end:int,tier:int>")
    usable = F.col("raw_text").isNotNull() & (F.coalesce(F.col("phrase"), F.lit("")) != "")

    def step(acc: Column, x: Column) -> Column:
        r = x["r"]
        loose = F.array_join(F.transform(F.filter(F.split(r["text"], ws), lambda w: w != ""), quoted), ws)
        patterns = [quoted(r["text"]), F.concat(F.lit("(?iu)"), quoted(r["text"])), F.concat(F.lit("(?iu)"), loose)]

        def place(tier: int) -> Column:
            """The nearest free occurrence of this tier, or of the next; later tiers aren't searched in vain."""
            if tier > len(patterns):
                return nowhere
            free = F.filter(occurrences(F.col("raw_text"), patterns[tier - 1]), lambda o: ~F.exists(acc, lambda u: (u["start"] == o["start"]) & (u["end"] == o["end"])))
            near = F.array_min(F.transform(free, lambda o: F.struct(F.abs(o["start"] - r["hint"]).alias("d"), o["start"].alias("start"), o["end"].alias("end"))))
            return bind(near, lambda n: F.when(n.isNotNull(), F.struct(n["start"].alias("start"), n["end"].alias("end"), F.lit(tier).alias("tier"))).otherwise(place(tier + 1)))

        found = bind(F.when(usable, place(1)), lambda p: F.struct(r["ord"].cast("long").alias("ord"), p["start"].alias("start"), p["end"].alias("end"), p["tier"].alias("tier")))
        return F.array_append(acc, found)

    placed = grouped.select("record_id", "type", "raw_text", "rows", F.aggregate("rows", empty, step).alias("at"))
    flat = placed.select("record_id", "type", "raw_text", F.explode(F.arrays_zip("rows", "at")).alias("z"))
    start, end = F.col("z.at.start"), F.col("z.at.end")
    found = F.substring(F.col("raw_text"), start + 1, end - start)
    return flat.select(
        "record_id",
        F.col("z.rows.r.ord").alias("ord"),
        F.coalesce(found, F.col("z.rows.r.text")).alias("text"),
        "type",
        sanitize_assertions(F.col("type"), F.col("z.rows.r.assertions")).alias("assertions"),
        start.alias("start"),
        end.alias("end"),
        F.col("z.at.tier").alias("tier"),
    )
