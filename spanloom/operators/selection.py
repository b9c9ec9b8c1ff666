"""Span selection by teachers' votes.

A vote is (record_id, start, end, teacher, logits): five type scores and one for "no concept".
Teachers are ``primary`` and, optionally, ``secondary``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import argmax_margin
from spanloom.operators.spans import first_per, without_overlap

# Fixed value: the order of the types in a vote.
VOTE_TYPES = ("TRIỆU_CHỨNG", "CHẨN_ĐOÁN", "THUỐC", "TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM")
ADDABLE = ("TRIỆU_CHỨNG", "TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM")
_KEY = ["record_id", "start", "end"]


def read_votes(votes: DataFrame) -> DataFrame:
    """Per span: t1, m1 of the primary and t2, m2 of the secondary teacher (type and margin)."""
    best = argmax_margin(F.col("logits"))
    five = F.slice("logits", F.lit(1), F.size("logits") - 1)
    kind = F.get(F.array(*map(F.lit, VOTE_TYPES)), (F.array_position(five, F.array_max(five)) - 1).cast("int"))
    v = votes.select(*_KEY, "teacher", kind.alias("t"), best["margin"].alias("m"))

    def of(name: str, c: str) -> Column:
        return F.max(F.when(F.col("teacher") == name, F.col(c)))

    return v.groupBy(*_KEY).agg(of("primary", "t").alias("t1"), of("primary", "m").alias("m1"), of("secondary", "t").alias("t2"), of("secondary", "m").alias("m2"))


def reject(spans: DataFrame, votes: DataFrame, margin: float = 1.0) -> DataFrame:
    """Spans whose margin (the greater of two teachers') exceeds ``-margin``; spans without a vote stay."""
    v = read_votes(votes).select(*_KEY, F.greatest("m1", "m2").alias("_m"))
    return spans.join(v, _KEY, "left").where(F.col("_m").isNull() | (F.col("_m") > -margin)).drop("_m")


def correct(spans: DataFrame, votes: DataFrame) -> DataFrame:
    """Symptoms that the primary teacher reads as a diagnosis get that type."""
    v = read_votes(votes).select(*_KEY, F.col("t1").alias("_t"))
    turned = (F.col("type") == "TRIỆU_CHỨNG") & (F.col("_t") == "CHẨN_ĐOÁN")
    return spans.join(v, _KEY, "left").withColumn("type", F.when(turned, F.lit("CHẨN_ĐOÁN")).otherwise(F.col("type"))).drop("_t")


def additions(raw: DataFrame, base: DataFrame, votes: DataFrame, margin: float = 1.0) -> DataFrame:
    """Raw spans that overlap no base span, of two signs and more, on whose type both teachers agree
    with margins of ``margin`` at least. Their score is 0. ``raw`` has record_id, start, end, text, ord."""
    free = without_overlap(raw.withColumn("id", F.col("ord")), base.withColumn("id", F.col("ord")), ["record_id"]).withColumnRenamed("id", "ord")
    free = free.join(raw.select(*_KEY, "ord", "text"), [*_KEY, "ord"]).where(F.length(F.trim("text")) >= 2)
    once = first_per(free, _KEY, ["ord"])
    agreed = (F.col("t1") == F.col("t2")) & F.col("t1").isin(*ADDABLE) & (F.col("m1") >= margin) & (F.col("m2") >= margin)
    return once.join(read_votes(votes), _KEY).where(agreed).select(*_KEY, F.col("t1").alias("type"), F.lit(0.0).alias("score"), "ord")


def decide(raw: DataFrame, votes: DataFrame, margin: float = 0.0) -> DataFrame:
    """Distinct raw spans with the teacher's type and a margin of ``margin`` at least; of two teachers
    the types must agree and the lesser margin counts. Their score is 0."""
    once = first_per(raw.where(F.length(F.trim("text")) >= 2), _KEY, ["ord"])
    v = once.join(read_votes(votes), _KEY)
    m = F.when(F.col("t2").isNull(), F.col("m1")).when(F.col("t1") == F.col("t2"), F.least("m1", "m2")).otherwise(F.lit(-1e9))
    return v.where(m >= margin).select(*_KEY, F.col("t1").alias("type"), F.lit(0.0).alias("score"), "ord")


def select(raw: DataFrame, base: DataFrame, votes: DataFrame, reject_margin: float | None = 1.0, decide_margin: float | None = None, add: bool = True) -> DataFrame:
    """Decide outright if a ``decide_margin`` is given; else reject, correct and add."""
    if decide_margin is not None:
        return decide(raw, votes, decide_margin)
    kept = base.select(*_KEY, "type", "score", "ord")
    if reject_margin is not None:
        kept = reject(kept, votes, reject_margin)
    kept = correct(kept, votes)
    return kept.unionByName(additions(raw, kept, votes)) if add else kept
