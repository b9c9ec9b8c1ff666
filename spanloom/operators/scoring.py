"""Corpus metrics over concepts, label agreement, and calibration of runs.

A concept row is (record_id, id, text, type, candidates, assertions, start, end); ``id`` is its place
within the record. Sums are global: a record's numerators and denominators add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import jaccard, word_error_rate
from spanloom.operators.alignment import ASSERTABLE, CODED
from spanloom.operators.spans import greedy_match

WEIGHTS = {"text": 0.3, "assertions": 0.3, "candidates": 0.4}
MARGINS = (-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0)


def concept_parts(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Per concept its share in the sums: record_id, tn, td, an, ad, cn, cd, predicted, expected,
    matched, spurious, missed. Only records of ``gold`` count."""
    none = F.array().cast("array<string>")

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            "record_id", "type", F.col("id").alias(p), F.coalesce("text", F.lit("")).alias(f"{p}_text"),
            F.array_distinct(F.coalesce("candidates", none)).alias(f"{p}_codes"), F.size(F.coalesce("candidates", none)).alias(f"{p}_n"),
            F.array_distinct(F.coalesce("assertions", none)).alias(f"{p}_marks"),
        )

    pred = pred.join(gold.select("record_id").distinct(), "record_id", "left_semi")
    match = greedy_match(pred, gold, ["record_id", "type"]).select("record_id", "type", "pid", "gid")
    g = side(gold, "gid").join(match, ["record_id", "type", "gid"], "left")
    p = side(pred, "pid")
    rows = g.join(p, ["record_id", "type", "pid"], "full_outer")
    is_gold, is_pred = F.col("gid").isNotNull(), F.col("pid").isNotNull()
    both, spurious = is_gold & is_pred, is_pred & ~is_gold
    assertable, coded = F.col("type").isin(*ASSERTABLE), F.col("type").isin(*CODED)
    weight = F.col("gid_n") + 1
    zero = F.lit(0.0)
    return rows.select(
        "record_id",
        F.when(both, F.greatest(zero, 1 - word_error_rate(F.col("gid_text"), F.col("pid_text")))).otherwise(zero).alias("tn"),
        F.when(is_gold, 1).when(spurious, 2).otherwise(0).alias("td"),
        F.when(both & assertable, jaccard(F.col("pid_marks"), F.col("gid_marks"), 1.0)).otherwise(zero).alias("an"),
        F.when(~assertable, 0).when(is_gold, 1).when(spurious, 2).otherwise(0).alias("ad"),
        F.when(both & coded, weight * jaccard(F.col("pid_codes"), F.col("gid_codes"), 1.0)).otherwise(zero).alias("cn"),
        F.when(~coded, 0).when(is_gold, weight).when(spurious, 2 * (F.col("pid_n") + 1)).otherwise(0).alias("cd"),
        is_pred.cast("int").alias("predicted"),
        is_gold.cast("int").alias("expected"),
        both.cast("int").alias("matched"),
        spurious.cast("int").alias("spurious"),
        (is_gold & ~is_pred).cast("int").alias("missed"),
    )


_SUMS = ("tn", "td", "an", "ad", "cn", "cd", "predicted", "expected", "matched", "spurious", "missed")


def _ratios(sums: DataFrame) -> DataFrame:
    def ratio(n: str, d: str):  # noqa: ANN202
        return F.when(F.coalesce(F.col(d), F.lit(0)) == 0, F.lit(1.0)).otherwise(F.col(n) / F.col(d))

    out = sums.withColumns({"text": ratio("tn", "td"), "assertions": ratio("an", "ad"), "candidates": ratio("cn", "cd")})
    return out.withColumn("final", sum(w * F.col(k) for k, w in WEIGHTS.items()))


def score_corpus(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: text, assertions, candidates, final, matched, spurious, missed. Empty sums score 1."""
    sums = concept_parts(pred, gold).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return _ratios(sums).select("text", "assertions", "candidates", "final", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("matched", "spurious", "missed")])


def score_records(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """The same ratios per record, with the numbers predicted and expected."""
    sums = concept_parts(pred, gold).groupBy("record_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return _ratios(sums).select("record_id", "text", "assertions", "candidates", "predicted", "expected")


def numeric_order(c: str) -> list:
    """Digit strings by value first, then the rest as strings."""
    digits = F.col(c).rlike(r"^\d+$")
    return [F.when(digits, 0).otherwise(1), F.when(digits, F.col(c).cast("decimal(38,0)")), F.col(c)]


def worst_records(pred: DataFrame, gold: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` records of lowest text score; equal scores in numeric order of the id."""
    return score_records(pred, gold).orderBy("text", *numeric_order("record_id")).limit(k)


def label_agreement(a: DataFrame, b: DataFrame, p: DataFrame) -> DataFrame:
    """One row of counts over span sets (record_id, start, end, type): the labels of a and b, their
    core, what only one has, and how a run ``p`` stands to the core, with and without the type."""
    full, bare = ["record_id", "start", "end", "type"], ["record_id", "start", "end"]
    tagged = None
    for name, df in (("a", a), ("b", b), ("p", p)):
        one = df.select(*full).distinct().withColumn("s", F.lit(name))
        tagged = one if tagged is None else tagged.unionByName(one)

    def flags(keys: list[str]) -> DataFrame:
        return tagged.groupBy(*keys).agg(*[F.max((F.col("s") == n).cast("int")).alias(n) for n in "abp"])

    per = flags(full)
    core = (F.col("a") == 1) & (F.col("b") == 1)
    counts = per.agg(
        F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.sum("p").alias("n_p"), F.sum(core.cast("int")).alias("core"),
        F.sum(((F.col("a") == 1) & (F.col("b") == 0)).cast("int")).alias("only_a"), F.sum(((F.col("b") == 1) & (F.col("a") == 0)).cast("int")).alias("only_b"),
        F.sum((core & (F.col("p") == 1)).cast("int")).alias("hit"),
    )
    # boundaries of the core (type left out) that the run has
    bounds = tagged.where("s = 'p'").select(*bare).distinct()
    cores = per.where(core).select(*bare).distinct()
    bound_hit = cores.join(bounds, bare, "left_semi").agg(F.count("*").alias("bound_hit"))
    out = counts.crossJoin(F.broadcast(bound_hit))
    return out.select(
        *["n_a", "n_b", "n_p", "core", "only_a", "only_b", "hit", "bound_hit"],
        (F.col("core") / F.greatest(F.col("n_a") + F.col("n_b") - F.col("core"), F.lit(1))).alias("jaccard"),
        (F.col("hit") / F.greatest("core", F.lit(1))).alias("recall"),
        ((F.col("n_p") - F.col("hit")) / F.greatest("n_p", F.lit(1))).alias("outside"),
        (F.col("bound_hit") - F.col("hit")).alias("wrong_type"),
    )


def margin_curve(margins: DataFrame, col: str = "margin", at: tuple[float, ...] = MARGINS) -> DataFrame:
    """For each candidate margin how many values it would drop, and their share."""
    sums = margins.agg(F.count(col).alias("n"), *[F.sum((F.col(col) <= -m).cast("long")).alias(f"m{i}") for i, m in enumerate(at)])
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("dropped")) for i, m in enumerate(at)]))
    return sums.select("n", rows.alias("r")).select("r.margin", "r.dropped", F.when(F.col("n") > 0, F.col("r.dropped") / F.col("n")).otherwise(0.0).alias("share"))


def order_preservation(runs: DataFrame) -> DataFrame:
    """Pairs of runs (name, known, measured), a before b by name: do the two scores order them alike?
    Runs are few (one row per submission), so the pairs are."""
    a, b = (runs.select(F.col("name").alias(f"{s}"), F.col("known").alias(f"k{s}"), F.col("measured").alias(f"m{s}")) for s in "ab")
    same = F.signum(F.col("ka") - F.col("kb")) == F.signum(F.col("ma") - F.col("mb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", same.alias("preserved"))


def type_distribution(concepts: DataFrame) -> DataFrame:
    """Per type: concepts, assertion labels, concepts with codes, codes."""
    return concepts.groupBy("type").agg(
        F.count("*").alias("n"),
        F.sum(F.greatest(F.size(F.coalesce("assertions", F.array())), F.lit(0))).cast("long").alias("n_assertions"),
        F.sum((F.size(F.coalesce("candidates", F.array())) > 0).cast("int")).cast("long").alias("n_coded"),
        F.sum(F.greatest(F.size(F.coalesce("candidates", F.array())), F.lit(0))).cast("long").alias("n_codes"),
    )


def position_order(concepts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows that stand before their predecessor (``unsorted``) or repeat an identity (``repeated``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(F.struct("start", "end")).over(w)
    again = F.row_number().over(Window.partitionBy(*keys, "start", "end", "type").orderBy(*order)) > 1
    return concepts.withColumns({"unsorted": F.coalesce(F.struct("start", "end") < before, F.lit(False)), "repeated": again})
