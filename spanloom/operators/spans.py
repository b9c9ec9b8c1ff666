"""Span algebra: gates, trims, overlap suppression, overlap joins, one-to-one matching.

Spans are half-open, ``[start, end)``, within a record. Greedy operators work on islands: maximal
chains of overlapping spans. Spans of different islands never overlap, so deciding island by
island gives exactly the result of deciding over the whole record, and what is brought together is
as small as an island, however many spans a record has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import WS, collapse, strip_diacritics

# Thresholds, header labels, generic prefixes and indication markers.
THRESHOLDS = {"TRIỆU_CHỨNG": 0.20, "CHẨN_ĐOÁN": 0.25, "THUỐC": 0.30, "TÊN_XÉT_NGHIỆM": 0.15, "KẾT_QUẢ_XÉT_NGHIỆM": 0.35}
DEFAULT_THRESHOLD, RAW_FLOOR = 0.5, 0.02
HEADERS = (
    "thuốc", "tên thuốc", "triệu chứng", "các triệu chứng", "chẩn đoán", "chẩn đoán sơ bộ", "chẩn đoán ra viện", "icd",
    "xét nghiệm", "tên xét nghiệm", "kết quả", "kết quả xét nghiệm", "khám lâm sàng", "cận lâm sàng", "tiền sử",
    "tiền sử bệnh", "bệnh sử", "điều trị", "tình trạng", "diễn biến", "lý do", "lý do vào viện", "hỏi bệnh", "bệnh nhân",
)
GENERIC_PREFIXES = ("dấu hiệu", "biểu hiện", "tình trạng", "hội chứng")
INDICATIONS = ("điều trị", "cho", "để", "khi", "nếu")
# Fixed value: a dosing word, without the marks around it.
DOSE = (
    r"(?:\d+(?:[.,\-/]\d+)*%?|\d+(?:mg|mcg|ug|g|ml|iu|meq|mmol)|mg|mcg|µg|ug|g|ml|iu|x|%|po|iv|im|sc|sl|pr|tab|"
    r"(?:q\d+h|qd|qid|qod|bid|tid|qhs|qam|qpm|prn|daily)(?::prn)?)"
)


def gate(spans: DataFrame, thresholds: dict[str, float] | None = None, default: float = DEFAULT_THRESHOLD, floor: float = RAW_FLOOR) -> DataFrame:
    """Spans whose score reaches the threshold of their type (``default`` for other types).

    NULL scores don't pass; a NULL type has the default threshold; columns are kept as they are.
    """
    least = F.lit(default)
    for kind, t in (THRESHOLDS if thresholds is None else thresholds).items():
        least = F.when(F.col("type") == kind, F.lit(t)).otherwise(least)
    return spans.where((F.col("score") >= floor) & (F.col("score") >= least))


def is_header(text: Column) -> Column:
    """True for section labels, list numbers and spans of less than two signs; NULL counts as one."""
    x = collapse(text)
    key = F.lower(F.trim(F.regexp_replace(x, r"[:;.\-]+$", "")))
    bare = strip_diacritics(key)
    labels = F.array(*map(F.lit, HEADERS))
    bare_labels = F.transform(labels, strip_diacritics)
    return F.coalesce((F.length(x) < 2) | x.rlike(r"^\d+\s*[.)]\s*$") | F.array_contains(labels, key) | F.array_contains(bare_labels, bare), F.lit(True))


def trim_edges(text: Column, start: Column, end: Column) -> Column:
    """The span without white space at its ends, as (start, end)."""
    inner = F.substring(text, start + 1, end - start)
    left = F.length(F.regexp_extract(inner, f"^({WS}*)", 1))
    right = F.length(F.regexp_extract(inner, f"({WS}*)$", 1))
    return F.struct((start + left).cast("int").alias("start"), F.greatest(end - right, start + left).cast("int").alias("end"))


def trim_generic_prefix(text: Column, start: Column, end: Column) -> Column:
    """The span's start behind a generic first phrase, if two words or more remain."""
    inner = F.substring(text, start + 1, end - start)
    head = F.regexp_extract(inner, r"(?iu)^((?:" + "|".join(GENERIC_PREFIXES) + r")(?![\p{L}\p{N}_])[\s:;,.\-]*)", 1)
    rest = F.substring(inner, F.length(head) + 1, F.length(inner))
    words = F.size(F.regexp_extract_all(rest, F.lit(r"[0-9A-Za-zÀ-ỹĐđ]+"), F.lit(0)))
    return (start + F.when(words >= 2, F.length(head)).otherwise(0)).cast("int")


def extend_medication(text: Column, end: Column) -> Column:
    """The end of a drug mention behind the dosing words that follow on its line, up to the first
    indication marker (in the markers' order)."""
    line = F.substring_index(F.substring(text, end + 1, F.length(text)), "\n", 1)
    cut = line
    for marker in reversed(INDICATIONS):
        cut = F.when(F.lower(line).contains(marker), F.substring(line, F.lit(1), F.instr(F.lower(line), marker) - 1)).otherwise(cut)
    taken = F.regexp_extract(cut, rf"(?iuU)^((?:\s*[.,;:]*{DOSE}[.,;:]*(?=\s|$))*)", 1)
    return (end + F.length(taken)).cast("int")


def islands(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans with ``island``, the number of their chain of overlaps within ``keys``."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("start") >= reach), 1).otherwise(0)
    return spans.withColumn("_new", fresh).withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def suppress_overlaps(spans: DataFrame, record: str = "record_id") -> DataFrame:
    """Greedy non-maximum suppression: by falling score, then falling length, then ``ord``, keep a
    span that overlaps none kept. Input: record, start, end, type, score, ord; so is the output.

    Spans with NULL start, end or record are left out; a NULL score is the lowest; repeated spans
    suppress each other. The results of a record are disjoint.
    """
    clean = spans.where(F.col("start").isNotNull() & F.col("end").isNotNull() & F.col(record).isNotNull())
    # of equal spans only the first can be kept; that much is decided before rows are moved, so a span
    # that is repeated very often costs nothing and a record has no more rows than distinct spans
    worst = -F.coalesce(F.col("score"), F.lit(float("-inf")))
    best = clean.groupBy(record, "start", "end").agg(F.min(F.struct(worst.alias("k1"), F.col("ord").alias("k3"), "type", "score")).alias("b"))
    best = best.select(record, "start", "end", "b.*")
    row = F.struct("k1", (F.col("start") - F.col("end")).alias("k2"), "k3", "start", "end", "type", "score")
    grouped = islands(best, [record]).groupBy(record, "island").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    empty = F.slice(F.col("rows"), F.lit(1), F.lit(0))
    kept = F.aggregate(
        "rows",
        empty,
        lambda acc, x: F.when(F.exists(acc, lambda o: ~((x["end"] <= o["start"]) | (x["start"] >= o["end"]))), acc).otherwise(F.array_append(acc, x)),
    )
    return grouped.select(record, F.explode(kept).alias("k")).select(record, "k.start", "k.end", "k.type", "k.score", F.col("k.k3").alias("ord"))


def _chained(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the island they lie in, over the spans of both."""
    left = a.select(F.lit(0).alias("side"), *keys, "start", "end", "id")
    right = b.select(F.lit(1).alias("side"), *keys, "start", "end", "id")
    chain = islands(left.unionByName(right).where("start is not null and end is not null"), list(keys))
    return chain.where("side = 0").drop("side"), chain.where("side = 1").drop("side")


def overlap_pairs(pred: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of overlapping spans of equal ``keys``: keys, island, pid, gid, overlap.

    Inputs have keys, id, start, end. Pairs are sought within islands only, so a key that holds a
    great share of all spans costs no more than its overlaps. NULL keys and bounds match nothing.
    """
    p, g = _chained(pred, gold, keys)
    p = p.withColumnsRenamed({"start": "ps", "end": "pe", "id": "pid"})
    g = g.withColumnsRenamed({"start": "gs", "end": "ge", "id": "gid"})
    overlap = (F.least("pe", "ge") - F.greatest("ps", "gs")).cast("int")
    return p.join(g, [*keys, "island"]).select(*keys, "island", "pid", "gid", overlap.alias("overlap")).where("overlap > 0")


def greedy_match(pred: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-to-one matching of overlapping spans: widest overlap first, then pid, then gid.

    Rows: keys, pid, gid, overlap. Decided island by island, which is the same as over all.
    """
    row = F.struct((-F.col("overlap")).alias("k"), "pid", "gid")
    grouped = overlap_pairs(pred, gold, keys).groupBy(*keys, "island").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    taken = F.aggregate(
        "rows",
        F.slice(F.col("rows"), F.lit(1), F.lit(0)),
        lambda acc, x: F.when(F.exists(acc, lambda o: (o["pid"] == x["pid"]) | (o["gid"] == x["gid"])), acc).otherwise(F.array_append(acc, x)),
    )
    return grouped.select(*keys, F.explode(taken).alias("m")).select(*keys, "m.pid", "m.gid", (-F.col("m.k")).alias("overlap"))


def without_overlap(spans: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans (keys, id, start, end) that overlap no span of ``base`` of equal ``keys``: an interval
    anti-join, within islands. Spans with NULL bounds are left out."""
    s, b = _chained(spans, base, keys)
    b = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("island").alias("_island"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    cond = (F.col("island") == F.col("_island")) & (F.col("start") < F.col("_e")) & (F.col("_s") < F.col("end"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_{k}"))
    return s.join(b, cond, "left_anti").drop("island")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; NULL keys are a key of their own."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
