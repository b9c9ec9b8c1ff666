"""The queries of the text-corpus operators: name -> (spark, folder) -> DataFrame, and SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.consensus import Consensus, fit_consensus
from spanloom.llm.leakage import find_leaks
from spanloom.llm.lookalike import learn, to_consistent
from spanloom.llm.mapping import map_values
from spanloom.llm.packing import pack_texts, packing_faults, packing_report
from spanloom.llm.pii import pii_spans, redacted
from spanloom.llm.sentences import sentence_units
from spanloom.llm.splitting import split_oversized
from spanloom.functions.text import WS
from spanloom.plans.runtime import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


# --- problem 1: personal information -------------------------------------------------------------


@query("p1_redacted")
def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every note with its personal information replaced by placeholders."""
    return redacted(read_table(spark, d, "input_notes"), "record_id", "raw_text")


@query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pii_spans(read_table(spark, d, "input_notes"), "record_id", "raw_text").distinct()


@query("p1_rest", "select distinct record_id, len(raw_text) as n_chars from input_notes where raw_text is not null")
def p1_rest(spark: SparkSession, d: str) -> DataFrame:
    """The length of every note, from its redacted form and the spans: nothing else is touched."""
    notes = read_table(spark, d, "input_notes").where("raw_text is not null").select("record_id", "raw_text").distinct()
    spans = pii_spans(notes, "record_id", "raw_text").groupBy("record_id").agg(F.sum(F.col("end_pos") - F.col("start_pos") - F.length("kind") - 2).alias("more"))
    left = redacted(notes, "record_id", "raw_text").join(spans, "record_id", "left")
    return left.select("record_id", (F.length("text") + F.coalesce("more", F.lit(0))).alias("n_chars"))


# --- problem 3: one consistent form --------------------------------------------------------------


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    """(code, elem, text) of every alias."""
    return read_table(spark, d, "terminology").select("code", F.posexplode("aliases").alias("elem", "text")).distinct()


def _table(spark: SparkSession, d: str) -> tuple:
    """The rewriting table learnt from all concept texts and all aliases."""
    return learn(read_table(spark, d, "concepts_a").select("text").unionByName(_aliases(spark, d).select("text")))


@query("p3_forms")
def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every concept text with its consistent form."""
    return to_consistent(read_table(spark, d, "concepts_a"), "concept_id", "text", _table(spark, d))


@query("p3_found")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    table = _table(spark, d)
    texts = to_consistent(read_table(spark, d, "concepts_a"), "concept_id", "text", table, changed_only=True)
    aliases = _aliases(spark, d).withColumn("key", F.to_json(F.struct("code", "elem")))
    other = to_consistent(aliases, "key", "text", table, changed_only=True)
    key = F.from_json("key", "code string, elem int")
    return (
        texts.select(F.lit("concepts_a.text").alias("field"), F.col("concept_id").cast("string").alias("row_key"), F.lit(0).alias("elem"))
        .unionByName(other.select(F.lit("terminology.aliases").alias("field"), key.code.alias("row_key"), key.elem.alias("elem")))
        .distinct()
    )


# --- problem 4: values mapped to the terminology -------------------------------------------------

_SYSTEM = {"CHẨN_ĐOÁN": "icd10", "THUỐC": "rxnorm"}


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    terms = read_table(spark, d, "terminology")
    names = terms.select(
        "code", F.col("system").alias("grp"), F.explode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name")
    )
    system = F.lit(None).cast("string")
    for kind, name in _SYSTEM.items():
        system = F.when(F.col("type") == kind, name).otherwise(system)
    values = read_table(spark, d, "concepts_a").withColumn("grp", system).where("grp is not null")
    return map_values(values, names, "text", "grp", _table(spark, d))


@query("p4_values")
def p4_values(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct value with its code, score and the reason if it has none."""
    return _mapped(spark, d).select("text", "grp", "code", F.round("score", 4).alias("score"), "reason")


@query("p4_found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    system = F.when(F.col("type") == "CHẨN_ĐOÁN", "icd10").when(F.col("type") == "THUỐC", "rxnorm")
    concepts = read_table(spark, d, "concepts_a").select("concept_id", "text", system.alias("grp")).where("grp is not null and text is not null")
    mapped = _mapped(spark, d).select("text", "grp", F.coalesce("code", F.lit("-")).alias("code"))
    return concepts.join(mapped, ["text", "grp"]).select("concept_id", "code").distinct()


# --- problem 5: oversized notes ------------------------------------------------------------------


@query("p5_pieces")
def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of every oversized note; a note that came twice with the same text is cut once."""
    notes = read_table(spark, d, "input_notes").select("record_id", "raw_text").where(F.length("raw_text") > 2000).distinct()
    return split_oversized(notes, "record_id", "raw_text", limit=2000, overlap=200)


@query(
    "p5_found",
    f"select record_id, max((list_max(list_transform(regexp_split_to_array(raw_text, '{WS}+'), lambda x: len(x))) > 2000)::int) as forced "
    "from input_notes where len(raw_text) > 2000 group by record_id",
)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = split_oversized(read_table(spark, d, "input_notes"), "record_id", "raw_text", limit=2000, overlap=200, with_text=False)
    return pieces.groupBy("record_id").agg((F.max("longest_run") > 2000).cast("int").alias("forced"))


@query("p5_rejoined", "select distinct record_id, md5(raw_text) as md5 from input_notes where len(raw_text) > 2000")
def p5_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Oversized notes put together again from their pieces."""
    piece = F.struct("piece_no", F.when(F.col("piece_no") == 0, F.col("piece")).otherwise(F.substring("piece", F.lit(201), F.length("piece"))).alias("new"))
    whole = p5_pieces(spark, d).groupBy("record_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return whole.select("record_id", F.md5(F.array_join(F.transform("p", lambda x: x["new"]), "")).alias("md5"))


# --- problem 6: consensus ------------------------------------------------------------------------


def _consensus(spark: SparkSession, d: str) -> Consensus:
    notes = read_table(spark, d, "input_notes").where("raw_text is not null")
    notes = notes.groupBy("record_id").agg(F.max_by("raw_text", F.struct("received_at", "raw_text")).alias("raw_text"))
    return fit_consensus(read_table(spark, d, "terra_labels"), texts=notes)


@query("p6_items")
def p6_items(spark: SparkSession, d: str) -> DataFrame:
    """Consensus, confidence and agreement of every item."""
    items = _consensus(spark, d).per_item()
    return items.withColumns({c: F.round(c, 6) for c in ("confidence", "agreement")})


@query("p6_annotators")
def p6_annotators(spark: SparkSession, d: str) -> DataFrame:
    """Reliability of every annotator."""
    return _consensus(spark, d).per_annotator()


@query("p6_found")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    items = _consensus(spark, d).per_item()
    values = {
        "type": F.col("type"),
        "assertions": F.array_join(F.array_sort("assertions"), ","),
        "position": F.format_string("%d-%d", "start_pos", "end_pos"),
    }
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in values.items()]))
    return items.select("item_id", rows.alias("r")).select("item_id", "r.field", "r.value")


@query(
    "p6_covered",
    "with r as (select *, row_number() over (partition by item_id, annotator_id order by labelled_at desc) as k from terra_labels where type is not null or assertions is not null or position is not null) "
    "select item_id, count(type) > 0 as has_type, count(assertions) > 0 as has_assertions, count(position) > 0 as has_position, count(*) as n_labels from r where k = 1 group by item_id",
)
def p6_covered(spark: SparkSession, d: str) -> DataFrame:
    """Which fields of every item have a consensus, and from how many labels."""
    items = p6_items(spark, d)
    has = {"has_type": "type", "has_assertions": "assertions", "has_position": "start_pos"}
    return items.select("item_id", *[F.col(c).isNotNull().alias(n) for n, c in has.items()], F.col("n_labels").cast("long").alias("n_labels"))


# --- problem 7: packing --------------------------------------------------------------------------


@query("p7_packed")
def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return pack_texts(read_table(spark, d, "documents"), "doc_id", "text")


@query("p7_report")
def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(p7_packed(spark, d))


@query("p7_rules", "select count(*) as texts, 0 as cut_texts, 0 as torn_texts, 0 as bad_containers, 0 as bad_windows from documents")
def p7_rules(spark: SparkSession, d: str) -> DataFrame:
    """How often the packing breaks a rule: never."""
    faults = packing_faults(p7_packed(spark, d), "doc_id")
    return faults.select("texts", *[F.col(c).cast("int").alias(c) for c in faults.columns[1:]])


# --- problem 8: leaked evaluation items ----------------------------------------------------------


def _leaks(spark: SparkSession, d: str, budget: int = 1) -> DataFrame:
    return find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"), min_words=15, budget=budget)


@query("p8_leaks")
def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Every leak, verbatim or with up to two edits, with its place."""
    return _leaks(spark, d, 2)


_WORDS = "regexp_extract_all(replace(lower(strip_accents(text)), 'đ', 'd'), '[\\p{L}\\p{N}]+')"
_FOUND = f"""
with i as (select item_id, {_WORDS} as w from eval_items where text is not null), d as (select doc_id, {_WORDS} as w from documents where text is not null),
gi as (select item_id, unnest(list_transform(range(1, len(w) - 13), lambda k: array_to_string(w[k : k + 14], ' '))) as g from i where len(w) >= 15),
gd as (select doc_id, unnest(list_transform(range(1, len(w) - 13), lambda k: array_to_string(w[k : k + 14], ' '))) as g from d where len(w) >= 15),
f as (select distinct doc_id, item_id from gd join gi using (g))
"""


@query("p8_found", _FOUND + "select doc_id, item_id from f")
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold 15 successive words of an item, unbroken."""
    return _leaks(spark, d).where("edits = 0 and n_words >= 15").select("doc_id", "item_id").distinct()


@query("p8_items", _FOUND + "select item_id, count(*) as n_docs from f group by item_id")
def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked, and into how many documents."""
    return p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"))


# --- problem 9: sentence units -------------------------------------------------------------------


@query("p9_units")
def p9_units(spark: SparkSession, d: str) -> DataFrame:
    """The numbered units of every document."""
    return sentence_units(read_table(spark, d, "documents"), "doc_id", "text")


@query("p9_found")
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentence_units(read_table(spark, d, "documents"), "doc_id", "text").select("doc_id", "start_pos", "end_pos").distinct()


@query("p9_covered", f"select doc_id, md5(regexp_replace(text, '{WS}+', '', 'g')) as md5 from documents where regexp_replace(text, '{WS}+', '', 'g') != ''")
def p9_covered(spark: SparkSession, d: str) -> DataFrame:
    """Documents without white space, put together from their units: all else belongs to exactly one."""
    texts = read_table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    units = p9_units(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("unit_no", "start_pos", "end_pos"))).alias("u"))
    parts = F.transform("u", lambda x: F.substring(F.col("text"), x["start_pos"] + 1, x["end_pos"] - x["start_pos"]))
    return texts.join(units, "doc_id").select("doc_id", F.md5(F.regexp_replace(F.array_join(parts, ""), f"{WS}+", "")).alias("md5"))
