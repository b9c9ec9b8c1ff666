"""The whole way from records to concept lists, composed of the operators.

A proposer gives scored spans (record_id, start, end, type, score, ord) for records (record_id,
raw_text). Models are plugged in as a factory that runs in Arrow batches on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import detect_assertions
from spanloom.operators.alignment import ASSERTABLE, align_mentions
from spanloom.operators.selection import select
from spanloom.operators.spans import extend_medication, gate, is_header, suppress_overlaps, trim_edges, trim_generic_prefix
from spanloom.operators.terminology import exact_link, names_of
from spanloom.plans.runtime import spread

SPAN = "record_id string, start int, end int, type string, score double, ord long"
Proposer = Callable[[DataFrame], DataFrame]


def replay(spans: DataFrame) -> Proposer:
    """A proposer that reads its spans from a table."""
    return lambda records: spans.join(records.select("record_id").distinct(), "record_id", "left_semi")


def _finder(names: list[tuple[str, str]]) -> Callable[[str], set[tuple[int, int, str]]]:
    """A function from a text to the places (start, end, type) of the names (name, type), in any letter case,
    that no letter, digit or underscore goes on."""
    import ahocorasick

    kinds: dict[str, set[str]] = {}
    for name, kind in names:
        kinds.setdefault(_small(name), set()).add(kind)
    automaton = ahocorasick.Automaton()
    for name, some in kinds.items():
        automaton.add_word(name, (len(name), sorted(some)))
    automaton.make_automaton()
    part = lambda c: c.isalnum() or c == "_"

    def find(text: str) -> set[tuple[int, int, str]]:
        low, out = _small(text), set()
        for last, (n, some) in automaton.iter(low) if kinds else ():
            start, end = last - n + 1, last + 1
            if not (start and part(low[start - 1])) and not (end < len(low) and part(low[end])):
                out.update((start, end, kind) for kind in some)
        return out

    return find


def _small(text: str) -> str:
    """Lower case, sign by sign, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([c.lower() if len(c.lower()) == 1 else c for c in text])


def by_dictionary(terms: DataFrame, kinds: dict[str, str], score: float = 1.0, block: int = 100_000) -> Proposer:
    """A proposer that finds the names of a dictionary (code, system, label, aliases) verbatim, in any
    letter case; ``kinds`` gives the type for each system.

    One automaton of all names passes over each text once, in Arrow batches; texts aren't shuffled. A
    dictionary of more than ``block`` names is sent in blocks, with a pass for each.
    """

    def propose(records: DataFrame) -> DataFrame:
        kind = F.lit(None).cast("string")
        for system, t in kinds.items():
            kind = F.when(F.col("system") == system, F.lit(t)).otherwise(kind)
        names = names_of(terms, ("system",)).select(kind.alias("type"), F.trim("name").alias("name")).where("type is not null").distinct()
        blocks = max(1, -(-names.count() // block))
        out = None
        for b in range(blocks):
            some = names if blocks == 1 else names.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == b)
            listed = sorted((r["name"], r["type"]) for r in some.collect())

            def run(batches: Iterator[pd.DataFrame], listed: list = listed) -> Iterator[pd.DataFrame]:
                find = _finder(listed)
                for pdf in batches:
                    rows = [(r, *at) for r, text in zip(pdf["record_id"], pdf["raw_text"], strict=True) if text for at in find(text)]
                    yield pd.DataFrame(rows, columns=["record_id", "start", "end", "type"])

            one = spread(records.select("record_id", "raw_text")).mapInPandas(run, "record_id string, start int, end int, type string")
            out = one if out is None else out.unionByName(one)
        if blocks > 1:
            out = out.distinct()
        return out.select("record_id", "start", "end", "type", F.lit(score).alias("score"), F.xxhash64("start", "end", "type").alias("ord"))

    return propose


def by_model(factory: Callable[[], Callable[[list[str]], list[list[tuple[int, int, str, float]]]]]) -> Proposer:
    """A proposer around a model: ``factory()`` is called once per Python worker and gives a function
    from texts to lists of (start, end, type, score)."""

    def propose(records: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = factory()
            for pdf in batches:
                found = model(pdf["raw_text"].fillna("").tolist())
                rows = [(r, s, e, t, float(x), k) for r, spans in zip(pdf["record_id"], found, strict=True) for k, (s, e, t, x) in enumerate(spans)]
                yield pd.DataFrame(rows, columns=["record_id", "start", "end", "type", "score", "ord"])

        return records.select("record_id", "raw_text").mapInPandas(run, SPAN)

    return propose


@dataclass(frozen=True)
class Settings:
    thresholds: tuple[tuple[str, float], ...] = ()
    emit_assertions: bool = True
    use_sections: bool = False
    use_family: bool = False
    reject_margin: float | None = None
    decide_margin: float | None = None
    max_codes: int = 1


def parse_thresholds(items: list[str]) -> dict[str, float]:
    """``TYPE=VALUE`` pairs; an unknown form or a value outside [0, 1] raises ValueError."""
    out = {}
    for item in items:
        name, sep, value = item.partition("=")
        if not sep or not 0 <= float(value) <= 1:
            raise ValueError(f"not TYPE=VALUE: {item!r}")
        out[name.strip()] = float(value)
    return out


def edges(raw: DataFrame, records: DataFrame) -> DataFrame:
    """Raw spans without white space at their ends, drug mentions with their dosing."""
    s = raw.join(records.select("record_id", "raw_text"), "record_id").withColumn("_t", trim_edges(F.col("raw_text"), F.col("start"), F.col("end")))
    s = s.withColumns({"start": F.col("_t.start"), "end": F.col("_t.end")}).where(F.col("start") < F.col("end"))
    longer = F.when(F.col("type") == "THUỐC", extend_medication(F.col("raw_text"), F.col("end"))).otherwise(F.col("end"))
    return s.select("record_id", "start", longer.alias("end"), "type", "score", "ord")


def assemble(spans: DataFrame, records: DataFrame, terms: DataFrame, settings: Settings) -> DataFrame:
    """Concepts (record_id, start, end, text, type, assertions, candidates): headers dropped, assertions
    by rule, codes by exact link."""
    s = spans.join(records.select("record_id", "raw_text"), "record_id").withColumn("text", F.substring("raw_text", F.col("start") + 1, F.col("end") - F.col("start")))
    s = s.where(~is_header(F.col("text")))
    marks = detect_assertions(F.col("raw_text"), F.col("start"), F.col("type").isin(*ASSERTABLE), settings.use_sections, settings.use_family)
    s = s.withColumn("assertions", marks if settings.emit_assertions else F.array().cast("array<string>"))
    s = s.withColumn("system", F.when(F.col("type") == "CHẨN_ĐOÁN", "icd10").when(F.col("type") == "THUỐC", "rxnorm"))
    linked = exact_link(s.drop("raw_text"), terms, "text", F.col("type") == "THUỐC", ("system",), settings.max_codes)
    return linked.select("record_id", "start", "end", "text", "type", "assertions", F.when(F.col("system").isNotNull(), F.col("codes")).alias("candidates"))


def predict(records: DataFrame, proposer: Proposer, terms: DataFrame, settings: Settings | None = None, votes: DataFrame | None = None) -> DataFrame:
    """Propose, trim and extend, gate, suppress, select by votes, trim prefixes, suppress again, assemble."""
    settings = settings or Settings()
    raw = edges(proposer(records), records)
    base = suppress_overlaps(gate(raw, dict(settings.thresholds) or None))
    if votes is not None:
        texts = raw.join(records.select("record_id", "raw_text"), "record_id").withColumn("text", F.substring("raw_text", F.col("start") + 1, F.col("end") - F.col("start"))).drop("raw_text")
        base = select(texts, base, votes, settings.reject_margin, settings.decide_margin)
    t = base.join(records.select("record_id", "raw_text"), "record_id")
    t = t.withColumn("start", trim_generic_prefix(F.col("raw_text"), F.col("start"), F.col("end"))).drop("raw_text")
    return assemble(suppress_overlaps(t), records, terms, settings)


def predict_from_mentions(records: DataFrame, mentions: DataFrame, terms: DataFrame, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """Concepts from quoted mentions (record_id, ord, text, type, assertions, start_hint), and the issues:
    mentions that have no place. The mentions' own assertions are kept."""
    settings = settings or Settings()
    placed = align_mentions(mentions, records)
    issues = placed.where("start is null").select("record_id", "ord", "text", "type", F.lit("no free occurrence").alias("reason"))
    ok = placed.where("start is not null").withColumn("system", F.when(F.col("type") == "CHẨN_ĐOÁN", "icd10").when(F.col("type") == "THUỐC", "rxnorm"))
    linked = exact_link(ok, terms, "text", F.col("type") == "THUỐC", ("system",), settings.max_codes)
    concepts = linked.select("record_id", "start", "end", "text", "type", "assertions", F.when(F.col("system").isNotNull(), F.col("codes")).alias("candidates"))
    return concepts.dropDuplicates(["record_id", "start", "end", "type"]), issues
