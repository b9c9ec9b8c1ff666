"""Codes made clean, records checked against the schema, expected against actual files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.alignment import ASSERTABLE, ASSERTION_ORDER, CODED, TYPES

# Forms of codes.
ICD_CODE = r"^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$"
DRUG_CODE = r"^[0-9]+$"


class RecordError(ValueError):
    """A record breaks the schema; the message names the first rule broken."""


def sanitize_codes(type_: Column, codes: Column, most: int = 10, allowed: Column | None = None) -> Column:
    """Trimmed codes of the type's form, in the allow list if there is one, each once, ``most`` at most."""
    diagnosis = type_ == "CHẨN_ĐOÁN"
    trimmed = F.transform(codes, lambda c: F.when(diagnosis, F.upper(F.trim(c))).otherwise(F.trim(c)))
    fit = F.filter(trimmed, lambda c: F.when(diagnosis, c.rlike(ICD_CODE)).otherwise(c.rlike(DRUG_CODE)))
    if allowed is not None:
        fit = F.filter(fit, lambda c: F.array_contains(allowed, c))
    return F.slice(F.array_distinct(fit), 1, most)


REQUIRED_KEYS = ("text", "type", "assertions", "position")
#: The rules in the order in which a record is read.
RULES = (
    "list", "object", "keys", "type", "candidates_presence", "position", "bounds", "text", "assertion_value", "assertion_type", "assertion_repeat",
    "candidate_null", "candidate_form", "candidate_repeat", "sorted", "unique",
)


def violations(concepts: DataFrame, records: DataFrame, order: str = "ord") -> DataFrame:
    """(record_id, ord, rule, rule_no) for every rule that a concept breaks.

    ``concepts``: record_id, ord, text, type, candidates, assertions, position; ``records``:
    record_id, raw_text (one row per record). A concept of a record that doesn't exist breaks
    ``bounds``. NULL fields break the rule that needs them.
    """
    c = concepts.select("record_id", F.col(order).alias("ord"), "text", "type", "candidates", "assertions", "position")
    c = c.join(records.select("record_id", "raw_text"), "record_id", "left")
    start, end = F.get("position", F.lit(0)), F.get("position", F.lit(1))
    w = Window.partitionBy("record_id").orderBy("ord")
    none = F.array().cast("array<string>")
    marks, codes = F.coalesce("assertions", none), F.coalesce("candidates", none)
    coded = F.coalesce(F.col("type").isin(*CODED), F.lit(False))
    shaped = F.coalesce(F.size("position") == 2, F.lit(False)) & start.isNotNull() & end.isNotNull()
    here = F.when(shaped, F.struct(start.alias("s"), end.alias("e")))  # others have no place in the order
    form = lambda x: F.when(F.col("type") == "CHẨN_ĐOÁN", x.rlike(ICD_CODE)).otherwise(x.rlike(DRUG_CODE))
    broken = {
        "type": ~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)),
        "candidates_presence": coded != F.col("candidates").isNotNull(),
        "position": ~shaped,
        "bounds": shaped & ~F.coalesce((start >= 0) & (start < end) & (end <= F.length("raw_text")), F.lit(False)),
        "text": shaped & F.coalesce(end <= F.length("raw_text"), F.lit(False)) & ~F.coalesce(F.substring("raw_text", start + 1, end - start) == F.col("text"), F.lit(False)),
        "assertion_value": F.exists(marks, lambda x: ~F.coalesce(x.isin(*ASSERTION_ORDER), F.lit(False))),
        "assertion_type": (F.size(marks) > 0) & ~F.coalesce(F.col("type").isin(*ASSERTABLE), F.lit(False)),
        "assertion_repeat": F.size(F.array_distinct(marks)) < F.size(marks),
        "candidate_null": F.exists(codes, lambda x: x.isNull()),
        "candidate_form": coded & F.exists(codes, lambda x: x.isNotNull() & ~form(x)),
        "candidate_repeat": F.size(F.array_distinct(codes)) < F.size(codes),
        "sorted": F.coalesce(here < F.lag(here).over(w), F.lit(False)),
        "unique": shaped & (F.row_number().over(Window.partitionBy("record_id", start, end, "type").orderBy("ord")) > 1),
    }
    checked = c.withColumns({f"_{i}": broken[r] for i, r in enumerate(RULES) if r in broken})
    found = F.array_compact(F.array(*[F.when(F.col(f"_{i}"), F.struct(F.lit(r).alias("rule"), F.lit(i).alias("rule_no"))) for i, r in enumerate(RULES) if r in broken]))
    return checked.select("record_id", "ord", F.explode(found).alias("v")).select("record_id", "ord", "v.rule", "v.rule_no")


def file_violations(files: DataFrame) -> DataFrame:
    """(record_id, ord, rule, rule_no) for what is wrong with concept files (record_id, value) as such: a
    text that is no JSON list (``list``, with ord -1), elements that are no objects (``object``), objects
    that lack text, type, assertions or position (``keys``; a key with a null value is there)."""
    whole = F.coalesce(F.trim("value").startswith("[") & F.try_parse_json("value").isNotNull(), F.lit(False))
    fault = lambda ord_, i: F.struct(ord_.alias("ord"), F.lit(RULES[i]).alias("rule"), F.lit(i).alias("rule_no"))
    needed = F.array(*map(F.lit, REQUIRED_KEYS))

    def of_element(x: Column, i: Column) -> Column:
        ord_ = i.cast("long")
        keys = F.coalesce(F.json_object_keys(x), F.array().cast("array<string>"))
        return F.when(~F.coalesce(x.startswith("{"), F.lit(False)), fault(ord_, 1)).when(F.size(F.array_except(needed, keys)) > 0, fault(ord_, 2))

    elements = F.array_compact(F.transform(F.from_json("value", "array<string>"), of_element))
    found = F.when(whole, elements).otherwise(F.array(fault(F.lit(-1).cast("long"), 0)))
    return files.select("record_id", F.explode(found).alias("v")).select("record_id", "v.ord", "v.rule", "v.rule_no")


def first_violation(concepts: DataFrame, records: DataFrame, order: str = "ord", files: DataFrame | None = None) -> DataFrame:
    """(record_id, ord, rule): per record the violation met first when it is read in order; with ``files``
    (record_id, value) also those of the files as such."""
    found = violations(concepts, records, order).withColumn("ord", F.col("ord").cast("long"))
    if files is not None:
        found = found.unionByName(file_violations(files))
    first = found.groupBy("record_id").agg(F.min(F.struct("ord", "rule_no", "rule")).alias("v"))
    return first.select("record_id", "v.ord", "v.rule")


def check_record(concepts: DataFrame, records: DataFrame, order: str = "ord", files: DataFrame | None = None) -> None:
    """Raise ``RecordError`` if any record is broken."""
    row = first_violation(concepts, records, order, files).orderBy("record_id").first()
    if row:
        raise RecordError(f"record {row['record_id']}, concept {row['ord']}: {row['rule']}")


def missing_and_extra(expected: DataFrame, actual: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, status): keys expected but absent (``missing``) and present but not expected (``extra``)."""
    e, a = expected.select(key).distinct(), actual.select(key).distinct()
    return e.join(a, key, "left_anti").withColumn("status", F.lit("missing")).unionByName(a.join(e, key, "left_anti").withColumn("status", F.lit("extra")))


def output_report(concepts: DataFrame, records: DataFrame, order: str = "ord", files: DataFrame | None = None) -> DataFrame:
    """(record_id, status): missing and extra records, and the first violation of the others. With ``files``
    (record_id, value) those say which records there are; a record with an empty list is then no missing one."""
    gaps = missing_and_extra(records, concepts if files is None else files)
    return gaps.unionByName(first_violation(concepts, records, order, files).select("record_id", F.col("rule").alias("status")))


def budget(models: DataFrame, limit: int = 9_000_000_000) -> DataFrame:
    """(total, within) of the declared parameters of a manifest's models (id, declared_parameters)."""
    return models.agg(F.coalesce(F.sum("declared_parameters"), F.lit(0)).cast("long").alias("total")).withColumn("within", F.col("total") <= limit)
