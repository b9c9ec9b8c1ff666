"""The core queries: name -> (spark, folder) -> DataFrame, and their SQL twins.

Queries run over whole tables. The concept tables stand in for prediction and label sets: the current
rows of ``concepts_a`` are the truth, those of ``concepts_b`` a prediction.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as X
from spanloom.operators import alignment, payload, scoring, selection, spans, terminology, validation
from spanloom.operators.copydiff import diff_copies, diff_values
from spanloom.plans import adapters, pipeline
from spanloom.plans.runtime import read_table
from spanloom.sources import sinks
from spanloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


# --- inputs -------------------------------------------------------------------------------------


def concepts(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The current row of each concept that has a span: record_id, id, ord, text, type, candidates, assertions, start, end."""
    c = read_table(spark, d, name)
    row = F.struct("loaded_at", F.xxhash64("text", "type", "position", "candidates", "assertions").alias("h"), "record_id", "text", "type", "candidates", "assertions", "position")
    now = c.where("concept_id is not null").groupBy("concept_id").agg(F.max(row).alias("r")).select("concept_id", "r.*")
    start, end = F.get("position", F.lit(0)), F.get("position", F.lit(1))
    return now.where((start < end) & F.col("type").isNotNull()).select(
        "record_id", F.col("concept_id").alias("id"), F.col("concept_id").alias("ord"), "text", "type", "candidates", "assertions", start.alias("start"), end.alias("end"), "position"
    )


def notes(spark: SparkSession, d: str) -> DataFrame:
    """One row per record: record_id, raw_text (the latest text that isn't NULL)."""
    n = read_table(spark, d, "input_notes").where("raw_text is not null")
    return n.groupBy("record_id").agg(F.max(F.struct("received_at", "raw_text")).alias("r")).select("record_id", "r.raw_text")


def _cte(*names: str) -> str:
    """SQL of the inputs above."""
    parts = []
    for n, t in (("ca", "concepts_a"), ("cb", "concepts_b")):
        if n in names:
            parts.append(
                f"{n} as (select record_id, concept_id as id, concept_id as ord, text, type, candidates, assertions, position[1] as s, position[2] as e, position "
                f"from (select *, row_number() over (partition by concept_id order by loaded_at desc) as k from {t}) where k = 1 and position[1] < position[2] and type is not null)"
            )
    if "notes" in names:
        parts.append("notes as (select record_id, raw_text from (select *, row_number() over (partition by record_id order by received_at desc) as k from input_notes where raw_text is not null) where k = 1)")
    if "pairs" in names:
        parts.append(
            "pairs as (select ca.record_id, ca.type, cb.id as pid, ca.id as gid, least(ca.e, cb.e) - greatest(ca.s, cb.s) as overlap "
            "from ca join cb on ca.record_id = cb.record_id and ca.type = cb.type and ca.s < cb.e and cb.s < ca.e)"
        )
    if "matched" in names:
        parts.append(
            "folded as (select record_id, type, list_reduce(list([{'p': pid, 'g': gid, 'o': overlap}] order by overlap desc, pid, gid), "
            "lambda a, b: case when len(list_filter(a, lambda o: o.p = b[1].p or o.g = b[1].g)) > 0 then a else list_concat(a, b) end) as m from pairs group by all), "
            "matched as (select record_id, type, u.p as pid, u.g as gid, u.o as overlap from (select record_id, type, unnest(m) as u from folded))"
        )
    if "scored" in names:
        wer = (
            "case when len(gw) = 0 and len(pw) = 0 then 0.0 when len(gw) = 0 then 1.0 else "
            "levenshtein(array_to_string(list_transform(gw, lambda w: chr(33 + list_position(vw, w))), ''), array_to_string(list_transform(pw, lambda w: chr(33 + list_position(vw, w))), '')) / len(gw) end"
        )
        parts.append(
            f"g as (select ca.*, matched.pid from ca left join matched on ca.record_id = matched.record_id and ca.type = matched.type and ca.id = matched.gid), "
            f"p as (select cb.* from cb where record_id in (select record_id from ca)), "
            f"j as (select coalesce(g.record_id, p.record_id) as record_id, coalesce(g.type, p.type) as type, g.id as gid, p.id as pid, coalesce(g.text, '') as gt, coalesce(p.text, '') as pt, "
            f"coalesce(len(g.candidates), 0) as gn, coalesce(len(p.candidates), 0) as pn, list_distinct(coalesce(g.candidates, [])) as gc, list_distinct(coalesce(p.candidates, [])) as pc, "
            f"list_distinct(coalesce(g.assertions, [])) as gm, list_distinct(coalesce(p.assertions, [])) as pm "
            f"from g full join p on g.record_id = p.record_id and g.type = p.type and g.pid = p.id), "
            f"w as (select *, list_filter(regexp_split_to_array(gt, '{X.WS}+'), lambda z: z != '') as gw, list_filter(regexp_split_to_array(pt, '{X.WS}+'), lambda z: z != '') as pw from j), "
            f"v as (select *, list_distinct(list_concat(gw, pw)) as vw from w), "
            f"parts as (select record_id, case when gid is not null and pid is not null then greatest(0.0, 1 - {wer}) else 0.0 end as tn, "
            "case when gid is not null then 1 else 2 end as td, type in ('TRIỆU_CHỨNG', 'CHẨN_ĐOÁN', 'THUỐC') as asb, type in ('CHẨN_ĐOÁN', 'THUỐC') as cod, "
            "case when len(list_distinct(list_concat(gm, pm))) = 0 then 1.0 else len(list_intersect(gm, pm)) / len(list_distinct(list_concat(gm, pm))) end as ja, "
            "case when len(list_distinct(list_concat(gc, pc))) = 0 then 1.0 else len(list_intersect(gc, pc)) / len(list_distinct(list_concat(gc, pc))) end as jc, gid, pid, gn, pn from v), "
            "scored as (select record_id, tn, td, case when asb and gid is not null and pid is not null then ja else 0.0 end as an, case when not asb then 0 when gid is not null then 1 else 2 end as ad, "
            "case when cod and gid is not null and pid is not null then (gn + 1) * jc else 0.0 end as cn, case when not cod then 0 when gid is not null then gn + 1 else 2 * (pn + 1) end as cd, "
            "(pid is not null)::int as np, (gid is not null)::int as ng, (gid is not null and pid is not null)::int as nm from parts)"
        )
    return "with " + ",\n".join(parts) + "\n"


_R = "case when sum({d}) = 0 then 1.0 else sum({n}) / sum({d}) end"
_T, _A, _C = _R.format(n="tn", d="td"), _R.format(n="an", d="ad"), _R.format(n="cn", d="cd")


def _list(c: str) -> F.Column:
    return F.array_join(F.array_sort(c), "|")


# --- problem 2: two copies ------------------------------------------------------------------------

_CURRENT = """
with a as (select * from (select *, row_number() over (partition by concept_id order by loaded_at desc) as k from concepts_a) where k = 1),
b as (select * from (select *, row_number() over (partition by concept_id order by loaded_at desc) as k from concepts_b) where k = 1),
j as (select coalesce(a.concept_id, b.concept_id) as concept_id, a.concept_id as ia, b.concept_id as ib,
  a.text as ta, b.text as tb, a.type as ya, b.type as yb, a.position as pa, b.position as pb
  from a full join b on a.concept_id = b.concept_id),
d as (select concept_id, 'only_a' as diff, null as va, null as vb from j where ib is null
  union all select concept_id, 'only_b', null, null from j where ia is null
  union all select concept_id, 'text', ta, tb from j where ia is not null and ib is not null and ta is distinct from tb
  union all select concept_id, 'type', ya, yb from j where ia is not null and ib is not null and ya is distinct from yb
  union all select concept_id, 'position', pa::varchar, pb::varchar from j where ia is not null and ib is not null and pa is distinct from pb)
"""
_FIELDS = {"key": "concept_id", "fields": ("text", "type", "position"), "version": "loaded_at"}


@query("p2_found", _CURRENT + "select concept_id, diff from d")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return diff_copies(read_table(spark, d, "concepts_a"), read_table(spark, d, "concepts_b"), **_FIELDS)


@query("p2_summary", _CURRENT + "select diff, count(*) as n from d group by diff")
def p2_summary(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("diff").agg(F.count("*").alias("n"))


@query("p2_values", _CURRENT + "select concept_id, diff, va as value_a, vb as value_b from d")
def p2_values(spark: SparkSession, d: str) -> DataFrame:
    return diff_values(p2_found(spark, d), read_table(spark, d, "concepts_a"), read_table(spark, d, "concepts_b"), **_FIELDS)


# --- span algebra ---------------------------------------------------------------------------------

_SCORE = "((id % 100) / 100.0)"
_LEAST = "case type " + " ".join(f"when '{k}' then {v}" for k, v in spans.THRESHOLDS.items()) + f" else {spans.DEFAULT_THRESHOLD} end"


def _scored(spark: SparkSession, d: str, name: str) -> DataFrame:
    return concepts(spark, d, name).withColumn("score", (F.col("id") % 100) / 100.0)


@query("span_gate", _cte("cb") + f"select type, count(*) as n from cb where {_SCORE} >= {spans.RAW_FLOOR} and {_SCORE} >= {_LEAST} group by type")
def span_gate(spark: SparkSession, d: str) -> DataFrame:
    return spans.gate(_scored(spark, d, "concepts_b")).groupBy("type").agg(F.count("*").alias("n"))


_TWO = "u as (select record_id, id * 2 as ord, s, e, type, (id % 7) / 7.0 as score from ca union all select record_id, id * 2 + 1, s - (id % 5), e + (id % 9), type, (id % 11) / 11.0 from cb)"


@query(
    "span_nms",
    _cte("ca", "cb").rstrip()
    + f""", {_TWO},
    f as (select record_id, list_reduce(list([{{'s': s, 'e': e, 'o': ord, 't': type}}] order by -score, s - e, ord),
      lambda a, b: case when len(list_filter(a, lambda o: not (b[1].e <= o.s or b[1].s >= o.e))) > 0 then a else list_concat(a, b) end) as m from u group by record_id)
    select record_id, k.s as start, k.e as end, k.t as type, k.o as ord from (select record_id, unnest(m) as k from f)""",
)
def span_nms(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps of two proposals suppressed."""
    a = concepts(spark, d, "concepts_a").select("record_id", (F.col("id") * 2).alias("ord"), "start", "end", "type", ((F.col("id") % 7) / 7.0).alias("score"))
    b = concepts(spark, d, "concepts_b").select(
        "record_id", (F.col("id") * 2 + 1).alias("ord"), (F.col("start") - F.col("id") % 5).cast("int").alias("start"), (F.col("end") + F.col("id") % 9).cast("int").alias("end"), "type", ((F.col("id") % 11) / 11.0).alias("score")
    )
    return spans.suppress_overlaps(a.unionByName(b)).select("record_id", "start", "end", "type", "ord")


@query("overlap_join", _cte("ca", "cb", "pairs") + "select record_id, type, pid, gid, overlap from pairs")
def overlap_join(spark: SparkSession, d: str) -> DataFrame:
    return spans.overlap_pairs(concepts(spark, d, "concepts_b"), concepts(spark, d, "concepts_a"), ["record_id", "type"]).drop("island")


@query("greedy_match", _cte("ca", "cb", "pairs", "matched") + "select record_id, type, pid, gid, overlap from matched")
def greedy_match(spark: SparkSession, d: str) -> DataFrame:
    return spans.greedy_match(concepts(spark, d, "concepts_b"), concepts(spark, d, "concepts_a"), ["record_id", "type"])


@query("spurious_pred", _cte("ca", "cb", "pairs", "matched") + "select record_id, id from cb where id not in (select pid from matched)")
def spurious_pred(spark: SparkSession, d: str) -> DataFrame:
    m = greedy_match(spark, d).select(F.col("pid").alias("id"))
    return concepts(spark, d, "concepts_b").join(m, "id", "left_anti").select("record_id", "id")


@query("missed_gold", _cte("ca", "cb", "pairs", "matched") + "select record_id, id from ca where id not in (select gid from matched)")
def missed_gold(spark: SparkSession, d: str) -> DataFrame:
    m = greedy_match(spark, d).select(F.col("gid").alias("id"))
    return concepts(spark, d, "concepts_a").join(m, "id", "left_anti").select("record_id", "id")


@query("interval_anti_join", _cte("ca", "cb") + "select record_id, id from cb where not exists (select 1 from ca where ca.record_id = cb.record_id and ca.s < cb.e and cb.s < ca.e)")
def interval_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return spans.without_overlap(concepts(spark, d, "concepts_b"), concepts(spark, d, "concepts_a"), ["record_id"]).select("record_id", "id")


@query("first_wins_dedup", _cte("ca", "cb").rstrip() + ", u as (select record_id, s, e, id * 2 as ord from ca union all select record_id, s, e, id * 2 + 1 from cb) select record_id, s as start, e as end, min(ord) as ord from u group by all")
def first_wins_dedup(spark: SparkSession, d: str) -> DataFrame:
    a, b = (concepts(spark, d, n).select("record_id", "start", "end", (F.col("id") * 2 + k).alias("ord")) for k, n in enumerate(("concepts_a", "concepts_b")))
    return spans.first_per(a.unionByName(b), ["record_id", "start", "end"], ["ord"])


_HEAD = ", ".join(f"'{h}'" for h in spans.HEADERS)


@query(
    "header_spans",
    "with l as (select record_id, unnest(string_split(raw_text, chr(10))) as line from (select distinct record_id, raw_text from input_notes where raw_text is not null)), "
    f"n as (select record_id, line, trim(regexp_replace(line, '{X.WS}+', ' ', 'g')) as x from l), "
    "k as (select *, lower(trim(regexp_replace(x, '[:;.-]+$', ''))) as key from n) "
    f"select record_id, line, count(*) as n from k where len(x) < 2 or regexp_matches(x, '^\\d+\\s*[.)]\\s*$') or key in ({_HEAD}) "
    f"or replace(strip_accents(key), 'đ', 'd') in (select replace(strip_accents(h), 'đ', 'd') from (select unnest([{_HEAD}]) as h)) group by all",
)
def header_spans(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the notes that are mere section labels."""
    n = read_table(spark, d, "input_notes").where("raw_text is not null").select("record_id", "raw_text").distinct()
    lines = n.select("record_id", F.explode(F.split("raw_text", "\n")).alias("line"))
    return lines.where(spans.is_header(F.col("line"))).groupBy("record_id", "line").agg(F.count("*").alias("n"))


@query("medication_extension")
def medication_extension(spark: SparkSession, d: str) -> DataFrame:
    """Drug mentions with the dosing that follows them."""
    c = concepts(spark, d, "concepts_a").where("type = 'THUỐC'").join(notes(spark, d), "record_id")
    first = (F.col("start") + F.length(F.regexp_extract(F.col("text"), r"^\S+", 0))).cast("int")
    return c.select("record_id", "id", "start", spans.extend_medication(F.col("raw_text"), first).alias("end"))


_PREFIX = "(?i)^(?:" + "|".join(spans.GENERIC_PREFIXES) + ")"


@query(
    "generic_prefix",
    _cte("ca", "notes").rstrip()
    + rf""", w as (select ca.record_id, ca.id, greatest(s - 11, 0) as a, raw_text[greatest(s - 11, 0) + 1 : e] as inside from ca join notes using (record_id)),
    x as (select *, case when regexp_matches(inside, '{_PREFIX}([^\p{{L}}\p{{N}}_]|$)') then regexp_extract(inside, '({_PREFIX}[\s:;,.-]*)', 1) else '' end as head from w)
    select record_id, id, (a + case when len(regexp_extract_all(inside[len(head) + 1 :], '[0-9A-Za-zÀ-ỹĐđ]+')) >= 2 then len(head) else 0 end)::int as start from x""",
)
def generic_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Spans begun behind a generic first phrase."""
    c = concepts(spark, d, "concepts_a").join(notes(spark, d), "record_id")
    wide = F.greatest(F.col("start") - 11, F.lit(0)).cast("int")
    return c.select("record_id", "id", spans.trim_generic_prefix(F.col("raw_text"), wide, F.col("end")).alias("start"))


@query("chunk_lines")
def chunk_lines(spark: SparkSession, d: str) -> DataFrame:
    """Notes in verbatim pieces of at most 800 characters."""
    n = notes(spark, d)
    return n.select("record_id", F.explode(X.chunks(F.col("raw_text"), 800)).alias("c")).select("record_id", "c.offset", F.length("c.chunk").alias("n_chars"), F.md5("c.chunk").alias("md5"))


ORACLE["chunk_lines"] = (
    _cte("notes").replace("with ", "with recursive ", 1).rstrip()
    + """, c as (
    select record_id, raw_text, 0 as pos, case when len(raw_text) > 800 and instr(reverse(raw_text[1:800]), chr(10)) between 1 and 799 then 801 - instr(reverse(raw_text[1:800]), chr(10)) else least(800, len(raw_text)) end as size from notes
    union all
    select record_id, raw_text, pos + size, case when len(raw_text) - (pos + size) > 800 and instr(reverse(raw_text[pos + size + 1 : pos + size + 800]), chr(10)) between 1 and 799
      then 801 - instr(reverse(raw_text[pos + size + 1 : pos + size + 800]), chr(10)) else least(800, len(raw_text) - (pos + size)) end
    from c where pos + size < len(raw_text))
    select record_id, pos as offset, size as n_chars, md5(raw_text[pos + 1 : pos + size]) as md5 from c"""
)


# --- text functions -------------------------------------------------------------------------------

_TEXTS = "t as (select distinct text from concepts_a where text is not null)"
_SURFACE = f"lower(trim(regexp_replace(text, '{X.WS}+', ' ', 'g'), ' ,;:.'))"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "concepts_a").where("text is not null").select("text").distinct()


@query(
    "normal_forms",
    f"with {_TEXTS} select text, {_SURFACE} as surface, replace(strip_accents(text), 'đ', 'd') as bare, "
    "trim(regexp_replace(strip_accents(lower(replace(text, 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g')) as term from t",
)
def normal_forms(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return _texts(spark, d).select("text", X.normalize_surface(c).alias("surface"), X.strip_diacritics(c).alias("bare"), X.normalize_term(c).alias("term"))


def _clean_sql(text: str, drug: str) -> str:
    """SQL of ``clean_mention``. The engine has no look-around, so a noise word takes its neighbours along: blanks
    are doubled, and the replacement runs again for words that shared another sign."""
    word = r"(^|[^\p{L}\p{N}_])(?:" + "|".join(X.DRUG_NOISE) + r")([^\p{L}\p{N}_]|$)"
    d = f"regexp_replace({text}, '{X.WS}+', '  ', 'g')"
    for _ in range(3):
        d = f"regexp_replace({d}, '{word}', '\\1 \\2', 'gi')"
    d = f"regexp_replace({d}, '(\\d),(\\d)', '\\1.\\2', 'g')"
    d = f"regexp_replace({d}, '\\s*({'|'.join(X.UNITS)})([^\\p{{L}}\\p{{N}}_]|$)', ' \\1\\2', 'gi')"
    return f"trim(regexp_replace(case when {drug} then {d} else {text} end, '{X.WS}+', ' ', 'g'))"


_IS_DRUG = "type = 'THUỐC'"


@query("clean_mentions", f"select distinct text, type, {_clean_sql('text', _IS_DRUG)} as clean from concepts_a where text is not null")
def clean_mentions(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "concepts_a").where("text is not null").select("text", "type").distinct()
    return t.select("text", "type", X.clean_mention(F.col("text"), F.col("type") == "THUỐC").alias("clean"))


@query(
    "char_ngrams",
    f"with {_TEXTS}, q as (select text, replace(trim(regexp_replace(strip_accents(lower(replace(text, 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g')), ' ', '_') as x from t) "
    "select text, array_to_string(list_sort(list_distinct(case when len(x) = 0 then [] when len(x) <= 3 then [x] else list_transform(range(1, len(x) - 1), lambda i: x[i : i + 2]) end)), '|') as grams from q",
)
def char_ngrams(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("text", F.array_join(F.array_sort(X.char_ngrams(X.normalize_term(F.col("text")))), "|").alias("grams"))


@query(
    "word_error_rate",
    _cte("ca", "cb").rstrip()
    + f""", j as (select ca.id, list_filter(regexp_split_to_array(ca.text, '{X.WS}+'), lambda z: z != '') as gw, list_filter(regexp_split_to_array(cb.text, '{X.WS}+'), lambda z: z != '') as pw
      from ca join cb on ca.id = cb.id where ca.text is not null and cb.text is not null), v as (select *, list_distinct(list_concat(gw, pw)) as vw from j)
    select id, round(case when len(gw) = 0 and len(pw) = 0 then 0.0 when len(gw) = 0 then 1.0 else levenshtein(array_to_string(list_transform(gw, lambda w: chr(33 + list_position(vw, w))), ''),
      array_to_string(list_transform(pw, lambda w: chr(33 + list_position(vw, w))), '')) / len(gw) end, 6) as wer from v""",
)
def word_error_rate(spark: SparkSession, d: str) -> DataFrame:
    a, b = concepts(spark, d, "concepts_a").select("id", "text"), concepts(spark, d, "concepts_b").select("id", F.col("text").alias("other"))
    both = a.join(b, "id").where("text is not null and other is not null")
    return both.select("id", F.round(X.word_error_rate(F.col("text"), F.col("other")), 6).alias("wer"))


@query(
    "set_jaccard",
    _cte("ca", "cb").rstrip()
    + """, j as (select ca.id, list_distinct(coalesce(ca.assertions, [])) as x, list_distinct(coalesce(cb.assertions, [])) as y from ca join cb on ca.id = cb.id),
    k as (select id, len(list_intersect(x, y)) as i, len(list_distinct(list_concat(x, y))) as u from j)
    select id, round(case when u = 0 then 1.0 else i / u end, 6) as metric, round(case when u = 0 then 0.0 else i / u end, 6) as retrieval from k""",
)
def set_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Both readings of two empty sets."""
    none = F.array().cast("array<string>")
    a = concepts(spark, d, "concepts_a").select("id", F.array_distinct(F.coalesce("assertions", none)).alias("x"))
    b = concepts(spark, d, "concepts_b").select("id", F.array_distinct(F.coalesce("assertions", none)).alias("y"))
    x, y = F.col("x"), F.col("y")
    return a.join(b, "id").select("id", F.round(X.jaccard(x, y, 1.0), 6).alias("metric"), F.round(X.jaccard(x, y, 0.0), 6).alias("retrieval"))


_BREAK = r"[.;:\n]|[^\p{L}\p{N}_](?:nhưng|song|tuy nhiên|còn|mà)[^\p{L}\p{N}_]"


def _cue_sql(window: str, cues: tuple[str, ...]) -> str:
    return " or ".join(f"(contains({window}, '{c}') and not regexp_matches(' ' || string_split({window}, '{c}')[-1] || ' ', '{_BREAK}'))" for c in cues)


def _window_sql(width: int) -> str:
    return f"lower(string_split(raw_text[greatest(s - {width}, 0) + 1 : s], chr(10))[-1])"


@query(
    "assertion_cues",
    _cte("ca", "notes").rstrip()
    + f""", w as (select ca.record_id, ca.id, ca.type, {_window_sql(40)} as w40, {_window_sql(60)} as w60, {_window_sql(50)} as w50 from ca join notes using (record_id))
    select record_id, id, case when type not in ('TRIỆU_CHỨNG', 'CHẨN_ĐOÁN', 'THUỐC') then '' else array_to_string(list_filter([case when {_cue_sql('w40', X.NEGATION_CUES)} then 'isNegated' end,
      case when {_cue_sql('w60', X.HISTORY_CUES)} then 'isHistorical' end, case when {_cue_sql('w50', X.FAMILY_CUES)} then 'isFamily' end], lambda z: z is not null), ',') end as marks from w""",
)
def assertion_cues(spark: SparkSession, d: str) -> DataFrame:
    c = concepts(spark, d, "concepts_a").join(notes(spark, d), "record_id")
    marks = X.detect_assertions(F.col("raw_text"), F.col("start"), F.col("type").isin(*alignment.ASSERTABLE), family=True)
    return c.select("record_id", "id", F.array_join(marks, ",").alias("marks"))


@query(
    "assertion_sections",
    _cte("ca", "notes").rstrip()
    + f""", w as (select ca.record_id, ca.id, ca.type, {_window_sql(40)} as w40, {_window_sql(60)} as w60, string_split(lower(raw_text[greatest(s - 400, 0) + 1 : s]), chr(10)) as ls from ca join notes using (record_id)),
    x as (select *, len(list_filter(ls[greatest(len(ls) - 3, 1) : len(ls)], lambda l: {" or ".join(f"contains(l, '{h}')" for h in X.HISTORY_SECTIONS)})) > 0 as under from w)
    select record_id, id, case when type not in ('TRIỆU_CHỨNG', 'CHẨN_ĐOÁN', 'THUỐC') then '' else array_to_string(list_filter([case when {_cue_sql('w40', X.NEGATION_CUES)} then 'isNegated' end,
      case when under or {_cue_sql('w60', X.HISTORY_CUES)} then 'isHistorical' end], lambda z: z is not null), ',') end as marks from x""",
)
def assertion_sections(spark: SparkSession, d: str) -> DataFrame:
    """With the section headings above a mention as a further cue of history."""
    c = concepts(spark, d, "concepts_a").join(notes(spark, d), "record_id")
    marks = X.detect_assertions(F.col("raw_text"), F.col("start"), F.col("type").isin(*alignment.ASSERTABLE), sections=True)
    return c.select("record_id", "id", F.array_join(marks, ",").alias("marks"))


@query("context_windows", _cte("ca", "notes") + "select record_id, id, md5(raw_text[greatest(s - 240, 0) + 1 : e + 240]) as context from ca join notes using (record_id)")
def context_windows(spark: SparkSession, d: str) -> DataFrame:
    c = concepts(spark, d, "concepts_a").join(notes(spark, d), "record_id")
    return c.select("record_id", "id", F.md5(X.context_slice(F.col("raw_text"), F.col("start"), F.col("end"))).alias("context"))


@query(
    "line_context",
    _cte("ca", "notes").rstrip()
    + f""", w as (select ca.record_id, ca.id, string_split(raw_text[1 : s], chr(10)) as above, raw_text[s + 1 : e] as mention, string_split(raw_text[e + 1 :], chr(10))[1] as behind from ca join notes using (record_id)),
    x as (select *, (above[-1] || mention || behind)[1 : 300] as line, list_filter(above[1 : len(above) - 1], lambda l: regexp_replace(l, '{X.WS}+', '', 'g') != '') as earlier from w)
    select record_id, id, case when len(earlier) = 0 then line else '[mục: ' || regexp_replace(regexp_replace(earlier[-1], '^{X.WS}+', ''), '{X.WS}+$', '')[1 : 80] || '] ' || line end as context from x""",
)
def line_context(spark: SparkSession, d: str) -> DataFrame:
    c = concepts(spark, d, "concepts_a").join(notes(spark, d), "record_id")
    return c.select("record_id", "id", X.line_context(F.col("raw_text"), F.col("start"), F.col("end")).alias("context"))


@query("dotted_codes", "select distinct code, upper(replace(code, '.', ''))[1:3] || case when len(replace(code, '.', '')) > 3 then '.' || upper(replace(code, '.', ''))[4:] else '' end as dotted from terminology where system = 'icd10'")
def dotted_codes(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "terminology").where("system = 'icd10'").select("code").distinct()
    return t.select("code", X.dotted_code(F.replace("code", F.lit("."), F.lit(""))).alias("dotted"))


@query("cache_keys", f"with {_TEXTS} select text, sha256('v1' || chr(10) || text)[1:24] as key from t")
def cache_keys(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("text", X.cache_key([F.lit("v1"), F.col("text")]).alias("key"))


# --- metrics --------------------------------------------------------------------------------------

_SCORED = _cte("ca", "cb", "pairs", "matched", "scored")


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return concepts(spark, d, "concepts_b"), concepts(spark, d, "concepts_a")


@query("score_corpus", _SCORED + f"select round({_T}, 6) as text, round({_A}, 6) as assertions, round({_C}, 6) as candidates, round(0.3 * {_T} + 0.3 * {_A} + 0.4 * {_C}, 6) as final, sum(nm)::bigint as matched, sum(np - nm)::bigint as spurious, sum(ng - nm)::bigint as missed from scored")
def score_corpus(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_corpus(*_both(spark, d)).withColumns({c: F.round(c, 6) for c in ("text", "assertions", "candidates", "final")})


@query("score_records", _SCORED + f"select record_id, round({_T}, 6) as text, round({_A}, 6) as assertions, round({_C}, 6) as candidates, sum(np)::bigint as predicted, sum(ng)::bigint as expected from scored group by record_id")
def score_records(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_records(*_both(spark, d)).withColumns({c: F.round(c, 6) for c in ("text", "assertions", "candidates")})


@query("worst_records", _SCORED + f", r as (select record_id, {_T} as t from scored group by record_id) select record_id, round(t, 6) as text from r order by t, case when regexp_matches(record_id, '^\\d+$') then 0 else 1 end, try_cast(record_id as bigint), record_id limit 10")
def worst_records(spark: SparkSession, d: str) -> DataFrame:
    return scoring.worst_records(*_both(spark, d)).select("record_id", F.round("text", 6).alias("text"))


@query("type_distribution", _cte("ca") + "select type, count(*) as n, sum(coalesce(len(assertions), 0))::bigint as n_assertions, count(*) filter (len(candidates) > 0) as n_coded, sum(coalesce(len(candidates), 0))::bigint as n_codes from ca group by type")
def type_distribution(spark: SparkSession, d: str) -> DataFrame:
    return scoring.type_distribution(concepts(spark, d, "concepts_a"))


_TERRA = "tp as (select record_id, position[1] as s, position[2] as e, type from terra_labels where type is not null)"


@query(
    "label_agreement",
    _cte("ca", "cb").rstrip()
    + f""", {_TERRA}, a as (select distinct record_id, s, e, type from ca), b as (select distinct record_id, s, e, type from cb), p as (select distinct record_id, s, e, type from tp),
    core as (select * from a intersect select * from b), hit as (select * from core intersect select * from p),
    bh as (select distinct record_id, s, e from core intersect select record_id, s, e from p),
    n as (select (select count(*) from a) as n_a, (select count(*) from b) as n_b, (select count(*) from p) as n_p, (select count(*) from core) as core, (select count(*) from (select * from a except select * from b)) as only_a,
      (select count(*) from (select * from b except select * from a)) as only_b, (select count(*) from hit) as hit, (select count(*) from bh) as bound_hit)
    select n_a, n_b, n_p, core, only_a, only_b, hit, bound_hit, round(core / greatest(n_a + n_b - core, 1), 6) as jaccard, round(hit / greatest(core, 1), 6) as recall, round((n_p - hit) / greatest(n_p, 1), 6) as outside, bound_hit - hit as wrong_type from n""",
)
def label_agreement(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "terra_labels").where("type is not null").select("record_id", F.get("position", F.lit(0)).alias("start"), F.get("position", F.lit(1)).alias("end"), "type")
    out = scoring.label_agreement(concepts(spark, d, "concepts_a"), concepts(spark, d, "concepts_b"), t)
    return out.withColumns({c: F.round(c, 6) for c in ("jaccard", "recall", "outside")})


_MARGIN = "(embedding[1]::double - embedding[6]::double) * 10"


@query(
    "margin_curve",
    f"with v as (select {_MARGIN} as m from embeddings), c as (select unnest([-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0])::double as margin) "
    "select margin, count(*) filter (m <= -margin) as dropped, round(count(*) filter (m <= -margin) / count(*), 6) as share from c cross join v group by margin",
)
def margin_curve(spark: SparkSession, d: str) -> DataFrame:
    v = read_table(spark, d, "embeddings").select(((F.get("embedding", F.lit(0)).cast("double") - F.get("embedding", F.lit(5)).cast("double")) * 10).alias("margin"))
    return scoring.margin_curve(v).withColumn("share", F.round("share", 6))


@query(
    "order_preservation",
    _cte("ca", "cb").rstrip() + ", r as (select type as name, (select avg(s) from ca c2 where c2.type = ca.type) as known, (select avg(s) from cb c3 where c3.type = ca.type) as measured from ca group by type) "
    "select x.name as a, y.name as b, sign(x.known - y.known) = sign(x.measured - y.measured) as preserved from r x join r y on x.name < y.name",
)
def order_preservation(spark: SparkSession, d: str) -> DataFrame:
    a, b = (concepts(spark, d, n).groupBy(F.col("type").alias("name")).agg(F.avg("start").alias(k)) for n, k in (("concepts_a", "known"), ("concepts_b", "measured")))
    return scoring.order_preservation(a.join(b, "name"))


@query("run_report", _cte("ca").rstrip() + ", per as (select record_id, count(*) as n from ca group by 1) select count(*) as records, sum(n)::bigint as concepts, min(n) as least, max(n) as most from per")
def run_report(spark: SparkSession, d: str) -> DataFrame:
    """The totals of a run; the checksum, which depends on the hash function, isn't shown."""
    return sinks.run_report(concepts(spark, d, "concepts_a")).drop("checksum")


# --- dictionaries ---------------------------------------------------------------------------------

_NAMES = "n as (select code, system, unnest(list_concat([label], coalesce(aliases, []))) as name from terminology), nn as (select * from n where name is not null and trim(name) != '')"
_KEYS = f"{_NAMES}, kk as (select code, system, {_SURFACE.replace('text', 'name')} as key from nn), k as (select * from kk where key != '')"
_INDEX = f"{_KEYS}, i as (select 'exact' as kind, key, system, code from k union all select 'plain', replace(strip_accents(key), 'đ', 'd'), system, code from k)"


@query("alias_index", f"with {_INDEX} select kind, key, system, array_to_string(list_sort(list(distinct code)), '|') as codes from i group by kind, key, system")
def alias_index(spark: SparkSession, d: str) -> DataFrame:
    return terminology.alias_index(read_table(spark, d, "terminology"), ("system",)).select("kind", "key", "system", F.array_join("codes", "|").alias("codes"))


_CODED = "c as (select candidates[1] as code, concept_id as ord, text as name, type from concepts_a where len(candidates) > 0 and text is not null and trim(text) != '')"


@query(
    "ambiguous_aliases",
    f"with {_CODED}, k as (select code, type as system, {_SURFACE.replace('text', 'name')} as key from c), i as (select 'exact' as kind, key, system, code from k where key != '' union all "
    "select 'plain', replace(strip_accents(key), 'đ', 'd'), system, code from k where key != '') select kind, key, system, count(distinct code) as n from i group by kind, key, system having count(distinct code) > 1",
)
def ambiguous_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Names that bear several codes, in the dictionary that the coded mentions make."""
    terms = _coded(spark, d).select("code", F.col("name").alias("label"), F.array().cast("array<string>").alias("aliases"), F.col("type").alias("system"))
    i = terminology.alias_index(terms, ("system",))
    return i.where(F.size("codes") > 1).select("kind", "key", "system", F.size("codes").cast("long").alias("n"))


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    system = F.when(F.col("type") == "CHẨN_ĐOÁN", "icd10").when(F.col("type") == "THUỐC", "rxnorm")
    return read_table(spark, d, "concepts_a").select("text", system.alias("system")).where("system is not null and text is not null").distinct()


@query(
    "exact_link",
    f"with {_INDEX}, x as (select kind, key, system, list(distinct code) as codes from i group by all), "
    f"m as (select distinct text, case type when 'CHẨN_ĐOÁN' then 'icd10' else 'rxnorm' end as system, {_SURFACE} as key from concepts_a where type in ('CHẨN_ĐOÁN', 'THUỐC') and text is not null), "
    "f as (select m.text, m.system, coalesce(e.codes, p.codes, []) as found from m left join x e on e.kind = 'exact' and e.key = m.key and e.system = m.system and m.key != '' "
    "left join x p on p.kind = 'plain' and p.key = replace(strip_accents(m.key), 'đ', 'd') and p.system = m.system and m.key != ''), "
    "leaf as (select distinct code from terminology) "
    "select text, system, len(found)::int as n_found, case when len(found) != 1 then '' when regexp_full_match(found[1], '[A-Z]\\d\\d') and (found[1] || '.9') in (select code from leaf) then found[1] || '.9' else found[1] end as code from f",
)
def exact_link(spark: SparkSession, d: str) -> DataFrame:
    out = terminology.exact_link(_mentions(spark, d), read_table(spark, d, "terminology"), extra=("system",))
    return out.select("text", "system", F.size("found").alias("n_found"), F.coalesce(F.get("codes", F.lit(0)), F.lit("")).alias("code"))


@query("drug_link", ORACLE["exact_link"].replace(f"{_SURFACE} as key from concepts_a", f"{_SURFACE.replace('text', _clean_sql('text', _IS_DRUG))} as key from concepts_a"))
def drug_link(spark: SparkSession, d: str) -> DataFrame:
    """The same with route and frequency words of drugs left out."""
    out = terminology.exact_link(_mentions(spark, d), read_table(spark, d, "terminology"), drug=F.col("system") == "rxnorm", extra=("system",))
    return out.select("text", "system", F.size("found").alias("n_found"), F.coalesce(F.get("codes", F.lit(0)), F.lit("")).alias("code"))


def _coded(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "concepts_a").where("size(candidates) > 0 and text is not null and trim(text) != ''")
    return c.select(F.get("candidates", F.lit(0)).alias("code"), F.col("concept_id").alias("ord"), F.col("text").alias("name"), "type")


@query(
    "alias_fold",
    f"with {_CODED}, f as (select code, name, min(ord) as ord from c where len(replace(code, '.', '')) >= 3 group by all), "
    "g as (select code, list(name order by ord, name) as n from f group by code) select code, n[1] as label, array_to_string(n[2:], '|') as aliases from g",
)
def alias_fold(spark: SparkSession, d: str) -> DataFrame:
    return terminology.fold_aliases(_coded(spark, d)).select("code", "label", F.array_join("aliases", "|").alias("aliases"))


@query(
    "rank_labels",
    f"with {_CODED}, f as (select code, name, min(struct_pack(a := case when ord % 3 = 0 then 0 else 1 end, b := case when ord % 2 = 0 then 1 else 2 end, c := len(name), d := lower(name), e := name)) as k from c group by code, name), "
    "g as (select code, min(k).e as label, list(name order by len(name), lower(name), name) as n from f group by code) "
    "select code, label, array_to_string(list_filter(n, lambda x: x != label)[1:24], '|') as aliases from g",
)
def rank_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = _coded(spark, d).select("code", (F.col("ord") % 3 == 0).alias("preferred"), F.when(F.col("ord") % 2 == 0, "SBD").otherwise("SCD").alias("tty"), "name")
    return terminology.rank_labels(rows).select("code", "label", F.array_join("aliases", "|").alias("aliases"))


@query("drug_name_fold")
def drug_name_fold(spark: SparkSession, d: str) -> DataFrame:
    """Labels that move to shorter ingredient names, over the coded mentions in order."""
    rows = _coded(spark, d).select("code", F.get(F.array(*map(F.lit, ("IN", "SCD", "SY", "BN", "XX"))), (F.col("ord") % 5).cast("int")).alias("tty"), "name", "ord")
    return terminology.fold_drug_names(rows).select("code", "label", F.array_join("aliases", "|").alias("aliases"))


_TERM = "trim(regexp_replace(strip_accents(lower(replace({c}, 'ß', 'ss'))), '[^a-z0-9]+', ' ', 'g'))"


@query(
    "postings",
    f"with {_NAMES}, q as (select code, {_TERM.format(c='name')} as q from nn), r as (select * from q where q != ''), "
    "p as (select 'name' as kind, q as term, code from r union select 'word', unnest(list_filter(string_split(q, ' '), lambda w: len(w) >= 2)), code from r "
    "union select 'gram', unnest(case when len(q) <= 3 then [replace(q, ' ', '_')] else list_transform(range(1, len(q) - 1), lambda i: replace(q, ' ', '_')[i : i + 2]) end), code from r) "
    "select kind, term, count(distinct code) as n from p group by kind, term",
)
def postings(spark: SparkSession, d: str) -> DataFrame:
    return terminology.postings(read_table(spark, d, "terminology")).groupBy("kind", "term").agg(F.countDistinct("code").alias("n"))


_ENTRY = (
    f"{_NAMES}, q as (select distinct code, system, {_TERM.format(c='name')} as q from nn), r as (select * from q where q != ''), "
    "rw as (select distinct code, system, unnest(list_filter(string_split(q, ' '), lambda w: len(w) >= 2)) as t from r), "
    "rg as (select distinct code, system, unnest(case when len(q) <= 3 then [replace(q, ' ', '_')] else list_transform(range(1, len(q) - 1), lambda i: replace(q, ' ', '_')[i : i + 2]) end) as t from r), "
    "nw as (select code, system, count(*) as n from rw group by all), ng as (select code, system, count(*) as n from rg group by all)"
)
_ASKED = (
    f"m as (select distinct text, case type when 'CHẨN_ĐOÁN' then 'icd10' else 'rxnorm' end as system, {_TERM.format(c='text')} as q from concepts_a where type in ('CHẨN_ĐOÁN', 'THUỐC') and text is not null), "
    "a as (select distinct q, system from m where q != ''), "
    "aw as (select distinct q, system, unnest(list_filter(string_split(q, ' '), lambda w: len(w) >= 2)) as t from a), "
    "ag as (select distinct q, system, unnest(case when len(q) <= 3 then [replace(q, ' ', '_')] else list_transform(range(1, len(q) - 1), lambda i: replace(q, ' ', '_')[i : i + 2]) end) as t from a), "
    "sw as (select q, system, count(*) as n from aw group by all), sg as (select q, system, count(*) as n from ag group by all)"
)
#: The best entries of the mentions, by counting common words and 3-grams.
_RETRIEVED = f"""with {_ENTRY}, {_ASKED},
cw as (select q, aw.system, code, count(*) as n from aw join rw using (t) where aw.system = rw.system group by all),
cg as (select q, ag.system, code, count(*) as n from ag join rg using (t) where ag.system = rg.system group by all),
ce as (select distinct a.q, a.system, r.code from a join r on a.q = r.q and a.system = r.system),
c as (select q, system, code from cw union select q, system, code from cg union select q, system, code from ce),
cp as (select distinct c.q, c.system, c.code from c join r on r.code = c.code and r.system = c.system where contains(r.q, c.q) or contains(c.q, r.q)),
s as (select c.q, c.system, c.code, ce.code is not null as exact, least(1.0, (ce.code is not null)::int + 0.18::double * (cp.code is not null)::int
  + 0.55::double * coalesce(cw.n::double / (sw.n + nw.n - cw.n), 0) + 0.27::double * coalesce(cg.n::double / (sg.n + ng.n - cg.n), 0)) as score
  from c left join ce using (q, system, code) left join cp using (q, system, code) left join cw using (q, system, code) left join cg using (q, system, code)
  left join sw using (q, system) left join sg using (q, system) left join nw using (code, system) left join ng using (code, system)),
k as (select *, row_number() over (partition by q, system order by score desc, exact desc, code)::int as rank from s),
hits as (select m.text as query, m.system, k.code, k.score, k.exact, k.rank from m join k on m.q = k.q and m.system = k.system where k.rank <= {{top}})
"""


@query("lexical_retrieve_topk", _RETRIEVED.format(top=5) + "select query, system, code, round(score, 6) as score, exact, rank from hits")
def lexical_retrieve_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five best entries for every distinct diagnosis and drug mention."""
    return _retrieved(spark, d, 5).withColumn("score", F.round("score", 6))


def _retrieved(spark: SparkSession, d: str, top_k: int) -> DataFrame:
    return terminology.retrieve(_mentions(spark, d), read_table(spark, d, "terminology"), extra=("system",), top_k=top_k)


@query(
    "candidate_payloads",
    _RETRIEVED.format(top=5) + "select query, system, string_agg(code || ' ' || exact::varchar, '|' order by rank) as entries, count(*) as n from hits group by query, system",
)
def candidate_payloads(spark: SparkSession, d: str) -> DataFrame:
    """The entries of every mention as a model is shown them, read back from the JSON."""
    shown = payload.candidate_payload(_retrieved(spark, d, 5), read_table(spark, d, "terminology").select("code", "system", "label").distinct(), ("system",))
    row = F.from_json("payload", "array<struct<code:string,label:string,score:double,exact:boolean>>")
    parts = F.transform(row, lambda r: F.concat(r["code"], F.lit(" "), r["exact"].cast("string")))
    return shown.select("query", "system", F.array_join(parts, "|").alias("entries"), F.size(row).cast("long").alias("n"))


@query(
    "vector_topk",
    "with q as (select vec_id as qid, embedding::double[] as x from embeddings where vec_id % 50 = 0), s as (select q.qid, e.vec_id as id, list_dot_product(q.x, e.embedding::double[]) as dot from q cross join embeddings e), "
    "r as (select *, row_number() over (partition by qid order by dot desc, id) as rank from s) select qid, id, round(dot, 6) as dot, rank::int as rank from r where rank <= 5",
)
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    return terminology.vector_topk(q, e.select(F.col("vec_id").alias("id"), "embedding"), 5).withColumn("dot", F.round("dot", 6))


@query(
    "hybrid_score",
    ORACLE["vector_topk"].replace("select qid, id, round(dot, 6) as dot, rank::int as rank from r where rank <= 5", "select qid, id, round(0.52 * (qid = id)::int + 0.48 * (dot + 1) / 2, 6) as score from r where rank <= 5"),
)
def hybrid_score(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), "embedding")
    top = terminology.vector_topk(q, e.select(F.col("vec_id").alias("id"), "embedding"), 5)
    return top.select("qid", "id", F.round(terminology.combine((F.col("qid") == F.col("id")).cast("double"), F.col("dot")), 6).alias("score"))


def _hashed_grams(width: int = 64) -> Callable[[list[str]], list[list[float]]]:
    """Stand-in for a neural encoder: signed counts of hashed 3-grams. Near means written alike here."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = [[0.0] * width for _ in texts]
        for v, t in zip(out, texts, strict=True):
            for i in range(max(len(t) - 2, 1)):
                h = crc32(t[i : i + 3].encode())
                v[h % width] += 1.0 if h >> 16 & 1 else -1.0
        return out

    return encode


@query("hybrid_retrieve_topk")
def hybrid_retrieve_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five best entries of every distinct diagnosis and drug mention by lexical and vector evidence.

    The vectors come from a stand-in encoder; the context of a mention isn't encoded."""
    t = read_table(spark, d, "terminology")
    all_names = F.concat_ws(" ; ", F.array_sort(F.collect_set("name")))
    passages = terminology.names_of(t, ("system",)).groupBy("code", "system").agg(all_names.alias("text"))
    coded = lambda df: adapters.embed(df.withColumn("_n", X.normalize_term(F.col("text"))), "_n", _hashed_grams, "hashed-3-grams").drop("_n")
    out = terminology.hybrid_retrieve(coded(_mentions(spark, d)), t, coded(passages), extra=("system",), top_k=5)
    return out.withColumn("score", F.round("score", 6))


@query(
    "dictionary_export",
    "with f as (select distinct code, system, label from terminology), r as (select *, row_number() over (partition by code order by system, label) as k from f) select code, label from r where k = 1",
)
def dictionary_export(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "terminology").select("code", "label", "aliases", F.struct("system", "label").alias("ord"))
    return sinks.terms_table(terminology.load_terms(t), numeric=False).select("code", "label")


# --- alignment, validation, payloads --------------------------------------------------------------


@query(
    "mention_occurrences",
    _cte("ca", "notes") + "select id, ((len(raw_text) - len(replace(raw_text, text, ''))) / len(text))::int as n, instr(raw_text, text)::int - 1 as first from ca join notes using (record_id) where text is not null and text != ''",
)
def mention_occurrences(spark: SparkSession, d: str) -> DataFrame:
    c = concepts(spark, d, "concepts_a").where("text is not null and text != ''").join(notes(spark, d), "record_id")
    at = alignment.occurrences(F.col("raw_text"), alignment.quoted(F.col("text")))
    return c.select("id", F.size(at).alias("n"), F.coalesce(F.get(at, F.lit(0))["start"], F.lit(-1)).alias("first"))


@query("align_nearest")
def align_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Every mention placed anew from its text and a hint that is a little off."""
    c = concepts(spark, d, "concepts_a").where("text is not null")
    m = c.select("record_id", "ord", "text", "type", "assertions", (F.col("start") + F.col("id") % 7).cast("int").alias("start_hint"))
    out = alignment.align_mentions(m, notes(spark, d))
    return out.select("record_id", "ord", "type", "start", "end", "tier", F.array_join("assertions", ",").alias("assertions"))


_ICD, _DRUG = validation.ICD_CODE.strip("^$"), validation.DRUG_CODE.strip("^$")


@query(
    "code_sanitize",
    f"select concept_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(candidates, lambda c: case when type = 'CHẨN_ĐOÁN' then upper(trim(c)) else trim(c) end), "
    f"lambda c: regexp_full_match(c, case when type = 'CHẨN_ĐOÁN' then '{_ICD}' else '{_DRUG}' end)))), '|') as codes from concepts_a where candidates is not null group by all",
)
def code_sanitize(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "concepts_a").where("candidates is not null")
    return c.select("concept_id", F.array_join(F.array_sort(validation.sanitize_codes(F.col("type"), F.col("candidates"), 1000)), "|").alias("codes")).distinct()


_LAST = "lag(struct_pack(a := s, b := e)) over (partition by record_id order by ord)"


_RULE_NO = "case rule " + " ".join(f"when '{r}' then {i}" for i, r in enumerate(validation.RULES)) + " end"
#: The rules over the current row of every concept, with whatever NULLs it has.
_BROKEN = f"""with notes as (select record_id, raw_text from (select *, row_number() over (partition by record_id order by received_at desc) as k from input_notes where raw_text is not null) where k = 1),
    r as (select record_id, concept_id as ord, text, type, candidates, assertions, position, position[1] as s, position[2] as e, coalesce(len(position) = 2, false) and position[1] is not null and position[2] is not null as ok
      from (select *, row_number() over (partition by concept_id order by loaded_at desc) as k from concepts_b where concept_id is not null) where k = 1),
    l as (select *, lag(case when ok then struct_pack(a := s, b := e) end) over (partition by record_id order by ord) as before from r),
    c as (select l.*, raw_text, coalesce(ok and before is not null and struct_pack(a := s, b := e) < before, false) as un, row_number() over (partition by l.record_id, s, e, type order by ord) > 1 as rep from l left join notes using (record_id)),
    m as (select *, coalesce(assertions, []) as ma, coalesce(candidates, []) as mc, coalesce(type in ('CHẨN_ĐOÁN', 'THUỐC'), false) as cod from c), v as (
    select record_id, ord, 'type' as rule from m where not coalesce(type in ('TRIỆU_CHỨNG', 'TÊN_XÉT_NGHIỆM', 'KẾT_QUẢ_XÉT_NGHIỆM', 'CHẨN_ĐOÁN', 'THUỐC'), false)
    union all select record_id, ord, 'candidates_presence' from m where cod != (candidates is not null)
    union all select record_id, ord, 'position' from m where not ok
    union all select record_id, ord, 'bounds' from m where ok and not coalesce(s >= 0 and s < e and e <= len(raw_text), false)
    union all select record_id, ord, 'text' from m where ok and coalesce(e <= len(raw_text), false) and not coalesce(raw_text[s + 1 : e] = text, false)
    union all select record_id, ord, 'assertion_value' from m where len(list_filter(ma, lambda x: x is null or x not in ('isNegated', 'isFamily', 'isHistorical'))) > 0
    union all select record_id, ord, 'assertion_type' from m where len(ma) > 0 and not coalesce(type in ('TRIỆU_CHỨNG', 'CHẨN_ĐOÁN', 'THUỐC'), false)
    union all select record_id, ord, 'assertion_repeat' from m where len(list_distinct(ma)) < len(ma)
    union all select record_id, ord, 'candidate_form' from m where cod and len(list_filter(mc, lambda x: not regexp_full_match(x, case when type = 'CHẨN_ĐOÁN' then '{_ICD}' else '{_DRUG}' end))) > 0
    union all select record_id, ord, 'candidate_repeat' from m where len(list_distinct(mc)) < len(mc)
    union all select record_id, ord, 'sorted' from m where un
    union all select record_id, ord, 'unique' from m where ok and rep) """


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """The current row of every concept of the second system, with whatever NULLs it has."""
    c = read_table(spark, d, "concepts_b").where("concept_id is not null")
    row = F.struct("loaded_at", F.xxhash64("text", "type", "position", "candidates", "assertions").alias("h"), "record_id", "text", "type", "candidates", "assertions", "position")
    return c.groupBy("concept_id").agg(F.max(row).alias("r")).select(F.col("concept_id").alias("ord"), "r.*")


@query("validate_records", _BROKEN + "select record_id, ord, rule from v")
def validate_records(spark: SparkSession, d: str) -> DataFrame:
    return validation.violations(_raw(spark, d), notes(spark, d)).select("record_id", "ord", "rule")


@query("first_violations", _BROKEN + f"select record_id, min_by(ord, ord * 100 + {_RULE_NO}) as ord, min_by(rule, ord * 100 + {_RULE_NO}) as rule from v group by record_id")
def first_violations(spark: SparkSession, d: str) -> DataFrame:
    return validation.first_violation(_raw(spark, d), notes(spark, d))


_BROKEN_FILES = "case concept_id % 5 when 0 then 'this is no list' when 1 then '{\"a\": 1}' when 2 then '[1, {\"text\": \"x\"}]' when 3 then '[]' else '[{\"text\": null, \"type\": \"T\", \"assertions\": [], \"position\": [0, 1]}]' end"


@query(
    "file_violations",
    "select distinct concept_id::varchar as record_id, r.ord::bigint as ord, r.rule as rule from (select concept_id, unnest(case concept_id % 5 when 0 then [{'ord': -1, 'rule': 'list'}] when 1 then [{'ord': -1, 'rule': 'list'}] "
    "when 2 then [{'ord': 0, 'rule': 'object'}, {'ord': 1, 'rule': 'keys'}] else [] end) as r from concepts_a where concept_id is not null)",
)
def file_violations(spark: SparkSession, d: str) -> DataFrame:
    """Concept files that are no lists, hold no objects, or objects without the needed keys."""
    made = read_table(spark, d, "concepts_a").where("concept_id is not null").select(F.col("concept_id").cast("string").alias("record_id"), F.expr(_BROKEN_FILES).alias("value")).distinct()
    return validation.file_violations(made).select("record_id", "ord", "rule")


@query(
    "missing_and_extra",
    "with e as (select distinct record_id from input_notes), a as (select distinct record_id from concepts_a) select record_id, 'missing' as status from e where record_id not in (select record_id from a) "
    "union all select record_id, 'extra' from a where record_id not in (select record_id from e)",
)
def missing_and_extra(spark: SparkSession, d: str) -> DataFrame:
    return validation.missing_and_extra(read_table(spark, d, "input_notes"), read_table(spark, d, "concepts_a"))


@query("position_order", _cte("cb") + f"select id, coalesce(struct_pack(a := s, b := e) < {_LAST}, false) as unsorted, row_number() over (partition by record_id, s, e, type order by ord) > 1 as repeated from cb")
def position_order(spark: SparkSession, d: str) -> DataFrame:
    return scoring.position_order(concepts(spark, d, "concepts_b"), ["record_id"], ["ord"]).select("id", "unsorted", "repeated")


_JSON_OK = "text is not null and trim(text) != ''"


@query(
    "coerce_answers",
    f"select concept_id::varchar as record_id, text, type, array_to_string(list_sort(list_distinct(coalesce(assertions, []))), ',') as marks, greatest(coalesce(position[1], 0) - 100, 0) as start_hint from concepts_a where {_JSON_OK} and type is not null",
)
def coerce_answers(spark: SparkSession, d: str) -> DataFrame:
    """Concepts written as a model would answer, with a fence and chatter around, and read back."""
    c = read_table(spark, d, "concepts_a").where(_JSON_OK + " and type is not null")
    body = F.to_json(F.struct(F.array(F.struct("text", "type", "assertions", (F.coalesce(F.get("position", F.lit(0)), F.lit(0)) - 100).alias("start_hint"))).alias("entities")))
    answers = c.select(F.col("concept_id").cast("string").alias("record_id"), F.concat(F.lit("```json\nSure [ok: "), body, F.lit("\n```")).alias("answer"))
    out = payload.coerce_mentions(answers)
    return out.select("record_id", "text", "type", F.array_join(F.array_sort("assertions"), ",").alias("marks"), "start_hint")


@query(
    "apply_mappings",
    _cte("ca") + f"select record_id, id, array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce(candidates, []), lambda c: case when type = 'CHẨN_ĐOÁN' then upper(trim(c)) else trim(c) end), "
    f"lambda c: regexp_full_match(c, case when type = 'CHẨN_ĐOÁN' then '{_ICD}' else '{_DRUG}' end)))), '|') as codes from ca where type in ('CHẨN_ĐOÁN', 'THUỐC')",
)
def apply_mappings(spark: SparkSession, d: str) -> DataFrame:
    c = concepts(spark, d, "concepts_a")
    m = c.where("candidates is not null").select("record_id", F.col("id").alias("entity_index"), F.lit(0).alias("ord"), "candidates")
    e = c.where(F.col("type").isin("CHẨN_ĐOÁN", "THUỐC")).select("record_id", F.col("id").alias("entity_index"), "type")
    return payload.apply_mappings(e, m, 1000).select("record_id", F.col("entity_index").alias("id"), F.array_join(F.array_sort("candidates"), "|").alias("codes"))


@query(
    "restrict_codes",
    _RETRIEVED.format(top=20).rstrip().replace("with n as", _cte("ca").rstrip() + ", n as", 1)
    + """, h as (select query, system, list(code) as codes, arg_min(code, rank) filter (exact) as exact from hits group by query, system),
    e as (select record_id, id, candidates, h.codes, h.exact from (select *, case type when 'CHẨN_ĐOÁN' then 'icd10' else 'rxnorm' end as system from ca where text is not null and candidates is not null) x
      left join h on h.query = x.text and h.system = x.system),
    f as (select record_id, id, list_filter(candidates, lambda c: list_contains(coalesce(codes, []), c)) as fit from e)
    select record_id, id as entity_index, coalesce(fit[1], '') as codes from f""",
)
def restrict_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes proposed for drugs and diagnoses, kept only where retrieval finds them too."""
    t = read_table(spark, d, "terminology")
    c = concepts(spark, d, "concepts_a").where("candidates is not null and text is not null")
    c = c.withColumn("system", F.when(F.col("type") == "CHẨN_ĐOÁN", "icd10").otherwise("rxnorm"))
    hits = terminology.retrieve(c.select("text", "system"), t, extra=("system",)).withColumnRenamed("query", "text")
    e = c.select("record_id", F.col("id").alias("entity_index"), "text", "system")
    m = c.select("record_id", F.col("id").alias("entity_index"), F.lit(0).alias("ord"), "candidates")
    return payload.restrict_codes(m, hits, entities=e).select("record_id", "entity_index", F.array_join("candidates", "|").alias("codes"))


@query(
    "concept_files",
    _cte("ca", "notes").rstrip()
    + """, p as (select record_id, string_agg(s || '-' || e || ' ' || type || ' ' || coalesce(text, '') || ' ' || case when type in ('CHẨN_ĐOÁN', 'THUỐC') then array_to_string(coalesce(candidates, []), '|') else 'none' end
      || ' ' || array_to_string(coalesce(assertions, []), '|'), chr(10) order by s, e, type, text nulls first, candidates nulls first, assertions) as x, count(*)::int as n from ca group by record_id)
    select notes.record_id, md5(coalesce(x, '')) as md5, coalesce(n, 0) as n from notes left join p using (record_id)""",
)
def concept_files(spark: SparkSession, d: str) -> DataFrame:
    """The output list of every record, as it is written and packaged, read back."""
    out = sinks.concept_lists(concepts(spark, d, "concepts_a"), notes(spark, d))
    back = F.from_json("json", "array<struct<text:string,type:string,candidates:array<string>,assertions:array<string>,position:array<int>>>")
    row = lambda c: F.concat_ws(" ", F.concat_ws("-", c["position"][0], c["position"][1]), c["type"], F.coalesce(c["text"], F.lit("")), F.coalesce(F.array_join(c["candidates"], "|"), F.lit("none")), F.array_join(c["assertions"], "|"))
    return out.select("record_id", F.md5(F.array_join(F.transform(back, row), "\n")).alias("md5"), F.size(back).alias("n"))


# --- selection ------------------------------------------------------------------------------------

_LOGIT = "[((id * {a} + {b}) % 13) / 2.0, ((id * {c} + 3) % 13) / 2.0, ((id * 5 + {b}) % 13) / 2.0, ((id * 2 + 1) % 13) / 2.0, ((id * 11 + {a}) % 13) / 2.0, ((id * 3 + {c}) % 13) / 2.0]"


def _logits(a: int, b: int, c: int) -> F.Column:
    i = F.col("id")
    terms = (i * a + b, i * c + 3, i * 5 + b, i * 2 + 1, i * 11 + a, i * 3 + c)
    return F.array(*[(t % 13) / 2.0 for t in terms])


def _votes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base = spans.first_per(concepts(spark, d, "concepts_a"), ["record_id", "start", "end"], ["ord"]).withColumn("score", F.lit(0.9))
    one = base.select("record_id", "start", "end", F.lit("primary").alias("teacher"), _logits(7, 1, 4).alias("logits"))
    two = base.select("record_id", "start", "end", F.lit("secondary").alias("teacher"), _logits(3, 2, 6).alias("logits"))
    return base, one.unionByName(two)


_KINDS = ", ".join(f"'{t}'" for t in selection.VOTE_TYPES)
_VOTE = (
    _cte("ca").rstrip()
    + f", b as (select * from (select *, row_number() over (partition by record_id, s, e order by ord) as k from ca) where k = 1), l as (select *, {_LOGIT.format(a=7, b=1, c=4)} as x, {_LOGIT.format(a=3, b=2, c=6)} as y from b), "
    f"v as (select *, [{_KINDS}][list_position(x[1:5], list_max(x[1:5]))] as t1, list_max(x[1:5]) - x[6] as m1, [{_KINDS}][list_position(y[1:5], list_max(y[1:5]))] as t2, list_max(y[1:5]) - y[6] as m2 from l) "
)


@query("reject_spans", _VOTE + "select record_id, s as start, e as end, type from v where greatest(m1, m2) > -1.0")
def reject_spans(spark: SparkSession, d: str) -> DataFrame:
    return selection.reject(*_votes(spark, d)).select("record_id", "start", "end", "type")


@query("correct_types", _VOTE + "select record_id, s as start, e as end, case when type = 'TRIỆU_CHỨNG' and t1 = 'CHẨN_ĐOÁN' then t1 else type end as type from v")
def correct_types(spark: SparkSession, d: str) -> DataFrame:
    return selection.correct(*_votes(spark, d)).select("record_id", "start", "end", "type")


@query("decide_spans", _VOTE + "select record_id, s as start, e as end, t1 as type from v where len(trim(text)) >= 2 and t1 = t2 and least(m1, m2) >= 0")
def decide_spans(spark: SparkSession, d: str) -> DataFrame:
    base, votes = _votes(spark, d)
    return selection.decide(base, votes).select("record_id", "start", "end", "type")


@query(
    "consensus_additions",
    _VOTE + "select record_id, s as start, e as end, t1 as type from v where len(trim(text)) >= 2 and t1 = t2 and t1 in ('TRIỆU_CHỨNG', 'TÊN_XÉT_NGHIỆM', 'KẾT_QUẢ_XÉT_NGHIỆM') and m1 >= 1 and m2 >= 1 "
    "and not exists (select 1 from ca where ca.type = 'THUỐC' and ca.record_id = v.record_id and ca.s < v.e and v.s < ca.e)",
)
def consensus_additions(spark: SparkSession, d: str) -> DataFrame:
    raw, votes = _votes(spark, d)
    base = concepts(spark, d, "concepts_a").where("type = 'THUỐC'")
    return selection.additions(raw, base, votes).select("record_id", "start", "end", "type")


# --- runs -----------------------------------------------------------------------------------------


@query("incremental_pending", "select o_orderkey as record_id from orders where not (o_orderkey % 3 = 0)")
def incremental_pending(spark: SparkSession, d: str) -> DataFrame:
    """Records to compute again: a third is done under this signature, a third under another one."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"))
    mine, other = incremental.run_signature({"v": 1}), incremental.run_signature({"v": 2})
    done = o.where("record_id % 3 < 2").withColumn("run_signature", F.when(F.col("record_id") % 3 == 0, mine).otherwise(other))
    return incremental.pending(o, done, mine)


@query(
    "dictionary_spans",
    _cte("notes").rstrip()
    + f""", {_NAMES}, nm as (select distinct case system when 'icd10' then 'CHẨN_ĐOÁN' else 'THUỐC' end as type, lower(trim(name)) as nm from nn),
    l as (select record_id, lower(raw_text) as low from notes), p as (select record_id, low, type, nm, string_split(low, nm) as parts from l join nm on contains(low, nm)),
    q as (select record_id, low, type, len(nm) as n, unnest(list_transform(range(1, len(parts)), lambda i: list_sum(list_transform(parts[1 : i], lambda x: len(x)))::bigint + (i - 1) * len(nm))) as s from p)
    select distinct record_id, s::int as start, (s + n)::int as end, type from q
    where not (s > 0 and regexp_matches(low[s : s], '[\\p{{L}}\\p{{N}}_]')) and not regexp_matches(low[s + n + 1 : s + n + 1], '[\\p{{L}}\\p{{N}}_]')""",
)
def dictionary_spans(spark: SparkSession, d: str) -> DataFrame:
    """Every place of a dictionary's name in the notes."""
    found = pipeline.by_dictionary(read_table(spark, d, "terminology"), {"icd10": "CHẨN_ĐOÁN", "rxnorm": "THUỐC"})(notes(spark, d))
    return found.select("record_id", "start", "end", "type")


@query("predict_dictionary")
def predict_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Notes to concepts with the dictionary as proposer."""
    terms = read_table(spark, d, "terminology")
    out = pipeline.predict(notes(spark, d), pipeline.by_dictionary(terms, {"icd10": "CHẨN_ĐOÁN", "rxnorm": "THUỐC"}), terms)
    return out.select("record_id", "start", "end", "type", "text", F.array_join("assertions", ",").alias("assertions"), F.array_join("candidates", "|").alias("codes"))


@query("predict_mentions")
def predict_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Notes to concepts from quoted mentions."""
    c = concepts(spark, d, "concepts_a").where("text is not null").select("record_id", "ord", "text", "type", "assertions", F.col("start").alias("start_hint"))
    out, _ = pipeline.predict_from_mentions(notes(spark, d), c, read_table(spark, d, "terminology"))
    return out.select("record_id", "start", "end", "type", "text", F.array_join("candidates", "|").alias("codes"))
