"""Core operators: literal cases, brute force on small inputs, and defined edge cases."""

import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as X
from spanloom.operators import alignment, payload, scoring, selection, spans, terminology, validation
from spanloom.operators.copydiff import diff_copies, diff_values
from spanloom.plans import pipeline, runtime
from spanloom.sources import files, sinks
from spanloom.streaming import incremental

CONCEPT = "record_id string, id long, ord long, text string, type string, candidates array<string>, assertions array<string>, start int, end int"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


# --- copies ---------------------------------------------------------------------------------------


def brute_diff(a, b):
    out = set()
    for k in a.keys() | b.keys():
        if k not in b:
            out.add((k, "only_a"))
        elif k not in a:
            out.add((k, "only_b"))
        else:
            out |= {(k, f) for f, x, y in zip(("t", "p"), a[k], b[k]) if x != y}
    return out


def test_diff_copies_against_brute_force(spark):
    rng = random.Random(1)
    a = {k: (rng.choice(["x", "y", None, ""]), rng.choice([[1, 2], [1, None], None, []])) for k in rng.sample(range(-9000, 90000), 3000)}
    b = {k: (v if rng.random() > 0.1 else (rng.choice(["z", None]), [3])) for k, v in a.items() if rng.random() > 0.05}
    b |= {k: ("new", None) for k in range(100000, 100050)}
    schema = "k long, t string, p array<int>, v int, clash string"
    rows = lambda m: [(k, *v, 2, "c") for k, v in m.items()] + [(k, "old", [9], 1, "c") for k in list(m)[:200]] + [(k, *m[k], 2, "c") for k in list(m)[:50]]
    da, db = spark.createDataFrame(rows(a) + [(None, "n", None, 1, "c")], schema), spark.createDataFrame(rows(b), schema)
    got = diff_copies(da, db, "k", ("t", "p"), "v")
    assert {tuple(r) for r in got.collect()} == brute_diff(a, b)
    for r in diff_values(got, da, db, "k", ("t", "p"), "v").collect():
        if r["diff"] == "t":
            assert (r["value_a"], r["value_b"]) == (a[r["k"]][0], b[r["k"]][0])


def test_diff_copies_edges(spark):
    schema = "k string, t string"
    empty, some = spark.createDataFrame([], schema), spark.createDataFrame([("a", None), ("b", "x" * 100_000)], schema)
    assert diff_copies(empty, empty, "k", ("t",)).count() == 0
    assert {tuple(r) for r in diff_copies(some, empty, "k", ("t",)).collect()} == {("a", "only_a"), ("b", "only_a")}
    other = spark.createDataFrame([("a", ""), ("b", "x" * 99_999 + "y")], schema)
    assert {tuple(r) for r in diff_copies(some, other, "k", ("t",)).collect()} == {("a", "t"), ("b", "t")}


# --- text -----------------------------------------------------------------------------------------


def test_normal_forms(spark):
    assert one(spark, " Đái  tháo đường. ", X.normalize_surface) == "đái tháo đường"
    assert one(spark, "đái tháo đường", X.strip_diacritics) == "dai thao duong"
    assert one(spark, "đái tháo đường", X.normalize_term) == "ai thao uong"
    assert one(spark, "đái tháo đường", lambda c: X.normalize_term(c, True)) == "dai thao duong"
    assert one(spark, "amlodipine 10 mg po daily", lambda c: X.clean_mention(c, F.lit(True))) == "amlodipine 10 mg"
    assert one(spark, "aspirin 2,5MG", lambda c: X.clean_mention(c, F.lit(True))) == "aspirin 2.5 MG"
    assert one(spark, None, X.normalize_surface) is None
    assert one(spark, "", X.char_ngrams) == [] and one(spark, "ab", X.char_ngrams) == ["ab"]
    assert one(spark, "abcd", X.char_ngrams) == ["abc", "bcd"]
    assert one(spark, "A001", X.dotted_code) == "A00.1" and one(spark, "j18", X.dotted_code) == "J18"


def test_synonym_cells(spark):
    assert one(spark, "+ viêm phổi; viêm phế quản", X.who_synonyms) == ["viêm phổi", "viêm phế quản"]
    assert one(spark, "viêm phổi; - ;viêm gan", X.who_synonyms) == ["viêm phổi"]
    assert one(spark, "viêm phổi (J18)", X.who_synonyms) == [] and one(spark, "Bao gồm: lao", X.who_synonyms) == [] and one(spark, None, X.who_synonyms) == []


def test_word_error_rate(spark):
    rows = [("a b c", "a b c", 0.0), ("a b c", "a x c", 1 / 3), ("a", "x y z", 3.0), ("", "", 0.0), ("", "a", 1.0), ("a", "", 1.0)]
    long = " ".join(f"w{i}" for i in range(300))
    rows.append((long, long.replace("w7 ", "v "), 1 / 300))
    df = spark.createDataFrame(rows, "r string, h string, e double").select("e", X.word_error_rate(F.col("r"), F.col("h")).alias("g"))
    assert all(abs(r["e"] - r["g"]) < 1e-9 for r in df.collect())


def test_jaccard_edges(spark):
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "a array<string>, b array<string>")
    got = [(r[0], r[1]) for r in df.select(X.jaccard(F.col("a"), F.col("b"), 1.0), X.jaccard(F.col("a"), F.col("b"), 0.0)).collect()]
    assert got[0] == (1.0, 0.0) and got[1] == (0.0, 0.0) and abs(got[2][0] - 1 / 3) < 1e-9


@pytest.mark.parametrize("size", [3, 12, 50])
def test_chunks_concatenate(spark, size):
    rng = random.Random(size)
    texts = ["", "\n", "abc"] + ["".join(rng.choices("ab \n", k=rng.randint(1, 300))) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.chunks(F.col("t"), size).alias("c"))

    def expected(t):
        out, p = [], 0
        while p < len(t):
            e = min(p + size, len(t))
            if e < len(t) and t.rfind("\n", p, e) > p:
                e = t.rfind("\n", p, e) + 1
            out.append((p, t[p:e]))
            p = e
        return out or [(0, "")]

    for r in df.collect():
        assert [(c["offset"], c["chunk"]) for c in r["c"]] == expected(r["t"])


def marks(spark, text, mention, kind="TRIỆU_CHỨNG", **flags):
    df = spark.createDataFrame([(text, text.index(mention))], "t string, s int")
    return df.select(X.detect_assertions(F.col("t"), F.col("s"), F.lit(kind in alignment.ASSERTABLE), **flags).alias("m")).first()["m"]


def test_assertions(spark):
    assert marks(spark, "Bệnh nhân không ho", "ho") == ["isNegated"]
    assert marks(spark, "không sốt, ho", "ho") == ["isNegated"]  # a comma doesn't end the scope
    assert marks(spark, "không sốt nhưng ho", "ho") == [] and marks(spark, "không sốt. ho", "ho") == [] and marks(spark, "không sốt\nho", "ho") == []
    assert marks(spark, "tiền sử ho", "ho") == ["isHistorical"] and marks(spark, "tiền sử không ho", "ho") == ["isNegated", "isHistorical"]
    assert marks(spark, "Tiền sử bệnh:\n- ho", "ho") == [] and marks(spark, "Tiền sử bệnh:\n- ho", "ho", sections=True) == ["isHistorical"]
    assert marks(spark, "mẹ bị ho", "ho") == [] and marks(spark, "mẹ bị ho", "ho", family=True) == ["isFamily"]
    assert marks(spark, "không ho", "ho", kind="TÊN_XÉT_NGHIỆM") == []


def test_line_context(spark):
    t = "Tiền sử\n\n  ho nhiều\nsốt"
    df = spark.createDataFrame([(t, t.index("sốt"), len(t)), (t, t.index("ho"), t.index("ho") + 2), ("ho", 0, 2)], "t string, s int, e int")
    got = [r[0] for r in df.select(X.line_context(F.col("t"), F.col("s"), F.col("e"))).collect()]
    assert got == ["[mục: ho nhiều] sốt", "[mục: Tiền sử]   ho nhiều", "ho"]


# --- spans ----------------------------------------------------------------------------------------


def random_spans(rng, n, records=5):
    out = []
    for i in range(n):
        s = rng.randint(0, 60)
        out.append((f"r{rng.randint(1, records)}", s, s + rng.randint(1, 9), rng.choice("AB"), rng.choice([0.1, 0.5, 0.9]), i))
    return out


def test_suppression_against_brute_force(spark):
    rng = random.Random(3)
    rows = random_spans(rng, 300)
    got = {tuple(r) for r in spans.suppress_overlaps(spark.createDataFrame(rows, pipeline.SPAN)).select("record_id", "start", "end", "ord").collect()}
    want = set()
    for rec in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == rec), key=lambda r: (-r[4], r[1] - r[2], r[5])):
            if all(r[2] <= k[1] or r[1] >= k[2] for k in kept):
                kept.append(r)
        want |= {(rec, k[1], k[2], k[5]) for k in kept}
    assert got == want


def test_matching_and_anti_join_against_brute_force(spark):
    rng = random.Random(4)
    p, g = random_spans(rng, 200), random_spans(rng, 200)
    schema = "record_id string, start int, end int, type string, score double, id long"
    dp, dg = spark.createDataFrame(p, schema), spark.createDataFrame(g, schema)
    got = {(r["pid"], r["gid"]) for r in spans.greedy_match(dp, dg, ["record_id", "type"]).collect()}
    pairs = sorted((-(min(a[2], b[2]) - max(a[1], b[1])), a[5], b[5]) for a in p for b in g if a[0] == b[0] and a[3] == b[3] and min(a[2], b[2]) > max(a[1], b[1]))
    used_p, used_g, want = set(), set(), set()
    for _, i, j in pairs:
        if i not in used_p and j not in used_g:
            used_p.add(i), used_g.add(j), want.add((i, j))
    assert got == want
    free = {r["id"] for r in spans.without_overlap(dp, dg, ["record_id"]).collect()}
    assert free == {a[5] for a in p if not any(a[0] == b[0] and a[1] < b[2] and b[1] < a[2] for b in g)}


def test_span_edges(spark):
    empty = spark.createDataFrame([], pipeline.SPAN)
    assert spans.suppress_overlaps(empty).count() == 0 and spans.gate(empty).count() == 0
    odd = spark.createDataFrame([("r", None, 3, "A", 0.5, 1), ("r", 0, 3, "A", None, 2), (None, 0, 1, "A", 0.5, 3)], pipeline.SPAN)
    assert [r["ord"] for r in spans.suppress_overlaps(odd).collect()] == [2]
    gated = spark.createDataFrame([("r", 0, 1, t, s, i) for i, (t, s) in enumerate([("THUỐC", 0.3), ("THUỐC", 0.29), ("X", 0.5), (None, 0.49)])], pipeline.SPAN)
    assert {r["ord"] for r in spans.gate(gated).collect()} == {0, 2}


def test_headers_and_trims(spark):
    for value, want in (("Thuốc :", True), ("XÉT NGHIỆM", True), ("xet nghiem", True), ("1.", True), ("x", True), ("thuốc ho", False), (None, True)):
        assert one(spark, value, spans.is_header) is want
    text = "hội chứng Cushing nặng"
    df = spark.createDataFrame([(text, 0, len(text)), ("hội chứng X", 0, 11)], "t string, s int, e int")
    assert [r[0] for r in df.select(spans.trim_generic_prefix(F.col("t"), F.col("s"), F.col("e"))).collect()] == [10, 0]
    drug = "amlodipine 10 mg po daily để hạ áp\nbid"
    df = spark.createDataFrame([(drug, 10), ("aspirin cho đau po", 7), ("aspirin 81mg, uống", 7)], "t string, e int")
    assert [r[0] for r in df.select(spans.extend_medication(F.col("t"), F.col("e"))).collect()] == [25, 7, 13]
    df = spark.createDataFrame([("  ho  ", 0, 6)], "t string, s int, e int")
    assert tuple(df.select(spans.trim_edges(F.col("t"), F.col("s"), F.col("e")).alias("x")).first()["x"]) == (2, 4)


# --- alignment ------------------------------------------------------------------------------------


def align(spark, text, mentions):
    m = spark.createDataFrame([("1", i, t, k, a, h) for i, (t, k, a, h) in enumerate(mentions)], "record_id string, ord long, text string, type string, assertions array<string>, start_hint int")
    out = alignment.align_mentions(m, spark.createDataFrame([("1", text)], "record_id string, raw_text string"))
    return [(r["start"], r["end"], r["tier"], r["assertions"]) for r in out.orderBy("ord").collect()]


def test_alignment(spark):
    text = "Hôm nay, ho khan. Đêm qua ho khan và Ho  Khan."
    s = "TRIỆU_CHỨNG"
    first, second, third = text.index("ho khan"), text.rindex("ho khan"), text.index("Ho  Khan")
    got = align(spark, text, [("ho khan", s, [], 0), ("ho khan", s, [], 0), ("ho khan", s, [], 0), ("ho khan", s, [], 0)])
    assert [g[:3] for g in got] == [(first, first + 7, 1), (second, second + 7, 1), (third, third + 8, 3), (None, None, None)]
    assert align(spark, text, [("ho khan", s, [], second)])[0][0] == second
    assert align(spark, text, [("HO KHAN", s, [], 0)])[0][2] == 2
    assert align(spark, text, [("khan", "TÊN_XÉT_NGHIỆM", ["isNegated"], 0)])[0][3] == []
    assert align(spark, text, [("khan", s, ["isHistorical", "isNegated", "isNegated", "x"], 0)])[0][3] == ["isNegated", "isHistorical"]
    assert align(spark, text, [("", s, [], 0), (None, s, None, None), ("sốt", s, [], 0)])[1][:2] == (None, None)
    assert align(spark, "a.b a+b a\\Eb", [("a.b", s, [], 0), ("a+b", s, [], 0), ("a\\Eb", s, [], 0)])[2][:3] == (8, 12, 1)


# --- metrics --------------------------------------------------------------------------------------


def concept_rows(*items):
    return [(r, i, i, t, k, c, a, s, e) for i, (r, t, k, c, a, s, e) in enumerate(items)]


D, S = "CHẨN_ĐOÁN", "TRIỆU_CHỨNG"
GOLD = concept_rows(("1", "viêm phổi", D, ["J18.9"], [], 0, 9), ("1", "ho", S, None, ["isNegated"], 12, 14), ("2", "sốt", S, None, [], 0, 3))


def score(spark, pred, gold=GOLD):
    return scoring.score_corpus(spark.createDataFrame(pred, CONCEPT), spark.createDataFrame(gold, CONCEPT)).first()


def test_scores(spark):
    r = score(spark, GOLD)
    assert (r["text"], r["assertions"], r["candidates"], r["final"]) == (1.0, 1.0, 1.0, 1.0)
    silent, guess = score(spark, []), score(spark, concept_rows(("1", "xx", S, None, [], 20, 22)))
    assert silent["text"] == 0.0 and guess["spurious"] == 1
    spurious = score(spark, concept_rows(("2", "sốt", S, None, [], 0, 3), ("2", "xx", S, None, [], 9, 11)), concept_rows(("2", "sốt", S, None, [], 0, 3)))
    assert abs(spurious["text"] - 1 / 3) < 1e-9
    extra = score(spark, concept_rows(("1", "viêm phổi", D, ["J18.9", "J18.1"], [], 0, 9)), GOLD[:1])
    assert abs(extra["candidates"] - 0.5) < 1e-9
    assert score(spark, GOLD, [])["text"] == 1.0 and score(spark, GOLD, [])["spurious"] == 0  # records of the truth only


def test_tools(spark):
    c = spark.createDataFrame([(-3.0,), (-1.0,), (0.5,), (None,)], "margin double")
    assert {r["margin"]: r["dropped"] for r in scoring.margin_curve(c).collect()}[1.0] == 2
    runs = spark.createDataFrame([("a", 1.0, 5.0), ("b", 2.0, 4.0), ("c", 3.0, 9.0)], "name string, known double, measured double")
    assert {(r["a"], r["b"]): r["preserved"] for r in scoring.order_preservation(runs).collect()} == {("a", "b"): False, ("a", "c"): True, ("b", "c"): True}
    k = "record_id string, start int, end int, type string"
    a, b = spark.createDataFrame([("1", 0, 2, "A"), ("1", 3, 5, "B")], k), spark.createDataFrame([("1", 0, 2, "A"), ("1", 3, 5, "A")], k)
    r = scoring.label_agreement(a, b, spark.createDataFrame([("1", 0, 2, "B")], k)).first()
    assert (r["core"], r["only_a"], r["only_b"], r["hit"], r["bound_hit"], r["wrong_type"]) == (1, 1, 1, 0, 1, 1)


# --- dictionaries ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def terms(spark):
    rows = [("K21.9", "Trào ngược dạ dày", ["GERD", ""]), ("J18", "Viêm phổi", None), ("J18.9", "Viêm phổi không xác định", []), ("A00", "Tả", ["bệnh tả"]), ("A01", "Thương hàn", ["bệnh tả"])]
    return spark.createDataFrame(rows, "code string, label string, aliases array<string>")


def test_exact_link(spark, terms):
    m = spark.createDataFrame([("gerd",), ("trao nguoc da day",), ("Bệnh tả",), ("viêm phổi",), ("không có",), ("",), (None,)], "text string")
    got = {r["text"]: (len(r["found"]), r["codes"]) for r in terminology.exact_link(m, terms).collect()}
    assert got["gerd"] == (1, ["K21.9"]) and got["trao nguoc da day"] == (1, ["K21.9"])
    assert got["Bệnh tả"] == (2, []) and got["viêm phổi"] == (1, ["J18.9"]) and got["không có"] == got[""] == got[None] == (0, [])


def test_retrieval_against_brute_force(spark, terms):
    def norm(s):
        import re
        import unicodedata

        d = "".join(c for c in unicodedata.normalize("NFD", s.casefold()) if unicodedata.category(c) != "Mn")
        return re.sub("[^a-z0-9]+", " ", d).strip()

    def grams(x):
        x = x.replace(" ", "_")
        return set() if not x else {x} if len(x) <= 3 else {x[i : i + 3] for i in range(len(x) - 2)}

    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    queries = ["trao nguoc da day", "viem phoi", "bệnh tả cấp"]
    want = {}
    for text in queries:
        q = norm(text)
        rows = []
        for t in terms.collect():
            names = {norm(n) for n in [t["label"], *(t["aliases"] or [])] if n.strip()}
            words, gs = {w for n in names for w in n.split() if len(w) >= 2}, set().union(*map(grams, names))
            qw = {w for w in q.split() if len(w) >= 2}
            if q in names or qw & words or grams(q) & gs:
                s = min(1.0, (q in names) + 0.18 * any(q in n or n in q for n in names) + 0.55 * jac(qw, words) + 0.27 * jac(grams(q), gs))
                rows.append((-s, q not in names, t["code"]))
        want[text] = [(c, round(-s, 9)) for s, _, c in sorted(rows)[:2]]
    got = {}
    for r in terminology.retrieve(spark.createDataFrame([(q,) for q in [*queries, "", None]], "text string"), terms, top_k=2).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["code"], round(r["score"], 9)))
    assert got == want


def test_retrieval_in_workers_and_by_join(spark, terms):
    q = spark.createDataFrame([(t, s) for t in ("Trào ngược dạ dày", "trao nguoc da day", "viem phoi nang", "a", "tả", "benh benh ta", "zq") for s in ("icd10", "other")], "text string, system string")
    t = terms.withColumn("system", F.lit("icd10")).select("code", "system", "label", "aliases")
    out = [{(r["query"], r["system"], r["rank"]): (r["code"], round(r["score"], 9), r["exact"]) for r in terminology.retrieve(q, t, extra=("system",), top_k=3, block_entries=n).collect()} for n in (5_000, 1)]
    assert out[0] == out[1] and len({k[0] for k in out[0]}) >= 4 and {k[1] for k in out[0]} == {"icd10"}


@pytest.mark.parametrize("block", [5_000, 4])
def test_hybrid_retrieval_against_brute_force(spark, block):
    rng = random.Random(7)
    labels = ["sore throat", "throat pain", "viem hong", "viem phoi", "pain", "sore"]
    names = [("k", f"C{i:02}", f"{labels[i % 6]} {i // 6}" if i > 5 else labels[i]) for i in range(30)] + [("other", "X1", "dau hong")]
    vec = {(s, c): [rng.gauss(0, 1) for _ in range(4)] for s, c, _ in names}
    vec = {k: [x / math.sqrt(sum(y * y for y in v)) for x in v] for k, v in vec.items()}
    del vec["k", "C05"]
    vec["k", "C07"] = vec["k", "C13"]
    asked = [("dau hong", "a", vec["k", "C01"]), ("dau hong", "b", vec["k", "C10"]), ("sore throat", "a", vec["k", "C09"]), ("zzzz", "a", vec["k", "C13"]), ("viem phoi", "a", None), ("zzzz", "b", None), (" ", "a", vec["k", "C01"])]
    terms = spark.createDataFrame([(s, c, n, []) for s, c, n in names], "system string, code string, label string, aliases array<string>")
    vectors = spark.createDataFrame([(*k, v) for k, v in vec.items()], "system string, code string, embedding array<double>")
    queries = spark.createDataFrame([(t, c, "k", e) for t, c, e in asked], "text string, context string, system string, embedding array<double>")
    grams = lambda x: {x.replace(" ", "_")[i : i + 3] for i in range(len(x) - 2)}
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    want = {}
    for t, c, e in asked:
        lexical = {}
        words = {w for w in t.split() if len(w) >= 2}
        for s, code, n in names:
            nw = {w for w in n.split() if len(w) >= 2}
            if s == "k" and t.strip() and (words & nw or grams(t) & grams(n)):
                lexical[code] = min(1.0, (t == n) + 0.18 * (t in n or n in t) + 0.55 * jac(words, nw) + 0.27 * jac(grams(t), grams(n)))
        dots = {code: sum(x * y for x, y in zip(v, e)) for (s, code), v in vec.items() if s == "k"} if e and t.strip() else {}
        near = sorted(dots, key=lambda x: (-round(dots[x], 9), x))[:6]
        score = {x: lexical.get(x, 0.0) if x not in dots else 0.52 * lexical.get(x, 0.0) + 0.48 * (dots[x] + 1) / 2 for x in {*lexical, *near}}
        best = sorted(score, key=lambda x: (-round(score[x], 9), ("k", x, t) not in names, x))[:3]
        want |= {(t, c, i + 1): (x, round(score[x], 6), ("k", x, t) in names) for i, x in enumerate(best)}
    out = terminology.hybrid_retrieve(queries, terms, vectors, extra=("system",), keys=("context",), top_k=3, pool=6, block_entries=block)
    got = {(r["query"], r["context"], r["rank"]): (r["code"], round(r["score"], 6), r["exact"]) for r in out.collect()}
    assert got == want
    assert got["zzzz", "a", 1][0] == "C07" and ("zzzz", "b", 1) not in got  # found by its vector alone


def test_vectors(spark):
    rng = random.Random(5)
    vecs = [(i, [rng.random() for _ in range(8)]) for i in range(60)] + [(60, None), (61, [1.0])]
    df = spark.createDataFrame(vecs, "id int, embedding array<float>")
    q = df.where("id < 3").withColumnRenamed("id", "qid")
    got = {(r["qid"], r["rank"]): r["id"] for r in terminology.vector_topk(q, df, 4).collect()}
    plain = {i: [float(x) for x in r["embedding"]] for i, r in ((r["id"], r) for r in df.where("id < 60").collect())}
    for i in range(3):
        order = sorted(plain, key=lambda j: (-sum(x * y for x, y in zip(plain[i], plain[j])), j))[:4]
        assert [got[i, k] for k in range(1, 5)] == order


def test_dictionary_builds(spark, tmp_path):
    names = spark.createDataFrame([("A00", 3, "c"), ("A00", 1, "b"), ("A00", 2, "a"), ("A00", 4, "b"), ("A0", 1, "x")], "code string, ord int, name string")
    assert [tuple(r) for r in terminology.fold_aliases(names).collect()] == [("A00", "b", ["a", "c"])]
    line = lambda code, tty, name, sup="N", sab="RXNORM": "|".join([code, "ENG", *[""] * 9, sab, tty, "", name, "", sup, ""])
    lines = [line("1", "SCD", "long name 5 MG"), line("1", "IN", "short"), line("1", "SY", "other"), line("1", "SY", "other"), line("2", "SCDC", "part"), line("2", "TMSY", "part x"), line("3", "IN", "gone", "O"), line("4", "IN", "alien", sab="X"), "bad|row"]
    raw = spark.createDataFrame(list(enumerate(lines)), "ord int, value string")
    rows = terminology.rrf_rows(raw)
    assert [tuple(r) for r in terminology.fold_drug_names(rows).collect()] == [("1", "short", ["long name 5 MG", "other"])]
    ranked = spark.createDataFrame([("1", False, "SCD", "bbb"), ("1", True, "IN", "cc"), ("1", False, "SBD", "a")], "code string, preferred boolean, tty string, name string")
    assert [tuple(r) for r in terminology.rank_labels(ranked).collect()] == [("1", "cc", ["a", "bbb"])]
    t = spark.createDataFrame([("10", "x", ["p", "q"]), ("9", "y", []), ("A", "z", None)], "code string, label string, aliases array<string>")
    assert [r["code"] for r in sinks.terms_table(t, True).collect()] == ["A", "9", "10"] and [r["code"] for r in sinks.terms_table(t, False).collect()] == ["10", "9", "A"]


# --- validation and payloads ----------------------------------------------------------------------


def test_sanitize(spark):
    f = lambda kind, allow=None: lambda c: validation.sanitize_codes(F.lit(kind), c, 2, allow)
    assert one(spark, [" j18.9 ", "J18.9", "bad", "K21", "A00"], f(D), "array<string>") == ["J18.9", "K21"]
    assert one(spark, ["12", "x1", " 7 "], f("THUỐC", F.array(F.lit("7"))), "array<string>") == ["7"]
    assert one(spark, None, f(D), "array<string>") is None and one(spark, [], f(D), "array<string>") == []


def test_queries_of_several_widths(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0, 1.0]), (4, None)], "id long, embedding array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.5]), (8, [1.0, 0.0, 0.0]), (9, None), (10, [1.0])], "qid long, embedding array<double>")
    for block in (2_000, 1):
        assert {(r["qid"], r["id"], r["rank"]) for r in terminology.vector_topk(q, v, 2, block).collect()} == {(7, 1, 1), (7, 2, 2), (8, 3, 1)}


def test_file_violations(spark):
    ok = {"text": None, "type": "T", "assertions": [], "position": [0, 1]}
    rows = [("1", "this is not json"), ("2", '{"text": "x"}'), ("3", json.dumps([ok, 5, {k: v for k, v in ok.items() if k != "assertions"}])), ("4", "[]"), ("5", json.dumps([ok])), ("6", None), ("7", "[1, 2")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "record_id string, value string, ord string")
    got = {(r["record_id"], r["ord"], r["rule"]) for r in validation.file_violations(df).collect()}
    assert got == {("1", -1, "list"), ("2", -1, "list"), ("3", 1, "object"), ("3", 2, "keys"), ("6", -1, "list"), ("7", -1, "list")}
    assert validation.file_violations(df.limit(0)).count() == 0


def test_planning_computes_nothing(spark):
    """Dealing rows out anew runs no job, even behind a shuffle."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    try:
        one = runtime.spread(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
        two = runtime.spread(spark.range(100))
        assert not tracker.getJobIdsForGroup("plan")
        assert one.count() == 7 and two.count() == 100
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_written_tables_are_removed(spark):
    before = set(runtime._WRITTEN)
    df = runtime.written(spark.range(10))
    (path,) = set(runtime._WRITTEN) - before
    assert df.count() == 10
    runtime.discard(df)
    assert path not in runtime._WRITTEN and not os.path.exists(path.removeprefix("file:"))


def test_violations(spark):
    schema = "record_id string, ord int, text string, type string, candidates array<string>, assertions array<string>, position array<int>"
    rows = [
        ("1", 0, "ho", S, None, [], [0, 2]), ("1", 1, "xx", S, None, [], [3, 6]), ("1", 2, "ho", S, [], ["isNegated", "isNegated"], [0, 2]), ("1", 3, "ho", "?", None, ["odd"], [0, 99]),
        ("1", 4, "sốt", D, None, [], [3, 6]), ("1", 5, "sốt", D, ["J1", "J18", "J18"], [], [3, 6]), ("1", 6, None, None, None, None, None), ("9", 0, "a", S, None, [], [0, 1]),
    ]
    got = {}
    for r in validation.violations(spark.createDataFrame(rows, schema), spark.createDataFrame([("1", "ho sốt")], "record_id string, raw_text string")).collect():
        got.setdefault((r["record_id"], r["ord"]), set()).add(r["rule"])
    assert ("1", 0) not in got
    assert got["1", 1] == {"text"} and got["1", 2] == {"candidates_presence", "assertion_repeat", "sorted", "unique"}
    assert got["1", 3] == {"type", "bounds", "assertion_value", "assertion_type"} and got["1", 4] == {"candidates_presence"}
    assert got["1", 5] == {"candidate_form", "candidate_repeat", "unique"} and {"type", "position"} <= got["1", 6] and got["9", 0] == {"bounds"}
    with pytest.raises(validation.RecordError):
        validation.check_record(spark.createDataFrame(rows, schema), spark.createDataFrame([("1", "ho sốt")], "record_id string, raw_text string"))


def test_payloads(spark):
    rows = [
        ("1", '```json\n{"entities": [{"text": "ho", "type": "TRIỆU_CHỨNG", "assertions": {"isNegated": true, "isFamily": "có", "isHistorical": false}, "start_hint": -4}]}\n```'),
        ("2", 'Here: {"text": "ho", "type": "TRIỆU_CHỨNG", "assertions": "isFamily"} done'),
        ("3", '[{"text": "x", "type": "KHÁC"}, {"text": "", "type": "THUỐC"}, {"text": "y", "type": "THUỐC", "assertions": ["isHistorical", ["isNegated"]], "start_hint": "7"}]'),
        ("4", "no json [here"),
        ("5", None),
    ]
    got = {r["record_id"]: (r["text"], sorted(r["assertions"]), r["start_hint"]) for r in payload.coerce_mentions(spark.createDataFrame(rows, "record_id string, answer string")).collect()}
    assert got == {"1": ("ho", ["isFamily", "isNegated"], 0), "2": ("ho", ["isFamily"], 0), "3": ("y", ["isHistorical", "isNegated"], 7)}
    rows = [("1", '{"mappings": [{"entity_index": 0, "candidates": ["A", null, "B"]}, {"candidates": ["C"]}]}'), ("2", '{"entity_index": 1, "candidates": 5}')]
    got = {(r["record_id"], r["entity_index"]): r["candidates"] for r in payload.coerce_mappings(spark.createDataFrame(rows, "record_id string, answer string")).collect()}
    assert got == {("1", 0): ["A", "B"], ("2", 1): ["5"]}
    m = spark.createDataFrame([("1", 0, 0, ["Z", "B"]), ("1", 0, 1, ["A"])], "record_id string, entity_index int, ord int, candidates array<string>")
    r = spark.createDataFrame([("1", 0, "A", True, 1), ("1", 0, "B", False, 2), ("1", 1, "C", True, 3), ("1", 1, "D", False, 1)], "record_id string, entity_index int, code string, exact boolean, rank int")
    assert {x["entity_index"]: x["candidates"] for x in payload.restrict_codes(m, r).collect()} == {0: ["B"], 1: ["C"]}
    e = spark.createDataFrame([("1", 0, "x"), ("1", 1, "x"), ("1", 2, "none")], "record_id string, entity_index int, text string")
    r = r.where("entity_index = 0").select(F.lit("x").alias("text"), "code", "exact", "rank")
    assert {x["entity_index"]: x["candidates"] for x in payload.restrict_codes(m.unionAll(m.limit(1).selectExpr("'1'", "2", "0", "array('A')")), r, entities=e).collect()} == {0: ["B"], 1: ["A"], 2: []}
    df = spark.createDataFrame([('{"a":1}',), ("[1",), ("x",), (None,)], "x string")
    assert [x[0] for x in df.select(payload.is_complete_json(F.col("x"))).collect()] == [True, False, False, False]


# --- selection ------------------------------------------------------------------------------------


def test_selection(spark):
    raw = spark.createDataFrame([("1", 0, 2, "ho", 1), ("1", 5, 8, "sốt", 2), ("1", 5, 8, "sốt", 3), ("1", 20, 21, "x", 4)], "record_id string, start int, end int, text string, ord long")
    base = spark.createDataFrame([("1", 0, 2, S, 0.9, 1)], "record_id string, start int, end int, type string, score double, ord long")

    def votes(first, second=None):
        rows = [("1", 0, 2, "primary", first), ("1", 5, 8, "primary", [9.0, 0, 0, 0, 0, 1.0])]
        if second:
            rows += [("1", 0, 2, "secondary", second), ("1", 5, 8, "secondary", [8.0, 0, 0, 0, 0, 6.9])]
        return spark.createDataFrame([(*r[:4], [float(x) for x in r[4]]) for r in rows], "record_id string, start int, end int, teacher string, logits array<double>")

    junk, good = [0, 0, 0, 0, 0, 5], [0, 6, 0, 0, 0, 1]
    assert selection.reject(base, votes(junk)).count() == 0 and selection.reject(base, votes(junk, good)).count() == 1
    assert selection.reject(base, votes([4, 0, 0, 0, 0, 5]), 1.0).count() == 0 and selection.reject(base, votes([4.1, 0, 0, 0, 0, 5]), 1.0).count() == 1
    assert selection.correct(base, votes(good)).first()["type"] == D
    added = selection.additions(raw, base, votes(good, good)).collect()
    assert [(r["start"], r["type"], r["score"], r["ord"]) for r in added] == [(5, S, 0.0, 2)]
    assert selection.additions(raw, base, votes(good)).count() == 0
    assert {(r["start"], r["type"]) for r in selection.decide(raw, votes(good)).collect()} == {(0, D), (5, S)}
    assert {(r["start"], r["type"]) for r in selection.decide(raw, votes(good, junk)).collect()} == {(5, S)}
    assert {(r["start"], r["type"]) for r in selection.select(raw, base, votes(good, good)).collect()} == {(0, D), (5, S)}


# --- sources, sinks, runs -------------------------------------------------------------------------


def test_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "2.txt").write_bytes("a\r\nb".encode())
    (folder / "10.txt").write_text("ho khan", encoding="utf-8")
    (folder / "x.txt").write_text("no")
    assert {tuple(r) for r in files.read_records(spark, str(folder)).collect()} == {("2", "a\nb"), ("10", "ho khan")}
    assert files.read_records(spark, str(folder), files.parse_ids("010")).count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_records(spark, str(folder), ["3"])
    with pytest.raises(FileNotFoundError):
        files.read_records(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.parse_ids("1,x")
    out = tmp_path / "out"
    concepts = spark.createDataFrame([("10", 3, 7, "khan", "THUỐC", None, None), ("10", 0, 2, "ho", S, None, ["isNegated"])], "record_id string, start int, end int, text string, type string, candidates array<string>, assertions array<string>")
    lists = sinks.concept_lists(concepts, files.read_records(spark, str(folder)))
    sinks.write_concept_files(lists, str(out))
    assert json.loads((out / "10.json").read_text(encoding="utf-8")) == [
        {"text": "ho", "type": S, "assertions": ["isNegated"], "position": [0, 2]},
        {"text": "khan", "type": "THUỐC", "candidates": [], "assertions": [], "position": [3, 7]},
    ]
    back = files.read_concepts(spark, str(out))
    assert back.count() == 2 and back.where("candidates is null").count() == 1
    assert sinks.write_package(lists, str(tmp_path / "p.zip")) == 2
    import zipfile

    assert zipfile.ZipFile(tmp_path / "p.zip").namelist() == ["output/2.json", "output/10.json"]


def test_term_files(spark, tmp_path):
    j = tmp_path / "t.jsonl"
    j.write_text('{"code": "A", "label": "x", "aliases": ["p"]}\n\n{"code": "B", "label": "y", "aliases": "q|r"}\n{"code": "", "label": "z"}\n{"code": "A", "label": "later"}\n', encoding="utf-8")
    assert {tuple(map(str, r)) for r in files.read_terms(spark, str(j)).collect()} == {("A", "x", "['p']"), ("B", "y", "['q', 'r']")}
    t = tmp_path / "t.tsv"
    t.write_text("CODE\tLabel\tAliases\nA\tx\tp| q\nB\ty\t\n", encoding="utf-8")
    assert {r["code"]: r["aliases"] for r in files.read_terms(spark, str(t)).collect()} == {"A": ["p", "q"], "B": []}
    t.write_text("code\tlabel\nA\t\n", encoding="utf-8")
    with pytest.raises(ValueError):
        files.read_terms(spark, str(t))
    a = tmp_path / "allow.txt"
    a.write_text("# c\na1,x\n\nb\n")
    assert {r[0] for r in files.read_allow_list(spark, str(a), upper=True).collect()} == {"A1", "B"}
    c = tmp_path / "codes.txt"
    c.write_text("A001  Cholera one\nA001  again\nbad\n")
    assert [tuple(r) for r in files.read_code_list(spark, str(c)).collect()] == [("A001", "Cholera one")]
    with pytest.raises(ValueError):
        files.read_code_list(spark, str(c), low=5)
    s = tmp_path / "s.csv"
    s.write_text("title,,\nMã bệnh,Tên,\nA00,Tả,\n", encoding="utf-8")
    assert files.read_code_sheet(spark, str(s)).select("`MÃ BỆNH`", "`TÊN`").collect()[0][1] == "Tả"


def test_incremental(spark, tmp_path):
    sig, other = incremental.run_signature({"b": 1, "a": 2}), incremental.run_signature({"a": 3})
    records = spark.createDataFrame([("1",), ("2",), ("3",)], "record_id string")
    done = records.where("record_id < '3'").withColumn("run_signature", F.when(F.col("record_id") == "1", sig).otherwise(other))
    assert {r[0] for r in incremental.pending(records, done, sig).collect()} == {"2", "3"}
    assert {r[0] for r in incremental.conflicts(records, done, sig).collect()} == {"2"}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.txt").write_text("a")
    seen = []
    for n in (1, 2):
        incremental.follow_records(spark, str(folder), str(tmp_path / "cp"), lambda df, _: seen.extend(r["record_id"] for r in df.collect())).awaitTermination(60)
        (folder / "2.txt").write_text("b")
    assert seen == ["1", "2"]


def test_pipeline(spark):
    text = "Tiền sử dùng aspirin 81 mg po và không ho."
    records = spark.createDataFrame([("1", text)], "record_id string, raw_text string")
    terms = spark.createDataFrame([("1191", "rxnorm", "aspirin 81 mg", []), ("R05", "icd10", "ho gà", [])], "code string, system string, label string, aliases array<string>")
    raw = spark.createDataFrame([("1", text.index("aspirin"), text.index("aspirin") + 8, "THUỐC", 0.9, 1), ("1", text.index("ho."), text.index("ho.") + 2, S, 0.9, 2), ("1", 0, 7, S, 0.8, 3)], pipeline.SPAN)
    got = {r["text"]: (r["assertions"], r["candidates"]) for r in pipeline.predict(records, pipeline.replay(raw), terms).collect()}
    assert got == {"aspirin 81 mg po": (["isHistorical"], ["1191"]), "ho": (["isNegated", "isHistorical"], None)}
    found = pipeline.by_dictionary(terms, {"rxnorm": "THUỐC"})(records).collect()
    assert [(r["start"], r["end"]) for r in found] == [(13, 26)]
    model = pipeline.by_model(lambda: lambda texts: [[(0, 2, S, 0.5)] for _ in texts])
    assert model(records).count() == 1
    assert pipeline.parse_thresholds(["A=0.5"]) == {"A": 0.5}
