"""Adapters, command line, published label sets, entry contract."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spanloom import cli
from spanloom.operators import scoring
from spanloom.plans import adapters, catalog
from spanloom.sources import files

DATA = "/root/testdata/sf0.001"


def test_generation_uses_the_cache(spark):
    prompts = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", None)], "record_id string, prompt string")
    first = adapters.generate(prompts, lambda: lambda batch: [p.upper() for p in batch], "m")
    assert {r["record_id"]: r["answer"] for r in first.collect()} == {"1": "A", "2": "A", "3": "B", "4": None}
    cache = first.where("answer = 'A'").select("key", F.lit("kept").alias("answer")).distinct()
    again = adapters.generate(prompts, lambda: lambda batch: [p.upper() for p in batch], "m", cache)
    assert {r["record_id"]: r["answer"] for r in again.collect()} == {"1": "kept", "2": "kept", "3": "B", "4": None}


def test_votes_and_embeddings(spark):
    records = spark.createDataFrame([("1", "Khám:\nho khan")], "record_id string, raw_text string")
    spans = spark.createDataFrame([("1", 6, 8), ("1", 6, 8)], "record_id string, start int, end int")
    assert adapters.vote_prompts(spans, records).first()["prompt"].startswith("Context: [mục: Khám:] ho khan\nSpan: \"ho\"")
    assert adapters.vote(spans, records, lambda: lambda ps: [[1, 2, 3, 4, 5, 6] for _ in ps]).count() == 1
    out = adapters.embed(spark.createDataFrame([("x",), (None,)], "t string"), "t", lambda: lambda ts: [[3.0, 4.0] for _ in ts], "m").collect()
    assert {r["t"]: r["embedding"] and [round(v, 3) for v in r["embedding"]] for r in out} == {"x": [0.6, 0.8], None: None}


def test_command_line(spark, tmp_path, capsys):
    notes = tmp_path / "in"
    notes.mkdir()
    (notes / "1.txt").write_text("Tiền sử viêm phổi, dùng aspirin.", encoding="utf-8")
    (notes / "2.txt").write_text("Khỏe.", encoding="utf-8")
    (tmp_path / "icd.tsv").write_text("code\tlabel\taliases\nJ18.9\tViêm phổi\t\n", encoding="utf-8")
    (tmp_path / "rx.tsv").write_text("code\tlabel\taliases\n1191\taspirin\t\n", encoding="utf-8")
    out = tmp_path / "out"
    assert cli.main(["predict", "--input", str(notes), "--output", str(out), "--icd", str(tmp_path / "icd.tsv"), "--drugs", str(tmp_path / "rx.tsv"), "--package", str(tmp_path / "a.zip")], spark) == 0
    got = json.loads((out / "1.json").read_text(encoding="utf-8"))
    assert [(c["text"], c["candidates"], c["assertions"]) for c in got] == [("viêm phổi", ["J18.9"], ["isHistorical"]), ("aspirin", ["1191"], ["isHistorical"])]
    assert zipfile.ZipFile(tmp_path / "a.zip").namelist() == ["output/1.json", "output/2.json"]
    assert cli.main(["validate", "--input", str(notes), "--output", str(out)], spark) == 0
    capsys.readouterr()
    cli.main(["score", "--pred", str(out), "--gold", str(out), "--worst"], spark)
    assert json.loads(capsys.readouterr().out.splitlines()[0])["final"] == 100.0
    (out / "1.json").write_text((out / "1.json").read_text(encoding="utf-8").replace("J18.9", "J1"), encoding="utf-8")
    (out / "9.json").write_text("[]")
    assert cli.main(["validate", "--input", str(notes), "--output", str(out)], spark) == 1
    assert {line.split()[1] for line in capsys.readouterr().out.splitlines()} == {"candidate_form", "extra"}
    (out / "9.json").unlink()
    for text, rule in (("no list", "list"), ("[5]", "object"), ('[{"text": "x"}]', "keys")):
        (out / "1.json").write_text(text)
        assert cli.main(["validate", "--input", str(notes), "--output", str(out)], spark) == 1
        assert capsys.readouterr().out.split() == ["1", rule]


def test_dictionary_from_a_sheet(spark, tmp_path):
    (tmp_path / "icd.csv").write_text("x,,,,\nMÃ BỆNH,TÊN BỆNH,MÃ NHÓM,TÊN NHÓM,WHO\na001,Tả・El Tor,A00,Bệnh tả,Tả cổ điển; ngoài\nA009,nan,A00,Bệnh tả,12\n", encoding="utf-8")
    target = tmp_path / "out"
    cli.main(["build-terms", "--sheet", str(tmp_path / "icd.csv"), "--category", "MÃ NHÓM,TÊN NHÓM", "--synonyms", "WHO", "--output", str(target)], spark)
    rows = {r["code"]: (r["label"], r["aliases"]) for r in spark.read.csv(str(target), sep="\t", header=True).collect()}
    assert rows == {"A00.1": ("Tả El Tor", "Tả cổ điển|ngoài"), "A00": ("Bệnh tả", None)}


@pytest.mark.skipif("LABEL_SETS" not in os.environ, reason="LABEL_SETS names no two folders of label files")
def test_published_label_sets(spark):
    """LABEL_SETS: two folders of concept files, joined by the path separator; the expected figures are
    those of FIXTURES.md for its label sets A and B."""
    first, second = os.environ["LABEL_SETS"].split(os.pathsep)
    sets = {n: files.concept_spans(files.read_concepts(spark, p)).cache() for n, p in (("a", first), ("b", second))}
    r = scoring.score_corpus(sets["a"], sets["a"]).first()
    assert (r["final"], r["matched"]) == (1.0, 456)
    common = sets["a"].select("record_id").distinct().join(sets["b"].select("record_id").distinct(), "record_id")
    a, b = (s.join(common, "record_id", "left_semi") for s in (sets["a"], sets["b"]))
    r = scoring.score_corpus(a, b).first()
    assert (r["matched"], r["spurious"], r["missed"]) == (250, 31, 73)
    assert [round(r[k], 6) for k in ("text", "assertions", "candidates", "final")] == [0.613006, 0.618380, 0.672840, 0.638551]
    agree = scoring.label_agreement(a, b, a).first()
    assert (agree["n_a"], agree["n_b"], agree["core"], round(agree["jaccard"], 6)) == (281, 323, 228, 0.606383)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_retrieval_queries_ask_for_mentions(spark):
    kind = F.when(F.col("type") == "CHẨN_ĐOÁN", "icd10").when(F.col("type") == "THUỐC", "rxnorm")
    c = spark.read.parquet(DATA + "/concepts_a.parquet").select("text", kind.alias("system")).where("text is not null and system is not null").distinct()
    names = catalog.QUERIES["lexical_retrieve_topk"](spark, DATA).cache()
    assert names.select("query", "system").subtract(c).isEmpty() and names.select("query", "system").distinct().count() > 0.9 * c.count()
    asked = catalog.QUERIES["candidate_payloads"](spark, DATA)
    assert asked.select("query", "system").subtract(c).isEmpty() and asked.count() == names.select("query", "system").distinct().count()


def test_restricted_codes_of_variants(spark, tmp_path):
    """A mention with an added word keeps its code, one that retrieves nothing an empty list."""
    terms = [("J18.9", "icd10", "Viêm phổi", []), ("K21.9", "icd10", "Trào ngược dạ dày", [])]
    spark.createDataFrame(terms, "code string, system string, label string, aliases array<string>").write.parquet(str(tmp_path / "terminology.parquet"))
    rows = [(i, f"r{i}", t, "CHẨN_ĐOÁN", c, [], [0, 3], "2024-01-01") for i, (t, c) in enumerate([("viêm phổi nặng", ["J18.9"]), ("dạ dày trào ngựơc", ["X", "K21.9"]), ("zq", ["J18.9"]), ("viêm phổi", ["J18.9"])])]
    spark.createDataFrame(rows, "concept_id long, record_id string, text string, type string, candidates array<string>, assertions array<string>, position array<int>, loaded_at string").write.parquet(str(tmp_path / "concepts_a.parquet"))
    got = {r["entity_index"]: r["codes"] for r in catalog.QUERIES["restrict_codes"](spark, str(tmp_path)).collect()}
    assert got == {0: "J18.9", 1: "K21.9", 2: "", 3: "J18.9"}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry_contract(spark):
    assert entry.entry(spark).count() > 0
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and set(catalog.QUERIES) <= set(names)
    for name in ("span_nms", "exact_link", "validate_records", "p2_found"):
        assert names[name](spark, DATA).count() > 0
