"""Command line: ``python -m spanloom.cli <command>``.

predict (dictionary proposer), score, compare, calibrate, validate, package, build-terms. Folders hold
``<id>.txt`` notes or ``<id>.json`` concept lists.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import text as X
from spanloom.operators import scoring, terminology, validation
from spanloom.plans import pipeline
from spanloom.sources import files, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spanloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("predict", help="find and link the names of the dictionaries in notes")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--icd", help="diagnosis dictionary")
    c.add_argument("--drugs", help="drug dictionary")
    c.add_argument("--ids")
    c.add_argument("--threshold", action="append", default=[], metavar="TYPE=VALUE")
    c.add_argument("--no-assertions", action="store_true")
    c.add_argument("--sections", action="store_true")
    c.add_argument("--family", action="store_true")
    c.add_argument("--package", help="also write this ZIP")
    for name, text in (("score", "metrics of predictions against labels"), ("compare", "agreement of two label sets and a run")):
        c = sub.add_parser(name, help=text)
        c.add_argument("--pred", required=True)
        c.add_argument("--gold", required=True)
        if name == "compare":
            c.add_argument("--other", required=True, help="the second label set")
        else:
            c.add_argument("--worst", action="store_true")
    c = sub.add_parser("calibrate", help="do the labels order known runs as their known scores do?")
    c.add_argument("--gold", required=True)
    c.add_argument("--run", action="append", required=True, metavar="NAME=FOLDER=SCORE")
    for name in ("validate", "package"):
        c = sub.add_parser(name)
        c.add_argument("--input", required=True)
        c.add_argument("--output", required=True)
        if name == "package":
            c.add_argument("--zip", required=True)
    c = sub.add_parser("build-terms", help="a dictionary from a code sheet or a vocabulary archive")
    c.add_argument("--sheet")
    c.add_argument("--code", default="MÃ BỆNH")
    c.add_argument("--names", default="TÊN BỆNH", help="name columns in order, comma-separated")
    c.add_argument("--category", help="columns of the heading's code and name, comma-separated")
    c.add_argument("--synonyms", help="column of synonyms")
    c.add_argument("--archive")
    c.add_argument("--unpack-to")
    c.add_argument("--output", required=True)
    return p


def _terms(spark: SparkSession, icd: str | None, drugs: str | None) -> DataFrame:
    out = spark.createDataFrame([], "code string, system string, label string, aliases array<string>")
    for path, system in ((icd, "icd10"), (drugs, "rxnorm")):
        if path:
            out = out.unionByName(files.read_terms(spark, path).withColumn("system", F.lit(system)))
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("spanloom").getOrCreate()
    if a.command == "predict":
        records, terms = files.read_records(spark, a.input, files.parse_ids(a.ids)), _terms(spark, a.icd, a.drugs)
        settings = pipeline.Settings(tuple(pipeline.parse_thresholds(a.threshold).items()), not a.no_assertions, a.sections, a.family)
        concepts = pipeline.predict(records, pipeline.by_dictionary(terms, {"icd10": "CHẨN_ĐOÁN", "rxnorm": "THUỐC"}), terms, settings)
        lists = sinks.concept_lists(concepts, records)
        sinks.write_concept_files(lists, a.output)
        if a.package:
            print(sinks.write_package(lists, a.package), "records packaged")
    elif a.command == "score":
        pred, gold = (files.concept_spans(files.read_concepts(spark, x)) for x in (a.pred, a.gold))
        r = scoring.score_corpus(pred, gold).first()
        print(json.dumps({k: round(r[k] * 100, 4) for k in ("final", "text", "assertions", "candidates")} | {k: r[k] for k in ("matched", "spurious", "missed")}))
        if a.worst:
            for w in scoring.worst_records(pred, gold).collect():
                print(w["record_id"], round(w["text"], 4))
    elif a.command == "compare":
        sets = [files.span_set(files.read_concepts(spark, x)) for x in (a.gold, a.other, a.pred)]
        print(json.dumps(scoring.label_agreement(*sets).first().asDict()))
    elif a.command == "calibrate":
        gold = files.concept_spans(files.read_concepts(spark, a.gold))
        runs = []
        for item in a.run:
            name, folder, known = item.split("=")
            runs.append((name, float(known), scoring.score_corpus(files.concept_spans(files.read_concepts(spark, folder)), gold).first()["final"] * 100))
        for r in scoring.order_preservation(spark.createDataFrame(runs, "name string, known double, measured double")).collect():
            print(r["a"], r["b"], "preserved" if r["preserved"] else "reversed")
    elif a.command in ("validate", "package"):
        records, concepts = files.read_records(spark, a.input), files.read_concepts(spark, a.output)
        bad = validation.output_report(concepts, records, files=files.read_concept_files(spark, a.output)).collect()
        for r in bad:
            print(r["record_id"], r["status"])
        if bad:
            return 1
        if a.command == "package":
            flat = concepts.select("record_id", "text", "type", "candidates", "assertions", F.get("position", F.lit(0)).alias("start"), F.get("position", F.lit(1)).alias("end"))
            print(sinks.write_package(sinks.concept_lists(flat, records), a.zip), "records packaged")
    elif a.sheet:
        sheet = files.read_code_sheet(spark, a.sheet)
        code = X.dotted_code(F.col(f"`{a.code}`"))
        columns = [n.strip() for n in a.names.split(",")]
        parts = [F.struct((F.col("ord") * 1000 + i).alias("ord"), X.clean_name(F.col(f"`{n}`")).alias("name")) for i, n in enumerate(columns)]
        if a.category:  # the heading above a code is an entry of its own, behind it
            c, n = a.category.split(",")
            above = sheet.select(X.dotted_code(F.col(f"`{c.strip()}`")).alias("code"), (F.col("ord") * 1000 + len(columns)).alias("ord"), X.clean_name(F.col(f"`{n.strip()}`")).alias("name"))
        rows = sheet.select(code.alias("code"), F.explode(F.array(*parts)).alias("p")).select("code", "p.ord", "p.name")
        if a.category:
            rows = rows.unionByName(above)
        if a.synonyms:
            more = sheet.select(code.alias("code"), F.col("ord").alias("_o"), F.posexplode(X.who_synonyms(F.col(f"`{a.synonyms}`"))).alias("_i", "name"))
            rows = rows.unionByName(more.select("code", (F.col("_o") * 1000 + 500 + F.col("_i")).alias("ord"), X.clean_name(F.col("name")).alias("name")))
        rows = rows.where("lower(name) != 'nan'")
        sinks.write_terms(terminology.fold_aliases(rows), a.output)
    elif a.archive:
        rows = files.read_rrf_archive(spark, a.archive, a.unpack_to or os.path.dirname(os.path.abspath(a.output)))
        sinks.write_terms(terminology.fold_drug_names(rows), a.output, numeric=True)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
