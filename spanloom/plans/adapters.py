"""Seams for models: text generation, embeddings and teachers' votes, each behind a factory.

A factory is called once per Python worker and returns a function over a batch; answers are cached in
a table keyed by a hash of everything that determines them, and only what isn't there is computed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import cache_key, line_context

#: Prompt of a teacher about one span; six answers, 0 for "no concept".
VOTE_PROMPT = 'Context: {context}\nSpan: "{text}"\nAnswer with one digit, 0-5.'


def vote_prompts(spans: DataFrame, records: DataFrame, template: str = VOTE_PROMPT) -> DataFrame:
    """(record_id, start, end, prompt) for spans, with the mention's line and section as context."""
    s = spans.join(records.select("record_id", "raw_text"), "record_id")
    before, middle = template.split("{context}")
    between, after = middle.split("{text}")
    text = F.substring("raw_text", F.col("start") + 1, F.col("end") - F.col("start"))
    prompt = F.concat(F.lit(before), line_context(F.col("raw_text"), F.col("start"), F.col("end")), F.lit(between), text, F.lit(after))
    return s.select("record_id", "start", "end", prompt.alias("prompt"))


def generate(prompts: DataFrame, factory: Callable[[], Callable[[list[str]], list[str]]], model: str, cache: DataFrame | None = None) -> DataFrame:
    """``prompts`` (with a column prompt) with ``key`` and ``answer``. Distinct prompts are answered once;
    those in ``cache`` (key, answer) not at all. NULL prompts have NULL answers."""
    keyed = prompts.withColumn("key", F.when(F.col("prompt").isNotNull(), cache_key([F.lit(model), F.col("prompt")], 32)))
    asked = keyed.select("key", "prompt").where("key is not null").dropDuplicates(["key"])
    if cache is not None:
        asked = asked.join(cache.select("key"), "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = factory()
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "answer": answer(pdf["prompt"].tolist())})

    answers = asked.mapInPandas(run, "key string, answer string")
    if cache is not None:
        answers = answers.unionByName(cache.select("key", "answer"))
    return keyed.join(answers, "key", "left")


def vote(spans: DataFrame, records: DataFrame, factory: Callable[[], Callable[[list[str]], list[list[float]]]], teacher: str = "primary") -> DataFrame:
    """Votes (record_id, start, end, teacher, logits) of a model over distinct spans."""
    asked = vote_prompts(spans.select("record_id", "start", "end").distinct(), records)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = factory()
        for pdf in batches:
            yield pd.DataFrame({"record_id": pdf["record_id"], "start": pdf["start"], "end": pdf["end"], "teacher": teacher, "logits": [[float(x) for x in r] for r in score(pdf["prompt"].tolist())]})

    return asked.mapInPandas(run, "record_id string, start int, end int, teacher string, logits array<double>")


def embed(texts: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], list[list[float]]]], model: str, cache: DataFrame | None = None) -> DataFrame:
    """``texts`` with ``embedding``, scaled to length 1; distinct texts are encoded once, those in
    ``cache`` (key, embedding) not at all. Zero vectors stay, NULL texts have none."""
    keyed = texts.withColumn("_key", F.when(F.col(text).isNotNull(), cache_key([F.lit(model), F.col(text)], 32)))
    asked = keyed.select(F.col("_key").alias("key"), F.col(text).alias("t")).where("key is not null").dropDuplicates(["key"])
    if cache is not None:
        asked = asked.join(cache.select("key"), "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        encode = factory()
        for pdf in batches:
            v = np.asarray(encode(pdf["t"].tolist()), dtype=np.float32)
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            yield pd.DataFrame({"key": pdf["key"], "embedding": list((v / np.where(norm > 0, norm, 1)).astype(np.float32))})

    vectors = asked.mapInPandas(run, "key string, embedding array<float>")
    if cache is not None:
        vectors = vectors.unionByName(cache.select("key", "embedding"))
    return keyed.join(vectors.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")


def probabilities(logits: Column) -> Column:
    """Softmax of an array."""
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return F.transform(logits, lambda x: F.exp(x - top) / total)
