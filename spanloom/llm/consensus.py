"""Consensus of several annotators' labels (problem 6).

Feature-assisted Dawid-Skene: expectation-maximisation fits, jointly, a confusion matrix per
annotator and a regularised classifier of item features whose output is the prior of an item's
label. Types and sets of assertions are labels of that kind. A span's start and end are fitted the
same way, with the positions seen on the item as candidates and, per annotator, a distribution of
the distance between what is written and what is true.

The features are those of the item: words of the passage it is about and of what stands around it in
the note (hashed), its site, its length and its place.

The labels of an item are brought together once; every iteration is one pass over that table which
shuffles only sums of as many numbers as there are parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import bind
from spanloom.plans.runtime import discard, spread, written

ITERATIONS = 8
#: The iterations end when no parameter moves by more.
SETTLED = 0.005
#: Items on which the classifier is fitted, at most (all other statistics cover all items).
CLASSIFIER_ITEMS = 10_000
#: Largest distance of a position from the true one that is told apart.
REACH = 5
#: Most bytes of all annotators' parameters, which every worker holds: some 60,000 annotators with the
#: types and assertions of clinical notes. More raise ValueError.
PARAMETER_BYTES = 64_000_000

_SITES, _LENGTHS, _PLACES, _WORDS = 16, 14, 12, 2048
#: Words of a passage that are features, from its beginning, and words before and behind it.
PASSAGE_WORDS, BEFORE_WORDS, AFTER_WORDS = 6, 2, 1
_PER_ITEM = 4 + PASSAGE_WORDS + 1 + BEFORE_WORDS + AFTER_WORDS
#: Features, and the one that has no weight, for items with fewer words.
_WIDTH = _SITES + _LENGTHS + _PLACES + 1 + _WORDS
_NONE = _WIDTH


@dataclass
class Flat:
    """Labels of a batch of items, one array element per label; ``item`` numbers the items."""

    n: int
    item: np.ndarray
    annotator: np.ndarray
    type: np.ndarray
    mark: np.ndarray
    start: np.ndarray
    end: np.ndarray
    site: np.ndarray
    words: np.ndarray  # hashed words, one row per item

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table) -> Flat:
        def flat(name: str) -> np.ndarray:
            c = batch.column(name)
            c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
            return c.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

        c = batch.column("a")
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        lengths = c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        site = batch.column("site").to_numpy() if isinstance(batch, pa.Table) else batch.column("site").to_numpy(zero_copy_only=False)
        w = batch.column("w")
        w = w.combine_chunks() if isinstance(w, pa.ChunkedArray) else w
        sizes = w.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        words = np.full((len(lengths), _PER_ITEM - 4), _NONE)
        row = np.repeat(np.arange(len(sizes)), sizes)
        words[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = w.flatten().to_numpy(zero_copy_only=False) + (_WIDTH - _WORDS)
        return cls(len(lengths), np.repeat(np.arange(len(lengths)), lengths), flat("a"), flat("t"), flat("m"), flat("s"), flat("e"), site, words)

    def features(self) -> np.ndarray:
        """The features each item has, by number: hashed site, bucket of the mean span length and of the place,
        the one that all have, and its words."""
        known = (self.start >= 0) & (self.end >= 0)
        count = np.maximum(1, np.bincount(self.item[known], minlength=self.n))
        length = np.bincount(self.item[known], (self.end - self.start)[known], minlength=self.n) / count
        place = np.bincount(self.item[known], self.start[known], minlength=self.n) / count
        own = [
            self.site % _SITES,
            _SITES + np.clip(np.log2(np.maximum(length, 1)) * 2, 0, _LENGTHS - 1).astype(int),
            _SITES + _LENGTHS + np.clip(np.log2(np.maximum(place, 1)), 0, _PLACES - 1).astype(int),
            np.full(self.n, _SITES + _LENGTHS + _PLACES),
        ]
        return np.column_stack([*own, self.words])


@dataclass
class Model:
    """Parameters: confusion[annotator, true, written], distances and classifier weights."""

    annotators: int
    types: int
    marks: int
    reach: int
    confusion: dict[str, np.ndarray] = field(default_factory=dict)
    distance: dict[str, np.ndarray] = field(default_factory=dict)
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def prior(self, what: str, x: np.ndarray) -> np.ndarray:
        w = self.weights[what]
        z = np.zeros((len(x), w.shape[1]))
        for column in x.T:
            z += w[column]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def labels(self, f: Flat, what: str, x: np.ndarray) -> np.ndarray:
        """Posterior of each item's label; without parameters, the share of the votes."""
        k, seen = (self.types, f.type) if what == "type" else (self.marks, f.mark)
        on = seen >= 0
        item, who, seen = f.item[on], f.annotator[on], seen[on]
        if what not in self.confusion:
            q = np.bincount(item * k + seen, minlength=f.n * k).reshape(f.n, k) + 0.01
            return q / q.sum(1, keepdims=True)
        log = np.log(self.confusion[what])[who, :, seen]
        s = self.prior(what, x)
        for j in range(k):
            s[:, j] += np.bincount(item, log[:, j], minlength=f.n)
        s -= s.max(1, keepdims=True)
        q = np.exp(s)
        return q / q.sum(1, keepdims=True)

    def places(self, f: Flat, what: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Posterior of each label's position being the true one (equal positions share it), and
        the pairs (label, candidate, distance) of an item."""
        value = f.start if what == "start" else f.end
        on = np.nonzero(value >= 0)[0]
        item, who, value = f.item[on], f.annotator[on], value[on]
        size = np.bincount(item, minlength=f.n)
        begin = np.cumsum(size) - size
        mine = size[item]
        left = np.repeat(np.arange(len(item)), mine)
        right = np.arange(len(left)) - np.repeat(np.cumsum(mine) - mine, mine) + np.repeat(begin[item], mine)
        d = np.clip(value[left] - value[right], -self.reach, self.reach) + self.reach
        same = np.bincount(right, d == self.reach, minlength=len(item))
        if what in self.distance:
            s = np.bincount(right, np.log(self.distance[what])[who[left], d], minlength=len(item))
            top = np.full(f.n, -np.inf)
            np.maximum.at(top, item, s)
            q = np.exp(s - top[item]) / same
        else:
            q = np.ones(len(item))
        q = q / np.bincount(item, q, minlength=f.n)[item]
        return on, q, np.stack([left, right]), d

    def sums(self, f: Flat) -> np.ndarray:
        """Sufficient statistics of a batch, in one vector."""
        x = f.features()
        out = []
        for what, k in (("type", self.types), ("mark", self.marks)):
            seen = f.type if what == "type" else f.mark
            on = seen >= 0
            q = self.labels(f, what, x)
            c = np.zeros((self.annotators, k, k))
            cell = f.annotator[on] * k + seen[on]
            for j in range(k):
                c[:, j, :] = np.bincount(cell, q[f.item[on], j], minlength=self.annotators * k).reshape(self.annotators, k)
            out.append(c.ravel())
        width = 2 * self.reach + 1
        for what in ("start", "end"):
            on, q, (left, right), d = self.places(f, what)
            out.append(np.bincount(f.annotator[on][left] * width + d, q[right], minlength=self.annotators * width))
        return np.concatenate(out)

    def update(self, sums: np.ndarray) -> None:
        """Maximisation: smoothed confusions and distances."""
        at = 0
        for what, k in (("type", self.types), ("mark", self.marks)):
            n = self.annotators * k * k
            c = sums[at : at + n].reshape(self.annotators, k, k) + 0.5 + 2.0 * np.eye(k)
            self.confusion[what] = c / c.sum(2, keepdims=True)
            at += n
        width = 2 * self.reach + 1
        for what in ("start", "end"):
            n = self.annotators * width
            c = sums[at : at + n].reshape(self.annotators, width)
            c = c + 20.0 * c.sum(0, keepdims=True) / max(1.0, c.sum()) + 0.05
            self.distance[what] = c / c.sum(1, keepdims=True)
            at += n

    def fit_classifier(self, sample: Flat, steps: int = 20, l2: float = 1e-3) -> None:
        """Regularised softmax regression of the posteriors on the features, going on from the weights there are.

        Accelerated descent with a step per feature: half the number of features of an item times a feature's
        share of the items bounds the curvature, so no rate has to be chosen.
        """
        if not sample.n:
            return
        x = sample.features()
        flat = x.ravel()
        step = 1 / (0.5 * x.shape[1] * np.bincount(flat, minlength=_WIDTH + 1) / sample.n + l2)
        step[_NONE] = 0
        for what in ("type", "mark"):
            q = self.labels(sample, what, x)
            w = ahead = self.weights[what]
            for k in range(steps):
                self.weights[what] = ahead
                off = (np.exp(self.prior(what, x)) - q) / sample.n
                g = l2 * ahead
                for j in range(w.shape[1]):
                    g[:, j] += np.bincount(flat, np.repeat(off[:, j], x.shape[1]), minlength=_WIDTH + 1)
                new = ahead - step[:, None] * g
                ahead, w = new + k / (k + 3) * (new - w), new
            self.weights[what] = w


@dataclass
class Consensus:
    """The fitted model with the item table it was fitted on."""

    items: DataFrame
    model: Model
    annotators: list[str]
    types: list[str]
    marks: list[str]
    key: str

    def per_item(self) -> DataFrame:
        """(item, type, assertions, start_pos, end_pos, confidence, agreement, n_labels).

        confidence is the posterior of the type; agreement the mean share of labels equal to the
        consensus over type, assertions and position.
        """
        model, types, marks, key = self.model, self.types, self.marks, self.key
        kind = dict(self.items.dtypes)[key]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                f = Flat.of(batch)
                x = f.features()
                qt, qm = model.labels(f, "type", x), model.labels(f, "mark", x)
                t, m = qt.argmax(1), qm.argmax(1)
                place, hits, votes = {}, np.zeros(f.n), np.zeros(f.n)
                for what, seen in (("start", f.start), ("end", f.end)):
                    on, q, _, _ = model.places(f, what)
                    item = f.item[on]
                    order = np.lexsort((-seen[on], q, item))
                    last = np.append(item[order][1:] != item[order][:-1], True) if len(order) else np.array([], bool)
                    value = np.full(f.n, -1, np.int64)
                    value[item[order][last]] = seen[on][order][last]
                    place[what] = value
                has = {w: np.bincount(f.item, s >= 0, minlength=f.n) > 0 for w, s in (("type", f.type), ("mark", f.mark))}
                for seen, best in ((f.type, t), (f.mark, m), (f.start, place["start"]), (f.end, place["end"])):
                    on = seen >= 0
                    hits += np.bincount(f.item[on], seen[on] == best[f.item[on]], minlength=f.n)
                    votes += np.bincount(f.item[on], minlength=f.n)
                agree = np.where(votes > 0, hits / np.maximum(votes, 1), np.nan)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key),
                        pa.array([types[i] if ok else None for i, ok in zip(t, has["type"], strict=True)], pa.string()),
                        pa.array([(marks[i].split(",") if marks[i] else []) if ok else None for i, ok in zip(m, has["mark"], strict=True)], pa.list_(pa.string())),
                        pa.array([int(v) if v >= 0 else None for v in place["start"]], pa.int32()),
                        pa.array([int(v) if v >= 0 else None for v in place["end"]], pa.int32()),
                        pa.array(qt.max(1)),
                        pa.array(agree, from_pandas=True),
                        pa.array(np.bincount(f.item, minlength=f.n).astype(np.int32)),
                    ],
                    names=[key, "type", "assertions", "start_pos", "end_pos", "confidence", "agreement", "n_labels"],
                )

        return self.items.mapInArrow(
            run, f"{key} {kind}, type string, assertions array<string>, start_pos int, end_pos int, confidence double, agreement double, n_labels int"
        )

    def per_annotator(self) -> DataFrame:
        """(annotator, type_reliability, assertion_reliability, position_reliability): chance of
        writing the true label of an item drawn evenly over the classes; for positions, of start
        and end being right."""
        m = self.model
        rows = []
        for i, name in enumerate(self.annotators):
            diag = [float(np.diag(m.confusion[w][i]).mean()) for w in ("type", "mark")]
            place = float(m.distance["start"][i, m.reach] * m.distance["end"][i, m.reach])
            rows.append((name, *diag, place))
        return self.items.sparkSession.createDataFrame(
            rows, "annotator_id string, type_reliability double, assertion_reliability double, position_reliability double"
        )


def _numbered(rows: DataFrame, c: str, most: int) -> tuple[list[str], DataFrame]:
    """The distinct values of a column in order, and a table (c, c_no) of their numbers; more than ``most`` raise."""
    values = sorted(r[0] for r in rows.where(F.col(c).isNotNull()).select(c).distinct().limit(most + 1).collect())
    if len(values) > most:
        raise ValueError(f"more than {most} values of {c}: their parameters don't fit")
    table = rows.sparkSession.createDataFrame(list(zip(values, range(len(values)), strict=True)), f"{c} {dict(rows.dtypes)[c]}, {c}_no int")
    return values, F.broadcast(table)  # at most ``most`` rows


def passage_words(text: F.Column, start: F.Column, end: F.Column) -> F.Column:
    """Hashed words of a passage and of what stands next to it, each kind apart; none for a NULL text."""

    def words(c: F.Column) -> F.Column:
        return F.filter(F.split(F.lower(c), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")

    def hashed(kind: str, c: F.Column) -> F.Column:
        return F.transform(c, lambda w: F.pmod(F.xxhash64(F.lit(kind), w), F.lit(_WORDS)).cast("int"))

    # the long text is cut once, the rest is read from the short piece
    first = F.greatest(start - 40, F.lit(0))
    none = F.array().cast("array<int>")

    def of_passage(ws: F.Column) -> F.Column:
        whole = F.when(F.size(ws) > 0, F.array(F.array_join(ws, " "))).otherwise(F.array().cast("array<string>"))
        return F.concat(hashed("in", F.slice(ws, 1, PASSAGE_WORDS)), hashed("all", whole))

    def of_piece(piece: F.Column) -> F.Column:
        return F.concat(
            bind(words(F.substring(piece, start - first + 1, end - start)), of_passage),
            hashed("before", F.slice(F.reverse(words(F.substring(piece, F.lit(1), start - first))), 1, BEFORE_WORDS)),
            hashed("after", F.slice(words(F.substring(piece, end - first + 1, F.lit(30))), 1, AFTER_WORDS)),
        )

    parts = bind(F.substring(text, first + 1, end - first + 30), of_piece)
    return F.when(text.isNotNull() & (start >= 0) & (end > start), parts).otherwise(none)


def fit_consensus(
    labels: DataFrame,
    item: str = "item_id",
    annotator: str = "annotator_id",
    kind: str = "type",
    assertions: str = "assertions",
    position: str = "position",
    time: str = "labelled_at",
    site: str | None = "site_code",
    texts: DataFrame | None = None,
    record: str = "record_id",
    text: str = "raw_text",
    iterations: int = ITERATIONS,
    classifier_items: int = CLASSIFIER_ITEMS,
) -> Consensus:
    """Fit consensus labels and annotator reliabilities; see ``Consensus`` for the results.

    ``texts`` (record, text; one row per record) gives the notes that the items are about; without them, or
    without the record of an item, its features are its site, length and place only.

    Of several rows of an annotator on an item the one with the latest ``time`` counts. Rows
    without any label (type, assertions and position NULL) don't count; an item with no other
    rows has no consensus and is left out. Assertions are a set: order and repeats don't matter.

    Defined cases: a single NULL field of a label is ignored for that field; rows with NULL item
    or annotator are left out; equal times are decided by content; repeated rows count once;
    items of one label take it, weighed by the annotator's habits; an empty table gives empty
    results; columns other than those named are ignored.
    """
    c = {k: F.col(f"`{v}`") for k, v in {"i": item, "w": annotator, "t": kind, "m": assertions, "p": position, "at": time}.items()}
    mark = F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(c["m"]))))
    rows = (
        labels.where(c["i"].isNotNull() & c["w"].isNotNull())
        .where(c["t"].isNotNull() | c["m"].isNotNull() | c["p"].isNotNull())
        .select(
            c["i"].alias("item"),
            c["w"].alias("who"),
            F.struct(
                c["at"].alias("at"),
                c["t"].alias("t"),
                F.when(c["m"].isNotNull(), mark).alias("m"),
                F.get(c["p"], F.lit(0)).cast("int").alias("s"),
                F.get(c["p"], F.lit(1)).cast("int").alias("e"),
            ).alias("o"),
            (F.pmod(F.xxhash64(F.col(f"`{site}`")), F.lit(1 << 20)) if site else F.lit(0)).alias("site"),
            (F.col(f"`{record}`") if texts is not None else F.lit(None).cast("string")).alias("record"),
        )
        .groupBy("item", "who")
        .agg(F.max("o").alias("o"), F.min("site").alias("site"), F.min("record").alias("record"))
        .select("item", "who", "o.t", "o.m", "o.s", "o.e", "site", "record")
    )
    rows = written(rows)
    types, type_no = _numbered(rows, "t", 1_000)
    marks, mark_no = _numbered(rows, "m", 1_000)
    annotators, who_no = _numbered(rows, "who", PARAMETER_BYTES // (8 * (len(types) ** 2 + len(marks) ** 2 + 2 * (2 * REACH + 1))))
    known = rows.join(who_no, "who").join(type_no, "t", "left").join(mark_no, "m", "left")
    # an item has as many labels as it has annotators, whose number is bounded
    label = F.struct(
        F.col("who_no").alias("a"), F.coalesce("t_no", F.lit(-1)).alias("t"), F.coalesce("m_no", F.lit(-1)).alias("m"),
        F.coalesce("s", F.lit(-1)).alias("s"), F.coalesce("e", F.lit(-1)).alias("e"),
    )
    grouped = (
        known.select("item", label.alias("l"), "site", "record")
        .groupBy("item")
        .agg(F.array_sort(F.collect_list("l")).alias("l"), F.min("site").cast("long").alias("site"), F.min("record").alias("record"))
        .select(F.col("item").alias(item), "site", "record", *[F.col(f"l.{x}").alias(x) for x in "atmse"])
    )
    if texts is None:
        grouped = grouped.withColumn("w", F.array().cast("array<int>"))
    else:
        middle = lambda c: F.get(F.array_sort(F.filter(c, lambda x: x >= 0)), F.floor(F.size(F.filter(c, lambda x: x >= 0)) / 2).cast("int"))
        notes = texts.select(F.col(f"`{record}`").alias("record"), F.col(f"`{text}`").alias("note"))
        grouped = grouped.join(notes, "record", "left").withColumn("w", passage_words(F.col("note"), middle("s"), middle("e"))).drop("note")
    items = written(grouped.drop("record"))
    discard(rows)
    model = Model(len(annotators), max(1, len(types)), max(1, len(marks)), REACH)
    n = items.count()
    share = max(1, -(-n // classifier_items))
    chosen = items if share == 1 else items.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(item)), F.lit(share)) == 0)
    sample = Flat.of(chosen.limit(2 * classifier_items).toArrow())
    model.weights = {"type": np.zeros((_WIDTH + 1, model.types)), "mark": np.zeros((_WIDTH + 1, model.marks))}
    work = spread(items.select("site", *"atmsew"))
    for _ in range(iterations if n else 1):
        fixed = Model(model.annotators, model.types, model.marks, model.reach, dict(model.confusion), dict(model.distance), dict(model.weights))

        def run(batches: Iterator[pa.RecordBatch], fixed: Model = fixed) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    one = fixed.sums(Flat.of(batch))
                    total = one if total is None else total + one
            if total is not None:
                some = np.nonzero(total)[0]
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[some])], names=["k", "v"])

        size = model.annotators * (model.types**2 + model.marks**2 + 2 * (2 * model.reach + 1))
        sums = np.zeros(size)
        for r in work.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
            sums[r["k"]] = r["v"]
        before = {**fixed.confusion, **fixed.distance}
        model.update(sums)
        model.fit_classifier(sample)
        now = {**model.confusion, **model.distance}
        if before and all(np.abs(now[k] - before[k]).max(initial=0.0) < SETTLED for k in now):
            break
    return Consensus(items, model, annotators, types, marks, item)
