"""Texts packed into containers of a fixed number of tokens (problem 7).

Hierarchical multi-length packing. Every text is sized in tokens of a public tokenizer and routed to
the shortest of several context sizes that holds it. Each tier packs windows of its own size, the
longest tier first: its own texts open a window, and the gap they leave is filled from the shorter
tiers, exact pairs preferred, else the largest text that fits. A window of a shorter tier is closed
if it is as good as full; otherwise its texts are handed on to the longest tier, which packs them
last. Closed windows of a shorter size are put together to containers, which all have the size of
the longest context. Containers are dealt into step groups of equal attention cost.

Packing happens where the rows are: each input partition packs its own texts on a histogram of
sizes, and a task keeps a few bytes per text. What a partition can't pack well, at most its
``CARRIED`` poorest containers, is carried on as ids and sizes and packed again together with that
of ``TOGETHER`` other partitions, so the fill doesn't depend on how the input is partitioned.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rank file of the tokenizer; a path that all executors can read.
TOKENIZER = os.environ.get("SPANLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
CAPACITY = 2048
#: Context sizes; each divides the next, and the last one is the container.
CONTEXTS = (256, 512, 1024, CAPACITY)
#: Least share of a window that is used when a shorter tier closes it, and of a container that isn't
#: packed again.
FULL = 0.995
#: Poorest containers of a partition that are packed again, and partitions whose share is brought together.
CARRIED, TOGETHER = 64, 512
#: Containers of a step group.
GROUP = 8

# Fixed value: the pattern by which the tokenizer's rank file parts a text.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):  # noqa: ANN201
    """The byte-pair encoding of a rank file, loaded once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str) -> int:
    """Tokens of the text; 0 for NULL and empty."""
    if not text:
        return 0
    text = text.encode("utf-8", "replace").decode("utf-8")
    return len(tokenizer(path).encode_ordinary(text))


def tier_of(size: np.ndarray, contexts: Sequence[int]) -> np.ndarray:
    """Number of the shortest context that holds each size."""
    return np.searchsorted(np.array(contexts), size, side="left")


class Sizes:
    """A multiset of sizes 1..capacity, with the sizes it has as bits of a number."""

    def __init__(self, capacity: int) -> None:
        self.left, self.mask = [0] * (capacity + 1), 0

    def add(self, s: int, n: int = 1) -> None:
        self.left[s] += n
        self.mask |= 1 << s

    def take(self, s: int) -> None:
        self.left[s] -= 1
        if not self.left[s]:
            self.mask &= ~(1 << s)

    def largest(self, most: int) -> int:
        """The largest size up to ``most``; 0 if there is none."""
        return (self.mask & ((2 << most) - 1)).bit_length() - 1 if most > 0 and self.mask & ((2 << most) - 1) else 0

    def fill(self, gap: int) -> list[int]:
        """Take sizes for a gap: an exact one, an exact pair, or the largest that fits and so on."""
        out: list[int] = []
        while s := self.largest(gap):
            if s < gap and (low := self.pair(gap)):
                s = gap - low
            out.append(s)
            self.take(s)
            gap -= s
        return out

    def pair(self, gap: int) -> int:
        """The smaller of two sizes that add up to ``gap``; the pair of most even sizes, 0 if there is none."""
        half = gap // 2
        low = self.mask & ((2 << half) - 1)
        # bit a of the mirrored number is set if there is a size gap - a
        high = int(f"{self.mask & ((1 << gap) - 1):0{gap + 1}b}"[::-1], 2)
        both = low & high & ~1
        if 2 * half == gap and both >> half & 1 and self.left[half] < 2:
            both &= ~(1 << half)
        return both.bit_length() - 1 if both else 0


def pack_tiers(counts: Sequence[int], contexts: Sequence[int], full: float = FULL) -> list[list[tuple[int, int, list[int]]]]:
    """Containers for ``counts[s]`` texts of each size s: each a list of windows (offset, context, sizes)."""
    capacity = contexts[-1]
    pool, late = Sizes(capacity), Sizes(capacity)
    for s, n in enumerate(counts):
        if s and n:
            pool.add(s, n)
    boxes: list[list[tuple[int, int, list[int]]]] = []
    windows: list[tuple[int, list[int]]] = []  # closed windows to be put together, of one size
    for t in range(len(contexts) - 1, -1, -1):
        context, shortest = contexts[t], contexts[t - 1] + 1 if t else 1
        closed: list[list[int]] = []
        while (s := pool.largest(context)) >= shortest:
            pool.take(s)
            window = [s, *pool.fill(context - s)]
            if context == capacity:
                boxes.append([(0, context, window)])
            elif sum(window) >= full * context:
                closed.append(window)
            else:
                # the tier's own texts go to the longest tier, the fillings stay for others
                for x in window:
                    (late if x >= shortest else pool).add(x)
        # windows of this size make containers; those over are opened again
        per = capacity // context
        if context < capacity:
            whole = len(closed) // per * per
            for k in range(0, whole, per):
                boxes.append([(i * context, context, w) for i, w in enumerate(closed[k : k + per])])
            windows += [(context, w) for w in closed[whole:]]
    for _, w in windows:
        for x in w:
            late.add(x)
    while s := late.largest(capacity):
        late.take(s)
        boxes.append([(0, capacity, [s, *late.fill(capacity - s)])])
    return boxes


def pack_sizes(sizes: np.ndarray, contexts: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Container number, slot, offset and context of each size (1..capacity); equal sizes are placed in
    the order in which they come."""
    n = len(sizes)
    box, slot, offset, context = np.empty(n, np.int64), np.empty(n, np.int32), np.empty(n, np.int32), np.empty(n, np.int32)
    counts = np.bincount(sizes, minlength=contexts[-1] + 1)
    order = np.argsort(sizes, kind="stable").tolist()
    at = (np.cumsum(counts) - counts).tolist()  # the next item of each size in the order
    for b, windows in enumerate(pack_tiers(counts.tolist(), contexts)):
        k = 0
        for begin, size, inside in windows:
            for s in inside:
                i = order[at[s]]
                at[s] += 1
                box[i], slot[i], offset[i], context[i] = b, k, begin, size
                begin, k = begin + s, k + 1
    return box, slot, offset, context


def step_groups(cost: np.ndarray, group: int) -> np.ndarray:
    """Step group of each container: dealt back and forth in order of cost, so sums are even."""
    n = len(cost)
    groups = max(1, -(-n // group))
    rank = np.empty(n, np.int64)
    rank[np.argsort(-cost, kind="stable")] = np.arange(n)
    lap, place = rank // groups, rank % groups
    return np.where(lap % 2 == 0, place, groups - 1 - place)


def _place(sizes: np.ndarray, contexts: Sequence[int], base: int, group: int) -> pd.DataFrame:
    """Places of sizes 1..capacity: container_id, slot, container_offset, context, step_group and the container's fill."""
    box, slot, offset, context = pack_sizes(sizes, contexts)
    boxes = int(box.max()) + 1 if len(box) else 0
    used = np.bincount(box, weights=sizes, minlength=boxes)
    step = step_groups(np.bincount(box, weights=sizes.astype(float) ** 2, minlength=boxes), group)
    return pd.DataFrame(
        {"container_id": base + box, "slot": slot, "container_offset": offset, "context": context, "step_group": base + (step[box] if boxes else box), "used": (used[box] if boxes else box).astype(np.int64)}
    )


def pack_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    contexts: Sequence[int] = CONTEXTS,
    group: int = GROUP,
    tokenizer_path: str = TOKENIZER,
) -> DataFrame:
    """One row per piece: id, piece_no, token_start, n_tokens, tier, context, container_id, slot,
    container_offset, step_group.

    Containers have the size of the longest of the ``contexts``, each of which divides the next. A text
    is cut only if it alone exceeds a container; its pieces are full containers and one remainder. tier
    is the number of the shortest context that holds the piece, context the size of the window in
    which it lies. Containers are numbered uniquely over the whole result, and so are step groups.
    Numbers follow the partitions of the input and so may differ between clusters; the rules above
    hold for each.

    Defined cases: NULL and empty texts have no tokens and yield one row with n_tokens 0 and NULL
    context, container, slot and step_group, so no text is lost; a NULL id is kept; repeated rows are
    packed each; other columns are not carried, so their names can't clash.
    """
    contexts = tuple(contexts)
    if any(b % a or a >= b for a, b in zip(contexts, contexts[1:], strict=False)):
        raise ValueError("each context must divide the next")
    capacity = contexts[-1]
    kind = df.schema[id_col].dataType.simpleString()
    sized = "id " + kind + ", piece_no int, token_start int, n_tokens int, container_id long, slot int, container_offset int, context int, step_group long, bucket long"
    names = ["id", "piece_no", "token_start", "n_tokens", "container_id", "slot", "container_offset", "context", "step_group"]

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, sizes = [], []
        for pdf in batches:
            ids.append(pdf["c0"])
            sizes.append(np.array([count_tokens(t, tokenizer_path) for t in pdf["c1"]], dtype=np.int64))
        if not ids:
            return
        key, size = pd.concat(ids, ignore_index=True).to_numpy(), np.concatenate(sizes)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        full = size // capacity
        rest = size - full * capacity
        item, whole, none = np.nonzero(rest)[0], np.repeat(np.arange(len(size)), full), np.nonzero(size == 0)[0]
        placed = _place(rest[item], contexts, part << 33, group)
        poor = placed.loc[placed.used < FULL * capacity].drop_duplicates("container_id").sort_values(["used", "container_id"])["container_id"].iloc[:CARRIED]
        again = placed["container_id"].isin(poor)
        boxes = int(placed["container_id"].max()) + 1 if len(placed) else part << 33
        groups = int(placed["step_group"].max()) + 1 if len(placed) else part << 33
        number = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
        rows = placed.drop(columns="used").assign(id=key[item], piece_no=full[item], n_tokens=rest[item], bucket=np.where(again, -1 - part // TOGETHER, part))
        # full pieces are containers of their own
        rows = pd.concat(
            [
                rows,
                pd.DataFrame({"id": key[whole], "piece_no": number, "n_tokens": capacity, "container_id": boxes + np.arange(len(whole)), "slot": 0, "container_offset": 0, "context": capacity, "step_group": groups + np.arange(len(whole)) // group, "bucket": part}),
                pd.DataFrame({"id": key[none], "piece_no": 0, "n_tokens": 0, "bucket": part}),
            ],
            ignore_index=True,
        )
        rows["token_start"] = rows["piece_no"] * capacity
        yield _typed(rows)[[*names, "bucket"]]

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = []
        for pdf in batches:
            if (pdf["bucket"] >= 0).any():
                yield pdf.loc[pdf["bucket"] >= 0, names]
            carried.append(pdf[pdf["bucket"] < 0])
        if not carried:
            return
        for bucket, pdf in pd.concat(carried, ignore_index=True).groupby("bucket"):
            # equal sizes take their places in the order of the ids
            pdf = pdf.sort_values(["id", "piece_no"], kind="stable").reset_index(drop=True)
            placed = _place(pdf["n_tokens"].to_numpy(np.int64), contexts, (1 << 62) + ((-1 - int(bucket)) << 33), group)
            for c in ("container_id", "slot", "container_offset", "context", "step_group"):
                pdf[c] = placed[c]
            yield _typed(pdf)[names]

    pieces = df.select(F.col(f"`{id_col}`").alias("c0"), F.col(f"`{text_col}`").alias("c1")).mapInPandas(first, sized).repartition("bucket")
    out = pieces.mapInPandas(last, sized.rsplit(",", 1)[0])
    tier = F.lit(len(contexts) - 1)
    for i in range(len(contexts) - 2, -1, -1):
        tier = F.when(F.col("n_tokens") <= contexts[i], F.lit(i)).otherwise(tier)
    return out.select(F.col("id").alias(id_col), "piece_no", "token_start", "n_tokens", tier.alias("tier"), "context", "container_id", "slot", "container_offset", "step_group")


def _typed(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole numbers in columns that may be NULL."""
    return rows.astype({c: "Int32" for c in ("piece_no", "token_start", "n_tokens", "slot", "container_offset", "context")} | {c: "Int64" for c in ("container_id", "step_group")})


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: pieces, containers, tokens and the share of the containers' room that is used."""
    return packed.where("container_id is not null").agg(
        F.count("*").alias("pieces"),
        F.countDistinct("container_id").alias("containers"),
        F.sum("n_tokens").alias("tokens"),
        F.round(F.sum("n_tokens") / (F.countDistinct("container_id") * capacity), 4).alias("fill"),
    )


def packing_faults(packed: DataFrame, id_col: str, capacity: int = CAPACITY) -> DataFrame:
    """One row: texts, and how many containers, texts and windows break a rule (all 0 in a right packing):
    containers over their capacity or with overlapping texts, texts cut though they fit, texts with
    tokens missing or repeated, pieces that leave their window."""
    placed = packed.where("container_id is not null")
    by_box = Window.partitionBy("container_id").orderBy("slot")
    ends = F.lag(F.col("container_offset") + F.col("n_tokens"), 1, 0).over(by_box)
    boxes = placed.withColumn("_over", F.col("container_offset") < ends).groupBy("container_id").agg(
        (F.max("_over") | (F.sum("n_tokens") > capacity) | (F.max(F.col("container_offset") + F.col("n_tokens")) > capacity)).alias("bad")
    )
    texts = packed.groupBy(id_col).agg(
        ((F.count("*") > 1) & (F.sum("n_tokens") <= capacity)).alias("cut"),
        (F.sum("n_tokens") != F.max(F.col("token_start") + F.col("n_tokens"))).alias("gaps"),
    )
    window = F.floor(F.col("container_offset") / F.col("context"))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return (
        texts.agg(F.count("*").alias("texts"), n(F.col("cut")).alias("cut_texts"), n(F.col("gaps")).alias("torn_texts"))
        .crossJoin(boxes.agg(n(F.col("bad")).alias("bad_containers")))
        .crossJoin(placed.agg(n((F.col("container_offset") + F.col("n_tokens") > (window + 1) * F.col("context"))).alias("bad_windows")))
    )
