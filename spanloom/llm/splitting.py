"""Oversized texts cut into bounded, overlapping pieces at natural boundaries (problem 5).

The cut positions minimise, by dynamic programming over all boundary positions of the text, the
sum of a penalty per cut (the weaker the boundary, the dearer) and of the squared deviation of
every piece from the even length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from spanloom.llm.common import map_rows

#: Penalty of a cut at the kinds of boundary, best first.
PENALTY = {"paragraph": 0.0, "line": 0.1, "sentence": 0.25, "clause": 0.6, "space": 1.0, "forced": 6.0}
#: Weight of the squared deviation of a piece's length from the even one, in units of the limit.
IMBALANCE = 1.0
#: Within a run without boundaries a forced cut is possible at about every so many characters.
FORCED_STRIDE = 64

_KINDS = list(PENALTY)
_BOUNDARY = re.compile(
    r"(?P<paragraph>[^\S\n]*\n[^\S\n]*\n\s*)|(?P<line>[^\S\n]*\n\s*)"
    r"|(?P<sentence>[.!?…。！？؟।]+[\"'”’»」』)\]]*[^\S\n]+(?=\S)|[。！？]+[”’」』）]*(?!\s))"
    r"|(?P<clause>[,;:，；：、][^\S\n]+(?=\S)|[，；：、](?!\s))|(?P<space>[^\S\n]+)"
)


def _joins(text: str, at: int) -> bool:
    """True if a cut before ``at`` would part a letter from its mark or a joined sign."""
    c = text[at]
    return unicodedata.category(c) in ("Mn", "Mc", "Me") or c in "‍️" or text[at - 1] == "‍"


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions at which the text may be cut, and the kind of each as index of PENALTY."""
    n = len(text)
    found = list(_BOUNDARY.finditer(text))
    at = np.array([m.end() for m in found], dtype=np.int64)
    kind = np.array([m.lastindex for m in found], dtype=np.int64) - 1
    at, kind = at[at < n], kind[at < n]
    edges = np.concatenate(([0], at, [n]))
    more = []
    for i in np.nonzero(np.diff(edges) > FORCED_STRIDE + FORCED_STRIDE // 2)[0].tolist():
        a, b = int(edges[i]), int(edges[i + 1])
        for p in range(a + FORCED_STRIDE, b - FORCED_STRIDE // 2, FORCED_STRIDE):
            while p < b and _joins(text, p):
                p += 1
            if p < b:
                more.append(p)
    if more:
        at = np.concatenate((at, np.unique(more)))
        kind = np.concatenate((kind, np.full(len(at) - len(kind), len(_KINDS) - 1)))
        order = np.argsort(at, kind="stable")
        at, kind = at[order], kind[order]
    return at, kind


def cut(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """Pieces ``(start, end, kind of the cut that ends it)``; the last one's kind is ``end``."""
    n = len(text)
    if n <= limit:
        return [(0, n, "end")] if n else []
    at, kind = boundaries(text)
    gaps = np.diff(np.concatenate(([0], at, [n])))
    if gaps.max(initial=0) > limit - overlap - 1:  # a run of marks so long that no cut keeps them whole
        known = dict(zip(at.tolist(), kind.tolist(), strict=True))
        at = np.union1d(at, np.arange(FORCED_STRIDE, n, FORCED_STRIDE))
        kind = np.array([known.get(p, len(_KINDS) - 1) for p in at.tolist()])
    at, kind = at[at >= overlap], kind[at >= overlap]
    pieces = max(2, math.ceil((n - overlap) / (limit - overlap)))
    even = (n + (pieces - 1) * overlap) / pieces
    ends = np.append(at, n)
    price = np.append(np.array([PENALTY[k] for k in _KINDS])[kind], 0.0).tolist()
    # best[i] = price[i] + min over j of best[j] + w (y[i] - x[j])^2, where y[i] - x[j] is the deviation of
    # the piece between the cuts from the even length; without the square of y[i] each j is a line
    x = ends / limit
    y = ((ends + (overlap - even)) / limit).tolist()
    lines, slopes = np.empty(len(ends)), 2 * IMBALANCE * x
    squares = (IMBALANCE * x * x).tolist()
    back = [-1] * len(ends)
    low = np.searchsorted(ends, ends - (limit - overlap), side="left").tolist()
    firsts = int(np.searchsorted(ends, limit, side="right"))
    alone = (IMBALANCE * ((ends[:firsts] - even) / limit) ** 2).tolist()
    lo, total = 0, 0.0
    for i, v in enumerate(y):
        least = alone[i] if i < firsts else math.inf
        # as the cost of a piece is convex in its length, the best cut before never moves back
        lo = max(lo, low[i])
        if lo < i:
            cost = lines[lo:i] - v * slopes[lo:i]
            j = lo + int(cost.argmin())
            through = float(cost[j - lo]) + IMBALANCE * v * v
            lo = j
            if through < least:
                least, back[i] = through, j
        total = least + price[i]
        lines[i] = total + squares[i]
    cuts, i = [], len(ends) - 1
    while i >= 0:
        cuts.append(i)
        i = back[i]
    cuts.reverse()
    out, start = [], 0
    for i in cuts:
        end = int(ends[i])
        out.append((start, end, "end" if end == n else _KINDS[int(kind[i])]))
        start = end - overlap
    return out


def longest_run(text: str) -> int:
    """Length of the longest run of characters without white space."""
    return max(map(len, text.split()), default=0)


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int = 2000, overlap: int = 200, with_text: bool = True) -> DataFrame:
    """Pieces of every text longer than ``limit`` code points.

    Columns: the id, piece_no (from 0), start_pos, end_pos, cut_kind, piece (NULL unless
    ``with_text``), longest_run (of the whole text, in characters). Piece ``k + 1`` starts ``overlap`` characters before piece ``k``
    ends; without those repeats the pieces concatenate to the text.

    Defined cases: NULL and empty texts and texts up to ``limit`` yield no row; a NULL id is kept
    as NULL; repeated rows are split once each; other columns are not carried, so their names
    can't clash. A run without boundaries is cut between two letters, never before a combining
    mark (unless the run of marks itself exceeds the limit).
    """
    if not 0 <= overlap < limit - FORCED_STRIDE:
        raise ValueError("overlap must be well below limit")

    def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
        if text is None or len(text) <= limit:
            return
        run = longest_run(text)
        for k, (start, end, kind) in enumerate(cut(text, limit, overlap)):
            yield key, k, start, end, kind, text[start:end] if with_text else None, run

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"{id_col} {kind}, piece_no int, start_pos int, end_pos int, cut_kind string, piece string, longest_run int", rows)
