"""Evaluation passages found in a training corpus (problem 8).

Pigeonhole edit matching. ``k`` character edits harm at most ``k`` places of a passage of ``m`` words, of two
neighbouring words each, so that of the ``k + 1`` stretches between them one has at least
``(m - 2k) / (k + 1)`` words that stand in the document unharmed and in a row. A test item is cut into
consecutive pieces of such a size that every stretch of that length holds a whole piece. One automaton
finds all exact piece hits of a document; the unbroken run around each hit is measured, and the
passages around the runs that are long enough are verified with Myers' bit-parallel distance. Where
the run itself is a whole passage, there is nothing left to measure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import map_rows, words_of

MIN_WORDS = 15
#: Test items, and characters of them, matched in one pass over the corpus; more are matched in further passes.
ITEM_BLOCK, ITEM_CHARS = 20_000, 32_000_000

def myers(pattern: str, text: str, budget: int) -> int:
    """Least edit distance of ``pattern`` to any part of ``text``; ``budget + 1`` if beyond it."""
    m = len(pattern)
    if not m:
        return 0
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full  # an occurrence may start anywhere, so nothing comes in from the right
        mh = mh << 1 & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        if score < best:
            best = score
    return min(best, budget + 1)


class Matcher:
    """The pieces of a block of test items in one automaton."""

    def __init__(self, items: Sequence[tuple[int, str]], min_words: int, budget: int) -> None:
        import ahocorasick

        self.min_words, self.budget = min_words, budget
        #: Words of the longest unharmed stretch of a passage, at least.
        self.stretch = -(-(min_words - 2 * budget) // (budget + 1))
        self.width = (self.stretch + 1) // 2
        if self.width < 1:
            raise ValueError("the budget is too large for passages of so few words")
        self.items = [(key, words_of(text)) for key, text in items if text]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, words) in enumerate(self.items):
            if len(words) >= min_words:
                for q in range(0, len(words) - self.width + 1, self.width):
                    places.setdefault(f" {' '.join(words[q : q + self.width])} ", []).append((i, q))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        self.empty = not places
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """Per item that leaks into ``text``: index, longest exact run in words, its place in the
        document and in the item (word numbers), least edits of a passage."""
        if self.empty:
            return
        words = words_of(text)
        joined = f" {' '.join(words)} "
        hits: dict[int, list[tuple[int, int]]] = {}
        at, last = 0, 0
        for end, where in self.automaton.iter(joined):
            at += joined.count(" ", last, end + 1)  # blanks up to the piece's closing one
            last = end + 1
            for i, q in where:
                hits.setdefault(i, []).append((q, at - 1 - self.width))
        for i, some in hits.items():
            found = self._best(self.items[i][1], words, some)
            if found:
                yield i, *found

    def _best(self, mine: list[str], words: list[str], hits: list[tuple[int, int]]) -> tuple[int, int, int, int] | None:
        """The longest run (words, place in the document and in the item) and the least edits, or None."""
        best = None
        runs: dict[int, int] = {}  # diagonal -> where its last run ends in the item
        edited = []
        for q, d in hits:
            if runs.get(d - q, -1) > q:
                continue  # inside a run that is known
            a, b, c, e = q, d, q + self.width, d + self.width
            while a and b and mine[a - 1] == words[b - 1]:
                a, b = a - 1, b - 1
            while c < len(mine) and e < len(words) and mine[c] == words[e]:
                c, e = c + 1, e + 1
            runs[d - q] = c
            if c - a >= self.min_words:
                if best is None or c - a > best[0]:
                    best = (c - a, b, a, 0)
            elif c - a >= self.stretch:
                edited.append((c - a, b, a))
        if best:
            return best
        for run, b, a in sorted(edited, reverse=True):
            if best and best[3] == 1:
                break  # without an exact run there is no less
            edits = self._edits(mine, words, a, b, run, best[3] - 1 if best else self.budget)
            if edits is not None:
                best = (run, b, a, edits)
        return best

    def _edits(self, mine: list[str], words: list[str], q: int, d: int, run: int, budget: int) -> int | None:
        """Least edits of a passage that holds a stretch of the run at ``q``; None if more than ``budget``."""
        m, k = self.min_words, self.budget
        first, last = max(0, q + self.stretch - m), min(q + run - self.stretch, len(mine) - m)
        # an edit harms two neighbouring words at most, and moves the following ones by one place
        near = "".join(["." if mine[j] in words[max(0, d + j - q - k) : d + j - q + k + 1] else "x" for j in range(first, last + m)])
        least = None
        for start in range(first, last + 1):
            if sum((len(x) + 1) // 2 for x in near[start - first : start - first + m].split(".") if x) > k:
                continue
            region = words[max(0, d - (q - start) - k) : d + (start + m - q) + k]
            edits = myers(f" {' '.join(mine[start : start + m])} ", f" {' '.join(region)} ", budget)
            if edits <= budget:
                least, budget = edits, edits - 1
                if budget < 1:
                    break
        return least


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    budget: int = 1,
    block: int = ITEM_BLOCK,
) -> DataFrame:
    """Rows (doc, item, n_words, doc_word, item_word, edits): documents that carry a passage.

    A row stands for a document and a test item of which a passage of ``min_words`` words occurs
    with at most ``budget`` character edits. n_words is the longest unbroken common run of words
    around the piece that was hit, doc_word and item_word the numbers of its first words, edits
    the least edits of a passage (0: verbatim). Words are compared without case, accents, Unicode
    form, punctuation and spacing.

    The test items are the stated query set: they are sent to the workers in blocks of about ``block`` items
    and ``ITEM_CHARS`` characters at most, with one pass over the corpus per block; the corpus isn't shuffled.

    Defined cases: NULL and empty texts and items of fewer words than ``min_words`` match nothing;
    items of equal text leak together; repeated document rows give repeated result rows; NULL ids
    are kept; other columns are not carried, so their names can't clash.
    """
    chosen = items.select(F.col(f"`{item_col}`").alias("k"), F.col(f"`{text_col}`").alias("t")).where("t is not null").distinct()
    size = chosen.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size.n // block), -(-size.chars // ITEM_CHARS))
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((docs, doc_col), (items, item_col))]
    schema = f"{doc_col} {kinds[0]}, {item_col} {kinds[1]}, n_words int, doc_word int, item_word int, edits int"
    out = None
    for part in range(blocks):
        some = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == part)
        query = tuple(sorted(((r.k, r.t) for r in some.collect()), key=lambda x: (str(x[0]), x[1])))

        def setup(query=query) -> Callable:  # noqa: ANN001
            matcher = Matcher(query, min_words, budget)

            def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
                if text:
                    for i, run, at, place, edits in matcher.find(text):
                        yield key, matcher.items[i][0], run, at, place, edits

            return rows

        one = map_rows(docs, [doc_col, text_col], schema, setup=setup)
        out = one if out is None else out.union(one)
    return out
