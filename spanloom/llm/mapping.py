"""Free-entered values mapped to the entries of a canonical list (problem 4).

Values are deduplicated, brought to the consistent form and normalised. Candidates come from an
inverted index of character n-grams over all names of the list and are ranked by weighted cosine.
A candidate counts if its cosine passes a threshold and an exact check of its words finds that nothing
that tells entries apart (grade, strength, organ, kind) is missing or added. The one of highest
cosine is accepted if it leads the best other entry by a margin; within the margin, the entry
whose words cost fewer edits.

What a word or an n-gram weighs is counted over the whole list. Long lists are matched in blocks of
names, which hold postings only; the best of all blocks are decided upon together, so the result
doesn't depend on the blocks.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import bare_text, map_rows
from spanloom.llm.lookalike import Rewriter
from spanloom.plans.runtime import discard, written

#: Lengths of the character n-grams.
GRAMS = (2, 3)
#: Least weighted cosine of a candidate. All that reach it are candidates: their number isn't limited.
THRESHOLD = 0.25
#: Least lead, in cosine, over the best candidate of another entry.
MARGIN = 0.02
#: Most that the edits of a candidate's words may cost.
MAX_COST = 3.0
#: Normalised values whose result a worker keeps at hand.
KNOWN_VALUES = 200_000
#: Names sent to the workers at once; a longer list is matched in blocks of about this size.
NAME_BLOCK = 100_000

# Phrases that values add to a name without changing what is named; those of dosing
# count only in groups whose names carry amounts.
_FILLERS = (
    "chan doan", "theo doi", "tien su", "on dinh", "dang dieu tri", "benh ly", "benh", "kieu", "nghi ngo", "nghi", "cd", "td",
    "the", "of", "thuoc", "t",
)
_DOSING = (
    "vien", "tabs", "tab", "caps", "cap", "tablet", "oral", "uong sau an", "uong truoc an", "uong sang", "uong trua", "uong chieu",
    "uong toi", "uong", "tiem tinh mach", "tiem bap", "tiem duoi da", "tiem", "truyen tinh mach", "truyen", "po", "im", "iv", "sc",
    "sl", "pr", "tid", "bid", "qd", "qid", "qhs", "qam", "qpm", "prn", "daily", "twice", "once",
)
_UNIT = r"(?:mgs?|mcgs?|µg|ug|grams?|g|mls?|iu|meq|mmol|%)"
_STRENGTH = re.compile(rf"(\d+(?:[.,]\d+)?)\s*({_UNIT})(?![a-z])")
_TOKEN = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+(?:[.,]\d+)?")
#: Dosing schedules carry digits that are no part of a name.
_SCHEDULE = re.compile(r"\bq\s*\d+\s*h(?:\s*:\s*prn)?\b|\b(?:uong\s+)?(?:ngay\s+)?\d+\s+lan(?:\s*/?\s*ngay)?\b|\b\d+\s*x\s*/?\s*ngay\b")
_TONE = "sfrxj"
_VOWEL_RUN = re.compile(r"aa|ee|oo|dd|aw|ow|uw|w")


def telex(word: str) -> str:
    """The accentless word behind a key sequence of a Vietnamese keyboard (``khuaanr`` -> ``khuan``)."""
    w = _VOWEL_RUN.sub(lambda m: m.group()[0] if m.group() != "w" else "u", word)
    if len(w) > 1 and w[-1] in _TONE and re.search("[aeiouy]", w[:-1]):
        return w[:-1]
    return re.sub(rf"(?<=[aeiouy])([{_TONE}])(?=[a-z])", "", w)


def strengths(text: str) -> frozenset[tuple[str, str]]:
    """Amounts with unit, in one spelling: ``2,5 mgs`` and ``2.5 MG`` are equal."""
    out = set()
    for n, unit in _STRENGTH.findall(text):
        value = float(n.replace(",", "."))
        unit = unit.rstrip("s") if len(unit) > 1 else unit
        out.add((f"{value:g}", {"gram": "g", "ug": "mcg", "µg": "mcg"}.get(unit, unit)))
    return frozenset(out)


def close(a: str, b: str, limit: int) -> int:
    """Restricted edit distance (a swap of neighbours counts 1) up to ``limit``; above it, 9."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return 9
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    a, b = a[n:], b[n:]
    n = 0
    for x, y in zip(reversed(a), reversed(b), strict=False):
        if x != y:
            break
        n += 1
    if n:
        a, b = a[:-n], b[:-n]
    if not a or not b:
        return len(a) + len(b)
    if limit == 1:
        return 1 if len(a) == len(b) == 1 or (len(a) == len(b) == 2 and a == b[::-1]) else 9
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            c = one[j - 1] if x == y else 1 + min(one[j - 1], one[j], now[-1])
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and two[j - 2] < c:
                c = min(c, two[j - 2] + 1)
            now.append(c)
        if min(now) > limit:
            return 9
        two, one = one, now
    return one[-1] if one[-1] <= limit else 9


def grams(compact: str) -> list[str]:
    """The distinct n-grams of a text with its ends marked."""
    padded = f"^{compact}$"
    return list(dict.fromkeys(padded[i : i + k] for k in GRAMS for i in range(max(1, len(padded) - k + 1))))


@dataclass
class Facts:
    """What is known of a group of the list as a whole."""

    dosed: bool
    names: int = 0
    vocabulary: frozenset[str] = frozenset()
    seen: dict[str, int] | None = None  # n-gram -> number of names

    def __post_init__(self) -> None:
        phrases = _FILLERS + _DOSING if self.dosed else _FILLERS
        self.fillers = re.compile(r"(?<!\w)(?:" + "|".join(sorted(phrases, key=len, reverse=True)) + r")(?!\w)")
        self.filler_words = {w for f in phrases for w in f.split()}
        self.rare = math.log(1 + self.names)
        self.weights = {g: math.log(1 + self.names / n) for g, n in (self.seen or {}).items()}


class Reader:
    """Values and names in words, by the facts of the whole list."""

    def __init__(self, facts: dict[str, Facts], table: tuple[tuple[str, str], ...]) -> None:
        self.facts, self.rewriter = facts, Rewriter(table)

    def fold(self, text: str) -> str:
        return bare_text(self.rewriter.rewrite(text)).replace("_", " ").strip()

    def words(self, folded: str, group: str, raw: bool = False) -> tuple[list[str], frozenset[tuple[str, str]]]:
        """Words without amounts, schedules and fillers; and the amounts. ``raw``: as they are typed."""
        facts = self.facts[group]
        amounts = strengths(folded)
        rest = _SCHEDULE.sub(" ", _STRENGTH.sub(" ", folded))
        words = _TOKEN.findall(re.sub(r"(?<=[a-z]{4})(?=\d)", " ", rest))
        if not raw:
            words = [self.untelex(w, group) for w in words]
        return facts.fillers.sub(" ", " ".join(words)).split() if words else [], amounts

    def untelex(self, word: str, group: str) -> str:
        facts = self.facts[group]
        known, fillers = facts.vocabulary, facts.filler_words
        if len(word) < 3 or word in known or word in fillers:
            return word
        t = telex(word)
        return t if t in known or t in fillers else word

    def missing(self, value: Sequence[str], name: Sequence[str], vocabulary: frozenset[str]) -> float:
        """Cost of reading the words of a value as those of a name, in any order; 9 if they differ
        in a word that tells entries apart."""
        rest = list(value)
        open_words = []
        cost = 0.0
        for w in name:
            if w in rest:
                rest.remove(w)
            else:
                open_words.append(w)
        if open_words and rest:
            # words run together or torn apart
            rest, open_words, n = _join(rest, open_words)
            open_words, rest, more = _join(open_words, rest)
            cost += 0.1 * (n + more)
        for w in list(open_words):
            if w.isdigit() or len(w) < 2:
                continue
            limit = 1 if len(w) < 7 else 2
            found = [(close(w, r, limit), k) for k, r in enumerate(rest) if not r.isdigit() and (len(name) == 1 or r not in vocabulary)]
            c, k = min(found, default=(9, 0))
            if c <= limit and (len(w) > 2 or len(rest[k]) > 2):
                cost += c
                rest.pop(k)
                open_words.remove(w)
        if open_words and rest:
            # a typing error across a word's edge: compare what is left without spaces
            a, b = "".join(open_words), "".join(rest)
            if _DIGITS.findall(a) != _DIGITS.findall(b):
                return 9.0
            return cost + close(a, b, max(1, len(a) // 8))
        if open_words:
            return 9.0
        for r in rest:
            if r.isdigit() or r in vocabulary:
                return 9.0
            cost += 0.5
        return cost


#: Codes of an equal name, highest cosine, and candidates (code, cosine, cost) that may be the best.
Found = tuple[list[str], float, list[tuple[str, float, float]]]


def decide(found: Found) -> tuple[str | None, float, str]:
    """Code, score and reason (``exact``, ``close``, or why nothing was accepted)."""
    exact, top, some = found
    if len(exact) == 1:
        return exact[0], 1.0, "exact"
    if not some:
        return None, top, "differs" if top >= THRESHOLD else "below threshold"
    best: dict[str, tuple[float, float]] = {}
    for code, score, cost in some:
        if code not in best or (score, -cost) > best[code]:
            best[code] = (score, -cost)
    lead = max(s for s, _ in best.values())
    rivals = sorted(((c, s, code) for code, (s, c) in best.items() if s > lead - MARGIN), reverse=True)
    if len(rivals) > 1 and rivals[1][0] >= rivals[0][0] - 0.01:
        return None, lead, "ambiguous"
    return rivals[0][2], rivals[0][1], "close"


class Block:
    """The inverted index over a block of the list: n-gram -> forms with normalised weights.

    Names of one group that differ in amounts only are one form.
    """

    def __init__(self, reader: Reader, names: Sequence[tuple[str, str, str, Sequence[str], Sequence[str]]]) -> None:
        self.reader = reader
        self.exact: dict[tuple[str, str], set[str]] = defaultdict(set)
        forms: dict[str, dict[tuple[str, ...], dict[frozenset, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        for code, group, folded, words, amounts in names:
            self.exact[group, folded].add(code)
            forms[group][tuple(words)][frozenset(amounts)].add(code)
        self.forms = {g: list(f.items()) for g, f in forms.items()}
        self.digits = {g: [_digits(words) for words, _ in f] for g, f in self.forms.items()}
        self.postings = {g: self._postings(g) for g in self.forms}
        self.known: dict[tuple, Found] = {}

    def _postings(self, group: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        facts = self.reader.facts[group]
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for i, (words, _) in enumerate(self.forms[group]):
            weights = [(g, facts.weights[g]) for g in grams("".join(words))]
            norm = math.sqrt(sum(w * w for _, w in weights)) or 1.0
            for g, w in weights:
                lists[g].append((i, w / norm))
        return {g: (np.array([i for i, _ in p], np.int32), np.array([x for _, x in p])) for g, p in lists.items()}

    def candidates(self, compact: str, group: str) -> tuple[np.ndarray, np.ndarray]:
        """Forms whose cosine passes the threshold, best first, with their cosines.

        Only the postings of the value's n-grams are touched.
        """
        facts, postings = self.reader.facts[group], self.postings[group]
        at, share, norm = [], [], 0.0
        for g in grams(compact):
            w = facts.weights.get(g, facts.rare)
            norm += w * w
            p = postings.get(g)
            if p is not None:
                at.append(p[0])
                share.append(w * p[1])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0)
        # rounded, so that equal cosines tie whatever the order of the sums
        score = np.round(np.bincount(np.concatenate(at), np.concatenate(share)) / math.sqrt(norm), 9)
        found = np.nonzero(score >= THRESHOLD)[0]
        order = found[np.argsort(-score[found], kind="stable")]
        return order, score[order]

    def find(self, text: str, group: str) -> Found:
        """The block's part in the decision on a value."""
        if group not in self.forms:
            return [], 0.0, []
        folded = self.reader.fold(text)
        exact = sorted(self.exact.get((group, folded), ()))
        if len(exact) == 1:
            return exact, 1.0, []
        words, amounts = self.reader.words(folded, group)
        # many values differ in case, accents, dosing or spacing only
        key = group, tuple(words), amounts
        if key not in self.known:
            if len(self.known) >= KNOWN_VALUES:
                self.known.clear()
            self.known[key] = self.read(words, amounts, group)
        _, top, some = self.known[key]
        return exact, top, some

    def read(self, words: Sequence[str], amounts: frozenset, group: str) -> Found:
        """Candidates in order of their cosine, as far down as a rival of the best may stand."""
        if not words:
            return [], 0.0, []
        vocabulary, digits = self.reader.facts[group].vocabulary, _digits(words)
        order, score = self.candidates("".join(words), group)
        some: list[tuple[str, float, float]] = []
        for i, s in zip(order.tolist(), score.tolist(), strict=True):
            if some and s <= some[0][1] - MARGIN:
                break
            name, by_amount = self.forms[group][i]
            codes = by_amount.get(amounts)
            if not codes or self.digits[group][i] != digits:
                continue
            cost = self.reader.missing(words, name, vocabulary)
            if cost <= MAX_COST:
                some += [(code, s, cost) for code in sorted(codes)]
        return [], float(score[0]) if len(score) else 0.0, some


def _digits(words: Sequence[str]) -> str:
    return "".join(sorted(c for w in words for c in w if c.isdigit()))


def _join(parts: list[str], whole: list[str]) -> tuple[list[str], list[str], int]:
    """Take words of ``whole`` that are two or three successive words of the other side run together."""
    n = 0
    for w in list(whole):
        for k in range(len(parts)):
            if not w.startswith(parts[k]):
                continue
            for m in (2, 3):
                if "".join(parts[k : k + m]) == w and k + m <= len(parts):
                    del parts[k : k + m]
                    whole.remove(w)
                    n += 1
                    break
            else:
                continue
            break
    return parts, whole, n


def _prepared(names: DataFrame, table: tuple[tuple[str, str], ...]) -> tuple[DataFrame, dict[str, Facts]]:
    """The list in words (c, g, folded, words, amounts), written once, and the facts of its groups.

    To the driver come the groups, the distinct words and the n-grams of the list, each once.
    """

    def amounts() -> Callable:
        reader = Reader({}, table)
        return lambda g, n: iter([(g, bool(strengths(reader.fold(n))))])

    dosed = map_rows(names, ["g", "n"], "g string, dosed boolean", setup=amounts).groupBy("g").agg(F.max("dosed").alias("dosed")).collect()
    phrases = {r.g: Facts(r.dosed) for r in dosed}

    def in_words() -> Callable:
        reader = Reader(phrases, table)

        def rows(c, g, n) -> Iterator[tuple]:  # noqa: ANN001
            folded = reader.fold(n)
            words, has = reader.words(folded, g, raw=True)
            if words:
                yield c, g, folded, words, sorted(f"{v} {u}" for v, u in has), grams("".join(words))

        return rows

    listed = written(map_rows(names, ["c", "g", "n"], "c string, g string, folded string, words array<string>, amounts array<string>, grams array<string>", setup=in_words))
    parts = [listed.select("g", F.lit(k).alias("k"), F.explode(k).alias("t")) for k in ("words", "grams")]
    counted = parts[0].unionByName(parts[1]).groupBy("g", "k", "t").agg(F.count("*").alias("n"))
    sizes = listed.groupBy("g").agg(F.count("*").alias("n")).select("g", F.lit("names").alias("k"), F.lit(None).cast("string").alias("t"), "n")
    known: dict[tuple[str, str], dict[str, int]] = defaultdict(dict)
    for r in counted.unionByName(sizes).collect():
        known[r.g, r.k][r.t] = r.n
    facts = {g: Facts(f.dosed, known[g, "names"].get(None, 0), frozenset(known[g, "words"]), known[g, "grams"]) for g, f in phrases.items()}
    return listed, facts


def map_values(
    values: DataFrame,
    names: DataFrame,
    text_col: str,
    group_col: str,
    table: tuple[tuple[str, str], ...],
    code_col: str = "code",
    name_col: str = "name",
    block: int = NAME_BLOCK,
) -> DataFrame:
    """Distinct (text, group) with code, score and reason.

    ``names`` has one row per name of an entry (code, group, name); a value is matched within its
    group. code is NULL for values that name no entry; reason says why.

    The list is sent to the workers in blocks of about ``block`` names, each asked all distinct values.
    What words and n-grams weigh, and the choice among the candidates, concern the whole list, so
    the result is the same for every size of block.

    Defined cases: rows with NULL text are left out, an empty text is unmapped; repeated values
    are mapped once; blank, NULL and repeated names are ignored; an empty list maps nothing;
    columns other than those named are ignored, whatever their names.
    """
    clean = names.select(F.col(f"`{code_col}`").alias("c"), F.coalesce(F.col(f"`{group_col}`"), F.lit("")).alias("g"), F.col(f"`{name_col}`").alias("n"))
    listed, facts = _prepared(clean.where("n is not null and c is not null and trim(n) != ''").distinct(), table)
    blocks = max(1, -(-sum(f.names for f in facts.values()) // block))
    todo = values.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{group_col}`").alias("grp")).where("text is not null").distinct()
    result = "text string, grp string, code string, score double, reason string"
    part = "text string, grp string, exact array<string>, top double, some array<struct<code:string,score:double,cost:double>>"
    out = None
    for k in range(blocks):
        some = listed if blocks == 1 else listed.where(F.pmod(F.xxhash64("c"), F.lit(blocks)) == k)
        rows = sorted((r.c, r.g, r.folded, tuple(r.words), tuple(r.amounts)) for r in some.select("c", "g", "folded", "words", "amounts").collect())

        def setup(rows=rows) -> Callable:  # noqa: ANN001
            one = Block(Reader(facts, table), [(c, g, f, w, [tuple(a.split(" ", 1)) for a in has]) for c, g, f, w, has in rows])

            def whole(text, grp) -> Iterator[tuple]:  # noqa: ANN001
                yield text, grp, *decide(one.find(text, grp or ""))

            def partly(text, grp) -> Iterator[tuple]:  # noqa: ANN001
                exact, top, few = one.find(text, grp or "")
                yield text, grp, exact, top, [{"code": c, "score": s, "cost": x} for c, s, x in few]

            return whole if blocks == 1 else partly

        one = map_rows(todo, ["text", "grp"], result if blocks == 1 else part, setup=setup)
        out = one if out is None else out.union(one)
    discard(listed)
    if blocks == 1:
        return out
    all_of = out.groupBy("text", "grp").agg(F.array_distinct(F.flatten(F.collect_list("exact"))).alias("exact"), F.max("top").alias("top"), F.flatten(F.collect_list("some")).alias("some"))

    def last(text, grp, exact, top, some) -> Iterator[tuple]:  # noqa: ANN001
        yield text, grp, *decide((list(exact), top, [(x["code"], x["score"], x["cost"]) for x in some]))

    return map_rows(all_of, ["text", "grp", "exact", "top", "some"], result, last)
