"""Sentence units of texts in any language and script (problem 9).

A hidden-event n-gram language model: between the tokens of a text stand hidden events, boundary or
none, wherever a unit may end. The model has the probability of the event after the left context
(the token before the mark and the mark), and of the right context given the event: behind a
boundary what follows depends on the mark only, within a sentence it depends on the left token too.
Both are n-grams that back off from tokens to their shapes. Forward-backward over the events of a
block gives the posterior of each, and a unit ends where a boundary is likelier than none.

Neighbouring events are tied: how much likelier or less likely a boundary is behind another one, by
the length of what stands between, is a factor of the transition. In long stretches without any
punctuation every gap between words (between letters, in scripts without spaces) is an event, whose
odds come from how often a word begins, or ends, units elsewhere.

The model is trained without labels on the texts themselves. One pass reads the texts and writes down
the events with their contexts; expectation-maximisation then runs on the table of counted contexts,
held up by the events that are certain: a mark at the end of a line ends a unit, a mark before a
comma or within an outer sentence's quotation doesn't, nor does a space between Thai letters go on.
The transition is re-estimated by a forward-backward pass over the written events, and a last pass
over them gives the units.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import char_class, map_rows
from spanloom.plans.runtime import discard, spread, written

#: Left tokens rarer than this, or than one in TOKENS of all candidates, are known by their shape
#: only; so the table has at most TOKENS left tokens, whatever the size of the corpus. The same
#: bounds hold for the words of the gaps.
MIN_COUNT, TOKENS = 5, 200_000
ROUNDS = 12
#: Characters before a mark in which its token is looked for; a longer one is known by its end.
TOKEN_CHARS = 40
#: Scored contexts that a worker keeps at hand.
KNOWN_CONTEXTS = 500_000
#: How sure the training begins that a final sign of a script without capitals ends a unit.
FINAL_SIGN = 0.97
#: Words of so many letters aren't abbreviated.
LONG = 8
#: Small words of so many letters aren't, before a capital.
WORD = 4
#: Factor of a boundary behind a boundary, by what stands between: one initial or other short token, up
#: to FEW characters, or more. The estimate begins with it and is held to it by so many pairs.
STEPS, STEP_PAIRS = (0.05, 0.5, 1.0), 200.0
FEW = 4
#: Share of a token's marks at the ends of lines from which it counts as one that ends units.
ENDING = 0.02
#: Log odds that speak for a boundary at a question or exclamation mark, or a final sign of a script without
#: capitals, without a quotation's end: what always goes on in the same way would else be taken for one
#: sentence.
ASKING = 1.5
#: Words (letters, in scripts without spaces) of a stretch without punctuation whose gaps are events: in
#: a text without any final mark, and in others.
BARE_STRETCH, LONG_STRETCH = 20, 100

_FINAL = ".!?…。！？؟।॥۔．｡။།༎។៕።፧։"
_WIDE = "。！？؟।॥۔．｡။།༎។៕።፧։"
_OPEN, _CLOSE = "“«„‹「『《〈", "”»›」』》〉"
_CLOSERS = _CLOSE + "\"'’)]}）】〕］"
_MARKS = re.compile(rf"[{re.escape(_FINAL)}]+[ ]?(?=[{re.escape(_CLOSE)}])[{re.escape(_CLOSERS)}]+|[{re.escape(_FINAL)}]+[{re.escape(_CLOSERS)}]*")
_ITEM = re.compile(r"[^\S\n]*(?:\(?(?:\d{1,3}|[a-zA-Zа-яđ]|[ivxIVX]{1,4})[.)]|[-•*+–—●▪◦‣·○■□])[^\S\n]+")
_SPACELESS = re.compile("(?<=[\u0e00-\u0e7f])[^\\S\n]+(?=[\u0e00-\u0e7f])")
#: Scripts whose spaces part sentences where they have no final marks.
_SPARSE = re.compile("(?<=[\u0e80-\u0eff])[^\\S\n]+(?=[\u0e80-\u0eff])|(?<=[\u1780-\u17d3])[^\\S\n]+(?=[\u1780-\u17d3])")
_LEFT = re.compile(r"[^\s\"“”«»„‹›「」『』《》()（）\[\]{}【】]+$")
_LINE = re.compile("[^\\n\\r\\u2028\\u2029]*(?:[\\n\\r\\u2028\\u2029]|$)")
_RUN_ON = re.compile(r"(?<=[^\W\d_]{3})[.!?…]+(?=[^\W\d_])")
_RATE = re.compile(r"[^\W\d_]+/[^\W\d_]{3,}")
_KANA = re.compile("[\u3041-\u30fa]")
_NUMBER = re.compile(r"\d+")
_DECIMAL = re.compile(r"\d+[.,]\d")


_HAN = "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U00031fff"
_CASELESS = re.compile(f"[{char_class([c for c in (*range(0x591, 0xD800), *range(0xF900, 0x10000)) if unicodedata.category(chr(c)) == 'Lo'])}]")
_QUOTED = re.compile(f'["{_OPEN}]')
_ANY_FINAL = re.compile(f"[{re.escape(_FINAL)}]")
_PLAIN = re.compile(r"[^\W_]+(?:[\u0300-\u036f\u200d'’-]*[^\W_]+)*")
_GAP = re.compile(r"[^\S\n]+")
_ENDS = re.compile(rf"\n+|[{re.escape(_FINAL)}]+[{re.escape(_CLOSERS)}]*(?:\s+|(?<=[{_WIDE}]))")
_UNBROKEN = re.compile(f"[^{re.escape(_FINAL)},;:，、；：\n\u0e00-\u0eff\u1780-\u17ff]+")
_HAN_RUN = re.compile(f"[{_HAN}]+")


def _is_han(c: str) -> bool:
    o = ord(c)
    return 0x3040 <= o < 0x3100 or 0x3400 <= o < 0xA000 or 0xF900 <= o < 0xFB00 or 0x20000 <= o < 0x32000


def _before(text: str, start: int, s: int) -> str:
    """The token before a mark at ``s``."""
    if s > start and _is_han(text[s - 1]):
        return text[s - 1]
    found = _LEFT.search(unicodedata.normalize("NFC", text[max(start, s - TOKEN_CHARS) : s]))
    # what stands behind a sentence that ends without a space isn't part of its last word
    if not found:
        return ""
    token = found.group()
    if token.isalnum():
        return token
    token = _RUN_ON.split(token)[-1]
    # of a rate ("times/minute") the last word counts
    return token if "/" not in token or not _RATE.fullmatch(token) else token.rpartition("/")[2]


@functools.lru_cache(maxsize=100_000)
def _shape(token: str) -> str:
    if not token:
        return "<none>"
    last = token[-1]
    if last.isdigit():
        return "<num>"
    if _is_han(last):
        return "<han>"
    if "/" in token or "@" in token or "www" in token:
        return "<url>"
    if len(token) == 1:
        return "<I>" if last.isupper() else "<i>" if last.islower() else "<l>"
    if "." in token:
        return "<dots>"
    letters = sum(c.isalpha() for c in token)
    if letters <= 3:
        return "<short>"
    if letters >= LONG:
        return "<long>"
    return "<caps>" if token.isupper() else "<word>"


@functools.lru_cache(maxsize=100_000)
def _left(token: str) -> str:
    """A left token as the model knows it."""
    if not token:
        return "<none>"
    if token[-1].isdigit():
        return "<num>"
    if _is_han(token[-1]):
        return "<han>"
    if len(token) == 1 and token.isupper():
        return "<I>"
    token = unicodedata.normalize("NFC", token).casefold()
    if len(token) >= LONG and token.isalpha():
        return "<long>"  # no abbreviation
    return _NUMBER.sub("0", token)[-24:]


@functools.lru_cache(maxsize=100_000)
def _is_word(token: str) -> bool:
    """True for a word in small letters that is too long, or too accented, for an abbreviation."""
    return token.isalpha() and token.islower() and (len(token) >= WORD or not unicodedata.is_normalized("NFD", token))


@functools.lru_cache(maxsize=100_000)
def _mark(cluster: str) -> str:
    """Kind of a mark cluster: the last final sign, and what closes behind it."""
    signs = [c for c in cluster if c in _FINAL]
    c = signs[-1]
    if "…" in signs or len([s for s in signs if s == "."]) > 1:
        kind = "…"
    elif any(s in "?？؟" for s in signs):
        kind = "?"
    elif any(s in "!！" for s in signs):
        kind = "!"
    else:
        kind = "。" if c in _WIDE else "."
    tail = cluster[-1]
    return kind + ('"' if tail in _CLOSE + "\"'’" else ")" if tail in _CLOSERS else "")


def _script(text: str, start: int, end: int) -> str:
    """``cased``, or the script without capitals that the block has letters of."""
    m = _CASELESS.search(text, start, end)
    if not m:
        return "cased"
    c = m.group()
    if _is_han(c):
        return "kana" if _KANA.search(text, start, end) else "han"
    return str(ord(c) >> 7)


def _right(text: str, at: int, end: int) -> tuple[str, int]:
    """Class of what follows at ``at`` in the block, and the spaces before it: 0, 1, or 2 with a line break."""
    i = at
    while i < end and text[i].isspace():
        i += 1
    gap = 0 if i == at else 2 if "\n" in text[at:i] else 1
    if i >= end:
        return "<end>", gap
    c = text[i]
    if c in _OPEN or c in "\"'‘(（[【":
        return "<open>", gap
    if c.isdigit():
        return "<dec>" if _DECIMAL.match(text, i, end) else "<num>", gap
    if c.isalpha() or unicodedata.category(c)[0] == "M":
        if c.islower():
            return "<low>", gap
        if c.isupper() or c.istitle():
            return "<up>", gap
        if _is_han(c):
            return text[i], gap
        j = i
        while j < end and j - i < 12 and (text[j].isalpha() or unicodedata.category(text[j])[0] == "M"):
            j += 1
        return text[i:j], gap
    return "<join>" if c in ",;:、，；：—–-/％%+=" or c in _CLOSERS or c in _FINAL else "<sign>", gap


@dataclass(slots=True)
class Candidate:
    at: int  # the unit would end here
    left: str
    shape: str
    mark: str
    right: str
    fixed: int | None  # a certain event
    begin: int  # where the left token begins

    @property
    def key(self) -> str:
        return "\x1f".join((self.left, self.shape, self.mark, self.right, "-1" if self.fixed is None else str(self.fixed)))


def is_flat(text: str) -> bool:
    return text.islower()


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans of lines that no line break divides for certain: a line break goes on within a block
    only if the line before has no final mark and the next begins with a lower-case letter."""
    out: list[tuple[int, int]] = []
    previous_open = False
    for m in _LINE.finditer(text):
        line = m.group()
        body = line.strip()
        if not body:
            previous_open = False
            continue
        start = m.start()
        goes_on = previous_open and body[0].islower() and not _ITEM.match(line)
        if goes_on:
            out[-1] = (out[-1][0], m.end())
        else:
            out.append((start, m.end()))
        stripped = body.rstrip(_CLOSERS)
        previous_open = not stripped or stripped[-1] not in _FINAL
    return out


def _quotes(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Pairs (opening, closing) of quotations in a block."""
    pairs, stack, straight = [], [], None
    for i in range(start, end):
        c = text[i]
        if c in _OPEN:
            stack.append(i)
        elif c in _CLOSE and stack:
            pairs.append((stack.pop(), i))
        elif c == '"':
            if straight is None:
                straight = i
            else:
                pairs.append((straight, i))
                straight = None
    return pairs


def candidates(text: str, start: int, end: int, flat: bool = False, least: int | None = None, script: str | None = None) -> list[Candidate]:
    """Where a unit of the block may end, in order, the block's own end not included.

    ``flat``: the text has small letters only, so that they say nothing about where units begin.
    ``least``: words of a stretch without punctuation whose gaps are events.
    """
    body_end = start + len(text[start:end].rstrip())
    item = _ITEM.match(text, start)
    first = item.end() if item and item.end() <= body_end else start
    quotes = None
    script = script or _script(text, start, body_end)
    out = []
    for m in _MARKS.finditer(text, first, body_end):
        at = m.end()
        if at >= body_end:
            break
        s = m.start()
        cluster = m.group()
        before = text[s - 1] if s > start else " "
        after = text[at]
        if cluster[0] in ".．" and before.isdigit() and after.isdigit():
            continue
        tight = not after.isspace()
        kind = _mark(cluster)
        if tight and kind == "." and not (after.isupper() or after in _OPEN + '"' or after.isdigit() or _is_han(after) or unicodedata.category(after) == "Lo"):
            continue
        token = _before(text, start, s)
        if tight and after.isdigit() and not (token and token[-1].isalpha()):
            continue
        if tight and kind == "." and "." in token and not after.isdigit() and ("/" in token or "@" in token or token.startswith("www")):
            continue
        right, gap = _right(text, at, body_end)
        fixed = 0 if right == "<join>" else None
        # a mark within a quotation that an outer sentence introduces or continues
        if quotes is None:
            quotes = _quotes(text, start, end) if _QUOTED.search(text, start, end) else []
        for a, b in quotes:
            if a < s and at <= b:
                lead = text[first:a].rstrip()
                introduced = bool(lead) and lead[-1] not in _FINAL + _CLOSERS
                follow, _ = _right(text, b + 1, body_end)
                final_in = [c for c in text[a:b].rstrip(_CLOSERS + " ")[-1:]]
                asks = bool(final_in) and final_in[0] in "?？؟!！,，"
                continued = follow in ("<low>", "<join>") or (follow[0] != "<" and asks)
                if introduced or continued:
                    fixed = 0
                break
        if flat and right == "<low>":
            right = "<up>"
        left = _left(token)
        if right in ("<up>", "<open>") and token.isalpha() and not flat:
            # abbreviations in small letters are shorter or stand before numbers, have a space behind
            # and no accent
            if _is_word(token) or (tight and (token.islower() and len(token) > 1 or token.istitle() and len(token) > 2)):
                left = "<long>"
        mark = f"{kind}{'' if gap or script in ('han', 'kana') else '_'}|{script}"
        out.append(Candidate(at, left, _shape(token), mark, right, fixed, s - len(token)))
    if script != "cased":
        for m in _SPACELESS.finditer(text, first, body_end):
            out.append(Candidate(m.start(), "<none>", "<none>", " ", "<none>", 1, m.start()))
        if not out:
            for m in _SPARSE.finditer(text, first, body_end):
                out.append(Candidate(m.start(), "<none>", "<none>", " ", "<none>", 1, m.start()))
    if least is not None and body_end - first >= (least if script in ("han", "kana") else 2 * least - 1):
        out += _gaps(text, first, body_end, least)
    out.sort(key=lambda c: c.at)
    return out


def _gaps(text: str, start: int, end: int, least: int) -> list[Candidate]:
    """Events between the words of long stretches without punctuation."""
    out = []
    for m in _UNBROKEN.finditer(text, start, end):
        if m.end() - m.start() < least:
            continue
        for run in _HAN_RUN.finditer(text, m.start(), m.end()):
            a, b = run.span()
            if b - a >= least:
                out += [Candidate(i, text[i - 2 : i], "<gap>", "<gap>|han", text[i : i + 2], None, i - 2) for i in range(a + 2, b - 1)]
        words = [w.span() for w in _PLAIN.finditer(text, m.start(), m.end()) if not _is_han(w.group()[0])]
        if len(words) >= least:
            for (a, b), (c, d) in zip(words, words[1:], strict=False):
                if _GAP.fullmatch(text, b, c):
                    out.append(Candidate(b, _folded(text[a:b]), "<gap>", "<gap>|words", _folded(text[c:d]), None, a))
    return out


def _folded(word: str) -> str:
    return unicodedata.normalize("NFC", word).lower()


@dataclass
class Reading:
    """What is needed of a text: its blocks, their events, and contexts that are counted only."""

    starts: list[int]  # of the blocks, without white space
    ends: list[int]
    block: list[int]  # of each event
    at: list[int]
    after: list[int]  # where the next unit would begin
    step: list[int]  # kind of what stands between the event and the one before in the block; -1: none
    key: list[str]
    counted: list[str]


def read(text: str) -> Reading:
    """The events of a text in order."""
    r = Reading([], [], [], [], [], [], [], [])
    flat = is_flat(text)
    least = LONG_STRETCH if _ANY_FINAL.search(text) else BARE_STRETCH
    for start, end in blocks(text):
        body = text[start:end]
        begin, body_end = start + len(body) - len(body.lstrip()), start + len(body.rstrip())
        number, script = len(r.starts), _script(text, start, body_end)
        r.starts.append(begin)
        r.ends.append(body_end)
        before = None
        for c in candidates(text, start, end, flat, least, script):
            after = c.at
            while text[after].isspace():
                after += 1
            if before is None:
                step = -1
            elif len(c.left) <= 2 and before.at <= c.begin <= before.at + 2 and c.shape in ("<I>", "<i>", "<l>", "<short>"):
                step = 0
            else:
                n = c.at - r.after[-1]
                step = 1 if n <= FEW else 2
            r.block.append(number)
            r.at.append(c.at)
            r.after.append(after)
            r.step.append(step)
            r.key.append(c.key)
            before = c
        m = None
        tail = text[max(start, body_end - 12) : body_end].rstrip(_CLOSERS + " ")
        if tail and tail[-1] in _FINAL:
            for m in _MARKS.finditer(text, max(start, body_end - 12), body_end):  # noqa: B007
                pass
        if m and m.end() == body_end:
            token = _before(text, start, m.start())
            mark = f"{_mark(m.group())}|{script}"
            r.counted.append("\x1f".join((_left(token), _shape(token), mark, "<end>", "1")))
            if _is_word(token) and _left(token) != "<long>":
                r.counted.append("\x1f".join(("<long>", "<long>", mark, "<end>", "1")))  # what it is known as before a capital
        # how lines begin is how units begin
        if not _ITEM.match(text, start):
            r.counted.append("\x1f".join(("<none>", "<none>", f"<line>|{script}", _right(text, start, body_end)[0], "1")))
    return r


@dataclass(frozen=True)
class Model:
    event: dict  # (left, mark) and (shape, mark) and (mark,) -> log odds of a boundary
    behind: dict  # (script, right) -> log probability behind a boundary, which hides what was before
    within: dict  # (left, mark, right), (shape, mark, right), (mark, right) -> log probability without one
    floor: float
    begins: dict = field(default_factory=dict)  # word -> log odds of a boundary before it, beyond those of any word
    finishes: dict = field(default_factory=dict)  # the same behind it
    gap: dict = field(default_factory=dict)  # kind of gap -> log odds of a boundary
    steps: tuple = STEPS

    def score(self, left: str, shape: str, mark: str, right: str, fixed: int) -> tuple[float, float]:
        """Log weights of no boundary and of a boundary; ``fixed`` is -1 for an event that isn't certain."""
        if fixed >= 0:
            return (0.0, -60.0) if fixed == 0 else (-60.0, 0.0)
        if shape == "<gap>":
            return 0.0, self.gap.get(mark, -9.0) + self.begins.get(right, 0.0) + self.finishes.get(left, 0.0)
        odds = self.event.get((left, mark))
        if odds is None:
            odds = self.event.get((shape, mark))
        if odds is None:
            odds = self.event.get((mark,), 0.0)
        b = self.behind.get((mark.partition("|")[2], right), self.floor)
        w = self.within.get((left, mark, right))
        if w is None:
            w = self.within.get((shape, mark, right))
        if w is None:
            w = self.within.get((mark, right), self.floor)
        return w, odds + b + (ASKING if mark.partition("|")[0].rstrip("_") in ("?", "!", "。") and right != "<low>" else 0.0)


def train(table: list[tuple[str, str, str, str, int, float]], rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the context table (left, shape, mark, right, fixed, count)."""
    rows = [r for r in table if r[5] > 0]
    line: dict[str, Counter] = {}
    rights_of: dict[str, Counter] = {}
    ended, seen, all_end, all_seen = Counter(), Counter(), Counter(), Counter()
    for left, _, mark, right, fixed, n in rows:
        kind, _, script = mark.partition("|")
        if fixed == 1 and kind not in ("<line>", " ") and right != "<end>":
            line.setdefault(script, Counter())[right] += n
        if kind == "<line>":
            line.setdefault(script, Counter())[right] += n
            continue
        rights_of.setdefault(mark, Counter())[right] += n
        kind = kind.rstrip("_") + script
        seen[left, kind] += n
        all_seen[kind] += n
        if right == "<end>":
            ended[left, kind] += n
            all_end[kind] += n
    rows = [r for r in rows if not r[2].startswith(("<line>", " "))]

    def first(left: str, shape: str, mark: str, right: str) -> float:
        """Boundary probability to begin with."""
        sign, _, script = mark.partition("|")
        sign = sign.rstrip("_")
        if right == "<low>":
            return 0.02 if sign != "。" else 0.5
        if script != "cased" and sign[0] in "。?!":
            return FINAL_SIGN
        if sign[0] == "." and right[0] == "<":
            n, e = seen[left, sign + script], ended[left, sign + script]
            if shape in ("<I>", "<i>", "<l>", "<dots>", "<caps>") and not e:
                return 0.05
            share = max(0.02, all_end[sign + script] / max(1.0, all_seen[sign + script]))
            # how unlikely is it that a word which ends sentences is never seen at a line's end?
            return 0.95 if e or n < 3 else max(0.05, 0.9 * (1 - share) ** n)
        if right[0] != "<":
            # in scripts without capitals: does it begin units as often as it stands here?
            begins = line.get(script, Counter())
            some = begins[right] / max(1.0, sum(begins.values()))
            here = rights_of[mark][right] / max(1.0, sum(rights_of[mark].values()))
            return min(0.95, max(0.02, 3 * some / (3 * some + here)))
        return 0.95

    p = [float(f) if f >= 0 else first(a, s, m, r) for a, s, m, r, f, _ in rows]
    # what goes on behind a token that is seen to end units is known by its shape, not by the token
    ends = {key for key, n in seen.items() if ended[key] > ENDING * n}
    rights = {r[3] for r in rows}
    floor = math.log(0.5 / (sum(r[5] for r in rows) + len(rights) + 1))
    model = None
    for _ in range(rounds):
        e1, e0 = Counter(), Counter()
        b, w = Counter(), Counter()
        for (left, shape, mark, right, fixed, n), q in zip(rows, p, strict=True):
            if fixed < 0 or right == "<end>":
                for key in ((left, mark), (shape, mark), (mark,)):
                    e1[key] += n * q
                    e0[key] += n * (1 - q)
            if right != "<end>":
                b[mark.partition("|")[2], right] += n * q
                sign, _, script = mark.partition("|")
                if (left, sign.rstrip("_") + script) not in ends:
                    w[left, mark, right] += n * (1 - q)
                w[shape, mark, right] += n * (1 - q)
                w[mark, right] += n * (1 - q)
        for _, _, mark, right, _, n in table:
            if mark.startswith("<line>"):
                b[mark.partition("|")[2], right] += n
        event = {}
        for key in set(e1) | set(e0):
            if len(key) == 1:
                prior = 0.0
            else:
                prior = _odds(e1[(key[1],)], e0[(key[1],)], 0.0, 2.0)
            event[key] = _odds(e1[key], e0[key], prior, 1.0)
        behind = _conditional(b, lambda k: k[:-1], floor, lambda k: None, 20.0)
        within = _conditional(w, lambda k: k[:-1], floor, lambda k: k[1:] if len(k) == 3 else None, 0.5)
        model = Model(event, behind, within, floor)
        p = []
        for left, shape, mark, right, fixed, _n in rows:
            if fixed >= 0:
                p.append(float(fixed))
                continue
            none, some = model.score(left, shape, mark, right, -1)
            top = max(none, some)
            p.append(math.exp(some - top) / (math.exp(some - top) + math.exp(none - top)))
    return model or Model({}, {}, {}, floor)


def _odds(a: float, b: float, prior: float, weight: float) -> float:
    up = 1 / (1 + math.exp(-prior))
    return math.log((a + weight * up + 0.01) / (b + weight * (1 - up) + 0.01))


def _conditional(counts: Counter, given, floor: float, lower, weight: float) -> dict:  # noqa: ANN001
    """Log probabilities of the last part of a key given the rest, backing off to ``lower(key)``."""
    total: Counter = Counter()
    for key, n in counts.items():
        total[len(key), given(key)] += n
    out: dict = {}
    for key in sorted(counts, key=len):
        back = lower(key)
        base = math.exp(out.get(back, floor)) if back else math.exp(floor)
        out[key] = math.log((counts[key] + weight * base) / (total[len(key), given(key)] + weight) + 1e-12)
    return out


def forward_backward(score: list[tuple[float, float]], step: list[int], steps: tuple) -> tuple[list[float], list[float]]:
    """Posterior of a boundary at each event of a block, and of a boundary at it and at the one before."""
    n = len(score)
    if n == 1 or all(steps[k] == 1.0 for k in step[1:]):
        alone = [_share(s0, s1) for s0, s1 in score]
        return alone, [0.0, *[a * b for a, b in zip(alone, alone[1:], strict=False)]]
    tie = [0.0, *[math.log(steps[k]) for k in step[1:]]]
    forward = [score[0]]
    for i in range(1, n):
        f0, f1 = forward[-1]
        forward.append((_add(f0, f1) + score[i][0], _add(f0, f1 + tie[i]) + score[i][1]))
    backward = [(0.0, 0.0)] * n
    for i in range(n - 2, -1, -1):
        none, some = score[i + 1][0] + backward[i + 1][0], score[i + 1][1] + backward[i + 1][1]
        backward[i] = (_add(none, some), _add(none, some + tie[i + 1]))
    total = _add(forward[-1][0], forward[-1][1])
    one = [_share(f[0] + b[0], f[1] + b[1]) for f, b in zip(forward, backward, strict=True)]
    both = [0.0, *[math.exp(min(0.0, forward[i - 1][1] + tie[i] + score[i][1] + backward[i][1] - total)) for i in range(1, n)]]
    return one, both


def _share(none: float, some: float) -> float:
    """Probability of the second of two log weights."""
    return 1 / (1 + math.exp(min(700.0, none - some)))


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b - a > -50 else a


class Splitter:
    """Reads off the units of texts; contexts that come again are scored once."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def score(self, key: str) -> tuple[float, float]:
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= KNOWN_CONTEXTS:
                self.known.clear()
            left, shape, mark, right, fixed = key.split("\x1f")
            found = self.known[key] = self.model.score(left, shape, mark, right, int(fixed))
        return found

    def blocks(self, block: list[int], key: list[str], step: list[int]) -> Iterator[tuple[int, int, list[float], list[float]]]:
        """Per block that has events: its first event and the one behind its last, and their posteriors."""
        i, n = 0, len(block)
        while i < n:
            j = i + 1
            while j < n and block[j] == block[i]:
                j += 1
            yield i, j, *forward_backward([self.score(k) for k in key[i:j]], step[i:j], self.model.steps)
            i = j

    def units(self, starts: list[int], ends: list[int], block: list[int], at: list[int], after: list[int], step: list[int], key: list[str], threshold: float) -> list[tuple[int, int]]:
        cuts: dict[int, list[int]] = {}
        for i, j, one, _ in self.blocks(block, key, step):
            cuts[block[i]] = [k for k, p in zip(range(i, j), one, strict=True) if p > threshold]
        out = []
        for b, (start, end) in enumerate(zip(starts, ends, strict=True)):
            for k in cuts.get(b, ()):
                if at[k] > start:
                    out.append((start, at[k]))
                    start = after[k]
            out.append((start, end))
        return out


def split(text: str, model: Model, threshold: float = 0.5) -> list[tuple[int, int]]:
    """Units of a text as spans without white space at their ends."""
    r = read(text)
    return Splitter(model).units(r.starts, r.ends, r.block, r.at, r.after, r.step, r.key, threshold)


_READ = "starts array<int>, ends array<int>, block array<int>, at array<int>, after array<int>, step array<int>, key array<string>, counted array<string>"


def readings(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The events of every text that has any letters: the id and the columns of ``Reading``."""

    def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
        if text and not text.isspace():
            r = read(text)
            yield key, r.starts, r.ends, r.block, r.at, r.after, r.step, r.key, r.counted

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"id {kind}, {_READ}", rows)


def fit(df: DataFrame, text_col: str, read_: DataFrame, min_count: int = MIN_COUNT, tokens: int = TOKENS) -> Model:
    """Train the model on all texts of a column, of which ``read_`` are the readings."""
    keys = ["left", "shape", "mark", "right", "fixed"]
    parts = F.split("k", "\x1f")
    counted = read_.select(F.explode(F.concat("key", "counted")).alias("k")).groupBy("k").agg(F.count("*").cast("double").alias("n"))
    counted = counted.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(keys)], "n").withColumn("fixed", F.col("fixed").cast("int"))
    gaps = written(counted)
    counted = gaps.where("shape != '<gap>'")
    # rare left tokens are pooled under their shape, rare right tokens under one sign; what is rare
    # grows with the corpus, so the pooled table doesn't
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0.0))).first()[0]
    rare = max(float(min_count), total / tokens)
    often = [F.broadcast(counted.groupBy(c).agg(F.sum("n").alias("of")).where(F.col("of") >= rare).select(c, F.lit(True).alias(f"known_{c}"))) for c in ("left", "right")]
    pooled = (
        counted.join(often[0], "left", "left")
        .join(often[1], "right", "left")
        .withColumn("left", F.when(F.col("known_left"), F.col("left")).otherwise(F.col("shape")))
        .withColumn("right", F.when(F.col("known_right"), F.col("right")).otherwise(F.lit("<other>")))
    )
    rows = pooled.groupBy(*keys).agg(F.sum("n").alias("n")).orderBy(*keys).collect()
    model = train([tuple(r) for r in rows])
    any_gaps = bool(gaps.where("shape = '<gap>'").take(1))
    discard(gaps)
    if any_gaps:
        model = replace(model, **_gap_odds(df, text_col, min_count, tokens))
    return replace(model, steps=_steps(read_, model))


def _gap_counts(text: str, counts: dict[str, Counter]) -> None:
    """Add what stands in a text, begins and ends its sentences: words, and pairs of letters of scripts without spaces."""
    for part in _ENDS.split(text.lower()):
        words = [w for w in _PLAIN.findall(part) if not _is_han(w[0])]
        if words:
            counts["n"].update(("<gap>|words", w) for w in words)
            counts["b"]["<gap>|words", words[0]] += 1
            counts["e"]["<gap>|words", words[-1]] += 1
        runs = [r for r in _HAN_RUN.findall(part) if len(r) > 1]
        if runs:
            counts["n"].update(("<gap>|han", r[i : i + 2]) for r in runs for i in range(len(r) - 1))
            counts["b"]["<gap>|han", runs[0][:2]] += 1
            counts["e"]["<gap>|han", runs[-1][-2:]] += 1


def _gap_odds(df: DataFrame, text_col: str, min_count: int, tokens: int) -> dict:
    """How often words, and pairs of letters of scripts without spaces, begin and end units."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = {k: Counter() for k in "nbe"}

        def out() -> pd.DataFrame:
            rows = [(m, t, float(n), float(counts["b"][m, t]), float(counts["e"][m, t])) for (m, t), n in counts["n"].items()]
            return pd.DataFrame(rows, columns=["mark", "t", "n", "b", "e"])

        for pdf in batches:
            for text in pdf["c"]:
                if text:
                    _gap_counts(text, counts)
                if len(counts["n"]) > 200_000:
                    yield out()
                    for c in counts.values():
                        c.clear()
        yield out()

    counts = spread(df.select(F.col(f"`{text_col}`").alias("c"))).mapInPandas(run, "mark string, t string, n double, b double, e double")
    counts = written(counts.groupBy("mark", "t").agg(*[F.sum(c).alias(c) for c in "nbe"]))
    model: dict[str, dict] = {"begins": {}, "finishes": {}, "gap": {}}
    for mark, n, b, e in counts.groupBy("mark").agg(*[F.sum(c).alias(c) for c in "nbe"]).collect():
        often = counts.where((F.col("mark") == mark) & (F.col("n") >= max(float(min_count), n / tokens))).select("t", "n", "b", "e").collect()
        for side, into, total in (("b", model["begins"], b), ("e", model["finishes"], e)):
            share = min(0.5, total / n)
            base = math.log(share / (1 - share))
            for r in often:
                p = min(1 - 1e-6, (r[side] + 5 * share) / (r.n + 5))
                into[r.t] = math.log(p / (1 - p)) - base
            if side == "b":
                model["gap"][mark] = base
    discard(counts)
    return model


def _steps(read_: DataFrame, model: Model) -> tuple:
    """The transition's factors, re-estimated from the posteriors of all neighbouring events."""

    def setup() -> Callable:
        splitter = Splitter(model)

        def rows(block, key, step) -> Iterator[tuple]:  # noqa: ANN001
            sums = [[0.0, 0.0, 0.0, 0.0] for _ in STEPS]  # pairs, boundary at the first, at the second, at both
            step = step.tolist()
            for i, j, one, both in splitter.blocks(block.tolist(), key.tolist(), step):
                for k in range(i + 1, j):
                    s = sums[step[k]]
                    s[0] += 1
                    s[1] += one[k - i - 1]
                    s[2] += one[k - i]
                    s[3] += both[k - i]
            yield from ((k, *s) for k, s in enumerate(sums) if s[0])

        return rows

    found = map_rows(read_.where("size(block) > 1"), ["block", "key", "step"], "k int, n double, a double, b double, ab double", setup=setup)
    sums = {r.k: r for r in found.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "ab")]).collect()}
    lift = {k: r.ab * r.n / max(r.a * r.b, 1e-9) for k, r in sums.items()}
    out = list(STEPS)
    for k in lift:
        if k < len(STEPS) - 1:  # long units are the measure
            ratio = lift[k] / max(lift.get(len(STEPS) - 1, 1.0), 1e-9)
            out[k] = min(1.0, max(0.02, (ratio * sums[k].n + STEP_PAIRS * STEPS[k]) / (sums[k].n + STEP_PAIRS)))
    return tuple(out)


def sentence_units(df: DataFrame, id_col: str, text_col: str, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """Rows (id, unit_no, start_pos, end_pos): the units of every text, in order.

    Without a ``model`` one is trained on the texts given. Units have no white space at their ends,
    and all other text belongs to exactly one unit.

    Defined cases: NULL, empty and blank texts have no units; a NULL id is kept; repeated rows are
    split each; other columns are not carried, so their names can't clash; an empty table trains an
    empty model, which ends units at line ends only where nothing else is known.
    """
    if model is None:
        read_ = written(readings(df, id_col, text_col))
        model = fit(df, text_col, read_)
    else:
        read_ = readings(df, id_col, text_col)

    def setup() -> Callable:
        splitter = Splitter(model)

        def rows(key, *columns) -> Iterator[tuple]:  # noqa: ANN001
            for k, (a, b) in enumerate(splitter.units(*(c.tolist() for c in columns), threshold)):
                yield key, k, a, b

        return rows

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(read_, ["id", "starts", "ends", "block", "at", "after", "step", "key"], f"{id_col} {kind}, unit_no int, start_pos int, end_pos int", setup=setup)
