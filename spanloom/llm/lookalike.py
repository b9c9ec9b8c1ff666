"""Visually identical text brought to one consistent form (problem 3).

Look-alike strings and code points are joined into classes by union-find, so that likeness is
transitive: a full-width Cyrillic-like letter ends up with the plain Latin one. Each class is
represented by its most frequent ordinary member in the data at hand, and texts are rewritten
greedily, longest pattern first, by an automaton of all other members.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import INVISIBLE, char_class, map_rows

# Letters of other scripts, or rare Latin letters, and the Latin letter each looks like.
_LOOKS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ο": "o", "ν": "v",
    "ϲ": "c", "ϳ": "j", "ɡ": "g", "ɑ": "a", "ı": "i", "ⅼ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "Ԍ": "G",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "Ɖ": "Đ", "Ð": "Đ", "‐": "-",
    "ρ": "p", "ι": "i", "κ": "k", "ɩ": "i", "ҽ": "e", "ꜱ": "s", "ⲟ": "o", "ⲣ": "p", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ᴜ": "u",
    "ʏ": "y", "գ": "q", "ց": "g", "զ": "q", "ռ": "n", "յ": "j", "Տ": "S", "Օ": "O", "Լ": "L", "Ս": "U",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R",
    "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L", "ꓟ": "M",
    "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
}
# Small Greek letters that are signs where they stand alone.
_SIGNS = "ρκι"
#: Kinds of compatibility variants that look like what they stand for; superscripts, circled
#: signs, fractions and the like look different.
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>")
#: Marks that shape a letter stand before marks of tone.
_SHAPES, _TONES = "̛̂̆", "̀́̃̉̇"


def _odd_spaces() -> list[str]:
    return [chr(c) for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs"]


@functools.cache
def edges() -> list[tuple[str, str]]:
    """Pairs of strings that look alike, in decomposed form, from rules and the fixed table."""
    out = [(c, "") for c in map(chr, INVISIBLE)]
    out += [(c, " ") for c in _odd_spaces()]
    out += list(_LOOKS.items())
    for code in [*range(0xA0, 0x3400), *range(0xA000, 0xD7A4), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]:
        c = chr(code)
        d = unicodedata.decomposition(c)
        if d.startswith(_SAME_LOOK) or 0xFB00 <= code <= 0xFB06 or 0x2160 <= code <= 0x217F:
            out.append((c, unicodedata.normalize("NFKD", c)))
    out += [(t + s, s + t) for s in _SHAPES for t in _TONES]
    return out


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def root(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: str, y: str) -> None:
        self.up[self.root(x)] = self.root(y)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.up:
            out.setdefault(self.root(x), []).append(x)
        return out


def _ordinary(x: str) -> bool:
    """True if ``x`` may represent its class: visible, of ordinary width, marks in order."""
    return x in ("", " ") or (
        not any(ord(c) in INVISIBLE or unicodedata.decomposition(c).startswith("<") or unicodedata.category(c) == "Zs" for c in x)
        and not (len(x) == 2 and x[0] in _TONES and x[1] in _SHAPES)
    )


def rewriting(counts: dict[str, int]) -> dict[str, str]:
    """Every member of a look-alike class that isn't its representative -> the representative.

    ``counts`` has the frequency of code points in the data. Of the ordinary members the most
    frequent is taken; if they are equally frequent, one that stands in for no other, and the one
    of lowest code point.
    """
    classes = Classes()
    for a, b in edges():
        classes.join(a, b)
    out = {}
    for members in classes.members().values():
        plain = [m for m in members if _ordinary(m)] or [min(members)]
        best = min(plain, key=lambda m: (m != "" and m != " ", -min((counts.get(c, 0) for c in m), default=0), m in _LOOKS, m))
        out |= {m: best for m in members if m != best}
    return out


_NATIVE = re.compile(r"[^\W\d_]+")


def _script(c: str) -> str:
    o = ord(c)
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "greek"
    if 0x400 <= o < 0x530:
        return "cyrillic"
    if 0x530 <= o < 0x590:
        return "armenian"
    if 0x13A0 <= o < 0x1400:
        return "cherokee"
    if 0xA4D0 <= o < 0xA500:
        return "lisu"
    if 0x2C80 <= o < 0x2D00:
        return "coptic"
    return "other" if o > 0x250 and o not in (0x251, 0x261) and not 0x1E00 <= o < 0x1F00 and not 0xFF00 <= o < 0xFFF0 else "latin"


class Rewriter:
    """Rewrites texts to the consistent form; built once per worker from the rewriting table."""

    def __init__(self, table: Iterable[tuple[str, str]]) -> None:
        import ahocorasick

        self.table = dict(table)
        self.automaton = ahocorasick.Automaton()
        for a, b in self.table.items():
            self.automaton.add_word(a, (a, b))
        self.automaton.make_automaton()
        # composed letters of other scripts hide their base letter
        signs = sorted({ord(a) for a in self.table if len(a) == 1} | {c for a, b in ((0x300, 0x370), (0x386, 0x3CF), (0x1F00, 0x2000), (0x400, 0x530)) for c in range(a, b)})
        self.suspect = re.compile(f"[{char_class(signs)}]")
        # the engine looks up at once among the signs of the first plane
        self.plane = re.compile(f"[{char_class([c for c in signs if c < 0x10000])}]")
        self.alike = {a for a in self.table if len(a) == 1 and a.isalpha()}
        self.hidden = {ord(a): None for a, b in self.table.items() if b == ""}

    def _kept(self, text: str) -> set[int]:
        """Positions of letters in words that are wholly of another script."""
        out: set[int] = set()
        for m in re.finditer(r"[^\W_](?:[^\W_]|[̀-ͯ])*", text):
            word = m.group()
            letters = [c for c in word if c.isalpha()]
            scripts = {_script(c) for c in letters}
            if len(scripts) != 1 or scripts <= {"latin", "other"}:
                continue
            # a whole word of look-alikes stands in for a Latin one, unless it is a lone capital
            # sign; a word with a letter of its own is a word of its script
            own = any(c not in self.alike for c in letters)
            sign = len(letters) == 1 and scripts == {"greek"} and (letters[0].isupper() or letters[0] in _SIGNS)
            if own or (sign and not re.search("[̀-ͯ]", word)):
                out.update(i for i in range(m.start(), m.end()) if _script(text[i]) in scripts or unicodedata.combining(text[i]))
        return out

    def rewrite(self, text: str) -> str:
        if text.isascii():
            return text
        suspect = self.plane if max(text) < "\U00010000" else self.suspect
        if not suspect.search(text) and unicodedata.is_normalized("NFC", text):
            return text
        text = unicodedata.normalize("NFD", text.translate(self.hidden))
        kept = self._kept(text)
        out, at = [], 0
        for end, (a, b) in self.automaton.iter_long(text):
            start = end - len(a) + 1
            if start < at or start in kept:
                continue
            out += [text[at:start], b]
            at = end + 1
        return unicodedata.normalize("NFC", "".join([*out, text[at:]]))


def code_point_counts(texts: DataFrame) -> dict[str, int]:
    """Occurrences of each code point over a single string column; at most one row per code point."""
    c = F.col(texts.columns[0])
    rows = texts.where(c.isNotNull()).select(F.explode(F.split(c, "")).alias("c")).groupBy("c").count().collect()
    return {r["c"]: r["count"] for r in rows if r["c"]}


def learn(texts: DataFrame) -> tuple[tuple[str, str], ...]:
    """The rewriting table for the data: classes of look-alikes with their representatives."""
    return tuple(sorted(rewriting(code_point_counts(texts)).items()))


@functools.cache
def _composing() -> list[int]:
    """Code points that composition may change: marks, what isn't composed itself, conjoining letters,
    and composed letters whose base may have a look-alike."""
    out = []
    for code in (*range(0x80, 0xD800), *range(0xF900, 0x30000)):
        c = chr(code)
        if unicodedata.category(c)[0] == "M" or not unicodedata.is_normalized("NFC", c) or 0x1100 <= code < 0x1200:
            out.append(code)
        elif code > 0x250 and not 0x1E00 <= code < 0x1F00 and not 0xAC00 <= code < 0xD7A4 and unicodedata.decomposition(c)[:1] not in ("", "<"):
            out.append(code)
    return out


def may_differ(text: Column, table: tuple[tuple[str, str], ...]) -> Column:
    """False for texts that are certainly consistent already; evaluated without Python."""
    changing = {ord(a) for a, _ in table if len(a) == 1} | set(_composing())
    # most texts consist of plain and accented Latin letters, which few ranges tell
    plain = [c for c in (*range(1, 0x250), *range(0x1E00, 0x1F00)) if c not in changing]

    def cls(codes: list[int]) -> str:
        return re.sub(r"\\U([0-9a-f]{8})", r"\\x{\1}", char_class(codes))

    return text.rlike(f"[^{cls(plain)}]") & text.rlike(f"[{cls(sorted(changing))}]")


def to_consistent(df: DataFrame, key_col: str, text_col: str, table: tuple[tuple[str, str], ...], changed_only: bool = False) -> DataFrame:
    """Rows (key, text, consistent): each text with its consistent form.

    Accents are composed, signs of other width, odd spaces and letters of another script that
    stand in for a look-alike are replaced by their class' representative, invisible characters
    are dropped. Words wholly in another script, signs that look different, letter case, spelling
    and plain spaces stay. The function is idempotent.

    With ``changed_only`` only the texts that differ from their consistent form are returned, and
    only those that may differ travel to the Python workers.

    Defined cases: NULL stays NULL (and isn't changed); an empty text is consistent; keys may be
    NULL or repeated, every row is returned once; other columns are not carried.
    """
    if changed_only:
        df = df.where(may_differ(F.col(f"`{text_col}`"), table))

    def setup() -> Callable:
        rewriter = Rewriter(table)

        def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
            new = None if text is None else rewriter.rewrite(text)
            if not changed_only or new != text:
                yield key, text, new

        return rows

    kind = df.schema[key_col].dataType.simpleString()
    return map_rows(df, [key_col, text_col], f"{key_col} {kind}, text string, consistent string", setup=setup)
