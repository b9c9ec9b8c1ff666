"""Column functions over text: normal forms, tokens, windows, cues, edit distance. No Python workers.

All functions return NULL for NULL input unless they say otherwise. Offsets count code points from 0.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode has it, as a class for both Java and RE2 patterns.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SURFACE_EDGE = " ,;:."
_NAME_EDGE = " ,;:"
# Route and frequency words of a prescription, and the units of strengths.
DRUG_NOISE = (
    "po", "iv", "im", "sc", "sl", "pr", "tid", "bid", "qd", "qid", "qhs", "qam", "qpm", "prn", r"q\d+h(?::prn)?", "daily", "twice", "once",
    "uống", "tiêm", "truyền", "lần", "ngày", "viên", "tab", "cap", "caps",
)
UNITS = ("mg", "mcg", "µg", "ug", "g", "ml", "iu", "meq", "mmol")
# Assertion cues.
NEGATION_CUES = (
    "chưa ghi nhận", "không ghi nhận", "chưa phát hiện", "không phát hiện", "không thấy", "chưa thấy", "phủ nhận", "loại trừ",
    "không có", "chưa có", "không bị", "chưa bị", "âm tính", "không", "chưa",
)
HISTORY_CUES = ("tiền sử", "đã từng", "trước đây", "trước đó", "đã được chẩn đoán")
HISTORY_SECTIONS = ("tiền sử", "bệnh sử", "trước khi nhập viện", "trước nhập viện", "thuốc đang dùng trước", "quá trình bệnh lý")
FAMILY_CUES = ("bố", "mẹ", "cha", "anh trai", "chị gái", "ông", "bà", "gia đình", "người thân", "bố mẹ", "con trai", "con gái")
CLAUSE_BREAK = r"[.;:\n]|(?<![\p{L}\p{N}_])(?:nhưng|song|tuy nhiên|còn|mà)(?![\p{L}\p{N}_])"


@functools.cache
def latin_bases() -> tuple[str, str]:
    """Letters with accents and, in step, their base letters, by canonical decomposition."""
    src, dst = [], []
    for code in range(0xC0, 0x3000):
        d = unicodedata.normalize("NFD", chr(code))
        if len(d) > 1 and all(unicodedata.category(c) == "Mn" for c in d[1:]):
            src.append(chr(code))
            dst.append(d[0])
    return "".join(src), "".join(dst)


def bind(value: Column, f) -> Column:  # noqa: ANN001
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def strip_diacritics(c: Column) -> Column:
    """Without accents; small ``đ`` becomes ``d``, capital ``Đ`` stays."""
    src, dst = latin_bases()
    return F.regexp_replace(F.translate(c, src + "đ", dst + "d"), r"\p{Mn}+", "")


def normalize_surface(c: Column) -> Column:
    """Lower case, white space collapsed, without `` ,;:.`` at the ends."""
    return F.lower(F.btrim(F.regexp_replace(c, f"{WS}+", " "), F.lit(_SURFACE_EDGE)))


def normalize_term(c: Column, fold_dstroke: bool = False) -> Column:
    """Case-folded, accentless, all but ``[a-z0-9]`` as single blanks; ``đ`` is a blank unless folded."""
    src, dst = latin_bases()
    x = F.lower(F.replace(c, F.lit("ß"), F.lit("ss")))
    if fold_dstroke:
        x = F.replace(x, F.lit("đ"), F.lit("d"))
    return F.trim(F.regexp_replace(F.regexp_replace(F.translate(x, src, dst), r"\p{Mn}+", ""), "[^a-z0-9]+", " "))


def clean_mention(c: Column, is_drug: Column) -> Column:
    """White space collapsed; of drugs also route and frequency words dropped, decimal commas written as points,
    and one blank before every unit that ends a word, whatever stands before it."""
    x = collapse(c)
    word = "(?<![\\p{L}\\p{N}_])(?:" + "|".join(DRUG_NOISE) + ")(?![\\p{L}\\p{N}_])"
    d = F.regexp_replace(x, "(?iu)" + word, " ")
    d = F.regexp_replace(d, r"(\d),(\d)", "$1.$2")
    d = F.regexp_replace(d, r"(?iu)\s*(" + "|".join(UNITS) + r")(?![\p{L}\p{N}_])", " $1")
    return F.when(is_drug, collapse(d)).otherwise(x)


def tokens(c: Column) -> Column:
    """Distinct words between blanks."""
    return F.array_distinct(F.filter(F.split(c, f"{WS}+"), lambda w: w != ""))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the blank-joined text (blanks as ``_``); a shorter text is its
    own n-gram, an empty one has none."""
    x = F.regexp_replace(c, " ", "_")
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - (n - 1), F.lit(1))), lambda i: F.substring(x, i, F.lit(n)))
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).when(F.length(x) <= n, F.array(x)).otherwise(F.array_distinct(parts))


def jaccard(a: Column, b: Column, both_empty: float) -> Column:
    """Share of the common elements of two sets; two empty sets give ``both_empty``."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(both_empty)).otherwise(F.size(F.array_intersect(a, b)) / union)


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Word edit distance over the reference's length; may exceed 1. An empty reference gives 0 if the
    hypothesis is empty too, else 1. Each distinct word of the two is one sign of an alphabet, so the
    built-in edit distance counts words, however many distinct words there are."""

    def words(c: Column) -> Column:
        return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")

    def utf8(c: Column) -> Column:
        # the sign with the number c, from U+10000 on
        six = lambda k: F.hex(F.lit(128) + F.shiftright(c, k).bitwiseAND(63))
        return F.concat(F.hex(F.lit(240) + F.shiftright(c, 18)), six(12), six(6), six(0))

    def rate(p: Column, both: Column) -> Column:
        def few(ws: Column) -> Column:
            return F.array_join(F.transform(ws, lambda w: F.char(F.array_position(both, w) + 127)), "")

        def many(ws: Column) -> Column:
            return F.decode(F.unhex(F.array_join(F.transform(ws, lambda w: bind(F.array_position(both, w).cast("long") + 65535, utf8)), "")), "UTF-8")

        n = F.size(p["r"])
        distance = F.when(F.size(both) <= 120, F.levenshtein(few(p["r"]), few(p["h"]))).otherwise(F.levenshtein(many(p["r"]), many(p["h"])))
        return F.when((n == 0) & (F.size(p["h"]) == 0), F.lit(0.0)).when(n == 0, F.lit(1.0)).otherwise(distance / n)

    pair = F.struct(words(reference).alias("r"), words(hypothesis).alias("h"))
    general = bind(pair, lambda p: bind(F.array_distinct(F.concat(p["r"], p["h"])), lambda both: rate(p, both)))
    return F.when(reference.isNull() | hypothesis.isNull(), F.lit(None)).when(reference == hypothesis, F.lit(0.0)).otherwise(general)


def dotted_code(c: Column) -> Column:
    """``A001`` as ``A00.1``, upper case; codes of up to three signs and dotted ones stay."""
    x = F.upper(F.trim(c))
    return F.when(x.contains(".") | (F.length(x) <= 3), x).otherwise(F.concat(F.substring(x, 1, 3), F.lit("."), F.substring(x, F.lit(4), F.length(x))))


def clean_name(c: Column) -> Column:
    """Middle dots as blanks, white space collapsed, no `` ,;:`` at the ends."""
    return F.btrim(collapse(F.regexp_replace(c, "・", " ")), F.lit(_NAME_EDGE))


# Fixed value: words of inclusion notes, which are no names.
GUIDANCE = r"(?iu)(?:bao gồm|loại trừ|dùng thêm|sử dụng|xem |mã hóa)"


def who_synonyms(cell: Column, low: int = 4, high: int = 90) -> Column:
    """Names of a synonym cell. A cell that is a number, has reference signs or guidance words gives
    none. Parts stand between line breaks and semicolons; reading stops at the first part that is
    blank, a number or ends in a colon; parts too short or too long are passed over."""
    parts = F.transform(F.split(F.trim(cell), r"[\n;]+"), lambda p: F.btrim(F.btrim(F.regexp_replace(p, f"^{WS}+|{WS}+$", "")), F.lit("+-–— ")))
    stop = F.array_position(F.transform(parts, lambda p: (p == "") | p.rlike(r"^\d+$") | p.endswith(":")), F.lit(True)).cast("int")
    kept = F.when(stop > 0, F.slice(parts, F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(parts)
    none = F.array().cast("array<string>")
    bad = (F.trim(cell) == "") | F.trim(cell).rlike(r"^\d+$") | cell.rlike(r"[†*(]") | cell.rlike(GUIDANCE)
    return F.when(cell.isNull() | bad, none).otherwise(F.filter(kept, lambda p: F.length(p).between(low, high)))


def window_before(text: Column, start: Column, width: int) -> Column:
    """Up to ``width`` characters before ``start``, not beyond the line's begin, in lower case."""
    begin = F.greatest(start - width, F.lit(0))
    return F.lower(F.substring_index(F.substring(text, begin + 1, start - begin), "\n", -1))


def cue_in_scope(window: Column, cues: tuple[str, ...]) -> Column:
    """True if behind the last occurrence of some cue no clause breaks off."""
    found = [window.contains(c) & ~F.substring_index(window, c, -1).rlike(CLAUSE_BREAK) for c in cues]
    return functools.reduce(lambda a, b: a | b, found)


def section_lines(text: Column, start: Column, lookback: int = 400, lines: int = 4) -> Column:
    """The last ``lines`` lines of the ``lookback`` characters before ``start``, in lower case."""
    begin = F.greatest(start - lookback, F.lit(0))
    all_lines = F.split(F.lower(F.substring(text, begin + 1, start - begin)), "\n")
    return F.slice(all_lines, F.greatest(F.size(all_lines) - lines + 1, F.lit(1)), F.lit(lines))


def detect_assertions(text: Column, start: Column, assertable: Column, sections: bool = False, family: bool = False) -> Column:
    """``isNegated``, ``isHistorical``, ``isFamily`` by the cues before a mention, in that order."""
    history = cue_in_scope(window_before(text, start, 60), HISTORY_CUES)
    if sections:
        history = history | F.exists(section_lines(text, start), lambda s: functools.reduce(lambda a, b: a | b, [s.contains(h) for h in HISTORY_SECTIONS]))
    out = [
        F.when(cue_in_scope(window_before(text, start, 40), NEGATION_CUES), F.lit("isNegated")),
        F.when(history, F.lit("isHistorical")),
    ]
    if family:
        out.append(F.when(cue_in_scope(window_before(text, start, 50), FAMILY_CUES), F.lit("isFamily")))
    return F.when(assertable, F.array_compact(F.array(*out))).otherwise(F.array().cast("array<string>"))


def context_slice(text: Column, start: Column, end: Column, width: int = 240) -> Column:
    """The mention with ``width`` characters on either side."""
    begin = F.greatest(start - width, F.lit(0))
    return F.substring(text, begin + 1, end + width - begin)


def chunks(text: Column, max_chars: int = 800) -> Column:
    """Verbatim pieces (offset, chunk) of at most ``max_chars``: cut behind the last line break of the
    window if there is one, else at its end. An empty text is one empty piece."""
    piece = "struct<offset:int,chunk:string>"

    def advance(acc: Column, _i: Column) -> Column:
        rest = F.substring(text, acc["pos"] + 1, F.lit(max_chars))
        back = F.locate("\n", F.reverse(rest))
        # a line break that begins the window doesn't end a piece
        ends = (back > 0) & (F.length(rest) - back > 0)
        size = F.when((F.length(text) - acc["pos"] > max_chars) & ends, F.length(rest) - back + 1).otherwise(F.length(rest))
        more = F.struct(acc["pos"].alias("offset"), F.substring(text, acc["pos"] + 1, size).alias("chunk"))
        return F.when(acc["pos"] >= F.length(text), acc).otherwise(F.struct((acc["pos"] + size).cast("int").alias("pos"), F.array_append(acc["out"], more).alias("out")))

    # a piece and the next together exceed the window, so twice the even number of steps suffices
    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.length(text) * 2 / max_chars).cast("int") + 2, F.lit(1)))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{piece}>").alias("out"))
    done = F.aggregate(steps, start, advance)["out"]
    return F.when(F.length(text) == 0, F.array(F.struct(F.lit(0).alias("offset"), F.lit("").alias("chunk")))).otherwise(done)


def line_context(text: Column, start: Column, end: Column, line_chars: int = 300, hint_chars: int = 80) -> Column:
    """The mention's line up to ``line_chars``, behind the nearest line before it that isn't blank."""
    behind = F.substring_index(F.substring(text, end + 1, F.length(text)), "\n", 1)

    def joined(above: Column) -> Column:
        line = F.substring(F.concat(F.element_at(above, -1), F.substring(text, start + 1, end - start), behind), 1, line_chars)
        earlier = F.filter(F.slice(above, F.lit(1), F.size(above) - 1), lambda x: x.rlike(r"(?U)\S"))
        last = F.try_element_at(earlier, F.lit(-1))
        return bind(F.regexp_replace(last, f"^{WS}+|{WS}+$", ""), lambda h: F.when(h.isNotNull(), F.concat(F.lit("[mục: "), F.substring(h, 1, hint_chars), F.lit("] "), line)).otherwise(line))

    return bind(F.split(F.substring(text, F.lit(1), start), "\n"), joined)


def cache_key(parts: list[Column], length: int = 24) -> Column:
    """The first signs of the SHA-256 of the parts joined by line breaks."""
    return F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, length)


def score_text(c: Column) -> Column:
    """A share as per cent with four decimals."""
    return F.format_string("%.4f", c * 100)


def argmax_margin(logits: Column) -> Column:
    """(label, margin): the first position of the greatest value, and its lead over the last value
    among all but the last."""
    head = F.slice(logits, F.lit(1), F.size(logits) - 1)
    return F.struct(
        (F.array_position(logits, F.array_max(logits)) - 1).cast("int").alias("label"),
        (F.array_max(head) - F.element_at(logits, -1)).alias("margin"),
    )


def group_score(logits: Column) -> Column:
    """Log of the summed exponentials of a group; -1e9 for an empty group."""
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return F.when(F.size(logits) == 0, F.lit(-1e9)).otherwise(top + F.log(total))


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
