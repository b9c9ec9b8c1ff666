"""Personal information found in free text and replaced by typed placeholders (problem 1).

Offset-preserving deobfuscation. Three transducers read the text one after another, and each keeps for
what it writes the stretch of its input that it came from: look-alike letters, odd widths, decomposed
accents and invisible signs become ordinary letters; numbers spelled in words, wholly or in part, and
letters that stand in for digits become digits; disguises of "at" and "dot" become signs. One set of
detectors finds identifiers on the last tape, and their spans are mapped back through all three to
the source.

Names are found by the titles and phrases around them, and, without any of these, by a model of name
parts: how much oftener a word in capitals stood in a name found by its title than elsewhere, over all
texts. One pass reads the texts, finds all that needs no model and writes it with the runs of capitals
that may be names; the model, counted from what was written, then decides about those runs.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import INVISIBLE, bare_text, char_class, map_rows
from spanloom.llm.lookalike import rewriting
from spanloom.plans.runtime import written

KINDS = ("EMAIL", "PHONE", "ID", "ADDRESS", "NAME")

#: Characters before an address or name, and before a number, that its caption may take.
CAPTION, NUMBER_CAPTION = 40, 60
#: Least score of a name that nothing but its words tells, and what a word adds that was in no name.
NAME_SCORE, UNKNOWN_PART = 2.0, -0.5

# The words that detectors go by, in composed accented lower case.
_DIGIT_WORDS = {
    "không": "0", "một": "1", "mốt": "1", "hai": "2", "ba": "3", "bốn": "4", "tư": "4", "năm": "5", "lăm": "5", "sáu": "6",
    "bảy": "7", "bẩy": "7", "tám": "8", "chín": "9",
}
_SURNAMES = (
    "nguyễn trần lê phạm hoàng huỳnh phan vũ võ đặng bùi đỗ hồ ngô dương lý khương quách thái vương đinh đoàn trịnh trương mai "
    "đào cao hà lưu lương tạ tô tăng chu châu kiều lâm mạc nghiêm ông phùng quan thạch tống triệu từ văn viên vi doãn giang hứa"
).split()
_TITLES = (
    "bệnh nhân", "tên bệnh nhân", "bn", "họ tên", "họ và tên", "người bệnh", "người nhà", "ông", "bà", "anh", "chị", "cô", "chú",
    "bác", "cậu", "dì", "cháu", "bé", "em", "con", "vợ", "chồng", "tên", "tên là", "bs", "bác sĩ", "bác sĩ điều trị", "bsck1", "bsck2", "bscki",
    "bsckii", "ths", "ts", "gs", "pgs", "ths.bs", "ts.bs", "pgs.ts", "gs.ts", "điều dưỡng", "đd", "ktv", "người lập phiếu", "hộ lý", "y tá",
    "mr", "mrs", "ms", "dr", "prof",
)
#: Titles after which also a lone or foreign name in capitals is taken, but no sentence goes on.
_NOT_NAMES = set(
    "ấy này đó kia nhà nữ nam tôi ta mình em anh chị bị có là và đã đang được đi đến vào về từ ở theo nói gọi kể khai xác nhận ký bàn giao tỉnh "
    "cho của với không hay thấy hiện nên cần mới vẫn còn sẽ do để khi nếu thì mà tại trong ngoài trên dưới sau trước lúc ngày tháng năm tuổi "
    "bệnh nhân viện sơ tính lời tên họ số cùng ra uống dùng cũng bỏ nhập khám điều trị chẩn đoán tiền gia đình mẹ bố cha con cháu bé ông bà cô "
    "chú bác vợ chồng người xuất đau sốt ho khó mệt ăn ngủ gửi xem tái phủ chưa nặng nhẹ tự đưa kèm thuốc hội chứng độ cấp mạn".split()
)
_AFTER_NAME = r"(?:đã|đi|ký|bàn giao|vào|được|xác nhận|nói|gọi|khai)"
_SLIP = r"(?:phiếu(?:\s+xét\s+nghiệm)?|bệnh\s+án|hồ\s+sơ|bệnh\s+phẩm|mẫu|sê-?ri|serial|máy(?:\s+đo)?|lô(?:\s+thuốc)?|mã(?:\s+\S+)?|hóa\s+đơn|xét\s+nghiệm)"
_CARD = (
    r"(?:cccd|cmnd|cmtnd|cmt|căn\s+cước(?:\s+công\s+dân)?|chứng\s+minh(?:\s+(?:thư|nhân\s+dân))?|giấy\s+tờ(?:\s+tùy\s+thân)?|(?:số\s+)?định\s+danh|"
    r"thẻ\s+bhyt|thẻ\s+bảo\s+hiểm(?:\s+y\s+tế)?|bhyt|thẻ|hộ\s+chiếu|passport)"
)

_LINK = r"[ \t]*(?:số)?[ \t]*[:#.]?[ \t]*(?:số)?[ \t]*"
_GAP = r"[ .\-]?"
_INSURANCE = rf"[A-Z]{{2}}[ \-]?\d[ \-]?\d{{2}}[ \-]?\d{{3}}{_GAP}\d{{3}}{_GAP}\d{{4}}"
_PASSPORT = r"[A-Z][ \-]?\d{7}"
_CITIZEN = rf"\d{{3}}{_GAP}\d{{3}}{_GAP}\d{{3}}(?:{_GAP}\d{{3}})?"
_ID = re.compile(rf"(?i:(?<!\w){_CARD}{_LINK})(?P<id>{_INSURANCE}|(?:{_CITIZEN})(?!{_GAP}\d)|{_PASSPORT})(?!\w)")
_BARE_CARD = re.compile(rf"(?<!\w)(?P<id>{_INSURANCE})(?!\w)")
_PHONE = re.compile(
    r"(?<![\w.,/+\-])(?<!\d )(?:(?:\(\+84\)|\+84|0084|\(0\d{1,4}\)|0)(?:[ .\-]?\d){6,11}|\+(?!84)[1-9]\d{0,2}(?:[ .\-]?\(?\d{1,4}\)?){2,6})(?![\w/]|[.,\-]\d)"
)
_SLIP_BEFORE = re.compile(rf"(?i)(?<!\w)(?:{_SLIP}|{_CARD})(?:\s+số)?\s*[:#]?\s*(?:số)?\s*(?:[A-Z]{{1,3}}-?)?$")

# Letters that stand in for digits.
_DIGIT_LETTERS = {"O": "0", "o": "0", "l": "1", "I": "1"}
_SPELT = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_UNIT = re.compile(rf"(?i)\d+|{_SPELT}")
#: Digit words, and numerals among them, one after another.
_SPELLED = re.compile(rf"(?i)(?<!\w)(?=[khmbtnlsc\d])(?:\d{{1,4}}[ .,\-]+)*(?:{_SPELT})(?!\w)(?:[ .,\-]+(?:(?:{_SPELT})|\d{{1,4}})(?!\w)){{2,}}")
_SPELT_PAIR = re.compile(rf"(?i)(?<!\w)(?=[khmbtnlsc])(?:{_SPELT})[ .,\-]+(?:{_SPELT}|\d)")
_STAND_IN = re.compile(r"\d[OolI]|[OolI]\d")
_MIXED = re.compile(r"(?<![\w+])\+?[\dOolI](?:[ .\-]?[\dOolI]){7,13}(?!\w)")

_AT = r"(?:[ \t]*(?:@|[(\[{][ \t]*(?:at|a còng)[ \t]*[)\]}])[ \t]*|[ \t]+(?:a[ \t]*(?:còng|móc)|at)[ \t]+)"
_DOT = r"(?:\.|[ \t]*[(\[{][ \t]*(?:dot|chấm)[ \t]*[)\]}][ \t]*|[ \t]+(?:chấm|dot)[ \t]+)"
_LABEL = r"[a-z0-9](?:[a-z0-9_\-]*[a-z0-9])?"
_LOCAL = rf"(?<![\w.+\-])[a-z0-9][a-z0-9_+\-]*(?:{_DOT}[a-z0-9_+\-]+)*"
_DISGUISED = re.compile(rf"(?i){_LOCAL}{_AT}{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[a-z]{{2,}}(?![\w@])")
_AT_CUE = re.compile(r"(?i)@|a[ \t]*(?:còng|móc)|[ \t(\[{]at[ \t)\]}]")
_SIGN_WORDS = re.compile(rf"(?i)(?P<at>{_AT})|(?P<dot>{_DOT})")
_EMAIL = re.compile(rf"(?i)(?<![\w.+\-])[a-z0-9][a-z0-9_+\-]*(?:\.[a-z0-9_+\-]+)*@{_LABEL}(?:\.{_LABEL})*\.[a-z]{{2,}}(?![\w@])")

_UP = r"[A-ZÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝĂĐĨŨƠƯẠ-Ỹ]"
_WORD = r"[^\W\d_]+"
_PLACE_WORDS = r"(?:đường|duong|phố|pho|phường|phuong|xã|xa|thị trấn|thi tran|quận|quan|huyện|huyen|thị xã|thành phố|thanh pho|tỉnh|tinh|ấp|ap|thôn|thon|khu phố|khu|chung cư|chung cu|tòa|tổ|to|kp\.?|tp\.?|tx\.?|tt\.?|p\.|q\.|h\.|x\.)"
#: The first part of an address: a number with the word for it, or a house number before a street.
_FIRST = (
    rf"(?:(?i:số(?:\s+nhà)?|so(?:\s+nha)?|nhà\s+số|ngõ|ngo|ngách|ngach|hẻm|hem|kiệt|kiet|tổ|to|đội|căn\s+hộ|can\s+ho|phòng|lô|thôn|xóm)\s+(?:số\s+)?[A-Z]?\d+[A-Z]?(?:[./\-]\d+)*[A-Z]?|(?<![\w./\-,])\d{{1,4}}[A-Z]?(?:/\d+)*[A-Z]?)"
)
_NAMEPART = rf"(?:\d{{1,2}}[ ]+)?{_UP}[\w'’]*(?:[ ]+{_UP}[\w'’]*){{0,4}}"
_LOOSE = r"(?:\d{1,2}[ ]+)?[^\W\d_]+(?:[ ]+[^\W\d_]+){0,4}"
_STEP = r"(?:,[ ]*|[ ]+-[ ]+|[ ]*–[ ]*)"


def _address(part: str) -> re.Pattern:
    kind = rf"(?i:{_PLACE_WORDS})[ ]*"
    place = rf"(?:{kind}(?:{part}|\d{{1,2}}(?!\w))|{part})"
    unit = r"(?!(?i:mgs?|mcg|ml|g|iu|iv|po|tab|viên|lần|ngày|giờ|tuổi|tuần|tháng|năm|độ|phút|cm|mm)\b)"
    street = rf"(?:[ ]*,?[ ]+(?i:đường|duong|phố|pho|chung cư|chung cu|ấp|ap|khu phố|thôn)[ ]+{part}|[ ]+{unit}{part})"
    return re.compile(rf"(?<!\w){_FIRST}(?:{street})(?:{_STEP}{place}){{1,5}}(?!\w)")


_ADDRESS = _address(_NAMEPART)
_ADDRESS_LOOSE = _address(_LOOSE)
_PLACE_MARK = re.compile(rf"(?i),[ ]*{_PLACE_WORDS}[ ]*\w|(?:[ ]-[ ][^,]+){{2}}")
_CUES = "địa chỉ|ngụ tại|ngụ|trú tại|thường trú|tạm trú|sống tại|nhà ở|ở|tới từ|đến từ|từ"
_ADDRESS_CUE = re.compile(rf"(?i)(?:{_CUES})[ :]*$")
_ADDRESS_WORD = re.compile(rf"(?i)(?:{_CUES})[ :]*(?=\S)")
_NO_PLACE = re.compile(r"(?i)(?:bệnh viện|phòng khám|trung tâm|trạm y tế|khoa|viện)[^.,;\n]*$")

def _either(phrases: Iterable[str]) -> str:
    """A pattern of phrases, longest first, that looks at common beginnings once; blanks may be any white space."""
    tails: dict[str, list[str]] = {}
    for p in phrases:
        tails.setdefault(p[:1], []).append(p[1:])
    if list(tails) == [""]:
        return ""
    parts = [(r"\s+" if c == " " else re.escape(c)) + _either(tails[c]) for c in tails if c]
    inner = "(?:" + "|".join(parts) + ")"
    return inner + "?" if "" in tails else inner


_TITLE = re.compile(rf"(?<![\w+/=]){_either(_TITLES)}(?:\.[ \t]*|[ \t]*[:(][ \t]*|[ \t]+)(?=[^\W\d_])")
_SHORT_TITLES = {"bn", "bs", "bsck1", "bsck2", "bscki", "bsckii", "ths", "ts", "gs", "pgs", "ths.bs", "ts.bs", "pgs.ts", "gs.ts", "đd", "ktv", "mr", "mrs", "ms", "dr", "prof"}
_INITIALS = re.compile(rf"(?:{_UP}\.[ ]?){{1,4}}[ ]?{_UP}[^\W\d_]*")
_CAPITAL = re.compile(rf"(?<!\w){_UP}[^\W\d_]*")
_CAPITALS = re.compile(rf"(?<![\w.]){_UP}[^\W\d_]+(?: {_UP}[^\W\d_]*){{1,4}}(?!\w)")
#: What bears a person's name without being one.
_OTHER_NAME = re.compile(r"(?i)(?:đường|phố|phường|quận|xã|thôn|ấp|tỉnh|thành phố|tp\.?|bệnh viện|bv\.?|phòng khám|trường|hội chứng|bệnh|thuốc|trung tâm|trạm y tế|viện|khoa|công ty|dấu hiệu|nghiệm pháp|thang điểm|phương pháp)[ ]+(?:[^\W\d_]+ ){0,2}$")
_TOKEN = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_SIGNATURES = ("đã ký", "ký tên", "bàn giao ca", "đi cùng", "được mẹ")
_SIGNED = re.compile(rf"(?m)(?:^|[.!?;:][ \t]+|[-•+*–][ \t]+)(?P<n>[^\W\d_][^\n.!?,;:()/]{{2,40}}?)[ ]+(?:{'|'.join(_SIGNATURES)})")
_SUR = set(_SURNAMES)
_SUR_BARE = {bare_text(s) for s in _SURNAMES}


class Tape:
    """A text written by a transducer, with the stretch of its input that each part came from."""

    def __init__(self, text: str, before: Tape | None = None, parts: list[tuple[int, int, int, int]] | None = None) -> None:
        #: (start, end) on this tape and on the one before, of rewritten parts only, in order.
        self.text, self.before, self.parts = text, before, parts or []
        self.starts = [p[0] for p in self.parts]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """The tape after disjoint edits ``(start, end, new text)``, in order."""
        if not edits:
            return self
        out, parts, at, n = [], [], 0, 0
        for start, end, new in edits:
            out += [self.text[at:start], new]
            n += start - at
            parts.append((n, n + len(new), start, end))
            n += len(new)
            at = end
        out.append(self.text[at:])
        return Tape("".join(out), self, parts)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The span of the source for a span of this tape that isn't empty."""
        if self.before is None:
            return start, end
        return self.before.back(self._place(start, 0), self._place(end - 1, 1))

    def _place(self, i: int, side: int) -> int:
        """Where the sign at ``i`` begins (side 0) or ends (side 1) on the tape before."""
        k = bisect.bisect_right(self.starts, i) - 1
        while k >= 0 and self.parts[k][1] == self.parts[k][0]:  # what was dropped left nothing
            if self.parts[k][1] <= i:
                break
            k -= 1
        if k < 0:
            return i + side
        _, end, first, last = self.parts[k]
        if i < end:
            return (first, last)[side]
        return last + (i - end) + side


def plain_letters(text: str) -> Tape:
    """The first transducer: look-alikes, widths, accents and invisible signs."""
    source = Tape(text)
    if text.isascii():
        return source
    looks, all_signs, plane = _alike()
    suspect = plane if max(text) < "\U00010000" else all_signs
    edits: list[tuple[int, int, str]] = []
    n, done = len(text), 0
    for m in suspect.finditer(text):
        i = m.start()
        if i < done:
            continue
        c = text[i]
        if unicodedata.combining(c) and i > done:
            i -= 1  # a mark belongs to the letter before
            c = text[i]
        if ord(c) in INVISIBLE:
            edits.append((i, i + 1, ""))
            done = i + 1
            continue
        j, end, marks = i + 1, i + 1, ""
        while j < n and (unicodedata.combining(text[j]) or (ord(text[j]) in INVISIBLE and j + 1 < n and unicodedata.combining(text[j + 1]))):
            if ord(text[j]) not in INVISIBLE:
                marks += text[j]
                end = j + 1
            j += 1
        base = looks.get(c, c)
        new = unicodedata.normalize("NFC", _ordered(base, marks)) if marks or base != c or not unicodedata.is_normalized("NFC", c) else c
        done = j
        if new != text[i:end]:
            edits.append((i, end, new))
    return source.rewrite(edits)


def plain_digits(tape: Tape) -> Tape:
    """The second transducer: numbers of seven digits and more, in words or with letters for digits."""
    text, edits = tape.text, []
    for m in _SPELLED.finditer(text) if _SPELT_PAIR.search(text) else ():
        parts = [(w.start(), w.end(), w.group()) for w in _UNIT.finditer(text, m.start(), m.end())]
        if sum(1 if not w[0].isdigit() else len(w) for _, _, w in parts) < 7:
            continue
        at = None
        for start, end, word in parts:
            if at is not None:
                edits.append((at, start, ""))
            if not word[0].isdigit():
                edits.append((start, end, _DIGIT_WORDS[word.lower()]))
            at = end
    if _STAND_IN.search(text):
        taken = {(a, b) for a, b, _ in edits}
        for m in _MIXED.finditer(text):
            if sum(c.isdigit() for c in m.group()) >= 6 and not any(a < m.end() and m.start() < b for a, b in taken):
                edits += [(i, i + 1, _DIGIT_LETTERS[text[i]]) for i in range(m.start(), m.end()) if text[i] in _DIGIT_LETTERS]
    return tape.rewrite(sorted(edits))


def plain_signs(tape: Tape) -> Tape:
    """The third transducer: disguises of "at" and "dot" within an e-mail address."""
    text, edits, done = tape.text, [], -1
    for cue in _AT_CUE.finditer(text):
        # an address stands in one line
        first, last = text.rfind("\n", 0, cue.start()) + 1, text.find("\n", cue.end())
        if first <= done:
            continue
        done = len(text) if last < 0 else last
        for m in _DISGUISED.finditer(text, first, done):
            edits += [(x.start(), x.end(), "@" if x.lastgroup == "at" else ".") for x in _SIGN_WORDS.finditer(text, m.start(), m.end()) if x.group() not in "@."]
    return tape.rewrite(edits)


def _ordered(base: str, marks: str) -> str:
    text = unicodedata.normalize("NFD", base + marks)
    shapes = "".join(c for c in text[1:] if c in "̛̂̆")
    return text[0] + shapes + "".join(c for c in text[1:] if c not in "̛̂̆") if text else ""


@functools.cache
def _alike() -> tuple[dict[str, str], re.Pattern, re.Pattern]:
    table = {a: b for a, b in rewriting({}).items() if len(a) == 1}
    # letters of other scripts that carry accents: their base letter has a look-alike
    for code in [*range(0x386, 0x3CF), *range(0x400, 0x530), *range(0x1F00, 0x2000)]:
        d = unicodedata.normalize("NFD", chr(code))
        if len(d) > 1 and d[0] in table:
            table[chr(code)] = unicodedata.normalize("NFC", table[d[0]] + d[1:])
    signs = sorted({ord(c) for c in table} | set(INVISIBLE) | set(range(0x300, 0x370)))
    # the second pattern has the signs of the first plane only, among which the engine looks up at once
    return table, re.compile(f"[{char_class(signs)}]"), re.compile(f"[{char_class([c for c in signs if c < 0x10000])}]")


def _names(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if len(low) != len(text):  # some capitals have two small letters
        low = "".join([c.lower() if len(c.lower()) == 1 else c for c in text])
    for m in _TITLE.finditer(low):
        asked = text[m.start() : m.end()]
        title = re.sub(r"[\s:(.]+$", "", m.group().lower())
        title = re.sub(r"\s+", " ", title)
        if "\n" in m.group() or (m.group().rstrip().endswith(".") and title not in _SHORT_TITLES):
            continue
        at = m.end()
        while (inner := _TITLE.match(low, at)) and "\n" not in inner.group():
            at = inner.end()  # "con gái là chị", "ThS. BS"
        # in running capitals a title may be part of any phrase
        shouted = asked[0].isupper() and len(title) > 1 and asked.rstrip(" :(.").isupper() and title not in ("bn", "bs", "đd", "ktv")
        span = _name_at(text, at, weak=shouted or title in ("em", "con", "tên", "người nhà", "bác", "ts", "ms") and "(" not in m.group(), shouted=shouted)
        if span:
            yield span
    lines = {text.rfind("\n", 0, i) + 1 for cue in _SIGNATURES for i in _places(text, cue)}
    for m in (m for at in sorted(lines) for m in _SIGNED.finditer(text, at, (text + "\n").index("\n", at))):
        span = _name_at(text, m.start("n"), weak=False)
        if span and span[1] == m.end("n"):
            yield span


def _places(text: str, part: str) -> Iterator[int]:
    i = text.find(part)
    while i >= 0:
        yield i
        i = text.find(part, i + 1)


def _name_at(text: str, at: int, weak: bool, shouted: bool = False) -> tuple[int, int] | None:
    m = _INITIALS.match(text, at)
    if m:
        end = m.end()
        # a further given name may follow the one behind the initials
        more = re.compile(rf"[ ]{_UP}[^\W\d_]*").match(text, end)
        return at, end if not more or text[end:more.end()].strip().lower() in _NOT_NAMES else more.end()
    tokens: list[re.Match] = []
    pos = at
    while len(tokens) < 6:
        t = _TOKEN.match(text, pos)
        if not t:
            break
        word = t.group()
        # a word that goes on with the sentence ends the name, unless it is written like a name
        if word.lower() in _NOT_NAMES and not (tokens and word[0].isupper() and word[1:].islower()) and not (not tokens and (word.lower() in _SUR or (word[0].isupper() and word.lower() in _SUR_BARE))):
            break
        if tokens and tokens[0].group()[0].isupper() and not t.group()[0].isupper():
            break
        tokens.append(t)
        pos = t.end()
        if text[pos : pos + 1] != " " or not text[pos + 1 : pos + 2].isalpha():
            break
        pos += 1
    if not tokens:
        return None
    head = tokens[0].group()
    low = head.lower()
    capital = head[0].isupper()
    surname = low in _SUR or (capital and low in _SUR_BARE and len(tokens) > 1)
    if low in _NOT_NAMES and len(tokens) < 2:
        return None
    if low in ("dương", "lý", "hồ", "thái", "ho", "do") and len(tokens) > 1 and tokens[1].group().lower() in ("tính", "do", "sơ", "độ", "khan", "ra", "gà"):
        return None
    if not capital:
        # in lower case only what begins with a surname is a name, two words at least
        if low not in _SUR or len(tokens) < 2:
            return None
    elif head.isupper() and len(head) > 1 and not surname and not weak and len(tokens) > 1 and not all(t.group().isupper() for t in tokens):
        tokens = tokens[:1]
    if weak and not surname and (shouted or len(tokens) < 2 or not all(t.group()[1:].islower() or "-" in t.group() for t in tokens)):
        return None
    return at, tokens[-1].end()


def tapes(source: str) -> Tape:
    """The last tape, on which detectors read."""
    return plain_signs(plain_digits(plain_letters(source)))


def find_pii(source: str, parts: NameParts | None = None) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` of the source text, disjoint and in order. ``parts``: the model by which
    names without title or phrase are found; without it, they are not."""
    tape = tapes(source)
    taken = _detect(tape.text)
    if parts:
        for a, b in parts.find(tape.text, taken):
            if all(b <= s or a >= e for s, e, _ in taken):
                taken.append((a, b, "NAME"))
    return sorted(((kind, *tape.back(a, b)) for a, b, kind in taken), key=lambda x: x[1:])


def _detect(text: str) -> list[tuple[int, int, str]]:
    """Disjoint spans (start, end, kind) on the last tape."""
    taken: list[tuple[int, int, str]] = []

    def add(kind: str, a: int, b: int) -> None:
        if b > a and all(b <= s or a >= e for s, e, _ in taken):
            taken.append((a, b, kind))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add("EMAIL", m.start(), m.end())
    for m in _ID.finditer(text):
        add("ID", m.start("id"), m.end("id"))
    for m in _BARE_CARD.finditer(text):
        if not _slip_before(text, m.start()):
            add("ID", m.start("id"), m.end("id"))
    for m in _PHONE.finditer(text):
        number, digits = m.group(), re.sub(r"\D", "", m.group())
        local = "0" + digits[4:] if digits.startswith("0084") else "0" + digits[2:] if digits.startswith("84") and not number.startswith("0") else digits
        fits = 8 <= len(digits) <= 15 if number[0] == "+" and not digits.startswith("84") else 9 <= len(local) <= 11
        if fits and not _slip_before(text, m.start()):
            add("PHONE", m.start(), m.start() + len(number.rstrip(")")))
    loose = (_ADDRESS_LOOSE.match(text, cue.end()) for cue in _ADDRESS_WORD.finditer(text))
    for found in (_ADDRESS.finditer(text), (m for m in loose if m)):
        for m in found:
            before = text[max(0, m.start() - CAPTION) : m.start()]
            if m.group()[0].isdigit() and not _ADDRESS_CUE.search(before) and not _PLACE_MARK.search(m.group()):
                continue  # a bare number before capitals is no house number
            if not _NO_PLACE.search(before):
                add("ADDRESS", m.start(), m.end())
    for a, b in _names(text):
        add("NAME", a, b)
    return taken


@dataclass
class NameParts:
    """How much likelier a word in capitals is in a name than elsewhere, as log odds: as a first word, as a later one."""

    first: dict[str, float]
    later: dict[str, float]

    def find(self, text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
        """Runs of two to five words in capitals that score as a name."""
        for start, end, free in _runs(text, taken):
            name = self.name(text[max(0, start - CAPTION) : start], text[start:end], free - start)
            if name:
                words = _words_at(start, text[start:end])
                yield words[name[0]][0], words[name[1] - 1][1]

    def name(self, before: str, run: str, free: int) -> tuple[int, int] | None:
        """The words [k, n) of a run that are a name, by the text before it and the offset where found spans end."""
        words = run.split(" ")
        low = [w.lower() for w in words]
        # a sentence may begin just before the name
        k = next((i for i, w in enumerate(low[:-1]) if w in self.first), None)
        if k is None:
            return None
        at = sum(len(w) + 1 for w in words[:k])
        if at < free or _OTHER_NAME.search((before + run[:at])[-CAPTION:]):
            return None
        score = [self.first[low[k]], *(self.later.get(w, UNKNOWN_PART) for w in low[k + 1 :])]
        while len(score) > 1 and score[-1] < 0:
            score.pop()  # what follows a name in capitals isn't part of it
        return (k, k + len(score)) if len(score) > 1 and sum(score) >= NAME_SCORE else None


def _runs(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, int]]:
    """Runs (start, end) of two to five words in capitals, each with the place where the last found span that
    reaches into it ends, if two words at least stand behind that."""
    spans = sorted(taken)  # disjoint, so that their ends are in order too
    for m in _CAPITALS.finditer(text):
        i = bisect.bisect_left(spans, (m.end(),))
        free = spans[i - 1][1] if i else 0
        if free <= _words_at(m.start(), m.group())[-2][0]:
            yield m.start(), m.end(), free


def _words_at(start: int, run: str) -> list[tuple[int, int]]:
    """The spans of the words of a run that begins at ``start``."""
    out = []
    for w in run.split(" "):
        out.append((start, start + len(w)))
        start += len(w) + 1
    return out


def _words_seen(text: str, taken: list[tuple[int, int, str]]) -> tuple[str, str, str]:
    """What the model is counted from, in small letters between blanks: first words of names found by title or
    phrase, later words of these, and all other words in capitals."""
    first, later, other, inside = [], [], [], bytearray(len(text))
    for a, b, kind in taken:
        if kind == "NAME":
            inside[a:b] = b"\x01" * (b - a)
            words = text[a:b].lower().split()
            first += words[:1]
            later += words[1:]
    for m in _CAPITAL.finditer(text):
        if not inside[m.start()]:
            other.append(m.group().lower())
    return " ".join(first), " ".join(later), " ".join(other)


_SEEN = "first string, later string, other string"


def fit_names(df: DataFrame, text_col: str) -> NameParts:
    """The model of name parts, from all texts: names found by title or phrase against all other words in
    capitals. The distinct words that stood in names twice at least come to the driver."""

    def rows(text) -> Iterator[tuple]:  # noqa: ANN001
        if text:
            tape = tapes(text).text
            yield _words_seen(tape, _detect(tape))

    return _fit(map_rows(df, [text_col], _SEEN, rows))


def _fit(seen: DataFrame) -> NameParts:
    def of(place: str) -> Column:
        return F.transform(F.split(place, " "), lambda w: F.struct(w.alias("w"), F.lit(place).alias("place")))

    places = ("first", "later", "other")
    words = seen.select(F.inline(F.concat(*map(of, places)))).where("w <> ''")
    counted = words.groupBy("w").agg(*[F.count_if(F.col("place") == p).alias(p) for p in places])
    counted = counted.where("first + later >= 2").collect()
    first = {r.w: math.log((r["first"] + 0.5) / (r["other"] + 0.5)) for r in counted if r["first"] > 1 and len(r.w) > 1}
    later = {r.w: math.log((r["later"] + 0.5) / (r["other"] + 0.5)) for r in counted if r["later"] > 0}
    return NameParts({w: x for w, x in first.items() if x > 0}, later)


def _readings(df: DataFrame, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """All texts read once, a row each: spans found without the model (kinds between blanks, places), runs that
    may be names, each with the text before it, the places they need, and the words that the model is counted
    from. Texts themselves, and rows without any, only if ``whole``."""

    def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
        if not text:
            if whole:
                yield key, text, "", [], [], [], "", "", ""
            return
        tape = tapes(text)
        taken = _detect(tape.text)
        places, runs, needed = [], [], []
        for a, b, _ in taken:
            places += tape.back(a, b)
        for start, end, free in _runs(tape.text, taken):
            begin = max(0, start - CAPTION)
            runs.append(tape.text[begin:end])
            words = _words_at(start, tape.text[start:end])
            needed += [start - begin, free - start, len(words)]
            for a, b in words:
                needed += tape.back(a, b)
        yield key, text if whole else None, " ".join(kind for _, _, kind in taken), places, runs, needed, *_words_seen(tape.text, taken)

    kind = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"id {kind}, body string, kinds string, places array<int>, runs array<string>, needed array<int>, {_SEEN}", rows)


def _decided(parts: NameParts, kinds: str, places: np.ndarray, runs: np.ndarray, needed: np.ndarray) -> list[tuple[str, int, int]]:
    """The spans of a text that was read, as those of ``find_pii``."""
    at = places.tolist()
    out = list(zip(kinds.split(), at[::2], at[1::2], strict=True))
    needs = iter(needed.tolist())
    for run in runs:
        begin, free, n = next(needs), next(needs), next(needs)
        words = [(next(needs), next(needs)) for _ in range(n)]
        name = parts.name(run[:begin], run[begin:], free)
        if name:
            out.append(("NAME", words[name[0]][0], words[name[1] - 1][1]))
    return sorted(out, key=lambda x: x[1:])


def _slip_before(text: str, at: int) -> bool:
    """True if the caption before a number is that of a slip, specimen, batch, device or card."""
    return bool(_SLIP_BEFORE.search(text[max(0, at - NUMBER_CAPTION) : at].rsplit("\n", 1)[-1]))


def redact(source: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by ``[KIND]``; all else stays as it is."""
    out, at = [], 0
    for kind, start, end in spans:
        out += [source[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, source[at:]])


def pii_spans(df: DataFrame, id_col: str, text_col: str, parts: NameParts | None = None) -> DataFrame:
    """Rows (id, kind, start_pos, end_pos), one per occurrence; offsets are code points of the text. Without
    ``parts`` the model of name parts is learnt from the texts.

    Defined cases: NULL and empty texts have no spans; a NULL id is kept; repeated rows give
    repeated spans; spans never overlap (the first of e-mail, identity number, phone, address,
    name wins); other columns are not carried, so their names can't clash. Whole texts are read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, kind string, start_pos int, end_pos int"
    if parts is None:
        read_ = written(_readings(df, id_col, text_col, whole=False))
        model = _fit(read_)

        def decided(key, *columns) -> Iterator[tuple]:  # noqa: ANN001
            for kind, a, b in _decided(model, *columns):
                yield key, kind, a, b

        some = read_.where("kinds <> '' or size(runs) > 0")
        return map_rows(some, ["id", "kinds", "places", "runs", "needed"], schema, decided)

    def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
        if text:
            for kind, a, b in find_pii(text, parts):
                yield key, kind, a, b

    return map_rows(df, [id_col, text_col], schema, rows)


def redacted(df: DataFrame, id_col: str, text_col: str, parts: NameParts | None = None) -> DataFrame:
    """Rows (id, text, n_found): every text with its personal information replaced; NULL stays NULL. Without
    ``parts`` the model of name parts is learnt from the texts, which are written with what was read."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, text string, n_found int"
    if parts is None:
        read_ = written(_readings(df, id_col, text_col, whole=True))
        model = _fit(read_)

        def decided(key, text, *columns) -> Iterator[tuple]:  # noqa: ANN001
            spans = _decided(model, *columns)
            yield key, redact(text, spans) if text else text, len(spans)

        return map_rows(read_, ["id", "body", "kinds", "places", "runs", "needed"], schema, decided)

    def rows(key, text) -> Iterator[tuple]:  # noqa: ANN001
        spans = find_pii(text, parts) if text else []
        yield key, redact(text, spans) if text else text, len(spans)

    return map_rows(df, [id_col, text_col], schema, rows)
