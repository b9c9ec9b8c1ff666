"""Helpers shared by the text-corpus operators."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanloom.plans.runtime import spread

#: Code points that are not seen: format characters used as disguise and joiners.
INVISIBLE = dict.fromkeys([0x00AD, 0x034F, 0x061C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF])


def char_class(codes: list[int]) -> str:
    """The inside of a pattern's class for sorted code points."""
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}" if a == b else f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


_HIDDEN = re.compile(f"[{char_class(sorted(INVISIBLE))}]")


class _Bare(dict):
    """Translation table: each sign in lower case without accents, made when it is first met."""

    def __missing__(self, code: int) -> str:
        kept = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if unicodedata.category(c)[0] != "M")
        self[code] = kept.casefold().replace("đ", "d")
        return self[code]


class _Words(_Bare):
    """The same with a blank for all that is no letter or digit, and nothing for what isn't seen."""

    def __missing__(self, code: int) -> str:
        self[code] = "" if code in INVISIBLE else "".join(c if c.isalnum() else " " for c in _BARE[code])
        return self[code]


_BARE, _WORDS = _Bare(), _Words()


def map_rows(df: DataFrame, columns: list[str], schema: str, rows: Callable[..., Iterator[tuple]] | None = None, setup: Callable[[], Callable[..., Iterator[tuple]]] | None = None) -> DataFrame:
    """Run ``rows(*values of columns)`` for each row and collect the tuples it yields; ``setup()`` makes
    that function once per task.

    Only the named columns travel to the Python workers, in Arrow batches; the output is built
    batch by batch, so a worker holds one batch however long the partition is.
    """
    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = setup() if setup else rows
        for pdf in batches:
            out: list[tuple] = []
            for values in zip(*(pdf[c].tolist() if pdf[c].dtype == object else pdf[c] for c in pdf.columns), strict=True):
                out.extend(each(*values))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return spread(df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])).mapInPandas(run, schema)


def seen(text: str) -> str:
    """``text`` without invisible code points."""
    return text if text.isascii() else _HIDDEN.sub("", text)


def bare_text(text: str) -> str:
    """``text`` in lower case without accents; ``đ`` counts as ``d``."""
    return text.lower() if text.isascii() else text.translate(_BARE)


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, without case and accents."""
    return text.translate(_WORDS).split()
