"""Canonical text.  Unicode normal forms are the only Python step; all else is built in."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Below U+0300 every string is its own NFC, below U+0080 its own NFKD.
NEEDS_NFC = r"[^\x{0000}-\x{02FF}]"
NEEDS_NFKD = r"[^\x{0000}-\x{007F}]"


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def _nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))


def nfc(text: Column) -> Column:
    """NFC; only texts that may change travel to Python."""
    return F.coalesce(_nfc(F.when(text.rlike(NEEDS_NFC), text)), text)


def nfkd(text: Column) -> Column:
    """NFKD, likewise."""
    return F.coalesce(_nfkd(F.when(text.rlike(NEEDS_NFKD), text)), text)


def canonical_text(text: Column) -> Column:
    """One line: NFC, no zero-width or control characters, single blanks, trimmed; null is empty."""
    out = nfc(F.coalesce(text, F.lit("")))
    for pattern, by in (
        (r"[\x{200B}\x{200C}\x{200D}\x{FEFF}]", ""),
        (r"\x{00A0}", " "),
        (r"[\p{Cc}&&[^\n\t]]", ""),
        (r"(?U)\s+", " "),
        ("^ | $", ""),
    ):
        out = F.regexp_replace(out, pattern, by)
    return out


def collapse_blanks(text: Column) -> Column:
    """Runs of white space to one blank, trimmed; no normal form."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def normalise_block(text: Column) -> Column:
    """Blanks collapse, at most one empty line, trimmed; line ends stay."""
    out = F.replace(text, F.lit("\u00a0"), F.lit(" "))
    out = F.regexp_replace(F.regexp_replace(out, "[ \t]+", " "), "\n{3,}", "\n\n")
    return F.regexp_replace(out, r"(?U)\A\s+|\s+\z", "")


def slugify_ascii(text: Column) -> Column:
    """ASCII slug: NFKD, other characters dropped, lower case, runs of the rest to one hyphen."""
    plain = F.lower(F.regexp_replace(nfkd(F.coalesce(text, F.lit(""))), r"[^\x{0000}-\x{007F}]", ""))
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9._-]+", "-"), "^-+|-+$", "")


def class_tokens(attribute: Column) -> Column:
    """Distinct lower-case tokens of a class attribute."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(attribute, F.lit(""))), r"(?U)\s+"), lambda t: t != ""))
