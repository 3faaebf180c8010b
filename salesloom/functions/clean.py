"""Cleaners for text that people typed: Column in, Column out, no Python workers.

Every cleaner gives NULL for text it cannot read; none raises under ANSI mode.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"

# The characters after which a word starts, besides blanks.
WORD_DELIMITERS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"

# Channel spellings, tried in this order.
CHANNEL_RULES = (
    ("gogle", "Google Ads"),
    ("face", "Facebook Ads"),
    ("linkedin", "LinkedIn Ads"),
)

# The words a dataframe writes for a missing cell.
MISSING_TOKENS = ("nan", "None", "<NA>")


# -- casts ---------------------------------------------------------------------------------


def safe_numeric(c: Column) -> Column:
    """Text or number to decimal(38,9); NULL when it is not a number."""
    return c.try_cast(NUMERIC)


def safe_int(c: Column) -> Column:
    """Text or integer to bigint; text with a fraction is NULL."""
    return c.try_cast("bigint")


def safe_date(c: Column) -> Column:
    """Year-month-day text to a date.

    Spark's own cast also takes ``2024`` and whole timestamps, so the shape is checked first.
    """
    text = c.cast("string")
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), text.try_cast("date"))


def parse_date_multi(c: Column) -> Column:
    """d/m/Y, Y-m-d, d-m-Y or Y/m/d text to a date; NULL for anything else.

    The formats exclude each other, so the text is rewritten to Y-m-d once and cast. That costs
    two regular expressions per row, where four date parsers in turn would throw and catch an
    exception for every format that does not fit.
    """
    text = F.trim(c)
    day_first = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4})$"
    year_first = r"^(\d{4})([/-])(\d{1,2})\2(\d{1,2})$"
    iso = F.when(text.rlike(day_first), F.regexp_replace(text, day_first, "$4-$3-$1")).when(
        text.rlike(year_first), F.regexp_replace(text, year_first, "$1-$3-$4")
    )
    return iso.try_cast("date")


def parse_money(c: Column) -> Column:
    """Brazilian money text (``R$ 1.234,56``) to decimal; dots always group thousands."""
    kept = F.regexp_replace(c, r"[^\d,.-]", "")
    return F.translate(kept, ",.", ".").try_cast(NUMERIC)


def parse_percent(c: Column) -> Column:
    """``15%`` to 0.15; a decimal comma is not read and gives NULL."""
    return (F.replace(c, F.lit("%"), F.lit("")).try_cast(NUMERIC) / 100).cast(NUMERIC)


def percent_digits(c: Column) -> Column:
    """First four digits over 1000: right for one-decimal percents, so ``5,0%`` is 0.05."""
    digits = F.substring(F.regexp_replace(c, r"[^\d]", ""), 1, 4)
    return (digits.try_cast(NUMERIC) / 1000).cast(NUMERIC)


def digits_key(c: Column) -> Column:
    """First run of digits as bigint: ``deal_1001`` to 1001, NULL when there is none."""
    return F.regexp_substr(c, F.lit(r"\d+")).try_cast("bigint")


def missing_to_null(c: Column) -> Column:
    """Text as it is, but the words for a missing cell become NULL."""
    text = c.cast("string")
    return F.when(~text.isin(*MISSING_TOKENS), text)


def canonical_label(c: Column, rules: Sequence[tuple[str, str]] = CHANNEL_RULES) -> Column:
    """First rule whose text occurs in the value, whatever its case; else the value itself."""
    folded = F.lower(c)
    labels = [F.when(folded.contains(needle.lower()), F.lit(name)) for needle, name in rules]
    return F.coalesce(*labels, c)


# -- accents and case ----------------------------------------------------------------------


@lru_cache(maxsize=None)
def _folds(form: str) -> tuple[tuple[str, str], ...]:
    """(character, base text) for every non-ASCII character that ``form`` decomposes."""
    pairs = []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue  # Hangul syllables follow a formula, surrogates are no characters
        char = chr(code)
        parts = unicodedata.normalize(form, char)
        if parts != char:
            base = "".join(p for p in parts if not unicodedata.category(p).startswith("M"))
            pairs.append((char, base))
    return tuple(pairs)


def _is_ascii(c: Column) -> Column:
    """One byte per character: cheaper than a regular expression."""
    return F.octet_length(c) == F.char_length(c)


def _hangul_to_jamo(c: Column) -> Column:
    """Canonical decomposition of Hangul syllables; runs only on values that hold one."""
    leads = "".join(map(chr, range(0x1100, 0x1100 + 19)))
    vowels = "".join(map(chr, range(0x1161, 0x1161 + 21)))
    tails = "".join(map(chr, range(0x11A8, 0x11A8 + 27)))

    def one(ch: Column) -> Column:
        index = F.ascii(ch) - 0xAC00
        lead = F.floor(index / 588).cast("int")
        vowel = F.floor((index % 588) / 28).cast("int")
        tail = index % 28
        jamo = F.concat(
            F.lit(leads).substr(lead + 1, F.lit(1)),
            F.lit(vowels).substr(vowel + 1, F.lit(1)),
            F.when(tail == 0, "").otherwise(F.lit(tails).substr(tail, F.lit(1))),
        )
        return F.when((index >= 0) & (index < 11172), jamo).otherwise(ch)

    return F.array_join(F.transform(F.split(c, ""), one), "")


def strip_accents(c: Column) -> Column:
    """Canonical decomposition (NFD) without its combining marks.

    One-to-one folds go through ``translate`` and the marks through one regular expression.
    """
    singles = [(a, b) for a, b in _folds("NFD") if len(b) == 1]
    folded = F.translate(c, "".join(a for a, _ in singles), "".join(b for _, b in singles))
    folded = F.regexp_replace(folded, r"\p{M}+", "")
    plain = F.when(folded.rlike("[가-힣]"), _hangul_to_jamo(folded)).otherwise(folded)
    return F.when(_is_ascii(c), c).otherwise(plain)


def to_ascii(c: Column) -> Column:
    """Compatibility decomposition (NFKD) with every non-ASCII character dropped."""
    ascii_folds = []
    for char, base in _folds("NFKD"):
        kept = base.encode("ascii", "ignore").decode("ascii")
        if kept:
            ascii_folds.append((char, kept))
    singles = [(a, b) for a, b in ascii_folds if len(b) == 1]
    longer = [(a, b) for a, b in ascii_folds if len(b) > 1]
    expand = F.map_from_arrays(
        F.split(F.lit("".join(a for a, _ in longer)), ""),
        F.split(F.lit("\n".join(b for _, b in longer)), "\n"),
    )

    def one(ch: Column) -> Column:
        return F.coalesce(F.try_element_at(expand, ch), ch)

    expanded = F.array_join(F.transform(F.split(c, ""), one), "")
    without_longer = F.translate(c, "".join(a for a, _ in longer), "")
    whole = F.when(without_longer != c, expanded).otherwise(c)
    folded = F.translate(whole, "".join(a for a, _ in singles), "".join(b for _, b in singles))
    plain = F.regexp_replace(folded, r"[^\x00-\x7F]+", "")
    return F.when(_is_ascii(c), c).otherwise(plain)


def snake_case(c: Column) -> Column:
    """ASCII, lower case, other characters joined into single underscores, none at the ends."""
    words = F.regexp_replace(F.lower(to_ascii(c)), r"\W+", "_")
    return F.regexp_replace(words, "^_+|_+$", "")


def title_case(c: Column) -> Column:
    """Capital after a blank or a delimiter, lower case elsewhere (``ana-maria`` too).

    Spark's ``initcap`` starts words at blanks only. It serves the values without delimiters,
    which most names are; the others are split at every delimiter.
    """
    marks = "".join("\\" + d for d in WORD_DELIMITERS) + r"\s"
    pieces = F.regexp_extract_all(F.lower(c), F.lit(f"[{marks}]+|[^{marks}]+"), F.lit(0))

    def capital(piece: Column) -> Column:
        return F.concat(F.upper(F.left(piece, F.lit(1))), F.substring(piece, 2, 2147483647))

    split = F.array_join(F.transform(pieces, capital), "")
    return F.when(c.rlike("^[A-Za-z0-9 ]*$"), F.initcap(c)).otherwise(split)
