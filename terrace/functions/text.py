"""Text expressions over Columns. All of them stay inside JVM code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the source loader strips before hashing a field.
STRIPPED_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: separator between the fields of a row digest.
DIGEST_SEPARATOR = "\x1f"

# Mappings up to this size become a CASE expression, longer ones a map lookup.
CASE_CHAIN_LIMIT = 32


def text(c: Column) -> Column:
    return c.cast("string")


def trimmed(c: Column) -> Column:
    """Strip blanks at both ends (only blanks, as SQL TRIM does)."""
    return F.trim(text(c))


def trimmed_in_two_steps(c: Column) -> Column:
    return F.ltrim(F.rtrim(text(c)))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def is_present(c: Column) -> Column:
    """True when the value is neither NULL nor blank; never NULL itself."""
    return c.isNotNull() & (trimmed(c) != "")


def clipped(c: Column, length: int) -> Column:
    """Silent truncation, as a conversion to VARCHAR(n) does."""
    return F.substring(text(c), 1, length)


def text_field(c: Column, length: int) -> Column:
    """Trimmed text of limited length, blank becoming NULL."""
    return clipped(blank_to_null(c), length)


def text_length(c: Column) -> Column:
    return F.length(text(c))


def without(c: Column, unwanted: str) -> Column:
    return F.replace(text(c), F.lit(unwanted), F.lit(""))


def without_prefix(c: Column, prefix: str) -> Column:
    value = text(c)
    rest = F.substring(value, len(prefix) + 1, 2**31 - 1)
    return F.when(value.startswith(prefix), rest).otherwise(value)


def joined(*parts: Column, sep: str = " ") -> Column:
    """Concatenate, reading NULL as the empty string and keeping separators."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(text(part), F.lit("")))
    return F.concat(*pieces)


def decoded(
    c: Column,
    codes: Mapping[str, str],
    unknown: Column | str | None = None,
    fold_case: bool = True,
) -> Column:
    """Replace a code by its meaning; anything else becomes ``unknown``.

    ``unknown`` may be a Column, so the original value can pass through.
    """
    key = trimmed(c)
    if fold_case:
        key = F.upper(key)
        codes = {code.upper(): meaning for code, meaning in codes.items()}
    default = unknown if isinstance(unknown, Column) else F.lit(unknown)
    if len(codes) > CASE_CHAIN_LIMIT:
        table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
        return F.coalesce(F.try_element_at(table, key), default)
    meanings: dict[str, list[str]] = {}
    for code, meaning in codes.items():
        meanings.setdefault(meaning, []).append(code)
    chain = None
    for meaning, its_codes in meanings.items():
        test = key == its_codes[0] if len(its_codes) == 1 else key.isin(its_codes)
        chain = F.when(test, meaning) if chain is None else chain.when(test, meaning)
    return default if chain is None else chain.otherwise(default)


def has_outer_blanks(c: Column) -> Column:
    return text(c) != trimmed(c)


def category_of(composite: Column) -> Column:
    """First five characters of a composite product key, ``-`` written ``_``."""
    return F.replace(F.substring(text(composite), 1, 5), F.lit("-"), F.lit("_"))


def number_of(composite: Column) -> Column:
    """The composite product key from its seventh character on."""
    return F.substring(text(composite), 7, 2**31 - 1)


def first_known(primary: Column, fallback: Column, unknown: str, default: str = "n/a") -> Column:
    """The primary source's value unless it is unknown, else the fallback's."""
    known = F.upper(trimmed(primary)) != unknown.upper()
    return F.when(known, primary).otherwise(F.coalesce(fallback, F.lit(default)))


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the stripped fields, 32 bytes; NULL counts as empty."""
    fields = [
        F.btrim(F.coalesce(text(c), F.lit("")), F.lit(STRIPPED_CHARACTERS)) for c in columns
    ]
    return F.unhex(F.sha2(F.concat_ws(DIGEST_SEPARATOR, *fields), 256))


def folded(c: Column) -> Column:
    """Compare without regard to case or trailing blanks."""
    return F.collate(text(c), "UTF8_LCASE_RTRIM")
