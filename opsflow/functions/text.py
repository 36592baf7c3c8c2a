"""String functions, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def key_text(col: Column) -> Column:
    """Comparable form of a code: case and trailing blanks do not count."""
    return F.upper(F.rtrim(col))


def text_length(col: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(col))


def remove_all(col: Column, parts: Sequence[str]) -> Column:
    """Remove each literal wherever it occurs, in the order given."""
    for part in parts:
        col = F.replace(col, F.lit(part), F.lit(""))
    return col


def normalize_ref(
    col: Column, suffixes: Sequence[str] = ("-1", "-2", "-3"), suffix_only: bool = False
) -> Column:
    """Reference number without its resend suffix.

    By default the suffixes go anywhere in the text, as the matching rules
    expect; ``suffix_only`` limits that to the end.
    """
    if not suffix_only:
        return remove_all(col, suffixes)
    return F.regexp_replace(col, "(" + "|".join(suffixes) + ")$", "")


def clean_tracking(col: Column, prefixes: Sequence[str]) -> Column:
    """Tracking number without carrier prefixes and without a first character
    that is no digit."""
    bare = F.trim(remove_all(col, prefixes))
    return F.when(
        bare.rlike("^[^0-9]") & (F.length(bare) > 0), F.substring(bare, 2, 1 << 20)
    ).otherwise(bare)


def first_name(name: Column) -> Column:
    """Text before the first blank; the whole name if it has none."""
    return F.when(F.instr(name, " ") > 0, F.substring_index(name, " ", 1)).otherwise(name)


def last_name(name: Column) -> Column:
    """Text after the first blank; null if the name has none."""
    at = F.instr(name, " ")
    return F.when(at > 0, F.substring(name, at + 1, F.length(name)))


def first_name_strict(name: Column) -> Column:
    """Text before the first blank of the left-trimmed name; empty without one."""
    bare = F.ltrim(name)
    at = F.instr(bare, " ")
    return F.when(at > 0, F.substring(bare, F.lit(1), at - 1)).when(
        name.isNotNull(), F.lit("")
    )


def last_name_strict(name: Column) -> Column:
    """Text after the first blank of the left-trimmed name; all of it without one."""
    bare = F.ltrim(name)
    return F.substring(bare, F.instr(bare, " ") + 1, F.length(bare))


def join_text(*cols: Column | str) -> Column:
    """Concatenation in which a null counts as empty text."""
    return F.concat_ws("", *[F.lit(c) if isinstance(c, str) else c for c in cols])


def join_lines(first: Column, second: Column) -> Column:
    """Two address lines with a blank between; the first alone if there is no second."""
    return F.when(second.isNull(), first).otherwise(F.concat_ws(" ", first, second))


def phone_with_prefix(
    phone: Column, country: Column, countries: Sequence[str] = ("US", "CA"), prefix: str = "+1"
) -> Column:
    """Add the calling code for the given countries unless there is a plus sign."""
    needs = country.isin(*countries) & ~phone.contains("+")
    return F.when(needs, F.concat(F.lit(prefix), phone)).otherwise(phone)


def plain_phone(phone: Column) -> Column:
    return F.replace(phone, F.lit("+"), F.lit(""))


def first_of_list(col: Column, separator: str = ";") -> Column:
    return F.substring_index(col, separator, 1)


def country_iso3(col: Column) -> Column:
    return F.when(col == "US", F.lit("USA")).otherwise(col)


def country_name(col: Column) -> Column:
    return F.when(col == "US", F.lit("United States")).otherwise(col)


def strip_trailing_id(col: Column) -> Column:
    """``'Name (123)'`` as ``'Name'``; blank text as null."""
    bare = F.trim(F.regexp_replace(col, r"\s*\(\d+\)\s*$", ""))
    return F.when(F.trim(col) != "", bare)


def trailing_id(col: Column) -> Column:
    """``'Name (123)'`` as 123, null without an id in parentheses."""
    return F.regexp_extract(col, r"\((\d+)\)\s*$", 1).try_cast("bigint")


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def null_to_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def user_name(col: Column, domain: str) -> Column:
    """Login without its domain prefix."""
    return F.replace(col, F.lit(domain + "\\"), F.lit(""))


def markup_text(col: Column, width: int | None = None) -> Column:
    """Text cut to ``width`` and escaped for XML."""
    if width is not None:
        col = F.left(col, F.lit(width))
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        col = F.replace(col, F.lit(raw), F.lit(escaped))
    return col


def comparable(col: Column) -> Column:
    """Nested value as lower-case JSON text, for case-insensitive comparison.

    Field order is that of the struct, so both sides must share one type.
    """
    return F.lower(F.to_json(col))
