"""Keys, fills, locations, document labels, paths, errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def business_key(*cols: Column) -> Column:
    """Concatenation without separator, missing parts as ''."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def fill_currency(c: Column, default: str = "USD") -> Column:
    """P14."""
    return F.coalesce(c, F.lit(default))


def fill_blank(c: Column) -> Column:
    """P15."""
    return F.coalesce(c, F.lit(""))


def location_a(address: Column, city: Column, state: Column, country: Column) -> Column:
    """Single-space join; a missing state is ''; any other missing part
    makes the whole value missing (``concat`` propagates NULL)."""
    sp = F.lit(" ")
    return F.concat(address, sp, city, sp, F.coalesce(state, F.lit("")), sp, country)


def location_b(address: Column, city: Column, state: Column, country: Column, null_token: str = "nan") -> Column:
    """Missing parts print as ``null_token``; all four missing -> ''."""
    tok = F.lit(null_token)
    joined = F.concat_ws(" ", *[F.coalesce(c, tok) for c in (address, city, state, country)])
    all_missing = " ".join([null_token] * 4)
    return F.when(joined == F.lit(all_missing), F.lit("")).otherwise(joined)


def base_name(path: Column) -> Column:
    """The text after the last '/'."""
    return F.substring_index(path, "/", -1)


def strip_ext(name: Column, ext: str = ".csv") -> Column:
    """Remove every occurrence of ``ext``."""
    return F.replace(name, F.lit(ext), F.lit(""))


def swap_ext(name: Column, old: str = ".csv", new: str = ".xlsx") -> Column:
    """The output key of an input file."""
    return F.replace(name, F.lit(old), F.lit(new))


def doc_label(file_name: Column) -> Column:
    """P18: 'DOC-' + the text before the first '-' once every 'DOC-' is removed
    from the base name ('DOC-12-<uuid>-x.csv' -> 'DOC-12')."""
    stem = strip_ext(base_name(file_name))
    return F.concat(F.lit("DOC-"), F.split_part(F.replace(stem, F.lit("DOC-"), F.lit("")), F.lit("-"), F.lit(1)))


def decode_key(c: Column) -> Column:
    """P20: percent-decode; '+' and every escape that isn't %xx are kept as they are,
    bytes that don't form a character become the replacement character."""
    lone = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(lone)


def output_name(file_name: Column) -> Column:
    """The name of a file's output: its base name without the extension, decoded."""
    return decode_key(strip_ext(base_name(file_name)))


def flatten_error(c: Column) -> Column:
    """Remove newlines, carriage returns and their escaped two-char forms."""
    out = c
    for token in ("\n", "\r", "\\n", "\\r"):
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def packed_texts(cols: Sequence[Column]) -> Column:
    """Texts as one text, which a shuffle writes in a third of the bytes of so many columns. It sorts as a struct of them does: nulls
    first, then by their bytes. Each is followed by a zero, which no packed text holds: the two lowest characters are written as pairs."""
    return F.concat_ws("\0", *[F.coalesce(F.concat(F.lit("\2"), F.replace(F.replace(c, F.lit("\1"), F.lit("\1\2")), F.lit("\0"), F.lit("\1\1"))), F.lit("")) for c in cols])


def unpacked_texts(packed: Column) -> Column:
    """The array of texts that ``packed_texts`` was given."""
    return F.transform(F.split(packed, "\0"), lambda x: F.when(
        x != "", F.replace(F.replace(F.substr(x, F.lit(2)), F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))))
