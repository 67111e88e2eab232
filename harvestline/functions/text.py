"""Text functions over columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from harvestline import vocab


def same_text(c: Column, value: str) -> Column:
    return F.lower(F.trim(c)) == F.lit(value.strip().lower())


def clean_key(c: Column) -> Column:
    """Lower-case a place name and drop the words for "district" wherever they occur."""
    key = F.lower(F.trim(c))
    for word in ("district", "dist.", "dist"):
        key = F.trim(F.replace(key, F.lit(word), F.lit("")))
    return key


def before_paren(c: Column) -> Column:
    return F.trim(F.substring_index(c, "(", 1))


def title_words(c: Column) -> Column:
    """Title case in which every run of letters starts a word.

    ``initcap`` only splits at blanks, so a marked blank is set after every run of other characters and taken out again. Texts
    where no letter follows such a character, by far the most, need no marks.
    """
    marked = F.regexp_replace(c, r"(\P{L}+)", "$1\u0001 ")
    split = F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))
    return F.when(c.rlike(r"[^\p{L} ]\p{L}"), split).otherwise(F.initcap(c))


def snake_case(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def snake_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def market_name(c: Column) -> Column:
    """Drop the committee suffix and put a blank before an opening parenthesis."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.trim(c), " APMC$", "")), r"(\w)\(", "$1 (")


def file_safe(c: Column) -> Column:
    swapped = F.translate(c, '/\\:*| ?"<>', "______")
    return F.trim(F.regexp_replace(swapped, "_+", "_"), F.lit("_"))


def null_if_blank(c: Column) -> Column:
    text = F.trim(c)
    return F.when(~F.lower(text).isin("nan", "none", ""), text)


def join_list(c: Column, sep: str = "; ") -> Column:
    return F.concat_ws(sep, c)


def _is_sensitive(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit("-"), F.lit("_")).isin(vocab.SENSITIVE_FIELDS)


def redact_map(params: Column) -> Column:
    return F.transform_values(params, lambda k, v: F.when(_is_sensitive(k), F.lit("[REDACTED]")).otherwise(v))


def redact_url(url: Column) -> Column:
    names = "|".join(name.replace("_", "[_-]") for name in vocab.SENSITIVE_FIELDS)
    return F.regexp_replace(url, rf"(?i)([?&](?:{names})=)[^&#]*", "$1[REDACTED]")
