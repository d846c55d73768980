"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL = r"^([A-Za-z0-9._%+-]+)@([A-Za-z0-9-]+)\..*$"


def capitalize_words(text: Column) -> Column:
    """First letter of each word upper, the rest lower."""
    return F.initcap(text)


def trimmed_length(text: Column) -> Column:
    return F.length(F.rtrim(text))


def first_word(text: Column) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(1))


def last_word(text: Column) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(-1))


def find(text: Column, part: str, *, zero_based: bool = False) -> Column:
    """Place of the first occurrence; 0 (or -1 when zero-based) if absent."""
    place = F.instr(text, part)
    return place - 1 if zero_based else place


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def count_chars(text: Column, members: str) -> Column:
    """Characters of a class such as ``a-z``; strips the others in one pass, which
    builds one string instead of a list of all matches."""
    return F.length(F.regexp_replace(text, f"[^{members}]+", ""))


def email_user(text: Column) -> Column:
    return F.regexp_extract(text, EMAIL, 1)


def email_company(text: Column) -> Column:
    return F.regexp_extract(text, EMAIL, 2)


def all_numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))


def positive_parts(parts: dict[str, Column], sep: str = ", ") -> Column:
    """``2 Gold, 1 Silver`` from the counts above zero."""
    texts = [F.when(n > 0, F.concat_ws(" ", n.cast("string"), F.lit(name))) for name, n in parts.items()]
    return F.concat_ws(sep, *texts)


def words(text: Column) -> Column:
    """Non-empty pieces between blanks."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")
