"""Text normalisation, containment, tokens, snippets, slugs and ids as column functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly columns that are computed once a row.

    The optimiser would write a column's expression into every filter that uses it, also into ones
    it infers itself; it does not look through a generator.
    """
    made = F.array(F.struct(*(c.alias(name) for name, c in columns.items())))
    return df.select("*", F.explode_outer(made).alias("__made")).select(*df.columns, *(F.col("__made")[name].alias(name) for name in columns))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: inside a lambda, a plain column would be computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str]:
    """Characters to U+024F whose decomposition starts with one ASCII letter, and those letters."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0x80, 0x250)]
    kept = [(a, d[0]) for a, d in pairs if d[0].isascii() and d[0].isalnum() and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(a for a, _ in kept), "".join(b for _, b in kept)


def grams(text: Column, least: Column, most: Column | None = None) -> Column:
    """The stretches of ``most`` characters (``least`` by default) at each place that has ``least``, in order, for ASCII texts.

    From an array of the characters: a substring would be counted off from the start each time.
    """
    width = least if most is None else most
    every = lambda cs: F.transform(F.sequence(F.lit(1), F.length(text) - least + 1), lambda i: F.array_join(F.slice(cs, i, width), ""))
    return F.when(F.length(text) >= least, let(F.split(text, ""), every)).otherwise(F.array().cast("array<string>"))


def strip_accents(text: Column) -> Column:
    return F.translate(text, *_accents())


def normalise(text: Column) -> Column:
    """Accents off, other non-ASCII dropped, lower case, punctuation but _ to single spaces; null gives ''."""
    given = F.coalesce(text, F.lit(""))
    # a text of as many bytes as characters is ASCII already
    ascii_only = F.when(F.octet_length(given) == F.length(given), given).otherwise(F.regexp_replace(strip_accents(given), r"[^\x00-\x7F]+", ""))
    return F.trim(F.regexp_replace(F.lower(ascii_only), r"\W+", " "))


def comparison_key(text: Column) -> Column:
    """As ``normalise`` with _ dropped too."""
    return F.trim(F.regexp_replace(normalise(text), r"[^a-z0-9]+", " "))


def slug(text: Column, most: int = 80) -> Column:
    return F.regexp_replace(F.substring(F.regexp_replace(comparison_key(text), " ", "-"), 1, most), r"-+$", "")


def has_term(norm: Column, term: Column) -> Column:
    """Whole-term containment: both sides normalised, so padding with spaces is exact."""
    return F.contains(F.concat(F.lit(" "), norm, F.lit(" ")), F.concat(F.lit(" "), term, F.lit(" ")))


def term_type(term: Column) -> Column:
    letter, digit = term.rlike("[A-Za-z]"), term.rlike("[0-9]")
    return F.when(letter & digit, "hybrid").when(digit, "number").otherwise("text")


def digits(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9]+", "")


def first_line(text: Column, most: int | None = 80) -> Column:
    """The first ``most`` characters of the first line; all of it with None."""
    line = F.substring_index(F.coalesce(text, F.lit("")), "\n", 1)
    return line if most is None else F.substring(line, 1, most)


def short_hash(*columns: Column, length: int = 20) -> Column:
    joined = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.substring(F.sha2(joined, 256), 1, length)


def snippet(text: Column, needle: Column, around: int = 40) -> Column:
    """The text around the first occurrence, with an ellipsis at each cut end; null without one."""
    at = F.instr(text, needle)
    lo = F.greatest(at - F.lit(around), F.lit(1))
    hi = F.least(at + F.length(needle) + F.lit(around), F.length(text) + 1)
    cut = F.substring(text, lo, hi - lo)
    return F.when(at > 0, F.concat(F.when(lo > 1, "...").otherwise(""), cut, F.when(hi <= F.length(text), "...").otherwise("")))


def process_number(digits_column: Column) -> Column:
    """17 digits as 00000.000000/0000-00."""
    part = lambda a, n: F.substring(digits_column, a, n)
    return F.concat(part(1, 5), F.lit("."), part(6, 6), F.lit("/"), part(12, 4), F.lit("-"), part(16, 2))


_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,2})?\s*$"


def number_digits(text: Column) -> Column:
    """Digits only; a whole number written as a float (123.0, 1e5) is written out first. Null gives ''."""
    value = F.when(text.rlike(_PLAIN_NUMBER), F.trim(text).try_cast("double"))
    whole = value.isNotNull() & (value == F.floor(value)) & (F.abs(value) < 1e18)
    return digits(F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(text))


def page_norm(text: Column) -> Column:
    """As ``normalise``, with all but a-z and 0-9 to single spaces."""
    return comparison_key(text)


def accent_norm(text: Column) -> Column:
    """Trimmed, lower case, white space reduced, accents off; punctuation stays. Null gives ''."""
    return strip_accents(F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))))


def title_norm(text: Column) -> Column:
    """For titles: ordinal marks and signs off, accents off, lower case; / . and - stay, other punctuation to single spaces."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[\u00ba\u00aa\u00b0]", "")
    ascii_only = F.regexp_replace(strip_accents(plain), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(F.lower(ascii_only), r"[^a-z0-9/.-]+", " "))


def shorten(text: Column, most: int, rule: str = "after") -> Column:
    """A text over ``most`` characters cut there: "after" adds an ellipsis, "within" counts it in, "trimmed" adds it after trailing spaces go."""
    cut = F.substring(text, 1, most - 3 if rule == "within" else most)
    cut = F.rtrim(cut) if rule == "trimmed" else cut
    return F.when(F.length(text) > most, F.concat(cut, F.lit("..."))).otherwise(text)


def parse_date(text: Column) -> Column:
    """A date written yyyy-MM-dd or dd/MM/yyyy; else null."""
    t = F.trim(text)
    iso = F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
    return F.coalesce(iso, F.when(t.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(t, "dd/MM/yyyy")))


def percent_text(share: Column) -> Column:
    """A share of 100 with two decimals and a decimal comma."""
    return F.concat(F.replace(F.format_string("%.2f", share), F.lit("."), F.lit(",")), F.lit("%"))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank, trimmed; '' if none is."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns), F.lit(""))


def ordered_distinct(values: Column) -> Column:
    """The first of the values that share a comparison key, in their order; blank ones go."""
    keyed = F.array_sort(F.transform(values, lambda x, i: F.struct(comparison_key(x).alias("key"), i.alias("i"), x.alias("x"))))
    first = let(keyed, lambda s: F.filter(s, lambda e, j: (e["key"] != "") & ((j == 0) | (F.get(s, j - 1)["key"] != e["key"]))))
    return F.transform(F.array_sort(F.transform(first, lambda e: F.struct(e["i"].alias("i"), e["x"].alias("x")))), lambda e: e["x"])


def flexible_term(text: Column, term: str) -> Column:
    """Whole-term containment in an ``accent_norm`` text: any white space between the term's words, no letter or digit beside it."""
    words = r"\s+".join(f"\\Q{w}\\E" for w in term.split())
    return text.rlike(f"(?<![a-z0-9]){words}(?![a-z0-9])")


def title_kind(title: Column, acts: tuple[str, ...]) -> Column:
    """ACT where the title holds a word for an official act, PERSON for up to six words of which three begin in capitals, else OTHER."""
    named = F.regexp_count(title, F.lit(r"\b[A-Z][a-z]+"))
    return F.when(comparison_key(title).rlike("|".join(acts)), "ACT").when((named >= 3) & (F.size(F.split(F.trim(title), r"\s+")) <= 6), "PERSON").otherwise("OTHER")
