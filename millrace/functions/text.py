"""Text functions as Spark columns, with Python's notion of white space, words and letters.

Every function is a plain expression: it stays in the JVM, and Catalyst can prune and push around it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character classes that Spark, DuckDB and Python agree on.
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


#: The characters of SPACE one by one, for trimming without a regular expression.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def words(c: Column) -> Column:
    """White-space separated tokens, no empty ones."""
    return F.filter(F.split(c, f"{SPACE}+"), lambda w: w != "")


def lines(c: Column) -> Column:
    """Stripped lines that are not blank; only \\n separates."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def split_lines(c: Column) -> Column:
    """Lines by any line break, without a trailing empty one."""
    return F.split(F.regexp_replace(c, r"\R$", ""), r"\R")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(w: Column, n: int) -> Column:
    """Runs of n tokens of an array joined by a space; none if there are fewer."""
    return let(w, lambda v: _ngrams(v, n))


def _ngrams(w: Column, n: int) -> Column:
    """By single elements: a slice would walk the whole array for each run."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *(F.get(w, i + k) for k in range(n))))
    return F.when(F.size(w) >= n, runs).otherwise(F.array().cast("array<string>"))


def normalize(c: Column) -> Column:
    """Lower case, without anything but word characters and white space, which is collapsed."""
    bare = F.regexp_replace(F.lower(c), f"[^{WORD_CHARS}{SPACE_CHARS}]", "")
    return F.trim(F.regexp_replace(bare, f"{SPACE}+", " "))


def exact_hash(c: Column) -> Column:
    """The first 8 bytes of SHA-256 of the normalised text, in hex."""
    return F.substring(F.sha2(normalize(c), 256), 1, 16)


def portable_hash(c: Column, seed: str = "") -> Column:
    """60 bits of MD5 as a number; the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), c)), 1, 15), 16, 10).cast("bigint")


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def int_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(0))


def url_site(url: Column) -> Column:
    """The first label of a URL's host; empty if there is no scheme."""
    return F.split_part(F.regexp_extract(url, "://([^/]*)", 1), F.lit("."), F.lit(1))


#: The entities that are decoded without a table.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_to_text(html: Column) -> Column:
    """Block ends become blank lines, <br> a line break; tags go; common entities are decoded; line breaks are collapsed."""
    out = F.regexp_replace(html, r"(?i)</(?:p|div|li|ul|ol|h[1-6]|blockquote|tr|table|pre)>", "\n\n")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>", "\n")
    out = F.regexp_replace(out, "<[^>]+>", "")
    for entity, plain in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return strip(F.regexp_replace(out, "\n{3,}", "\n\n"))


def longest_run(a: Column) -> Column:
    """Length of the longest run of equal neighbours of an array; 0 for an empty one."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["last"].eqNullSafe(x), s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(F.transform(a, lambda x: x.cast("string")), start, step, lambda s: s["best"])


#: Number words.
UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "- - twenty thirty forty fifty sixty seventy eighty ninety".split()


def number_words(n: Column) -> Column:
    """English words of 0 to 999; other numbers as digits."""
    unit, ten = F.array(*map(F.lit, UNITS)), F.array(*map(F.lit, TENS))

    def under_100(x: Column) -> Column:
        tail = F.when(x % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("-"), F.element_at(unit, (x % 10 + 1).cast("int"))))
        return F.when(x < 20, F.element_at(unit, (F.least(x, F.lit(19)) + 1).cast("int"))).otherwise(F.concat(F.element_at(ten, (F.floor(x / 10) + 1).cast("int")), tail))

    rest = n % 100
    hundreds = F.concat(F.element_at(unit, (F.floor(n / 100) + 1).cast("int")), F.lit(" hundred"), F.when(rest == 0, F.lit("")).otherwise(F.concat(F.lit(" and "), under_100(rest))))
    return F.when((n < 0) | (n > 999), n.cast("string")).when(n < 100, under_100(F.greatest(F.least(n, F.lit(99)), F.lit(0)))).otherwise(hundreds)


def markdown_link(text: Column, url: Column) -> Column:
    return F.when(F.coalesce(url, F.lit("")) == "", text).otherwise(F.concat(F.lit("["), text, F.lit("]("), url, F.lit(")")))
