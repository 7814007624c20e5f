"""Text expressions. All of them are Column in, Column out and run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.tokens import CURLY_TOKEN, SQUARE_TOKEN

# What a Unicode-aware strip removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"[ \t\n\x0B\f\r]+"
MASK = "{#}"
WORD = r"[\p{L}\p{N}]+"
XML_NAME = r"^[\p{L}_][\p{L}\p{N}_.\-]*$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every Unicode whitespace character, not only spaces."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def mask_placeholders(c: Column | str, mark: str = MASK) -> Column:
    """Tokens replaced by ``mark``: one pass per bracket kind, only where the bracket occurs."""
    out = as_col(c)
    for pattern, bracket in ((CURLY_TOKEN, "{"), (SQUARE_TOKEN, "[")):
        replaced = F.regexp_replace(out, pattern, mark)
        out = F.when(F.contains(as_col(c), F.lit(bracket)), replaced).otherwise(out)
    return out


def normalize_source(c: Column | str) -> Column:
    """Masked text with whitespace runs collapsed; the lookup form of a string."""
    return F.trim(F.regexp_replace(mask_placeholders(c), SPACE_RUN, " "))


def source_hash(c: Column | str) -> Column:
    """Lookup hash: equal for texts that differ only in tokens or spacing."""
    return F.sha2(normalize_source(c), 256)


def value_hash(c: Column | str) -> Column:
    """Staleness hash: changes with any change of the text."""
    return F.sha2(as_col(c), 256)


def xml_escape(c: Column | str) -> Column:
    out = as_col(c)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def xml_unescape(c: Column | str) -> Column:
    out = as_col(c)
    for entity, plain in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&apos;", "'"),
        ("&amp;", "&"),
    ):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return out


def comment_safe(c: Column | str) -> Column:
    """Comment body carrying the English text; ``--`` may not occur inside a comment."""
    dashed = F.replace(as_col(c), F.lit("--"), F.lit("––"))
    return F.concat(F.lit(" EN: "), F.rtrim(dashed, F.lit("-")), F.lit(" "))


def words(c: Column | str) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(as_col(c), SPACE_RUN), lambda w: w != "")


def terms(c: Column | str) -> Column:
    """Lower-case letter/digit runs, the form in which glossary terms are compared."""
    return F.regexp_extract_all(F.lower(as_col(c)), F.lit(WORD), F.lit(0))


def term_key(c: Column | str) -> Column:
    return F.array_join(terms(c), " ")


def each(items: Column) -> Column:
    """Explode for computed arrays.

    A plain explode makes the optimizer filter on the array's size first, which computes the array
    twice and on the wrong side of an exchange; rows without items come out as one null instead.
    """
    return F.explode_outer(items)


def estimate_tokens(c: Column | str, chars_per_token: int = 4) -> Column:
    return F.ceil(F.length(as_col(c)) / F.lit(chars_per_token)).cast("bigint")


def hash_bucket(buckets: Column | int, *cols: Column | str) -> Column:
    """Stable bucket number in [0, buckets) from an md5 prefix; equal in every engine."""
    n = F.lit(buckets) if isinstance(buckets, int) else buckets
    text = F.concat_ws("\u0001", *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, n.cast("bigint"))
