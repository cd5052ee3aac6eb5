"""Scalar text functions. All but Unicode folding and full entity decoding are built-in expressions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The character classes that names are compared by.
OPEN, CLOSE = r"(\[（「『", r")\]）」』"
QUOTES = "['\"`´]"
WORD_CHARS = "0-9a-z가-힣"
TOKEN = "[0-9A-Za-z가-힣]+"
SPACES = r"(?U)\s+"
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]


def _none(s: Column) -> Column:
    return F.coalesce(s, F.lit(""))


def norm(s: Column) -> Column:
    """Key of a name: no white space, lower case; null is empty."""
    return F.lower(F.regexp_replace(_none(s), SPACES, ""))


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def _beyond_ascii(s: Column, plain: Column, udf) -> Column:  # noqa: ANN001
    """plain for ASCII text, which never leaves the JVM; the Python function gets only the other texts."""
    other = s.rlike(r"[^\x00-\x7F]")
    return F.when(other, udf(F.when(other, s))).otherwise(plain)


def nfkc(s: Column) -> Column:
    return _beyond_ascii(_none(s), _none(s), _nfkc)


def folded(s: Column) -> Column:
    """NFKC and case folding; the form that the other name functions start from."""
    return _beyond_ascii(_none(s), F.lower(_none(s)), _fold)


def trivial_norm(s: Column, fold=folded) -> Column:  # noqa: ANN001
    """Folded, trimmed, quotes alike, white space runs as one space."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(fold(s), r"(?U)^\s+|\s+$", ""), QUOTES, "'"), SPACES, " ")


def loose_key(s: Column, fold=folded) -> Column:  # noqa: ANN001
    """Folded, bracketed content dropped, letters and digits only."""
    inner = F.regexp_replace(fold(s), f"[{OPEN}][^{CLOSE}]*[{CLOSE}]", "")
    return F.regexp_replace(inner, f"[^{WORD_CHARS}]", "")


def base_name(s: Column, fold=folded) -> Column:  # noqa: ANN001
    """Folded, without any trailing bracket groups."""
    cut = F.regexp_replace(fold(s), rf"(?U)(\s*[{OPEN}][^{CLOSE}]*[{CLOSE}]\s*)+$", "")
    return F.regexp_replace(F.regexp_replace(cut, r"(?U)^\s+|\s+$", ""), SPACES, " ")


def is_specific(base: Column) -> Column:
    """Six letters and digits, or two words."""
    compact = F.length(F.regexp_replace(base, f"[^{WORD_CHARS}]", ""))
    words = F.size(F.filter(F.split(base, SPACES), lambda w: w != ""))
    return (compact >= 6) | (words >= 2)


def tokens(s: Column, fold=folded) -> Column:  # noqa: ANN001
    return F.array_distinct(F.regexp_extract_all(fold(s), F.lit(TOKEN), 0))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def contains_either(a: Column, b: Column) -> Column:
    return (F.length(a) > 0) & (F.length(b) > 0) & (a.contains(b) | b.contains(a))


def shortened(s: Column, most: int = 17, keep: int = 16) -> Column:
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, keep), F.lit("…"))).otherwise(s)


def html_escape(s: Column) -> Column:
    for a, b in ESCAPES:
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def html_unescape(s: Column) -> Column:
    """All character references."""
    return _unescape(s)


def xml_unescape(s: Column) -> Column:
    """The five of XML, as built-in expressions."""
    for b, a in [("'", "&#x27;"), ("'", "&#39;"), ("'", "&apos;"), ('"', "&quot;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")]:
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def strip_markup(s: Column, unescape=html_unescape) -> Column:  # noqa: ANN001
    """Text of word-processor XML or HTML: paragraph ends are new lines, tags go, then references are decoded."""
    return unescape(F.regexp_replace(F.replace(s, F.lit("</w:p>"), F.lit("\n")), "<[^>]+>", ""))


def safe_key(k: Column) -> Column:
    """A property key for a graph statement: [0-9A-Za-z_] only, not empty, no leading digit."""
    plain = F.regexp_replace(k, "[^0-9A-Za-z_]", "_")
    return F.when(plain.rlike("^([0-9].*)?$"), F.concat(F.lit("p_"), plain)).otherwise(plain)


def safe_code(code: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(code, F.lit("RELATED_TO")), "[^0-9A-Za-z_]", "_"))
