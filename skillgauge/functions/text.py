"""Text columns: trimming, entity decoding, and HTML reduced to its text."""

import html as html_lib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# What counts as part of a word: letters, numbers and the underscore.
WORD = r"\p{L}\p{N}_"

# Every character that Python's str.strip() removes.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# NUL cannot occur in decoded text and so marks where a text node ends.
_CUT = "\u0000"

# Markup whose inside is never text: comments, declarations, and the three
# elements that hold code.
_HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style|template)(?=[\s/>])[^>]*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
    r"|<[!?][^>]*+>"
)

# An opening or closing tag. A quoted attribute value may hold ">". All loops
# are possessive: they neither backtrack nor recurse on long attributes.
_TAG = (
    r"</?[a-zA-Z](?:[^>\"'=]++"
    r"|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'"
    r"|[=\"'])*+>"
)

_PLAIN_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&amp;", "&"),  # last, so that "&amp;lt;" stays "&lt;"
]
# Any other reference as ``html.unescape`` finds them. It holds one "&" only, so what is
# found at one place does not depend on any other place.
_RARE_ENTITY = (
    r"&(?!(?:lt|gt|quot|apos|nbsp|amp|#39);)"
    r"(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
)


@F.pandas_udf(ArrayType(StringType()))
def _unescape(references: pd.Series) -> pd.Series:
    return references.map(lambda row: [html_lib.unescape(r) for r in row], na_action="ignore")


# So marked, its call is not repeated for filters that the planner derives, as the one
# before an explode; those would run it a second time, ahead of any repartition.
_unescape = _unescape.asNondeterministic()


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def _decode_plain(text: Column) -> Column:
    for reference, character in _PLAIN_ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def _without_markup(markup: Column) -> Column:
    flat = F.regexp_replace(F.replace(markup, F.lit(_CUT), F.lit("")), _HIDDEN, _CUT)
    return F.regexp_replace(flat, _TAG, _CUT)


def with_html_text(
    df: DataFrame, markup: str, name: str, separator: str = " "
) -> DataFrame:
    """Add the visible text of the HTML fragments in ``markup``.

    Text nodes are decoded and trimmed, empty ones are dropped, and the rest is
    joined. Null and empty markup give null.

    The usual character references are replaced inside the JVM. Of the others only the
    references travel to Python, never the texts around them. Each step is a column of
    its own, so that none is computed twice.
    """
    flat, rare = F.col("_flat"), F.col("_rare")
    between = F.transform(F.split(flat, _RARE_ENTITY, -1), _decode_plain)
    # One more text than references.
    parts = F.zip_with(between, rare, lambda text, found: F.concat(text, F.coalesce(found, F.lit(""))))
    nodes = F.split(F.array_join(parts, ""), _CUT)
    kept = F.filter(F.transform(nodes, strip), lambda node: node != "")
    return (
        df.withColumn("_flat", F.when(F.col(markup) != "", _without_markup(F.col(markup))))
        .withColumn("_rare", _unescape(F.regexp_extract_all(flat, F.lit(_RARE_ENTITY), F.lit(0))))
        .withColumn(name, F.array_join(kept, separator))
        .drop("_flat", "_rare")
    )


def newline_normalised(text: Column) -> Column:
    """Line ends as text-mode reading gives them."""
    return F.regexp_replace(text, r"\r\n?", "\n")
