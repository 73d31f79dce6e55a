"""Records read from page elements, for pages without JSON-LD.

Elements nest, which column expressions cannot follow, so one small tag walker
runs per page inside Arrow batches. Spark splits and spreads the pages.
"""

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skillgauge.operators.extract import JOB_PAGE, SOURCE

_VOID = set(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CODE = {"script", "style", "template"}

# What a listing card gets where it states nothing itself.
UNKNOWN_TITLE = "Unknown"
TO_BE_FILLED = "TBD"
LISTING_LOCATION = "Argentina"


class _Element:
    """Text nodes seen while one element is open."""

    def __init__(self, attrs: dict):
        self.attrs = attrs
        self.nodes: list[str] = []
        self.inner: dict[str, _Element] = {}

    def joined(self) -> str:
        return "".join(self.nodes)

    def squeezed(self) -> str:
        return "".join(node.strip() for node in self.nodes)


class _Walker(HTMLParser):
    """Calls ``match`` for each opening tag and fills the element it returns
    with the text up to the matching closing tag."""

    def __init__(self, match):
        super().__init__(convert_charrefs=True)
        self._match = match
        self._open: list[tuple[str, _Element | None]] = []
        self._text: list[str] = []

    def _end_node(self):
        node = "".join(self._text)
        self._text = []
        if node and not any(tag in _CODE for tag, _ in self._open):
            for _, element in self._open:
                if element is not None:
                    element.nodes.append(node)

    def handle_starttag(self, tag, attrs):
        self._end_node()
        inside = [element for _, element in self._open if element is not None]
        element = self._match(tag, dict(attrs), inside)
        if tag not in _VOID:
            self._open.append((tag, element))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_node()
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == tag:
                del self._open[depth:]
                break

    def handle_data(self, data):
        self._text.append(data)

    def handle_comment(self, data):
        self._end_node()

    def handle_decl(self, decl):
        self._end_node()

    def handle_pi(self, data):
        self._end_node()

    def walk(self, html: str):
        self.feed(html)
        self.close()
        self._end_node()


def _posting_part(tag: str, attrs: dict) -> str | None:
    if tag == "h1":
        return "job_title"
    if tag == "a" and attrs.get("data-company-name") == "true":
        return "company_name"
    if tag == "div" and attrs.get("id") == "jobDescriptionText":
        return "job_description"
    if tag == "div" and attrs.get("data-testid") == "inlineHeader-companyLocation":
        return "location"
    return None


def _read_posting(html: str) -> dict:
    found: dict[str, _Element] = {}

    def match(tag, attrs, inside):
        part = _posting_part(tag, attrs)
        if part is None or part in found:
            return None
        found[part] = _Element(attrs)
        return found[part]

    _Walker(match).walk(html)
    texts = {
        part: (
            element.squeezed()
            if part in ("job_title", "job_description")
            else element.joined().strip()
        )
        for part, element in found.items()
    }
    return {part: texts.get(part) for part in _POSTING_PARTS}


_POSTING_PARTS = ["job_title", "company_name", "location", "job_description"]
_POSTING_HINT = (
    "(?i)<h1|jobDescriptionText|data-company-name|inlineHeader-companyLocation"
)


@F.pandas_udf(StructType([StructField(p, StringType()) for p in _POSTING_PARTS]))
def _posting_fields(pages: pd.Series) -> pd.DataFrame:
    empty = dict.fromkeys(_POSTING_PARTS)
    return pd.DataFrame(
        [empty if html is None else _read_posting(html) for html in pages],
        columns=_POSTING_PARTS,
    )


def parse_selectors(pages: DataFrame, source: str = SOURCE) -> DataFrame:
    """Legacy record of each saved posting page; absent elements are null.

    Pages that hold none of the elements are not sent to Python.
    """
    hinted: Column = F.when(F.col("html").rlike(_POSTING_HINT), F.col("html"))
    read = pages.select(
        "file_name",
        F.col("html").isNull().alias("_unread"),
        _posting_fields(hinted).alias("f"),
    )
    # The address keeps the whole stem: this reader knows no "jk=" names.
    stem = F.replace(
        F.replace("file_name", F.lit("job_"), F.lit("")), F.lit(".html"), F.lit("")
    )
    return read.select(
        "file_name",
        F.lit(source).alias("source"),
        "f.job_title",
        "f.company_name",
        "f.location",
        F.concat(F.lit("https://" + JOB_PAGE), stem).alias("job_url"),
        "f.job_description",
        F.lit(None).cast("date").alias("posted_date"),
        F.lit(None).cast("string").alias("job_type"),
        F.when(F.col("_unread"), "bad_encoding").alias("error_reason"),
    )


def _read_cards(html: str) -> list[tuple]:
    cards: list[_Element] = []

    def match(tag, attrs, inside):
        if "data-jk" in attrs:
            card = _Element(attrs)
            cards.append(card)
            return card
        if tag == "span" and "jobTitle" in (attrs.get("id") or ""):
            untitled = [card for card in inside if "title" not in card.inner]
            title = _Element(attrs)
            for card in untitled:
                card.inner["title"] = title
            return title if untitled else None
        return None

    _Walker(match).walk(html)
    return [
        (
            card.attrs["data-jk"],
            card.inner["title"].joined() if "title" in card.inner else None,
            card.attrs.get("href"),
        )
        for card in cards
    ]


def _cards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["file_name", "card_no", "job_id", "job_title", "job_url"]
    for batch in batches:
        rows = [
            (name, number, *card)
            for name, html in zip(batch["file_name"], batch["html"])
            for number, card in enumerate(_read_cards(html))
        ]
        yield pd.DataFrame(rows, columns=columns)


def parse_listing(
    pages: DataFrame, scraped_date: Column, source: str = SOURCE
) -> DataFrame:
    """One row per job card of each stored listing page."""
    carded = pages.filter(F.col("html").contains("data-jk"))
    cards = carded.select("file_name", "html").mapInPandas(
        _cards,
        "file_name string, card_no int, job_id string, job_title string, "
        "job_url string",
    )
    return cards.select(
        "file_name",
        "card_no",
        F.lit(source).alias("source"),
        "job_id",
        F.coalesce("job_title", F.lit(UNKNOWN_TITLE)).alias("job_title"),
        "job_url",
        F.lit(TO_BE_FILLED).alias("company_name"),
        F.lit(LISTING_LOCATION).alias("location"),
        F.lit(TO_BE_FILLED).alias("job_description"),
        F.lit(None).cast("date").alias("posted_date"),
        F.lit(None).cast("string").alias("job_type"),
        scraped_date.cast("date").alias("scraped_date"),
    )
