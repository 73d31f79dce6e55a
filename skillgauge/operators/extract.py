"""Posting pages with embedded JSON-LD -> job records.

No row raises: a page that cannot be read keeps its file name and gets an
``error_reason``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.dates import posted_date
from skillgauge.functions.text import with_html_text

# They decide which block, id and address a page yields.
SOURCE = "indeed"
JSON_LD = r'(?s)<script type="application/ld\+json">(\{.*?\})</script>'
SOURCE_ID = r"jk=([a-f0-9]+)"
JOB_PAGE = "indeed.com/viewjob?jk="

RECORD = [
    "source",
    "job_source_id",
    "country",
    "job_title",
    "company_name",
    "job_url",
    "job_description",
    "posted_date",
]


def source_id(file_name: Column) -> Column:
    """Id of a posting, from the name its page was saved under."""
    name = F.replace(file_name, F.lit(".html"), F.lit(""))
    return F.coalesce(
        F.nullif(F.regexp_extract(name, SOURCE_ID, 1), F.lit("")),
        F.replace(name, F.lit("job_"), F.lit("")),
    )


def job_url(country: Column, job_id: Column) -> Column:
    host = F.when(country != "", F.concat(F.lower(country), F.lit("."))).otherwise("")
    return F.concat(F.lit("https://"), host, F.lit(JOB_PAGE), job_id)


def _kind(path: str) -> Column:
    """Type name of a JSON branch; null if the branch is absent."""
    return F.schema_of_variant(F.try_variant_get("_json", path, "variant"))


def _text(path: str) -> Column:
    return F.try_variant_get("_json", path, "string")


def _odd(kind: Column, *allowed: str) -> Column:
    """A branch is there and is none of the allowed types."""
    name = F.regexp_extract(kind, r"^\w+", 0)
    return kind.isNotNull() & ~name.isin(*allowed)


def parse_postings(pages: DataFrame, source: str = SOURCE) -> DataFrame:
    """One record per page: ``file_name``, the eight record columns and
    ``error_reason``.

    ``pages`` holds ``file_name`` and ``html``; a null ``html`` stands for a
    file that is not UTF-8. Narrow: nothing is shuffled. JSON in the wild repeats keys,
    of which the last one counts, so the session is told to accept them.
    """
    pages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    block = F.regexp_extract("html", JSON_LD, 1)
    read = pages.select("file_name", "html").withColumn("_block", block)
    read = read.withColumn("_json", F.try_parse_json("_block"))

    scalar = ["STRING", "BIGINT", "DECIMAL", "DOUBLE", "BOOLEAN", "VOID"]
    misshapen = (
        _odd(_kind("$.jobLocation"), "OBJECT")
        | _odd(_kind("$.jobLocation.address"), "OBJECT")
        | _odd(_kind("$.jobLocation.address.addressCountry"), "STRING", "VOID")
        | _odd(_kind("$.hiringOrganization"), "OBJECT")
        | _odd(_kind("$.hiringOrganization.name"), *scalar)
        | _odd(_kind("$.title"), *scalar)
        | _odd(_kind("$.description"), "STRING", "VOID")
    )
    error = (
        F.when(F.col("html").isNull(), "bad_encoding")
        .when(F.col("_block") == "", "no_json_ld")
        .when(F.col("_json").isNull(), "bad_json")
        .when(misshapen, "bad_shape")
        .when(_odd(_kind("$.datePosted"), "STRING", "VOID"), "bad_date")
    )
    fields = read.select(
        "file_name",
        error.alias("error_reason"),
        source_id(F.col("file_name")).alias("job_source_id"),
        _text("$.jobLocation.address.addressCountry").alias("country"),
        _text("$.title").alias("job_title"),
        _text("$.hiringOrganization.name").alias("company_name"),
        _text("$.description").alias("_description"),
        F.nullif(_text("$.datePosted"), F.lit("")).alias("_posted"),
    )
    fields = with_html_text(fields, "_description", "job_description")
    record = fields.select(
        "file_name",
        "error_reason",
        F.lit(source).alias("source"),
        "job_source_id",
        "country",
        "job_title",
        "company_name",
        job_url(F.col("country"), F.col("job_source_id")).alias("job_url"),
        "job_description",
        # Text that is no date goes on as it is and fails when it is loaded.
        F.coalesce(
            posted_date(F.col("_posted")).cast("string"), F.col("_posted")
        ).alias("posted_date"),
    )
    good = F.col("error_reason").isNull()
    return record.select(
        "file_name",
        *[F.when(good, F.col(name)).alias(name) for name in RECORD],
        "error_reason",
    )


def split_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason column, and the rejected rows."""
    good = parsed.filter(F.col("error_reason").isNull()).drop("error_reason")
    return good, parsed.filter(F.col("error_reason").isNotNull())
