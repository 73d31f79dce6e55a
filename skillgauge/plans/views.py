"""The given tables in the roles of the stored tables.

documents are jobs, part is a second skill catalog, pages are saved pages, events
are downloads, and labels say which jobs were processed before.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.functions.ids import stable_id
from skillgauge.session import fresh_path, spread
from skillgauge.sources.seed import catalog_frame

# A small catalog whose names occur in the given texts.
TERMS = [
    ("The", "article", ["det", "common"]),
    ("of the", "phrase", ["prep", "det"]),
    ("of", "prep", ["prep", "common"]),
    ("with", "prep", ["prep"]),
    ("was", "verb", ["aux"]),
    ("for", "prep", ["prep", "common"]),
    ("rest", "noun", ["rare"]),
    ("und", "conj", ["de", "common"]),
    ("für", "prep", ["de", "prep"]),
    ("que", "conj", ["es", "fr"]),
    ("está", "verb", ["es", "aux"]),
    ("über", "prep", ["de", "rare"]),
    ("in", "prep", ["prep", "multi"]),
    ("von", "prep", ["de", "prep"]),
    ("ü", "frag", ["de"]),
]

# Names of which only the variants occur.
VARIANT_TERMS = [
    ("Zconj", "conj", ["und", "y", "and"]),
    ("Zprep", "prep", ["of", "de", "von"]),
    ("Zart", "article", ["the", "der", "la", "el"]),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows need costly work: small files are spread over all cores."""
    return spread(table(spark, sf_dir, name))


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per application to the shared folder and
    read from there by every query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = fresh_path(spark, name)
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def term_catalog(spark: SparkSession) -> DataFrame:
    return catalog_frame(spark, TERMS).withColumn(
        "skill_id", stable_id(F.col("skill_name"))
    )


def variant_catalog(spark: SparkSession) -> DataFrame:
    rows = [(name, category, ["x"], forms) for name, category, forms in VARIANT_TERMS]
    return spark.createDataFrame(
        rows,
        "skill_name string, category string, tags array<string>, "
        "variants array<string>",
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One skill per part."""
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    return part.select(
        stable_id(name).alias("skill_id"),
        name.alias("skill_name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("category"),
        F.array("p_type", F.concat(F.lit("size-"), "p_size")).alias("tags"),
        F.array().cast("array<string>").alias("variants"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        "p_size",
        "p_type",
        "p_brand",
    )


def jobs(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """Documents as jobs that are all still unprocessed."""
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"),
        "source",
        F.col("doc_id").cast("string").alias("job_source_id"),
        F.col("lang").alias("country"),
        F.concat_ws(" ", "source", "lang").alias("job_title"),
        F.col("source").alias("company_name"),
        F.col("text").alias("job_description"),
        F.lit(None).cast("timestamp_ntz").alias("skill_extraction_date"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("job_id"), "quality", "toxic"
    )


def job_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir, read=texts)


def jobs_partly_processed(
    spark: SparkSession, sf_dir: str, read=table
) -> DataFrame:
    """Jobs of which the labelled ones were processed."""
    done = labels(spark, sf_dir).select(
        "job_id",
        F.when(F.col("quality") == 1, "2024-02-01 10:30:00")
        .otherwise("2024-02-02 11:45:30")
        .cast("timestamp_ntz")
        .alias("skill_extraction_date"),
    )
    return (
        jobs(spark, sf_dir, read)
        .drop("skill_extraction_date")
        .join(done, "job_id", "left")
    )


def dated_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs with the date of the order of the same number."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.to_date("o_orderdate").alias("posted_date"),
    )
    return jobs(spark, sf_dir).join(orders, "job_id", "left")


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under the file name a browser would give them."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.concat(F.lit("job_"), url_number(F.col("url")), F.lit(".html")).alias(
            "file_name"
        ),
        "html",
    )


def url_number(url: Column) -> Column:
    return F.regexp_extract(url, r"/(\d+)", 1)


def posting_pages(docs: DataFrame, labels: DataFrame, orders: DataFrame) -> DataFrame:
    """Documents wrapped into posting pages with JSON-LD.

    The date format follows the language, the country is missing for unlabelled
    documents, and some pages are broken: no block at all (source src0),
    malformed JSON (quality 0), a list in place of the location (toxic 1).
    """
    day = orders.select(
        F.col("o_orderkey").alias("doc_id"), F.to_date("o_orderdate").alias("day")
    )
    rows = docs.join(labels, "doc_id", "left").join(day, "doc_id", "left")
    iso = F.date_format("day", "yyyy-MM-dd")
    posted = (
        F.when(F.col("lang") == "de", F.date_format("day", "dd.MM.yyyy"))
        .when(F.col("lang") == "fr", F.date_format("day", "yyyyMMdd"))
        .when(F.col("lang") == "es", F.concat(iso, F.lit("T23:00:00-03:00")))
        .otherwise(iso)
    )
    escaped = F.replace(
        F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")
    )
    description = F.concat(
        F.lit("<div><p>"),
        escaped,
        F.lit('</p><!-- <p>no --><script>var t="</p>";</script></div>'),
    )
    location = F.when(F.col("toxic") == 1, '"jobLocation":[]').when(
        F.col("toxic").isNotNull(),
        F.concat(
            F.lit('"jobLocation":{"address":{"addressCountry":"'),
            F.upper("lang"),
            F.lit('"}}'),
        ),
    ).otherwise('"jobLocation":{}')
    fields = F.to_json(
        F.struct(
            F.concat_ws(" ", "source", "lang").alias("title"),
            description.alias("description"),
            posted.alias("datePosted"),
            F.struct(F.col("source").alias("name")).alias("hiringOrganization"),
        )
    )
    block = F.concat(
        F.lit('<script type="application/ld+json">{'),
        location,
        F.lit(","),
        F.when(F.col("quality") == 0, ",").otherwise(""),
        F.substr(fields, F.lit(2)),
        F.lit("</script>"),
    )
    number = F.lower(F.hex("doc_id"))
    name = F.when(
        F.col("lang") == "en", F.concat(F.lit("job_"), number, F.lit(".html"))
    ).otherwise(F.concat(F.lit("viewjob?jk="), number, F.lit("&from=x.html")))
    return rows.select(
        name.alias("file_name"),
        F.concat(
            F.lit("<html><head>"),
            F.when(F.col("source") != "src0", block).otherwise(""),
            F.lit("</head><body></body></html>"),
        ).alias("html"),
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_pages(
        texts(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        table(spark, sf_dir, "orders"),
    )


def downloads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("package_id"), "ts", "user_id"
    )
