"""Row rules that the tables enforce, and counts of what happened to rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.dates import posted_date
from skillgauge.operators.merge import DUPLICATE, FAILED, INSERTED


def too_wide(name: str, width: int) -> Column:
    """Blanks past the width do not count: they are cut off when stored."""
    return F.length(F.rtrim(name)) > width


def bad_date(name: str) -> Column:
    return F.col(name).isNotNull() & posted_date(F.col(name)).isNull()


def row_errors(
    rows: DataFrame,
    widths: dict[str, int],
    required: list[str] = (),
    dates: list[str] = (),
) -> DataFrame:
    """``rows`` with ``error_reason``: the first broken rule, or null.

    Rules in order: required columns, widths, NUL characters, dates held as text.
    """
    nul = "\u0000"
    rules = [(F.col(c).isNull(), f"missing:{c}") for c in required]
    rules += [(too_wide(c, w), f"too_long:{c}") for c, w in widths.items()]
    rules += [
        (F.col(c).contains(nul), f"nul:{c}")
        for c, kind in rows.dtypes
        if kind == "string"
    ]
    rules += [(bad_date(c), f"bad_date:{c}") for c in dates]
    return rows.withColumn(
        "error_reason",
        F.coalesce(*[F.when(broken, F.lit(name)) for broken, name in rules]),
    )


def stored_values(
    rows: DataFrame, widths: dict[str, int], dates: list[str] = ()
) -> DataFrame:
    """Valid rows as the table keeps them: cut to width, dates as dates."""
    cut = {c: F.substring(c, 1, w) for c, w in widths.items()}
    parsed = {c: posted_date(F.col(c)) for c in dates}
    return rows.withColumns({**cut, **parsed})


def parse_metrics(parsed: DataFrame, key: str = "job_source_id") -> DataFrame:
    """One row: files, saved, duplicates, failed.

    Counts copies from sizes of keys and needs no per-row status.
    """
    keys = parsed.groupBy(
        F.col("error_reason").isNotNull().alias("failed"), key
    ).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    failed = F.coalesce(F.sum(F.when(F.col("failed"), F.col("n"))), F.lit(0))
    saved = F.count_if(~F.col("failed"))
    return keys.agg(
        total.alias("files"),
        saved.alias("saved"),
        (total - failed - saved).alias("duplicates"),
        failed.alias("failed"),
    )


def status_counts() -> list[Column]:
    """Aggregates over pair outcomes: inserted, duplicates, failed, total input rows."""

    def rows_with(value):
        picked = F.when(F.col("status") == value, F.col("n_rows"))
        return F.coalesce(F.sum(picked), F.lit(0).cast("long"))

    return [
        rows_with(INSERTED).alias("inserted"),
        rows_with(DUPLICATE).alias("duplicates"),
        rows_with(FAILED).alias("failed"),
        F.coalesce(F.sum("n_rows"), F.lit(0).cast("long")).alias("total"),
    ]


def load_summary(status: DataFrame) -> DataFrame:
    """One row: inserted, duplicates, failed, total, over the input rows."""
    return status.agg(*status_counts())


def jobs_load_summary(checked: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: inserted, failed, total. Rows whose key exists are in neither."""
    given = checked.select(
        F.lit(False).alias("inserted"),
        F.col("error_reason").isNotNull().alias("failed"),
        F.lit(True).alias("total"),
    )
    added = inserted.select(
        F.lit(True).alias("inserted"),
        F.lit(False).alias("failed"),
        F.lit(False).alias("total"),
    )
    return given.unionAll(added).agg(
        *[F.count_if(c).alias(c) for c in ("inserted", "failed", "total")]
    )
