"""The skill catalog: upsert, defaults and the spellings searched for."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.ids import stable_id


def _or_empty(column: Column) -> Column:
    return F.coalesce(column, F.array().cast("array<string>"))


def with_catalog_defaults(catalog: DataFrame) -> DataFrame:
    """Missing tags and variants become empty arrays."""
    if "variants" not in catalog.columns:
        catalog = catalog.withColumn("variants", F.lit(None).cast("array<string>"))
    return catalog.withColumns(
        {name: _or_empty(F.col(name)) for name in ("tags", "variants")}
    )


def upsert_catalog(target: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """Insert new skills; for known names replace category, tags and creation
    time, and keep the id and the variants the batch does not state.

    A name that occurs twice in the batch makes the job fail, as the statement
    would on a table with a unique name.
    """
    columns = [c for c in ("category", "tags", "variants") if c in batch.columns]
    once = (
        batch.groupBy("skill_name")
        .agg(F.first(F.struct(*columns)).alias("new"), F.count("*").alias("copies"))
        .select(
            "skill_name",
            F.when(
                F.col("copies") > 1,
                F.raise_error(
                    F.concat(F.lit("skill twice in batch: "), F.col("skill_name"))
                ).cast("boolean"),
            )
            .otherwise(F.lit(True))
            .alias("in_batch"),
            "new",
        )
    )
    old = with_catalog_defaults(target).alias("old")
    both = old.join(once, "skill_name", "full_outer")

    def newer(name):
        if name not in columns:
            return F.col(name)
        return F.when(F.col("in_batch"), F.col(f"new.{name}")).otherwise(F.col(name))

    variants = newer("variants")
    if "variants" in columns:
        variants = F.when(F.size("new.variants") > 0, F.col("new.variants")).otherwise(
            F.col("variants")
        )
    return both.select(
        F.coalesce("skill_id", stable_id(F.col("skill_name"))).alias("skill_id"),
        "skill_name",
        newer("category").alias("category"),
        _or_empty(newer("tags")).alias("tags"),
        _or_empty(variants).alias("variants"),
        F.when(F.col("in_batch"), now.cast("timestamp_ntz"))
        .otherwise(F.col("created_at"))
        .alias("created_at"),
    )


def surfaces(catalog: DataFrame, match_variants: bool = False) -> DataFrame:
    """One row per lower-case spelling: the skill it stands for and whether it is
    searched in texts. A name goes before a variant of another skill."""
    skills = with_catalog_defaults(catalog).filter(F.length("skill_name") > 0)
    spelled = skills.select(
        "skill_name",
        F.explode(
            F.concat(
                F.array(F.struct(F.col("skill_name").alias("text"), F.lit(0).alias("rank"))),
                F.transform(
                    F.array_compact("variants"),
                    lambda v: F.struct(v.alias("text"), F.lit(1).alias("rank")),
                ),
            )
        ).alias("s"),
    ).filter(F.length("s.text") > 0)
    # Of several skills with one spelling, the last in catalog order counts:
    # longest name first, then by name.
    order = F.struct(-F.col("s.rank"), -F.length("skill_name"), F.col("skill_name"))
    return spelled.groupBy(F.lower("s.text").alias("lower")).agg(
        F.max_by("skill_name", order).alias("skill_name"),
        F.max_by("s.text", order).alias("surface"),
        (F.min("s.rank") <= F.lit(int(match_variants))).alias("searched"),
    )
