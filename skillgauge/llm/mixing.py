"""Mix sources to target weights by cutting hash-random orders at exact budgets.

Each document gets a key from a hash. Within a source, keys are dealt into ranges,
the ranges' token counts are summed up, and only the range in which the budget ends
is looked at row by row. So every row needs only its source's cut: texts are not
shuffled, and a source with most of the rows is no larger a group than any other.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; a source of size 0 has target 0; rows that share the key at which a
budget ends (equal ids) share what is left in proportion to their sizes; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


@dataclass(frozen=True)
class MixRule:
    """Weights are given to the sources in order, over and over.

    ``share`` of all tokens is dealt out by weight; no source gets more than
    ``repeat`` times its own tokens.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: tuple[int, int] = (3, 2)
    repeat: int = 2
    seed: str = "mix"


def source_targets(sized: DataFrame, rule: MixRule) -> DataFrame:
    """One row per source: ``source``, ``n``, ``source_size``, ``target``.

    ``sized`` holds ``source`` and ``size``. What a capped source leaves is dealt
    out again by weight; each round is one aggregate over the sources.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, rule.weights)), (F.col("place") % len(rule.weights) + 1).cast("int")
    )
    sources = (
        sized.groupBy("source")
        .agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(place) - 1)
        .withColumn("weight", weight.cast("long"))
        .drop("place")
    )
    up, down = rule.share
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, cap = F.lit(0.0), F.col("source_size") * float(rule.repeat)
    spent = -1
    while True:
        is_capped = F.lit(False) if spent < 0 else level > cap
        row = sources.agg(
            F.sum(F.when(is_capped, F.col("source_size")).otherwise(0)),
            F.sum(F.when(is_capped, 0).otherwise(F.col("weight"))),
            F.count(F.when(is_capped, 1)),
        ).first()
        capped, weights, count = (value or 0 for value in row)
        if count == spent or not weights:
            break
        spent = count
        left = up * total - rule.repeat * down * capped
        level = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(down * weights))
    return sources.withColumn("target", F.least(level, cap)).drop("weight")


def source_cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds to ``targets`` where the last, partial epoch of each source ends.

    ``epochs`` whole passes; then keys below ``cut_key`` once more, and of the
    rows at it (``cut_size`` tokens together) ``cut_rest`` tokens.
    """
    budget = F.floor("target").cast("long")
    plan = targets.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    ranges = F.ceil(F.sqrt("n"))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    bucket = F.floor(place * ranges / F.lit(2.0**32)).cast("long")
    at = plan.withColumnRenamed("source", "at")
    dealt = sized.join(at, F.col("source").eqNullSafe(F.col("at"))).select(
        "source", "key", "size", "rest", bucket.alias("bucket")
    )
    running = Window.partitionBy("source").rowsBetween(Window.unboundedPreceding, 0)
    ends_here = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("part"))

    def before(order: str) -> Column:
        return F.sum("part").over(running.orderBy(order)) - F.col("part")

    bucket_at = (
        dealt.groupBy("source", "bucket")
        .agg(F.sum("size").alias("part"), F.first("rest").alias("rest"))
        .withColumn("before", before("bucket"))
        .where(ends_here)
        .select(F.col("source").alias("at"), F.col("bucket").alias("at_bucket"), (F.col("rest") - F.col("before")).alias("rest"))
    )
    key_at = (
        dealt.drop("rest")
        .join(bucket_at, F.col("source").eqNullSafe(F.col("at")) & (F.col("bucket") == F.col("at_bucket")))
        .groupBy("source", "key")
        .agg(F.sum("size").alias("part"), F.first("rest").alias("rest"))
        .withColumn("before", before("key"))
        .where(ends_here)
        .select(
            F.col("source").alias("at"),
            F.col("key").alias("cut_key"),
            F.col("part").alias("cut_size"),
            (F.col("rest") - F.col("before")).alias("cut_rest"),
        )
    )
    return plan.join(key_at, F.col("source").eqNullSafe(F.col("at")), "left").drop("rest", "at", "n")


def taken_tokens(prefix: str = "") -> tuple[Column, Column]:
    """Tokens of a row's last, partial pass, and of all its passes."""
    size, key, cut_key, cut_size, cut_rest, epochs = (
        F.col(prefix + name) for name in ("size", "key", "cut_key", "cut_size", "cut_rest", "epochs")
    )
    at_cut = F.floor(size * cut_rest / cut_size).cast("long")
    part = F.when(key < cut_key, size).when(key == cut_key, at_cut).otherwise(F.lit(0))
    return part, epochs * size + part


def mix(docs: DataFrame, rule: MixRule, stored: str) -> DataFrame:
    """Per document ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    The narrow table of sizes is kept at ``stored``, so texts are read once.
    """
    spark = docs.sparkSession
    docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), rule.seed).alias("key"),
    ).write.parquet(stored)
    sized = spark.read.parquet(stored)
    cuts = source_cuts(sized, source_targets(sized, rule)).withColumnRenamed("source", "at")
    joined = sized.join(cuts, F.col("source").eqNullSafe(F.col("at")))
    return joined.select("doc_id", "size", "source_size", "target", taken_tokens()[1].alias("taken"))


OWN = "__mix_"


def apply_mix(docs: DataFrame, rule: MixRule, stored: str) -> DataFrame:
    """The mixed rows: whole copies for whole epochs, a cut text where a budget ends.

    Columns and their order stay, whatever they are called, but for names that start
    with ``__mix_``, which are refused; ``n_chars`` follows the text where there is
    one. A text cut after word *k* keeps its characters up to there.
    """
    if taken := [name for name in docs.columns if name.lower().startswith(OWN)]:
        raise ValueError(f"columns {taken} have names that the mix uses itself")
    spark = docs.sparkSession
    size, key = word_count(F.col("text")), random_key(F.col("doc_id"), rule.seed)
    docs.select("source", size.alias("size"), key.alias("key")).write.parquet(stored)
    sized = spark.read.parquet(stored)
    cuts = source_cuts(sized, source_targets(sized, rule))
    cuts = cuts.select([F.col(name).alias(OWN + name) for name in cuts.columns])
    part, epochs = F.col(f"{OWN}part"), F.col(f"{OWN}epochs")
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    words = F.slice(pieces, F.lit(1), F.greatest(part, F.lit(1)).cast("int"))
    cut_text = F.when(part == F.col(f"{OWN}size"), F.col("text")).otherwise(F.array_join(words, ""))
    copies = F.array_repeat(F.col("text"), epochs.cast("int"))
    texts = F.when(part > 0, F.array_append(copies, cut_text)).otherwise(copies)
    mixed = (
        docs.withColumn(f"{OWN}size", size)
        .withColumn(f"{OWN}key", key)
        .join(cuts, F.col("source").eqNullSafe(F.col(f"{OWN}source")))
        .withColumn(f"{OWN}part", taken_tokens(OWN)[0])
        .withColumn("text", F.explode(texts))
    )
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast("long"))
    return mixed.select(*docs.columns)
