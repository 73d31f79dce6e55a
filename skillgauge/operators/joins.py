"""Joins of a large side, whose keys may be very unevenly used, with a lookup."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup of at most this many short rows is sent to every executor.
LOOKUP_ROWS = 100_000
SALTS = 32
# A key with more rows than this is hot; so many are looked for.
HOT_ROWS = 100_000
HOT_KEYS = 1_000
# Types of which equal values of both sides have equal hashes.
_HASHED = {"string", "bigint", "int", "smallint", "tinyint", "date"}


def fits(lookup: DataFrame, rows: int = LOOKUP_ROWS) -> bool:
    """Count the lookup, reading no more than ``rows`` + 1 of its rows."""
    return lookup.limit(rows + 1).count() <= rows


def hot_keys(large: DataFrame, on: list[str], rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with more than ``rows`` rows, by one sketch of bounded size.

    It tells which keys are salted, so what it misses changes the plan, not the result.
    """
    found = large.select(F.xxhash64(*on).alias("h")).agg(F.expr(f"approx_top_k(h, {HOT_KEYS}, {16 * HOT_KEYS})").alias("top")).first().top
    return [item["item"] for item in found or [] if item["count"] > rows and item["item"] is not None]


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str,
    salt_by: list[str],
    rows: int = LOOKUP_ROWS,
    read_twice: bool = False,
) -> DataFrame:
    """``large.join(lookup, on, how)`` for inner, left, semi and anti joins.

    The lookup is counted first. If it is small it is broadcast and the large
    side does not move. Otherwise each lookup row is repeated once per salt and
    the rows of a hot key go to as many tasks as there are salts; the salt is a
    hash of ``salt_by``, so a task that is run again draws the same one. Both sides are
    then shuffled and sorted: the planner knows neither the real size of the lookup nor
    that it is repeated, and would broadcast it at any size.

    ``read_twice`` says that the large side is cheap to read. It is then read once more
    for its hot keys, and only those, and keys with a null, are salted: other lookup rows
    are not repeated.
    """
    if fits(lookup, rows):
        return large.join(F.broadcast(lookup), on, how)
    salt, last = F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"), F.lit(SALTS - 1)
    kinds = [(dict(large.dtypes)[key], dict(lookup.dtypes)[key]) for key in on]
    if read_twice and all(one == other and one in _HASHED for one, other in kinds):
        hot: Column = F.xxhash64(*on).isin(hot_keys(large, on))
        null = reduce(Column.__or__, [F.col(key).isNull() for key in on])
        salt, last = F.when(hot | null, salt).otherwise(0), F.when(hot, last).otherwise(0)
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    joined = large.withColumn("_salt", salt).join(repeated.hint("merge"), [*on, "_salt"], how)
    return joined.drop("_salt")
