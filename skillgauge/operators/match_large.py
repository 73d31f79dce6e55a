"""Matching for catalogs with too many names for one pattern.

Texts are cut into words and single other characters. Every run of such pieces
that is shaped like some catalog name is looked up in the catalog. Hits of several
pieces are resolved per text, from left to right and longest first; a hit of one
piece then counts unless an accepted longer one covers it. (A hit of one piece
cannot rule out a longer one: one that starts there is preferred, and one that
starts before is decided before.)
"""

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from skillgauge.functions.text import WORD
from skillgauge.operators.catalog import surfaces
from skillgauge.operators.joins import lookup_join

_PIECE = rf"[{WORD}]+|[^{WORD}]"


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s){_PIECE}"), F.lit(0))


def _fold(text: Column) -> Column:
    """Key under which texts that differ only in case meet. Upper before lower
    also joins the long s and the Kelvin sign with their plain letters."""
    upper = F.replace(F.upper(text), F.lit("İ"), F.lit("I"))
    return F.lower(F.replace(upper, F.lit("ẞ"), F.lit("SS")))


def _is_word(piece: Column) -> Column:
    return F.coalesce(piece.rlike(f"^[{WORD}]"), F.lit(False))


def _runs(shape: Row) -> Column:
    """Runs of ``pieces`` with the length and the edges of one shape of name."""
    length = shape.n_pieces
    last = F.size("pieces") - length + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
        F.array().cast("array<int>")
    )

    def word_at(position):
        return F.try_element_at("is_word", position)

    def fits(start):
        end = start + length
        ok = (word_at(start) == F.lit(shape.word_first)) & (
            word_at(end - 1) == F.lit(shape.word_last)
        )
        # Pieces are whole words, so a word edge needs no test; any other edge
        # must touch a word.
        if not shape.word_first:
            ok = ok & (start > 1) & word_at(F.greatest(start - 1, F.lit(1)))
        if not shape.word_last:
            ok = ok & F.coalesce(word_at(end), F.lit(False))
        return ok

    def run(start):
        if length == 1:
            text = F.element_at("pieces", start)
        else:
            text = F.array_join(F.slice("pieces", start, length), "")
        return F.struct(
            start.alias("start"), (start + length).alias("end"), text.alias("text")
        )

    return F.transform(F.filter(starts, fits), run)


def _leftmost_longest(hits: Column) -> Column:
    """The hits of one text that do not overlap an earlier one."""
    ordered = F.array_sort(hits)
    no_hits = F.filter(ordered, lambda hit: F.lit(False))
    nothing = F.struct(F.lit(0).alias("end"), no_hits.alias("kept"))

    def take(state, hit):
        return F.when(
            hit["start"] >= state["end"],
            F.struct(
                hit["end"].alias("end"), F.array_append(state["kept"], hit).alias("kept")
            ),
        ).otherwise(state)

    return F.aggregate(ordered, nothing, take, lambda state: state["kept"])


# Two hashes tell rows apart, also such as share an id. Equal rows share both; they
# are matched as one, and counted, so that each gets its pairs.
_ROW = ["row_a", "row_b"]
_JOB = [*_ROW, "job_id", "job_title"]


def _hits(cut: DataFrame, shapes: list[Row], keys: DataFrame) -> DataFrame:
    """Runs that are catalog names, with the name each stands for."""
    runs = (
        cut.select(*_JOB, F.explode(F.concat(*[_runs(s) for s in shapes])).alias("run"))
        .select(*_JOB, "run.*")
        .withColumn("fold", _fold(F.col("text")))
        .withColumn("chars", F.length("text"))
    )
    found = lookup_join(runs, keys, ["fold", "chars"], "inner", [*_ROW, "start"])
    spelled = F.filter("spellings", lambda s: s["lower"] == F.lower("text"))
    skill = F.coalesce(F.try_element_at(spelled, F.lit(1))["skill_name"], "text")
    return found.select(*_JOB, "start", "end", skill.alias("skill_name"))


def _resolved(hits: DataFrame) -> DataFrame:
    """Hits that no earlier or longer one covers.

    Overlapping hits form islands, found by a running maximum, and only an island is
    folded: work grows with the number of hits, however many a text has.
    """
    order = Window.partitionBy(*_JOB).orderBy("start", F.desc("end"))
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= before, F.lit(True)).cast("long")
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    hit = F.struct("start", (-F.col("end")).alias("minus_end"), "end", "skill_name")
    return (
        hits.withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy(*_JOB, "island")
        .agg(_leftmost_longest(F.collect_set(hit)).alias("accepted"))
        .select(*_JOB, F.explode("accepted.skill_name").alias("skill_name"))
    )


# Most copies of a row that one row of the count stands for.
_COPIES = 10_000


def _for_each_row(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """Each skill once per job row: equal rows get the same skills each.

    Skills and copies meet in one shuffle, folded before it: a row of ``cut`` brings
    a one and no skill.
    """
    one = cut.select(*_JOB, F.lit(None).cast("string").alias("skill_name"), F.lit(1).alias("n"))
    rows = (
        pairs.select(*_JOB, "skill_name", F.lit(0).alias("n"))
        .unionByName(one)
        .groupBy(*_JOB)
        .agg(F.collect_set("skill_name").alias("skills"), F.sum("n").alias("n"))
    )
    # Copies are laid out in two steps, so that no array is as long as their number.
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_COPIES).cast("long")))
    part = F.least(F.lit(_COPIES).cast("long"), F.col("n") - F.col("first")).cast("int")
    return (
        rows.filter(F.size("skills") > 0)
        .withColumn("first", first)
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), part)))
        .select("job_id", "job_title", F.explode("skills").alias("skill_name"))
    )


def match_by_grams(
    jobs: DataFrame, catalog: DataFrame, match_variants: bool = False
) -> DataFrame:
    """Same result as the pattern method of ``match_pairs``, also for equal rows.

    Texts never move. Only hits that overlap are collected. The catalog is broadcast when
    it is small enough and is otherwise joined with salts, as common words are hot
    keys.
    """
    names = surfaces(catalog, match_variants).select(
        _fold(F.col("surface")).alias("fold"),
        F.length("surface").alias("chars"),
        "lower",
        "skill_name",
        "searched",
        F.size(_pieces(F.col("surface"))).alias("n_pieces"),
        _is_word(F.substring("surface", 1, 1)).alias("word_first"),
        _is_word(F.expr("right(surface, 1)")).alias("word_last"),
    )
    # A name has at most 100 characters and two kinds of edge on each side.
    shapes = (
        names.filter("searched")
        .select("n_pieces", "word_first", "word_last")
        .distinct()
        .collect()
    )
    if not shapes:
        return jobs.select(
            "job_id", "job_title", F.lit(None).cast("string").alias("skill_name")
        ).limit(0)
    # One entry per key; the spellings of one key differ in case only.
    keys = (
        names.groupBy("fold", "chars")
        .agg(
            F.bool_or("searched").alias("searched"),
            F.collect_list(F.struct("lower", "skill_name")).alias("spellings"),
        )
        .filter("searched")
        .drop("searched")
    )
    # A hash passes over nulls, so it is told where they are.
    text = ["job_id", "job_title", "job_description"]
    text += [F.col(c).isNull() for c in ("job_id", "job_title")]
    cut = jobs.select(
        F.xxhash64(*text).alias("row_a"),
        F.xxhash64(*reversed(text)).alias("row_b"),
        "job_id",
        "job_title",
        _pieces(F.col("job_description")).alias("pieces"),
    ).withColumn("is_word", F.transform("pieces", _is_word))

    hits = _hits(cut, shapes, keys)
    # Names of one piece cannot overlap one another.
    if any(shape.n_pieces > 1 for shape in shapes):
        hits = _resolved(hits)
    return _for_each_row(hits.select(*_JOB, "skill_name"), cut)
