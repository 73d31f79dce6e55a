"""An inverted index over job texts, and search that skips blocks by their bounds.

Jobs are dealt into blocks by a hash of their id. The index has one row for each word
and block, with the postings and the most often the word occurs in one job of the
block. A search reads the bounds of its words first. A few best blocks give a score
that the k best reach; then only blocks whose bound reaches it are opened. Counts of
words come from the bounds, so texts are not read again.

A job matches if it holds all words of the search; its score is the sum of each word's
occurrences times the logarithm of all jobs over the jobs with the word.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.text import WORD

INDEX = "word string, block int, n int, best int, postings array<struct<job_id:string,tf:int>>"
#: Blocks that are searched first.
FIRST = 8


def word_lists(texts: DataFrame, *kept: str) -> DataFrame:
    """``job_id`` and the lower-case words of its text, and the columns ``kept``. Narrow."""
    words = F.regexp_extract_all(F.lower("job_description"), F.lit(f"[{WORD}]+"), F.lit(0))
    return texts.select(*kept, "job_id", words.alias("words"))


def build_index(texts: DataFrame, blocks: int) -> DataFrame:
    """Index rows of a load of jobs (job_id, job_description), each id once.

    Texts are shuffled once, by block; words are counted and collected where they then
    are, so neither words nor postings move. A block of a word that every job holds has
    as many postings as the block has jobs.
    """
    block = F.pmod(F.xxhash64("job_id"), F.lit(blocks)).cast("int")
    # A task for each block; put together, blocks would need the memory of several.
    dealt = texts.select("job_id", "job_description", block.alias("block")).repartitionById(blocks, F.col("block"))
    words = word_lists(dealt, "block").select("block", "job_id", F.explode("words").alias("word"))
    counted = words.groupBy("block", "job_id", "word").agg(F.count("*").cast("int").alias("tf"))
    rows = counted.groupBy("word", "block").agg(
        F.count("*").cast("int").alias("n"),
        F.max("tf").alias("best"),
        F.collect_list(F.struct("job_id", "tf")).alias("postings"),
    )
    # Rows of a word lie together in each file, so a search opens few row groups.
    return rows.sortWithinPartitions("word", "block")


def _weights(index: DataFrame, words: list[str], n_jobs: int) -> dict[str, float] | None:
    """Each word's weight; None if one of them occurs nowhere."""
    import math

    found = index.where(F.col("word").isin(words)).groupBy("word").agg(F.sum("n").alias("df")).collect()
    if len(found) < len(words):
        return None
    return {row.word: math.log(n_jobs / row.df) for row in found}


def _scored(index: DataFrame, words: list[str], weight: Column) -> DataFrame:
    """Scores of the jobs that hold all words."""
    hits = index.select("word", F.inline("postings"))
    return hits.groupBy("job_id").agg(
        F.count("*").alias("n"), F.sum(F.col("tf") * weight).alias("score")
    ).where(F.col("n") == len(words)).select("job_id", "score")


def search(index: DataFrame, words: list[str], n_jobs: int, k: int, blocks: int) -> DataFrame:
    """The k best jobs for the words: ``job_id``, ``score``; equal scores by id.

    ``blocks`` is the number the index was built with. The driver gets one row for each
    word and one score.
    """
    spark = index.sparkSession
    words = sorted({word.lower() for word in words})
    empty = spark.createDataFrame([], "job_id string, score double")
    weights = _weights(index, words, n_jobs) if words and n_jobs else None
    if weights is None:
        return empty
    pairs = [x for word, value in weights.items() for x in (F.lit(word), F.lit(value))]
    weight = F.element_at(F.create_map(*pairs), F.col("word"))
    rows = index.where(F.col("word").isin(words))
    bounds = rows.select("word", "block", "best").groupBy("block").agg(
        F.count("*").alias("n_words"), F.sum(F.col("best") * weight).alias("bound")
    ).where(F.col("n_words") == len(words)).select("block", "bound")

    def best_of(chosen: DataFrame) -> DataFrame:
        # At most one short row for each block.
        opened = rows.join(F.broadcast(chosen.select("block")), "block", "left_semi")
        return _scored(opened, words, weight).orderBy(F.desc("score"), "job_id").limit(k)

    first = best_of(bounds.orderBy(F.desc("bound"), "block").limit(FIRST))
    reached = first.agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    # Sums of doubles may differ in their last digits by order.
    least = reached.least * (1 - 1e-9) if reached.n == k else float("-inf")
    return best_of(bounds.where(F.col("bound") >= F.lit(least)))
