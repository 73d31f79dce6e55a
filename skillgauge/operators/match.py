"""Catalog skills found in job descriptions.

A match is case-insensitive, starts and ends at a word edge, and at each
position the longest name wins. Matches do not overlap.
"""

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.functions.text import WORD
from skillgauge.operators.catalog import surfaces
from skillgauge.operators.match_large import match_by_grams

# Most names that go into one pattern. A larger catalog is joined instead (see
# ``match_large``), so neither the pattern nor its lookup grows without bound.
PATTERN_NAMES = 20_000


def unprocessed(jobs: DataFrame) -> DataFrame:
    """Jobs that still wait for extraction and have a description."""
    return jobs.filter(
        F.col("skill_extraction_date").isNull() & F.col("job_description").isNotNull()
    )


def _is_word(character: str) -> bool:
    return character == "_" or character.isalnum()


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def _fold(character: str) -> str:
    """The same for all characters that equal each other when case is ignored."""
    upper = character.upper()
    return (upper if len(upper) == 1 else character).lower()[0]


def _tree(names: list[str]) -> dict:
    """Names as a prefix tree: folded character -> [character, subtree]; the key
    "" holds the edge that must follow a name ending there."""
    root: dict = {}
    for name in names:
        node = root
        for character in name:
            node = node.setdefault(_fold(character), [character, {}])[1]
        node[""] = f"(?![{WORD}])" if _is_word(name[-1]) else f"(?=[{WORD}])"
    return root


def _alternatives(node: dict) -> str:
    """Pattern for all ends below a node: going on comes before stopping, so the
    longest name is tried first."""
    branches = []
    for key, value in node.items():
        if key == "":
            continue
        text, below = value
        while len(below) == 1 and "" not in below:
            ((character, below),) = below.values()
            text += character
        branches.append(_quoted(text) + _alternatives(below))
    if "" in node:
        branches.append(node[""])
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def build_pattern(names: list[str]) -> str:
    """One regular expression that matches the longest name at each position.

    A word edge is written as a look-around, so it means the same on every Java
    version. Names share their prefixes, so the work per position follows the
    letters that agree and not the number of names, and most positions are ruled
    out by the left edge alone.
    """
    spelled = [name for name in names if name]
    inner = [name for name in spelled if _is_word(name[0])]
    outer = [name for name in spelled if not _is_word(name[0])]
    sides = [
        edge + _alternatives(_tree(sorted(side)))
        for edge, side in ((f"(?<![{WORD}])", inner), (f"(?<=[{WORD}])", outer))
        if side
    ]
    return "(?iu)(?:" + "|".join(sides) + ")"


def _canonical(matches: Column, names: dict[str, str]) -> Column:
    """Distinct catalog spellings of matched texts. A text whose lower-case form
    is unknown stays as it was written.

    A map is searched from end to end, so names are kept by their first letters.
    """
    by_start: dict[str, dict[str, str]] = {}
    for low, name in names.items():
        by_start.setdefault(low[:2], {})[low] = name
    lookup = F.from_json(
        F.lit(json.dumps(by_start)), "map<string,map<string,string>>"
    )

    def name_of(text):
        low = F.lower(text)
        same_start = F.try_element_at(lookup, F.substring(low, 1, 2))
        return F.coalesce(F.try_element_at(same_start, low), text)

    return F.array_distinct(F.transform(F.array_distinct(matches), name_of))


def match_pairs(
    jobs: DataFrame,
    catalog: DataFrame,
    match_variants: bool = False,
    pattern_names: int = PATTERN_NAMES,
) -> DataFrame:
    """``(job_id, job_title, skill_name)``, each skill once per job row.

    Reads at most ``pattern_names`` + 1 catalog rows to the driver to choose the
    method. A catalog that fits becomes one literal pattern, and matching and
    naming stay inside the row: no join and no shuffle. A larger catalog is
    joined on n-grams, with the same result: equal job rows get their pairs each.
    """
    sets = _pattern_sets(jobs, catalog, match_variants, pattern_names)
    if sets is None:
        return match_by_grams(jobs, catalog, match_variants)
    return sets.select("job_id", "job_title", F.explode("skills").alias("skill_name"))


def match_sets(jobs: DataFrame, catalog: DataFrame, match_variants: bool = False) -> DataFrame:
    """``(job_id, job_title, skills)``: one row per job row with the array of its skills.
    Narrow; for catalogs of at most ``PATTERN_NAMES`` names."""
    sets = _pattern_sets(jobs, catalog, match_variants, PATTERN_NAMES)
    if sets is None:
        raise ValueError(f"sets are matched with at most {PATTERN_NAMES} names")
    return sets


def _pattern_sets(
    jobs: DataFrame, catalog: DataFrame, match_variants: bool, pattern_names: int
) -> DataFrame | None:
    """Skills of each job row by one pattern; None if the catalog is too large."""
    rows = surfaces(catalog, match_variants).limit(pattern_names + 1).collect()
    if len(rows) > pattern_names:
        return None
    searched = [row.surface for row in rows if row.searched]
    if not searched:
        none = F.array().cast("array<string>").alias("skills")
        return jobs.select("job_id", "job_title", none)
    names = {row.lower: row.skill_name for row in rows}
    found = F.regexp_extract_all(
        "job_description", F.lit(build_pattern(searched)), F.lit(0)
    )
    return jobs.select("job_id", "job_title", _canonical(found, names).alias("skills"))
