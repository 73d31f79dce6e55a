"""Declared foreign keys: deletes that go down to all children, and rows without parent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from skillgauge.operators.merge import cascade_delete, orphans


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` names a row of ``parent``. ``spread`` are other columns of the
    child by which the rows of a much used parent can be told apart."""

    child: str
    column: str
    parent: str
    spread: tuple[str, ...]


#: Tables and their keys as the stored tables declare them.
PRIMARY_KEYS = {
    "jobs": "job_id",
    "skills": "skill_id",
    "job_skills": "job_skill_id",
    "packages": "package_id",
    "package_downloads": "download_id",
}
FOREIGN_KEYS = [
    ForeignKey("job_skills", "job_id", "jobs", ("skill_id",)),
    ForeignKey("job_skills", "skill_id", "skills", ("job_id",)),
    ForeignKey("package_downloads", "package_id", "packages", ("date",)),
]


def levels(tables: list[str], keys: list[ForeignKey]) -> list[str]:
    """The tables, parents before children. Fails if keys form a circle."""
    left, done = list(tables), []
    while left:
        ready = [t for t in left if all(k.parent in done or k.parent not in tables for k in keys if k.child == t)]
        if not ready:
            raise ValueError(f"foreign keys form a circle: {', '.join(left)}")
        done += ready
        left = [t for t in left if t not in ready]
    return done


def delete_rows(
    tables: dict[str, DataFrame],
    deleted: dict[str, DataFrame],
    keys: list[ForeignKey] = FOREIGN_KEYS,
    primary: dict[str, str] = PRIMARY_KEYS,
) -> dict[str, DataFrame]:
    """What is left of each table after these rows, and all that hang on them, are gone.

    ``deleted`` holds primary keys by table. Tables are taken level by level: the rows
    that a table loses are the deleted parents of the next level. A child with a null in
    its column has no parent and stays.
    """
    kept, gone = {}, dict(deleted)
    for name in levels(list(tables), keys):
        rows, key = tables[name], primary[name]
        left = rows
        if name in deleted:
            left = cascade_delete(left, deleted[name], key, [c for c in rows.columns if c != key][:1] or [key])
        for link in keys:
            if link.child == name and link.parent in gone:
                lost = gone[link.parent].withColumnRenamed(primary[link.parent], link.column)
                left = cascade_delete(left, lost, link.column, list(link.spread))
        if left is not rows:
            # What is left may be the whole table, so it is never broadcast.
            gone[name] = rows.select(key).join(left.select(key).hint("merge"), key, "left_anti")
        kept[name] = left.select(*rows.columns)
    return kept


def rows_without_parent(
    tables: dict[str, DataFrame], keys: list[ForeignKey] = FOREIGN_KEYS, primary: dict[str, str] = PRIMARY_KEYS
) -> dict[tuple[str, str], DataFrame]:
    """For each foreign key between these tables, the child rows whose parent is missing."""
    found = {}
    for link in keys:
        if link.child in tables and link.parent in tables:
            parents = tables[link.parent].withColumnRenamed(primary[link.parent], link.column)
            found[link.child, link.column] = orphans(tables[link.child], parents, link.column, list(link.spread))
    return found
