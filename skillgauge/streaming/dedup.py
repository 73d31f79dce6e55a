"""First-wins over a stream, with the keys that were seen in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key: of the first micro-batch that has the key, the row
    that comes first by ``order``. Rows whose key holds a null are all kept.

    Which keys were seen is kept in the checkpoint, so stored rows are never read again.
    The rows of a key pass through one task in chunks, of which one row is held; bound a
    micro-batch by the source's files per trigger. For very many keys set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, which keeps
    state outside the heap.
    """
    names = rows.columns

    def first(_, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        best = None
        for chunk in chunks:
            both = chunk if best is None else pd.concat([best, chunk])
            best = both.sort_values(order, kind="stable").head(1)
        state.update((True,))
        if best is not None:
            yield best[names]

    partial = F.lit(False)
    for key in keys:
        partial = partial | F.col(key).isNull()
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    kept = rows.where(~partial).groupBy(*keys).applyInPandasWithState(
        first, schema, "seen boolean", "append", GroupStateTimeout.NoTimeout
    )
    return kept.unionByName(rows.where(partial))
