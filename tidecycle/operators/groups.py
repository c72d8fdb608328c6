"""Many small series in one call: a task gets whole series one after the other and works on thousands of them at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that are worked on at a time; a longer series is held as a whole.
ROWS = 1 << 17


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each series of a table sorted by `keys`; null equals null."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def by_series(df: DataFrame, keys: list[str], order: list[str], apply, schema, rows: int = ROWS) -> DataFrame:
    """`apply(table, starts)` on whole series, sorted by keys and `order` (nulls last), about `rows` rows of them at a time; it returns a table of `schema`. A series is in one call, but a call holds many."""

    def run(batches):
        held, n, enough = [], 0, rows
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            table = pa.Table.from_batches(held)
            first = starts(table, keys)
            cut = int(first[-1])
            if cut:
                yield from apply(table.slice(0, cut).combine_chunks(), first[:-1]).to_batches()
                held = table.slice(cut).combine_chunks().to_batches()
                n -= cut
            enough = max(rows, 2 * n)  # a long series is looked at again when it has doubled
        if n:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from apply(table, starts(table, keys)).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, *[F.col(c).asc_nulls_last() for c in order]).mapInArrow(run, schema)
