"""Rows whose key several documents have, found by one sort that no hot key can overload."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _repeated(key: str, doc: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with a neighbour of the same key, and the ends of the partition.

        The last row of a batch waits for the next one. A key may go on in the next partition,
        so the first and last row always stay.
        """
        keys, docs, first = np.empty(0, np.int64), np.empty(0, np.int64), True
        for batch in batches:
            keys = np.concatenate([keys, batch.column(key).to_numpy()])
            docs = np.concatenate([docs, batch.column(doc).to_numpy()])
            new = np.r_[True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])]
            keys, docs = keys[new], docs[new]
            if len(keys) < 3:
                continue
            same = keys[1:] == keys[:-1]
            keep = np.r_[first, same[:-1] | same[1:]]
            first = False
            yield pa.RecordBatch.from_arrays([pa.array(keys[:-1][keep]), pa.array(docs[:-1][keep])], names=[key, doc])
            # Of these the first has been judged; it tells whether the second repeats it.
            keys, docs = keys[-2:], docs[-2:]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(docs)], names=[key, doc])

    return run


def shared_keys(rows: DataFrame, key: str, doc: str) -> DataFrame:
    """The distinct (key, doc) rows whose key other documents have too, and a few more.

    Rows are dealt by ranges of (key, doc), so the rows of a hot key spread over as many tasks as they
    fill. Besides shared keys the result holds at most three other rows per task.
    """
    dealt = rows.select(key, doc).repartitionByRange(key, doc).sortWithinPartitions(key, doc)
    return dealt.mapInArrow(_repeated(key, doc), f"{key} long, {doc} long")
