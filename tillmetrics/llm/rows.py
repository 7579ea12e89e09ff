"""Filters on whole rows that look at one text column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import TextBlock, text_blocks
from .ship import ship


def filter_by_text(docs: DataFrame, text_col: str, keep: Callable[[TextBlock], np.ndarray]) -> DataFrame:
    """The rows of docs, with all columns, for which keep(block) is true."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in text_blocks(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(keep(block)))

    return docs.mapInArrow(work, docs.schema)
