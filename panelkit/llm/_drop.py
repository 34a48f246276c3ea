"""Rows told by a set of ids too large to hold: a filter of fixed size passes
those that can't be meant, and only the others are joined."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._memory import lean

#: Bits of a filter.
FILTER_BITS = 1 << 24


def filter_bits(ids: np.ndarray) -> list[np.ndarray]:
    x = ids.astype(np.int64).view(np.uint64)
    return [((x * np.uint64(m)) >> np.uint64(40)).astype(np.int64) % FILTER_BITS for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


def hits(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of ``ids`` the filter ``bits`` may hold."""
    first, second = ((bits[at >> 3] >> (at & 7)) & 1 for at in filter_bits(ids))
    return (first & second).astype(bool)


def _filter_maker(batches):
    """Bytes of the filter, by 4 KiB page, that a partition's ids set."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for b in batches:
        for at in filter_bits(np.array(b.column(0))):
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    pages = bits.reshape(-1, 4096)
    used = np.flatnonzero(pages.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([pages[p].tobytes() for p in used], pa.binary())],
                                     names=["page", "bits"])


def _or_pages(group: pd.DataFrame) -> pd.DataFrame:
    bits = np.bitwise_or.reduce(np.array([np.frombuffer(x, np.uint8) for x in group["bits"]]), axis=0)
    return pd.DataFrame({"page": [group["page"].iloc[0]], "bits": [bits.tobytes()]})


def filter_of(ids: DataFrame) -> np.ndarray:
    """The filter of a frame of one column of whole numbers without nulls."""
    pages = (ids.mapInArrow(lean(_filter_maker), "page long, bits binary")
             .groupBy("page").applyInPandas(_or_pages, "page long, bits binary").collect())  # FILTER_BITS at most
    out = np.zeros((FILTER_BITS // 8 // 4096, 4096), np.uint8)
    for p in pages:
        out[p.page] = np.frombuffer(p.bits, np.uint8)
    return out.ravel()


def drop_rows(df: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``id_col``, as long, is in ``gone`` (one
    long column, no nulls). Rows that the filter of ``gone`` rules out stay where
    they are; the others, which are few if few rows go, are joined. Rows with a
    null id stay."""
    bits = filter_of(gone)

    @F.pandas_udf("boolean")
    def maybe(ids: pd.Series) -> pd.Series:
        return pd.Series(hits(ids.to_numpy(), bits))
    meant = maybe(F.coalesce(df[id_col].cast("long"), F.lit(0)))
    ids = gone.toDF("_gone")
    doubtful = df.where(meant)
    doubtful = doubtful.join(ids, doubtful[id_col].cast("long") == ids["_gone"], "left_anti")
    return df.where(~meant).union(doubtful)
