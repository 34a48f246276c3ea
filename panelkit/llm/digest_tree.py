"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition becomes a run: its rows' digests in sorted order, equal
ones collapsed to one entry (best row, count), cut into parts by the leading
bits of the digest. Runs are exchanged and merged in rounds: in round ``r`` the
``fan_in`` runs whose numbers agree after division by ``fan_in ** (r + 1)``
meet, part by part, and are merged by order, two neighbours at a time, into one
sorted run; entries with the same key fold into one that keeps the best
identifier and the sum of the counts. After the last round one entry per
distinct text is left. Which rows stay is known there; where every row needs
its verdict, the merged runs are sent back down the same tree, each run looking
its own keys up in the run it was merged into. No level ever holds more than
``fan_in`` entries of one text, however many copies a text has: a third of all
rows being one text costs no more than any other input.

Entries only fold when SHA-256, a second independent 128-bit digest and the
byte length all agree (the verification at every level). Levels are stored, so
an executor lost costs the round it was in. A task holds the parts of ``fan_in``
runs, ``BLOCK`` entries each on average.

Null texts count as empty. Texts are equal when identical after lower-casing
A-Z. Of equal texts the row with the largest (or smallest) id stays; null ids
lose against any other. Among repeated rows with that id the first one of the
first run stays, so exactly one row of each group is kept. Ids are whole
numbers. An empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._drop import drop_rows
from panelkit.llm._tables import stored
from panelkit.stages import releasing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["digest", "digest2", "n_bytes"]
#: Entries of a part of a run, at the top of the tree and on average.
BLOCK = 16_384
#: A run's entry: SHA-256, second digest and length as bytes that sort; the best row; how many rows.
ENTRY = np.dtype([("key", "S56"), ("known", "u1"), ("id", "<i8"), ("run", "<i8"), ("pos", "<i8"), ("n", "<i8")])
RUN = "run long, part long, block binary"


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                payload: bool = False) -> DataFrame:
    """One row per document: run, position, digests, id (and with ``payload``
    the whole row as struct ``row``)."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    cols = [F.spark_partition_id().cast("long").alias("run"), F.monotonically_increasing_id().alias("pos"),
            F.unhex(F.sha2(text, 256)).alias("digest"), F.unhex(F.md5(text)).alias("digest2"),
            F.octet_length(text).cast("long").alias("n_bytes"), F.col(id_col).cast("long").alias("id")]
    if payload:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return docs.select(*cols)


def folded(entries: np.ndarray, largest: bool) -> np.ndarray:
    """Sorted entries with those of one key folded into the best of them (the
    first in order among equals) and their count."""
    if not len(entries):
        return entries
    first = np.flatnonzero(np.append(True, entries["key"][1:] != entries["key"][:-1]))
    if len(first) == len(entries):
        return entries
    sizes = np.diff(np.append(first, len(entries)))
    value = ~entries["id"] if largest else entries["id"]  # reversed without overflow
    able = entries["known"] == np.repeat(np.maximum.reduceat(entries["known"], first), sizes)
    value = np.where(able, value, np.iinfo(np.int64).max)
    best = able & (value == np.repeat(np.minimum.reduceat(value, first), sizes))
    place = np.minimum.reduceat(np.where(best, np.arange(len(entries)), len(entries)), first)
    out = entries[place]
    out["n"] = np.add.reduceat(entries["n"], first)
    return out


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs merged by order; of equal keys those of earlier runs come first."""
    while len(runs) > 1:
        pairs = []
        for a, b in zip(runs[::2], runs[1::2]):
            out = np.empty(len(a) + len(b), ENTRY)
            at = np.searchsorted(a["key"], b["key"], side="right") + np.arange(len(b))
            mine = np.ones(len(out), bool)
            mine[at] = False
            out[at], out[mine] = b, a
            pairs.append(out)
        runs = pairs + runs[len(pairs) * 2:]
    return runs[0]


def _rows(batches):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _blocks(run: int, entries: np.ndarray, bits: int):
    """A sorted run as one row per part."""
    if not bits:
        parts = np.zeros(len(entries), np.int64)
    else:
        head = np.ascontiguousarray(entries["key"]).view(np.uint8).reshape(-1, 56)[:, :8].copy().view(">u8").ravel()
        parts = (head >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
    ends = np.append(first[1:], len(entries))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(first), run), pa.int64()), pa.array(parts[first], pa.int64()),
        pa.array([entries[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], names=["run", "part", "block"])


def _fixed(column, width: int) -> np.ndarray:
    data = np.frombuffer(column.buffers()[1 if pa.types.is_fixed_size_binary(column.type) else 2], np.uint8)
    return data[:len(column) * width].reshape(-1, width) if column.offset == 0 else \
        np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _packer(largest: bool, bits: int):
    """Rows sorted by run and key to sorted runs in blocks."""
    def pack(batches):
        held, run = [], None
        for b in batches:
            entries = np.zeros(b.num_rows, ENTRY)
            key = np.hstack([_fixed(b.column(2), 32), _fixed(b.column(3), 16),
                             b.column(4).to_numpy(zero_copy_only=False).astype(">u8").view(np.uint8).reshape(-1, 8)])
            entries["key"] = np.ascontiguousarray(key).view("S56").ravel()
            entries["known"] = b.column(5).is_valid().to_numpy(zero_copy_only=False)
            entries["id"] = b.column(5).fill_null(0).to_numpy(zero_copy_only=False)
            entries["run"], entries["pos"] = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            entries["n"] = 1
            cuts = np.flatnonzero(np.append(True, entries["run"][1:] != entries["run"][:-1])) if len(entries) else []
            for a, e in zip(cuts, [*cuts[1:], len(entries)]):
                if run is not None and entries["run"][a] != run:
                    yield _blocks(run, folded(np.concatenate(held), largest), bits)
                    held = []
                run = int(entries["run"][a])
                held.append(folded(entries[a:e], largest))
        if held:
            yield _blocks(run, folded(np.concatenate(held), largest), bits)
    return pack


def _merger(largest: bool):
    """Rows (run merged into, part, run, block), sorted, to merged runs."""
    def merge(batches):
        for (up, part), rows in groupby(_rows(batches), lambda r: r[:2]):
            out = folded(merged([np.frombuffer(r[3], ENTRY) for r in rows]), largest)
            yield pa.RecordBatch.from_arrays([pa.array([up], pa.int64()), pa.array([part], pa.int64()), pa.array([out.tobytes()], pa.binary())],
                                             names=["run", "part", "block"])
    return merge


def _tell(batches):
    """Rows (run merged into, part, run or null, block), the merged run first:
    every run with the entries of the merged one for its own keys."""
    for (_, part), rows in groupby(_rows(batches), lambda r: r[:2]):
        whole = np.frombuffer(next(rows)[3], ENTRY)
        for _, _, run, block in rows:
            own = np.frombuffer(block, ENTRY)
            out = whole[np.searchsorted(whole["key"], own["key"])]
            yield pa.RecordBatch.from_arrays([pa.array([run], pa.int64()), pa.array([part], pa.int64()), pa.array([out.tobytes()], pa.binary())],
                                             names=["run", "part", "block"])


def _unpack(batches):
    """Runs as rows: run, key, best row, count."""
    for run, _, block in _rows(batches):
        e = np.frombuffer(block, ENTRY)
        key = np.ascontiguousarray(e["key"]).view(np.uint8).reshape(-1, 56)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(e), run), pa.int64()), pa.array([k.tobytes() for k in key[:, :32]], pa.binary()),
            pa.array([k.tobytes() for k in key[:, 32:48]], pa.binary()), pa.array(key[:, 48:].copy().view(">u8").ravel().astype(np.int64)),
            pa.array(e["id"], mask=e["known"] == 0), pa.array(e["run"]), pa.array(e["pos"]), pa.array(e["n"])],
            names=["run", *KEY, "keep_id", "best_run", "best_pos", "group_size"])


UNPACKED = "run long, digest binary, digest2 binary, n_bytes long, keep_id long, best_run long, best_pos long, group_size long"


def merge_tree(leaves: DataFrame, largest: bool, fan_in: int, block: int = BLOCK) -> list[DataFrame]:
    """The levels of the tree over the rows of :func:`digest_runs`: the runs
    themselves first, a single run last."""
    size = leaves.agg(F.max("run"), F.count("*")).first()
    runs, bits = (size[0] or 0) + 1, max(0, (max(size[1], 1) // block).bit_length())
    rows = (leaves.select("run", "pos", *KEY, "id").repartition("run").sortWithinPartitions("run", *KEY, "pos"))
    levels = [stored(rows.mapInArrow(_packer(largest, bits), RUN), "digest-level")]
    while runs > 1:
        runs = -(-runs // fan_in)
        met = (levels[-1].select(F.floor(F.col("run") / fan_in).cast("long").alias("up"), "part", "run", "block")
               .repartition("up", "part").sortWithinPartitions("up", "part", "run"))
        levels.append(stored(met.mapInArrow(_merger(largest), RUN), "digest-level"))
    return levels


def tree_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
               fan_in: int = 16, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept`` and
    ``digest`` (SHA-256 of the normalised text)."""
    if keep not in ("max", "min"):
        raise ValueError("keep must be 'max' or 'min'")
    with releasing(docs.sparkSession) as step:
        leaves = stored(digest_runs(docs, id_col, text_col), "digest-runs")
        levels = merge_tree(leaves, keep == "max", fan_in, block)
        told = levels[-1]
        for below in reversed(levels[:-1]):
            up = F.floor(F.col("run") / fan_in).cast("long").alias("up")
            rows = (told.select(F.col("run").alias("up"), "part", F.lit(None).cast("long").alias("run"), "block")
                    .unionByName(below.select(up, "part", "run", "block"))
                    .repartition("up", "part").sortWithinPartitions("up", "part", F.col("run").asc_nulls_first()))
            told = stored(rows.mapInArrow(_tell, RUN), "digest-told")
        mine = leaves.join(told.mapInArrow(_unpack, UNPACKED), ["run", *KEY])
        return step.keep(mine.select("id", "keep_id", "group_size",
                                     ((F.col("run") == F.col("best_run")) & (F.col("pos") == F.col("best_pos"))).alias("kept"), "digest"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", fan_in: int = 16) -> DataFrame:
    """The kept rows of ``docs``, whole: the best rows of the last level's run."""
    with releasing(docs.sparkSession) as step:
        leaves = stored(digest_runs(docs, id_col, text_col, payload=True), "digest-runs")
        best = merge_tree(leaves, keep == "max", fan_in)[-1].mapInArrow(_unpack, UNPACKED)
        # the rows that go are told by the positions without text; the texts of the others stay where they are
        gone = stored(leaves.select("pos").join(best.select(F.col("best_pos").alias("pos")), "pos", "left_anti"), "digest-gone")
        return step.keep(drop_rows(leaves.select("pos", "row"), "pos", gone).select("row.*"))
