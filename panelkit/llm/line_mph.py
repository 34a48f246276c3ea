"""Line dedup by probing a sharded minimal perfect hash.

The lines of all texts are hashed (128 bits of the key: both ends stripped of
ASCII white space, A-Z lower-cased) and counted by distinct documents. The
distinct hashes of the lines that are frequent enough to be dropped are dealt
over shards by hash; each shard, built in a task of its own, is a minimal
perfect hash with two compact arrays behind it: a 64-bit fingerprint and the
largest document id. The counts decide before, in the aggregation, so lines
that are not frequent are not indexed. Documents are then read once more
and probe the arrays; no line is joined to another.

Shards have a bounded number of keys, and documents are probed by rounds of
shards that together hold at most ``round_keys`` keys (about 20 bytes each):
what is shipped to the tasks has that bound at any input size, and the number
of rounds grows instead. Between rounds the documents with the lines found so
far are written to the shared folder.

A line is lost when its key has at least ``min_chars`` code points and stands
in at least ``min_docs`` documents, except in the largest id that holds it
(there all its places stay). Null and empty texts are one empty line. Rows
with the same id count as one document. Rows with a null id count for nothing
and lose every frequent line. Extra columns and empty tables need no care.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm._tables import stored

BLANK = " \t\n\x0b\x0c\r"
GAMMA = 2.0


def line_keys(text: str | None, min_chars: int) -> tuple[list[str], list[int], list[bytes]]:
    """Lines of a text; numbers and 128-bit key hashes of those long enough."""
    lines = (text or "").split("\n")
    at, keys = [], []
    for i, line in enumerate(lines):
        key = line.strip(BLANK)
        if len(key) >= min_chars:
            at.append(i)
            keys.append(hashlib.blake2b(key.encode().lower(), digest_size=16).digest())
    return lines, at, keys


def _keys_of_documents(min_chars: int):
    def keys(batches):
        for b in batches:
            ids, found = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = set(line_keys(t, min_chars)[2])
                ids += [i] * len(own)
                found += own
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ids, pa.int64())],
                                             names=["h1", "h2", "id"])
    return keys


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """A new 64-bit hash of both halves for every level."""
    x = h1 ^ (h2 * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level * 0xD1342543DE82EF95) & (2**64 - 1)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Level after level, keys alone in their slot take it; the others go on
    to the next level. A key's number is the rank of its slot, so ``n``
    distinct keys get exactly the numbers 0 to ``n - 1``."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        taken = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.cumsum(taken, dtype=np.int32) - taken
        self.start = np.cumsum([0, *map(len, levels)])

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> "PerfectHash":
        levels = []
        while len(h1):
            slots = _mixed(h1, h2, len(levels)) % np.uint64(int(GAMMA * len(h1)) + 1)
            levels.append(np.bincount(slots.astype(np.int64), minlength=int(GAMMA * len(h1)) + 1) == 1)
            left = ~levels[-1][slots.astype(np.int64)]
            h1, h2 = h1[left], h2[left]
        return cls(levels)

    def number(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Numbers of keys; -1, or any number, for keys that were not built in."""
        out, todo = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, taken in enumerate(self.levels):
            if not len(todo):
                break
            slots = (_mixed(h1[todo], h2[todo], level) % np.uint64(len(taken))).astype(np.int64)
            hit = taken[slots]
            out[todo[hit]] = self.rank[self.start[level] + slots[hit]]
            todo = todo[~hit]
        return out

    def packed(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return sizes.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def unpacked(cls, blob: bytes) -> "PerfectHash":
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        sizes, at, levels = np.frombuffer(blob, "<i8", n, 8), 8 * (n + 1), []
        for size in sizes.tolist():
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = group["h1"].to_numpy(np.int64).view(np.uint64), group["h2"].to_numpy(np.int64).view(np.uint64)
    mph = PerfectHash.build(h1, h2)
    at = np.argsort(mph.number(h1, h2))
    return pd.DataFrame({"shard": [group["shard"].iloc[0]], "mph": [mph.packed()],
                         "fingerprints": [h2[at].tobytes()],
                         "last_ids": [group["last_id"].to_numpy(np.int64)[at].tobytes()]})


def line_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
               min_docs: int = 5, shard_keys: int = 250_000) -> tuple[DataFrame, int]:
    """The stored shards (shard, mph, fingerprints, last_ids) and their number."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = (src.mapInArrow(_keys_of_documents(min_chars), "h1 long, h2 long, id long")
               .groupBy("h1", "h2").agg(F.countDistinct("id").alias("n_docs"), F.max("id").alias("last_id"))
               .where(F.col("n_docs") >= min_docs))
    counted = stored(counted, "line-counts")
    shards = -(-counted.count() // shard_keys)
    dealt = F.pmod(F.col("h1").bitwiseXOR(F.shiftright("h2", 7)), F.lit(max(1, shards)))
    built = (counted.withColumn("shard", dealt)
             .groupBy("shard").applyInPandas(_build, "shard long, mph binary, fingerprints binary, last_ids binary"))
    return stored(built, "line-index"), shards


def _prober(blobs: list[dict], shards: int, min_chars: int, finish: bool):
    def probe(batches):
        index = {b["shard"]: (PerfectHash.unpacked(b["mph"]), np.frombuffer(b["fingerprints"], np.uint64),
                              np.frombuffer(b["last_ids"], np.int64)) for b in blobs}
        for b in batches:
            texts, ids = b.column("text").to_pylist(), b.column("id").to_pylist()
            lost = [set(x or ()) for x in b.column("lost").to_pylist()]
            places, keys, split = [], [], []
            for d, t in enumerate(texts):
                lines, at, own = line_keys(t, min_chars)
                split.append(lines)
                places += [(d, i) for i in at]
                keys += own
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            h1, h2 = halves[:, 0].copy().view(np.uint64), halves[:, 1].copy().view(np.uint64)
            shard = _shard(halves, shards)
            for s, (mph, fingerprints, last_ids) in index.items():
                mine = np.flatnonzero(shard == s)
                at = mph.number(h1[mine], h2[mine])
                hit = (at >= 0) & (fingerprints[at] == h2[mine]) if len(fingerprints) else np.zeros(len(mine), bool)
                for k, last in zip(mine[hit].tolist(), last_ids[at[hit]].tolist()):
                    d, i = places[k]
                    if ids[d] != last:
                        lost[d].add(i)
            if finish:
                kept = ["\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else "\n".join(lines)
                        for lines, gone in zip(split, lost)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([len(x) for x in split], pa.int64()),
                     pa.array([len(x) for x in lost], pa.int64()), pa.array(kept, pa.string())],
                    names=["id", "n_lines", "n_dropped", "kept"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("text"), pa.array([sorted(x) for x in lost], pa.list_(pa.int32()))],
                    names=["id", "text", "lost"])
    return probe


def _shard(halves: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key; the same rule as ``line_index``'s."""
    return np.mod(halves[:, 0] ^ (halves[:, 1] >> 7), max(1, shards))


def drop_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                        min_docs: int = 5, shard_keys: int = 250_000, round_keys: int = 1_500_000) -> DataFrame:
    """``id``, ``n_lines``, ``n_dropped`` and ``kept`` (the text left) of every row."""
    index, shards = line_index(docs, id_col, text_col, min_chars, min_docs, shard_keys)
    per_round = max(1, round_keys // shard_keys)
    state = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.lit(None).cast("array<int>").alias("lost"))
    rounds = [list(range(i, min(i + per_round, shards))) for i in range(0, shards, per_round)] or [[]]
    for k, own in enumerate(rounds):
        # round_keys keys at most: a proven bound on what reaches the driver and the tasks
        blobs = [r.asDict() for r in index.where(F.col("shard").isin(own)).collect()] if own else []
        last = k == len(rounds) - 1
        schema = (T.StructType([T.StructField("id", T.LongType()), T.StructField("n_lines", T.LongType()),
                                T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])
                  if last else state.schema)
        state = state.mapInArrow(_prober([{x: bytes(v) if isinstance(v, bytearray) else v for x, v in b.items()} for b in blobs],
                                         shards, min_chars, last), schema)
        if not last:
            state = stored(state, "line-rounds")
    return state
