"""Phrase collocations from one FM-index per shard over word ids.

Tasks cut their texts into pieces and words and deal them, language by
language, into shards of bounded size. For each length from 2 on, every shard
holds an FM-index of its words in both directions, sorted as deep as the phrases
are long: the Burrows-Wheeler transform of the words and that of the reversed
words. Starting from single words, the intervals of all phrases are extended to
the right (by the reversed transform) and to the left (by the forward one) in
turn, each step moving both intervals, until the phrases have that length; the
widths of the intervals are their counts. Counts are summed across shards.

A phrase can only be frequent if the phrases one word shorter inside it are, so
a shard's words are cut where that is ruled out before they are indexed for the
next length; the counts of the longer frequent phrases stay exact. For words
this is told each shard (the frequent ones get numbers), for longer phrases by a
filter of ``FILTER_BITS`` bits, whatever their number: what it lets through in
error, more of it the fuller it is, costs rows but never a result.

A shard sends its words and phrases as sorted, packed runs, one a bucket, that
are merged where they meet; the number of buckets grows with the words, so that
a task holds some ``BUCKET`` entries. A shard comes from one task's rows and
holds ``SHARD`` bytes of text, or one text if longer. A very frequent word,
phrase or language has one entry a shard, and those of a phrase are folded as
they arrive.

Null texts have no words; null languages count as ``und``; repeated rows count
as often as they stand there; ids and other columns take no part; empty tables
give no rows. Equal scores are ordered by count, then by the phrase's bytes.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm._tables import stored
from panelkit.stages import releasing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that end a piece, and bytes between words.
PIECE_ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bytes of text of a shard, and bytes that a task may hold before it makes one.
SHARD, HELD = 4 << 20, 12 << 20
#: Entries of a bucket, on average and before they are folded.
BUCKET = 250_000
#: Bits of the filter of frequent phrases.
FILTER_BITS = 1 << 25


# -- words and shards ----------------------------------------------------

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(PIECE_ENDS)] = 2


def words_of(data: np.ndarray, ends: np.ndarray):
    """Texts (bytes, and the ends of each) as (distinct words, ids with 0
    between pieces). Ids count from 1."""
    kind = _KIND[data]
    inside = kind == 0
    ended = kind == 2
    if len(data):
        begun = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(data))]
        ended[begun] = True  # a text's first byte begins a piece
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[begun] = inside[begun]
        after = np.append(~inside[1:], True)
        after[begun - 1] = True
        last = np.flatnonzero(inside & after)
        first = np.flatnonzero(first)
        del after
    if not len(data) or not len(first):
        return pa.array([], pa.string()), np.zeros(0, np.int32)
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(last - first + 1, out=offsets[1:])
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[inside])).dictionary_encode()
    ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    piece = np.searchsorted(np.flatnonzero(ended), first, side="right")
    return words.dictionary, np.insert(ids, np.flatnonzero(np.diff(piece)) + 1, 0)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers below 2^32, byte by byte, compressed."""
    if not len(columns[0]):
        return b""
    planes = [c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(data: bytes, size: int, columns: int = 1) -> list[np.ndarray]:
    if not size:
        return [np.zeros(0, np.int64)] * columns
    planes = np.frombuffer(pa.decompress(data, decompressed_size=size * 4 * columns, codec="zstd"), np.uint8).reshape(columns, 4, size)
    return [np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes]


def _shards(shard_bytes: int, held_bytes: int):
    def run(batches):
        held: dict[str, list] = {}
        sizes: dict[str, int] = {}
        made = TaskContext.get().partitionId() << 32

        def shard(lang):
            nonlocal made
            texts = held.pop(lang)
            sizes.pop(lang)
            bases = np.cumsum([0] + [len(t) for t, _ in texts[:-1]])
            ends = np.concatenate([e + b for (_, e), b in zip(texts, bases)])
            data = np.concatenate([t for t, _ in texts]) if len(texts) > 1 else texts[0][0]
            texts.clear()
            words, ids = words_of(data, ends)
            del data
            if len(words):
                counts = np.bincount(ids, minlength=len(words) + 1)[1:]
                made += 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([made], pa.int64()), pa.array([lang], pa.string()), pa.array([int(counts.sum())], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64())),
                    pa.array([len(ids)], pa.int64()), pa.array([pack(ids)], pa.binary())],
                    names=["shard", "lang", "n", "words", "counts", "size", "ids"])
        for b in batches:
            langs, texts = b.column(0).dictionary_encode(), b.column(1)
            which = langs.indices.to_numpy(zero_copy_only=False)
            lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = np.flatnonzero(which == code)
                ends, at = np.cumsum(lengths[rows]), 0
                while at < len(rows):
                    base = ends[at - 1] if at else 0
                    to = max(int(np.searchsorted(ends, base + shard_bytes - sizes.get(lang, 0), "right")), at + 1)
                    mine = texts.take(pa.array(rows[at:to])).cast(pa.large_binary())
                    offsets = np.frombuffer(mine.buffers()[1], np.int64)[:to - at + 1]
                    data = np.frombuffer(mine.buffers()[2] or b"", np.uint8)[:offsets[-1]]
                    held.setdefault(lang, []).append((data, offsets[1:]))
                    sizes[lang] = sizes.get(lang, 0) + len(data)
                    if sizes[lang] >= shard_bytes or to < len(rows):
                        yield from shard(lang)
                    at = to
                while sum(sizes.values()) > held_bytes:
                    yield from shard(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from shard(lang)
    return run


# -- the index -----------------------------------------------------------

class BidirectionalIndex:
    """FM-index of a word sequence (ids from 1, 0 between pieces) and of its
    reverse, both sorted by ``depth`` words. A phrase is an interval in each:
    (start, start in the reverse, width)."""

    def __init__(self, ids: np.ndarray, depth: int):
        text = np.append(0, ids).astype(np.int32)
        self.symbols = int(text.max()) + 1
        self.starts = np.append(0, np.cumsum(np.bincount(text, minlength=self.symbols)))
        self.forward, self.backward = self._transform(text, depth), self._transform(text[::-1], depth)
        self._steps: dict[bool, np.ndarray] = {}

    def _transform(self, text, depth):
        """The word before each rotation, in the order of their first words."""
        ranks, sorted_by, key = {1: text}, 1, text
        while sorted_by < depth:
            add = min(sorted_by, depth - sorted_by)
            if sorted_by > 1:
                ranks[sorted_by] = key = np.unique(key, return_inverse=True)[1].astype(np.int32)
            more = np.roll(ranks[add], -sorted_by)
            key = key * np.int64(int(more.max()) + 1)
            key += more
            sorted_by += add
        return text[np.argsort(key, kind="stable") - 1]

    def _step(self, right: bool) -> np.ndarray:
        """Where the rotation that begins with each place's word stands."""
        if right not in self._steps:
            last = self.backward if right else self.forward
            out = np.empty(len(last), np.int32)
            out[np.argsort(last, kind="stable")] = np.arange(len(last), dtype=np.int32)
            self._steps[right] = out
        return self._steps[right]

    def words(self):
        """All words as phrases: (ids as one column, intervals)."""
        ids = np.arange(1, self.symbols)
        at, width = self.starts[1:-1], np.diff(self.starts)[1:]
        here = width > 0
        return ids[here, None], (at[here], at[here], width[here])

    def extend(self, phrases, intervals, right: bool, more: bool = True):
        """All phrases one word longer, to the right or to the left."""
        start, other, width = intervals if right else (intervals[1], intervals[0], intervals[2])
        if not len(width):
            return np.zeros((0, phrases.shape[1] + 1), np.int64), intervals
        first = np.cumsum(width) - width
        places = np.repeat((other - first).astype(np.int32), width)
        places += np.arange(len(places), dtype=np.int32)
        key = np.repeat(np.arange(len(width), dtype=np.int64) * self.symbols, width)
        key += (self.backward if right else self.forward)[places]
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(head, len(key)))
        parent, word = np.divmod(key[head], self.symbols)
        real = word > 0
        head, size, parent, word = head[real], size[real], parent[real], word[real]
        longer = np.column_stack([phrases[parent], word] if right else [word, phrases[parent]])
        if not more:
            return longer, (None, None, size)
        moved = start[parent] + head - first[parent]
        stepped = self._step(right)[places[order[head]]]
        return longer, ((moved, stepped, size) if right else (stepped, moved, size))

    def phrases(self, length: int):
        """All phrases of ``length`` words as rows of ids, and their counts."""
        found, intervals = self.words()
        for k in range(1, length):
            found, intervals = self.extend(found, intervals, right=k % 2 == 1, more=k + 1 < length)
        return found, intervals[2]


def cut(ids: np.ndarray, good: np.ndarray, k: int) -> np.ndarray:
    """The runs of ``ids`` in which every ``k`` neighbours are ``good`` (a flag
    for each first one) and that hold k + 1 words at least, with 0 between them:
    just the words in which a longer phrase can be frequent."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], good.astype(np.int8), [0]])))
    first, size = edges[::2], edges[1::2] - edges[::2]
    first, size = first[size > 1], size[size > 1] + k - 1
    if not len(first):
        return np.zeros(0, ids.dtype)
    ends = np.cumsum(size + 1)
    places = np.repeat(first - (ends - size - 1), size + 1) + np.arange(ends[-1])
    out = ids[np.minimum(places, len(ids) - 1)]
    out[ends - 1] = 0
    return out[:-1]


def phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of phrases, given as a column of gids for each word."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def narrowed(ids: np.ndarray, gid: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    """``ids`` cut where no phrase of 2, 3, ... words goes on that may be frequent."""
    for k, bits in enumerate(filters, 2):
        n = len(ids) - k + 1
        if n <= 0:
            return ids[:0]
        global_ids = np.append(-1, gid)[ids]
        spot = phrase_hash([global_ids[i:i + n] for i in range(k)]) % np.uint64(FILTER_BITS)
        good = (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        for i in range(k):
            good &= ids[i:i + n] > 0
        ids = cut(ids, good, k)
    return ids


# -- passes over the shards ----------------------------------------------

def _rows(batches):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _word_runs(buckets: int):
    """Shards to runs: the words of each bucket with their places and counts."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                lang, words = row.column(1)[0].as_py(), row.column(2).flatten()
                counts = row.column(3).flatten().to_numpy(zero_copy_only=False)
                hashed = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) + np.uint64(zlib.crc32(lang.encode()))
                bucket = (hashed % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                ends = np.append(first[1:], len(order))
                texts = words.take(pa.array(order)).to_pylist()
                n = len(first)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[first]), pa.array([lang] * n, pa.string()), pa.array([row.column(0)[0].as_py()] * n, pa.int64()),
                    pa.array(ends - first), pa.array([pa.compress("\n".join(texts[x:y]).encode(), codec="zstd", asbytes=True) for x, y in zip(first, ends)], pa.binary()),
                    pa.array([sum(len(t.encode()) + 1 for t in texts[x:y]) - 1 for x, y in zip(first, ends)], pa.int64()),
                    pa.array([pack(order[x:y], counts[order[x:y]]) for x, y in zip(first, ends)], pa.binary())],
                    names=["bucket", "lang", "shard", "size", "words", "bytes", "numbers"])
    return run


def _frequent_words(buckets: int, min_count: int):
    """Runs sorted by bucket and language: the frequent words with their numbers
    (shard null), and for each shard the places and numbers of its own."""
    def run(batches):
        for bucket, same in groupby(_rows(batches), lambda r: r[0]):
            made = 0
            for lang, rows in groupby(same, lambda r: r[1]):
                rows = list(rows)
                words = pa.concat_arrays([pa.array(pa.decompress(r[4], decompressed_size=r[5], codec="zstd", asbytes=True).decode().split("\n"), pa.string())
                                          for r in rows]).dictionary_encode()
                places, counts = zip(*[unpack(r[6], r[3], 2) for r in rows])
                which = words.indices.to_numpy(zero_copy_only=False)
                total = np.zeros(len(words.dictionary), np.int64)
                np.add.at(total, which, np.concatenate(counts))
                often = np.flatnonzero(total >= min_count)
                gid = np.full(len(total), -1, np.int64)
                gid[often] = (made + np.arange(len(often))) * buckets + bucket
                made += len(often)
                if made * buckets >= 2**32:
                    raise ValueError("more than 2^32 frequent words")
                m = len(often)
                yield _told([None] * m, [lang] * m, words.dictionary.take(pa.array(often)).to_pylist(), gid[often].tolist(), total[often].tolist(),
                            [None] * m, [None] * m)
                at, out = 0, []
                for r, place in zip(rows, places):
                    mine = gid[which[at:at + r[3]]]
                    at += r[3]
                    kept = mine >= 0
                    if kept.any():
                        out.append((r[2], int(kept.sum()), pack(place[kept], mine[kept])))
                if out:
                    n = len(out)
                    yield _told([x[0] for x in out], [lang] * n, [None] * n, [None] * n, [None] * n, [x[1] for x in out], [x[2] for x in out])
    return run


def _told(*columns):
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["shard", "lang", "word", "gid", "f", "size", "numbers"])


def _number(batches):
    """Shards with the numbers of their frequent words instead of all words."""
    for shard, size, ids, kept in _rows(batches):
        place, gid = (np.concatenate(c) for c in zip(*[unpack(k["numbers"], k["size"], 2) for k in kept]))
        order = np.argsort(gid)
        gid, local = gid[order], np.zeros(int(place.max()) + 2, np.int32)
        local[place[order] + 1] = np.arange(1, len(gid) + 1)
        ids, = unpack(ids, size)
        ids = np.where(ids < len(local), local[np.minimum(ids, len(local) - 1)], 0)
        ids = cut(ids, ids > 0, 1)
        yield pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([len(gid)], pa.int64()), pa.array([pack(gid)], pa.binary()),
            pa.array([len(ids)], pa.int64()), pa.array([pack(ids)], pa.binary())], names=["shard", "n_gids", "gids", "size", "ids"])


def _phrase_runs(length: int, buckets: int, filters: list[bytes]):
    """Shards to sorted runs of their phrases of ``length`` words and counts."""
    def run(batches):
        bits = [np.frombuffer(zlib.decompress(f), np.uint8) for f in filters]
        for _, n_gids, gids, size, ids in _rows(batches):
            gid, = unpack(gids, n_gids)
            left = narrowed(unpack(ids, size)[0], gid, bits)
            if not len(left):
                continue
            phrases, counts = BidirectionalIndex(left, length).phrases(length)
            words = [gid[phrases[:, k] - 1] for k in range(length)]
            bucket = (phrase_hash(words) >> np.uint64(20)) % np.uint64(buckets)
            order = np.lexsort([*words[::-1], bucket])
            bucket = bucket[order].astype(np.int64)
            columns = [c[order] for c in [*words, counts]]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(first[1:], len(order))
            blobs = []
            for x, y in zip(first, ends):
                part = [c[x:y] for c in columns]
                part[0] = np.diff(part[0], prepend=0)  # sorted: small steps
                blobs.append(pack(*part))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(ends - first), pa.array(blobs, pa.binary())],
                                             names=["bucket", "size", "run"])
    return run


def _folded(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Entries (words, count) with those of one phrase folded, in order."""
    order = np.lexsort(columns[-2::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns[:-1]] + [np.add.reduceat(columns[-1], first) if len(first) else columns[-1]]


def _frequent_phrases(length: int, min_count: int):
    """Runs sorted by bucket: the phrases whose counts over all shards suffice."""
    def run(batches):
        for _, rows in groupby(_rows(batches), lambda r: r[0]):
            folded, fresh, waiting = None, [], 0
            for _, size, blob in rows:
                part = unpack(blob, size, length + 1)
                part[0] = np.cumsum(part[0])
                fresh.append(part)
                waiting += size
                if waiting > max(BUCKET, len(folded[0]) if folded else 0):
                    folded, fresh, waiting = _folded([np.concatenate(c) for c in zip(*([folded] if folded else []), *fresh)]), [], 0
            if fresh:
                folded = _folded([np.concatenate(c) for c in zip(*([folded] if folded else []), *fresh)])
            keep = folded[-1] >= min_count
            words = np.column_stack([c[keep] for c in folded[:-1]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array(np.arange(0, words.size + 1, length), pa.int32()), pa.array(words.ravel())),
                pa.array(folded[-1][keep], pa.int64())], names=["w", "f"])
    return run


def _filter_pages(length: int):
    """The filter's bits of phrases, as pages of 4 KB."""
    def run(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for b in batches:
            words = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            bits[(phrase_hash(list(words.T)) % np.uint64(FILTER_BITS)).astype(np.int64)] = True
        pages = np.packbits(bits, bitorder="little").reshape(-1, 4096)
        used = np.flatnonzero(pages.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([pages[p].tobytes() for p in used], pa.binary())], names=["page", "bits"])
    return run


def _or_pages(pages: pd.DataFrame) -> pd.DataFrame:
    bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pages["bits"]])
    return pd.DataFrame({"page": [pages["page"].iloc[0]], "bits": [bits.tobytes()]})


def phrase_filter(phrases: DataFrame, length: int) -> bytes:
    """A filter of ``FILTER_BITS`` bits of all ``phrases``, compressed."""
    pages = (phrases.select("w").mapInArrow(_filter_pages(length), "page long, bits binary")
             .groupBy("page").applyInPandas(_or_pages, "page long, bits binary").collect())  # FILTER_BITS at most
    out = np.zeros((FILTER_BITS // 8 // 4096, 4096), np.uint8)
    for p in pages:
        out[p.page] = np.frombuffer(p.bits, np.uint8)
    return zlib.compress(out.tobytes(), 1)


def frequent_phrases(docs: DataFrame, longest: int = 4, min_count: int = 30, lang_col: str = "lang", text_col: str = "text",
                     shard_bytes: int = SHARD):
    """(sizes, words, phrases): words per language; ``gid``, ``lang``, ``word``,
    ``f`` of the frequent words; ``w`` (their gids) and ``f`` of the frequent
    phrases of 1 to ``longest`` words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER).alias("text"))
    with releasing(docs.sparkSession) as step:
        shards = stored(texts.mapInArrow(_shards(shard_bytes, max(HELD, shard_bytes)),
                                         "shard long, lang string, n long, words array<string>, counts array<long>, size long, ids binary"), "shards")
        sizes = stored(shards.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-sizes")
        entries, total = shards.agg(F.sum(F.size("words")), F.sum("n")).first()
        buckets = 1 + (entries or 0) // BUCKET
        runs = (shards.select("shard", "lang", "words", "counts").mapInArrow(
            _word_runs(buckets), "bucket long, lang string, shard long, size long, words binary, bytes long, numbers binary")
            .repartition("bucket").sortWithinPartitions("bucket", "lang"))
        told = stored(runs.mapInArrow(_frequent_words(buckets, min_count),
                                      "shard long, lang string, word string, gid long, f long, size long, numbers binary"), "phrase-words")
        words = told.where("shard IS NULL").select("gid", "lang", "word", "f")
        mine = told.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list(F.struct("size", "numbers")).alias("kept"))
        shards = stored(shards.select("shard", "size", "ids").join(mine, "shard")
                        .mapInArrow(_number, "shard long, n_gids long, gids binary, size long, ids binary"), "shards")
        step.release(sizes, told, shards)
        phrases, filters, found = [words.select(F.array("gid").alias("w"), "f")], [], None
        buckets = 1 + (total or 0) // BUCKET
        for length in range(2, longest + 1):
            if found is not None:
                filters.append(phrase_filter(found, length - 1))
            runs = (shards.mapInArrow(_phrase_runs(length, buckets, list(filters)), "bucket long, size long, run binary")
                    .repartition("bucket").sortWithinPartitions("bucket"))
            found = stored(runs.mapInArrow(_frequent_phrases(length, min_count), "w array<long>, f long"), "phrases")
            phrases.append(found)
        out = phrases[0]
        for p in phrases[1:]:
            out = out.unionByName(p)
        return step.keep(sizes), step.keep(words), step.keep(out)


def collocations(docs: DataFrame, top: int = 2000, longest: int = 4, min_count: int = 30, lang_col: str = "lang",
                 text_col: str = "text", shard_bytes: int = SHARD) -> DataFrame:
    """Per language the ``top`` phrases by score: ``lang``, ``rank``, ``phrase``,
    its count ``a``, the counts ``l`` and ``r`` of its parts at the cut of lowest
    score, ``n`` and ``score`` (2,000,000 a / (l + r), floored)."""
    sizes, words, phrases = frequent_phrases(docs, longest, min_count, lang_col, text_col, shard_bytes)
    long_ones = phrases.where(F.size("w") > 1)
    # the best extension to either side decides; it is one word longer
    extensions = (long_ones.where(F.size("w") > 2)
                  .select(F.explode(F.array(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1))).alias("w"), "f")
                  .groupBy("w").agg(F.max("f").alias("extended")))
    kept = (long_ones.join(extensions, "w", "left").where(F.col("extended").isNull() | (5 * F.col("extended") < 4 * F.col("f")))
            .select("w", F.col("f").alias("a")))
    cuts = kept.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    sides = cuts.select("w", "a", "k", F.explode(F.array(
        F.struct(F.slice("w", F.lit(1), F.col("k")).alias("part"), F.lit(True).alias("left")),
        F.struct(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("part"), F.lit(False).alias("left")))).alias("s"))
    counted = (sides.select("w", "a", "k", F.col("s.left").alias("left"), F.col("s.part").alias("part"))
               .join(phrases.select(F.col("w").alias("part"), "f"), "part")
               .groupBy("w", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
               .withColumn("score", F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0)) div (CAST(l AS DECIMAL(20, 0)) + r)")))
    judged = counted.groupBy("w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    named = (judged.select("w", "a", "cut", F.posexplode("w").alias("at", "gid")).join(words.select("gid", "lang", "word"), "gid")
             .groupBy("w", "a", "cut").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
             .select("lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
