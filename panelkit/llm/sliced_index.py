"""Spelling variant grouping over a bit-sliced position index.

The vocabulary is counted with built-in functions. Two words are near if they
differ by exactly one inserted, deleted or replaced letter. Such a pair, whose
shorter word has ``s`` letters, shares the first ``s // 2`` letters or the last
``s - s // 2``, so every word meets others only within groups of equal halves.
A task lays groups side by side into blocks and holds, per position and letter,
the set of the block's words with that letter there, one bit a word. All words
of a block are then sought at once: sets of words with no error so far and with
one (replaced, inserted, deleted: the same letters met at the same position, one
later, one earlier) go on letter by letter with a few word operations. In the
groups of equal ends, words that share the first half too are left out, so each
pair is found once. Bits stand in order of falling counts: the first set bit is
the most frequent near word.

Groups of more than ``CHUNK`` words are dealt over chunks by hash, and each of
their words is sought in every chunk; a task holds one block or one chunk, and
streams what it seeks. Only (word, number of near words, best of them) leaves a
task, never pairs. Roots come from pointer doubling; counts at least double
along forms, so the rounds grow with the logarithm of the logarithm of the
largest count.

Null texts hold no words, null ids count as empty text in the checksum; repeated rows
count as often as they stand there; empty tables give no rows; of ties in count
the word smallest in code-point order is the form.
"""

from __future__ import annotations

from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm._tables import stored

#: Fixed value: the letters of a word.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a group that one index may hold.
CHUNK = 16_384
#: Bits of a block of small groups, and letters that a block may hold.
BLOCK, BLOCK_LETTERS = 2_048, 4_000_000
#: 64-bit words that one set of the words sought may take.
SOUGHT = 65_536
#: Bytes of index that are kept instead of made anew for each batch of words sought.
KEPT = 128 << 20


def misspelt(doc_id: Column, run: Column, every: int = 97) -> Column:
    """``run`` less one letter, where ``every`` divides the checksum of
    ``<doc_id>:<run>``; else ``run``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words, thinned by :func:`misspelt`, that have
    ``min_length`` letters and stand ``min_count`` times."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col).cast("string"), UPPER, LOWER), F.lit(LETTERS), F.lit(0))
    words = (docs.select(F.col(id_col).alias("_id"), F.explode(runs).alias("_run"))
             .select(misspelt(F.col("_id"), F.col("_run")).alias("word")))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


def _rows(batches):
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        yield from zip(*columns)


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of words, a row each, 0 beyond their ends."""
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


def _bits(flags: np.ndarray, size: int) -> np.ndarray:
    """Rows of flags as rows of ``size`` 64-bit words."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    out = np.zeros((*flags.shape[:-1], size * 8), np.uint8)
    out[..., :packed.shape[-1]] = packed
    return out.view("<u8")


class PositionIndex:
    """Words of ``short`` or ``short + 1`` letters as bitsets per position and letter."""

    def __init__(self, words: list[str], short: int):
        self.words, self.short = words, short
        self.size = -(-len(words) // 64)
        codes = _codes(words, short + 1)
        self.alphabet = np.unique(codes)
        self.codes = np.searchsorted(self.alphabet, codes)
        lengths = np.array([len(w) for w in words])
        self.is_short, self.is_long = _bits(lengths == short, self.size), _bits(lengths == short + 1, self.size)
        self.keep = (short + 1) * (len(self.alphabet) + 1) * self.size * 8 <= KEPT
        self.kept: dict[int, np.ndarray] = {}

    def at(self, position: int) -> np.ndarray:
        """Per letter of the alphabet the words that have it at ``position``;
        the last row, of all other letters, is empty."""
        found = self.kept.get(position)
        if found is None:
            flags = np.arange(len(self.alphabet) + 1)[:, None] == self.codes[None, :, position]
            found = _bits(flags, self.size)
            if self.keep:
                self.kept[position] = found
        return found

    def near(self, words: list[str], allowed: np.ndarray, spared: int | None) -> np.ndarray:
        """For each word, a set: the allowed words at exactly one error from it,
        without those that share its first ``spared`` letters."""
        codes = _codes(words, self.short + 1)
        places = np.searchsorted(self.alphabet, codes)
        places[(places == len(self.alphabet)) | (self.alphabet[np.minimum(places, len(self.alphabet) - 1)] != codes)] = len(self.alphabet)
        lengths = np.array([len(w) for w in words])
        out = np.zeros(allowed.shape, np.uint64)
        for is_long in (False, True):
            rows = np.flatnonzero(lengths == self.short + is_long)
            if len(rows):
                out[rows] = self._near(places[rows], allowed[rows], spared, is_long)
        return out

    def _near(self, places, none, spared, is_long):
        """The recurrences. ``none``: words that agree so far; ``replaced``,
        ``inserted``, ``deleted``: words that do but for that one error."""
        replaced, inserted, deleted = (np.zeros_like(none) for _ in range(3))
        shared = none if spared == 0 else None
        last = self.short + is_long
        here, before = self.at(0), None
        for i in range(last):
            letter = places[:, i]
            same = here[letter]
            following = self.at(i + 1) if i < self.short else None
            if is_long:
                deleted = (deleted & before[letter]) | none if before is not None else none
            else:
                inserted = (inserted | none) & following[letter]
                replaced = (replaced & same) | (none & ~same)
            none = none & same
            if i + 1 == spared:
                shared = none
            before, here = here, following
        if is_long:
            found = deleted & self.is_short
        else:
            found = (replaced & self.is_short) | ((inserted | none) & self.is_long)
        return found if shared is None else found & ~shared


def _best(index: PositionIndex, counts: np.ndarray, words: list[str], found: np.ndarray):
    """Rows of the words that have near words: how many, and the first of them."""
    number = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
    rows = np.flatnonzero(number)
    place = (found[rows] != 0).argmax(axis=1)
    word = found[rows, place]
    bit = place * 64 + np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1))
    return pa.RecordBatch.from_arrays([
        pa.array([words[r] for r in rows], pa.string()), pa.array(number[rows]),
        pa.array([index.words[b] for b in bit], pa.string()), pa.array(counts[bit], pa.int64())],
        names=["word", "near", "best", "best_n"])


def _search(batches):
    """Rows sorted by group and, in it, index before sought, falling count, word."""
    block, sizes, of = [], [], (0, 0)

    def flush():
        if not block:
            return
        (short, side), words, counts = of, [w for w, _ in block], np.array([n for _, n in block])
        index = PositionIndex(words, short)
        group = np.repeat(np.arange(len(sizes)), sizes)
        step = max(1, SOUGHT // index.size)
        for at in range(0, len(words), step):
            mine = group[at:at + step]
            inside = _bits(np.arange(mine[0], mine[-1] + 1)[:, None] == group[None, :], index.size)
            found = index.near(words[at:at + step], inside[mine - mine[0]], short // 2 if side else None)
            yield _best(index, counts, words[at:at + step], found)
        block.clear()
        sizes.clear()

    for (short, side, _, chunk), rows in groupby(_rows(batches), lambda r: r[:4]):
        if chunk is None:
            words = [(r[5], r[6]) for r in rows]
            if len(words) < 2:
                continue
            if block and (of != (short, side) or len(block) + len(words) > max(64, min(BLOCK, BLOCK_LETTERS // (short + 1)))):
                yield from flush()
            of = short, side
            block += words
            sizes.append(len(words))
            continue
        rows = iter(rows)
        held, sought = [], []
        for r in rows:
            if r[4]:
                sought.append(r[5])
                break
            held.append((r[5], r[6]))
        if not held:
            continue
        index, counts = PositionIndex([w for w, _ in held], short), np.array([n for _, n in held])
        everything = _bits(np.ones(len(held), bool), index.size)
        while sought:
            sought += [r[5] for r in islice(rows, max(1, SOUGHT // index.size) - len(sought))]
            found = index.near(sought, np.tile(everything, (len(sought), 1)), short // 2 if side else None)
            yield _best(index, counts, sought, found)
            sought = [r[5] for r in islice(rows, 1)]
    yield from flush()


def near_words(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (n, word of the near word of largest n,
    ties to the smaller word) of the words (distinct, with count ``n``) that have near ones."""
    size, classes = F.length("word"), []
    for shorter in (0, 1):
        short = size - shorter
        for side in (0, 1):
            half = F.substring("word", F.lit(1), F.floor(short / 2).cast("int")) if side == 0 else \
                F.substring("word", size - (short - F.floor(short / 2)).cast("int") + 1, size)
            classes.append(F.struct(short.alias("short"), F.lit(side).alias("side"), half.alias("half")))
    keyed = words.select("word", "n", F.explode(F.array(*classes)).alias("k")).where("k.short > 0").select("k.*", "word", "n")
    group = ["short", "side", "half"]
    hot = (keyed.groupBy(*group).count().where(F.col("count") > chunk)
           .select(*group, F.ceil(F.col("count") / chunk).cast("int").alias("chunks")))
    dealt = keyed.join(hot, group, "left")
    cold = dealt.where("chunks IS NULL").select(*group, F.lit(None).cast("int").alias("chunk"), F.lit(0).alias("role"), "word", "n")
    split = dealt.where("chunks IS NOT NULL")
    held = split.select(*group, F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("role"), "word", "n")
    sought = split.select(*group, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("role"), "word", "n")
    rows = (cold.unionByName(held).unionByName(sought).repartition(*group, "chunk")
            .sortWithinPartitions(*group, "chunk", "role", F.desc("n"), "word"))
    found = rows.mapInArrow(_search, "word string, near long, best string, best_n long")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word"))).alias("best")) \
        .select("word", "n_near", F.struct((-F.col("best.minus")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of (word, form): forms followed to the last one."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "roots")
        links = step.select("word", "root")
        if step.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, id_col: str = "doc_id", text_col: str = "text",
             chunk: int = CHUNK) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word."""
    words = stored(vocabulary(docs, min_length, min_count, id_col, text_col), "vocabulary")
    near = near_words(words, chunk)
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best.n") >= 2 * F.col("n"), F.col("best")).alias("form"))
    judged = stored(judged.select("word", "n", "n_near", F.col("form.word").alias("form"), F.col("form.n").alias("form_n")), "variants")
    found = roots(judged.where("form IS NOT NULL"))
    return judged.join(found, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
