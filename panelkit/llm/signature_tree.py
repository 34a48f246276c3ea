"""N-gram Jaccard join by signature trees.

A text's set holds its distinct word shingles. A signature is a bitmap of a
set's tokens, with two to four times as many bits as tokens. A tree sorts the
rows of a task by size; its leaves hold a few rows, its nodes the OR of their
bitmaps, their size range and their slack (tokens beyond the bits set). Two
trees are traversed together, level by level: a pair of nodes is pruned when
the sizes are too far apart or when the largest possible overlap - common bits
plus slack - is below what the threshold asks of the smallest sizes. Pairs of
rows get the sharper bound of tokens that cannot be shared; what is left is
verified on the whole sets.

Which rows meet in a task loses no link. Tokens have one order everywhere:
long shingles first, so that common short words come last, then by hash. Sets
that link share one of the first ``n - ceil(t * n) + 1`` tokens, and their
sizes fall into the same or neighbouring classes of ratio ``t``. So

1. equal sets are collapsed to one, and its tokens at the front are its keys;
2. for each key and size class held by several sets, trees over signatures
   alone find the pairs that may link, and give back a forest over them (once
   for the keys, such as those of a passage, that the same sets hold);
3. the forest's components gather each set with all that it may link with; each
   set goes once to the tasks of its component, where trees verify on whole
   sets, skipping pairs already connected, and give back the links that count;
4. the components of these links are the answer.

Groups of any size are split into chunks of bounded size. In step 2 all pairs
of chunks meet. In step 3 chunks are first linked within themselves and with a
few common pivots of the group; afterwards only the rows outside the group's
largest component meet the other chunks. No pair within a group is ever
emitted, just forests.

Null and empty texts, and texts without words, have an empty set and link
with nothing. Fewer words than a shingle make one shingle. Rows with a null id
link with nothing (component null). Rows that share an id are one node. Tokens
are 54-bit hashes beside the length; a set's identity is a 128-bit digest.
Extra columns and empty tables need no care.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm._drop import drop_rows, filter_of, hits
from panelkit.llm._memory import lean
from panelkit.llm._tables import stored
from panelkit.llm.components import components
from panelkit.stages import releasing

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
KNOWN = 400_000
LEAF, FAN = 8, 8
#: Rows of a chunk that only brings signatures, and of one that brings whole sets.
SIGNATURE_CHUNK, SET_CHUNK = 4_096, 2_048
#: Expected number of pivots of a group of several chunks.
PIVOTS = 64


class _Words(dict):
    """Number of each word; its hash and byte length by number."""

    def __init__(self):
        super().__init__()
        self.hashes, self.lengths = np.zeros(1024, np.uint64), np.zeros(1024, np.int64)

    def __missing__(self, word):
        n = len(self)
        if n == len(self.hashes):
            self.hashes, self.lengths = np.resize(self.hashes, 2 * n), np.resize(self.lengths, 2 * n)
        self[word] = n
        self.hashes[n] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self.lengths[n] = len(word)
        return n


def token_set(text: str | None, words: _Words, size: int) -> np.ndarray:
    """Sorted distinct tokens: ten bits for the length (long first), 54 of hash."""
    found = WORD.findall((text or "").encode().lower())
    if not found:
        return np.zeros(0, np.uint64)
    at = np.array(list(map(words.__getitem__, found)), np.int64)
    width = min(size, len(at))
    n = len(at) - width + 1
    mixed, length = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for i in range(width):
        mixed = (mixed ^ words.hashes[at[i:i + n]]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        length += words.lengths[at[i:i + n]]
    short = (1023 - np.minimum(length, 1023)).astype(np.uint64)
    return np.unique((short << np.uint64(54)) | (mixed >> np.uint64(10)))


def front(n: int, percent: int) -> int:
    """How many of the first tokens two linked sets must share one of."""
    return n - -(-percent * n // 100) + 1 if n else 0


def signature(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of the tokens; as many bits as the power of two from 2 n on."""
    bits = 64 << max(0, math.ceil(math.log2(max(1, 2 * len(tokens)) / 64)))
    at = np.unique(tokens * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(bits)
    out = np.zeros(bits // 64, np.uint64)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def folded(bitmaps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of different widths, all folded to the smallest one."""
    width = min(map(len, bitmaps))
    return np.array([np.bitwise_or.reduce(b.reshape(-1, width), axis=0) for b in bitmaps])


class SignatureTree:
    """Rows in order of size; levels from the rows up to at most FAN nodes."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        self.order = np.lexsort((bitmaps[:, 0], sizes))
        n, b = sizes[self.order], bitmaps[self.order]
        slack = n - np.bitwise_count(b).sum(1, dtype=np.int64)
        self.levels = [(b, n, n, slack)]
        fan = LEAF
        while len(self.levels[-1][1]) > FAN:
            b, lo, hi, slack = self.levels[-1]
            at = np.arange(0, len(lo), fan)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.maximum.reduceat(slack, at)))
            fan = FAN

    def below(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of each node at ``level``, and which of the nodes they belong to."""
        fan = LEAF if level == 1 else FAN
        width = np.minimum(fan, len(self.levels[level - 1][1]) - nodes * fan)
        owner = np.repeat(np.arange(len(nodes)), width)
        return nodes[owner] * fan + np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width), owner


def may_link(a, i: np.ndarray, b, j: np.ndarray, percent: int, rows: bool) -> np.ndarray:
    """Which of the pairs (i of level a, j of level b) the bounds leave."""
    (ba, lo_a, hi_a, slack_a), (bb, lo_b, hi_b, slack_b) = a, b
    keep = np.flatnonzero((100 * hi_a[i] >= percent * lo_b[j]) & (100 * hi_b[j] >= percent * lo_a[i]))
    out = np.zeros(len(i), bool)
    step = max(1, 2_000_000 // ba.shape[1])
    for s in range(0, len(keep), step):
        k = keep[s:s + step]
        x, y = ba[i[k]], bb[j[k]]
        if rows:  # a bit of one set that the other lacks is a token not shared
            most = np.minimum(lo_a[i[k]] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64),
                              lo_b[j[k]] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
        else:
            most = np.bitwise_count(x & y).sum(1, dtype=np.int64) + np.minimum(slack_a[i[k]], slack_b[j[k]])
        # 100 overlap >= percent * union, union = sizes - overlap
        out[k] = (100 + percent) * most >= percent * (lo_a[i[k]] + lo_b[j[k]])
    return out


def dual_traversal(left: SignatureTree, right: SignatureTree, percent: int):
    """Arrays of row numbers (left, right) of the pairs that the bounds leave,
    part after part; each pair of one tree with itself comes once."""
    same = left is right
    top_a, top_b = len(left.levels) - 1, len(right.levels) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(left.levels[-1][1])), np.arange(len(right.levels[-1][1])), indexing="ij"))
    stack = [(top_a, top_b, i, j)]
    while stack:
        la, lb, i, j = stack.pop()
        if same and la == lb:
            ordered = i <= j if la else i < j
            i, j = i[ordered], j[ordered]
        ok = may_link(left.levels[la], i, right.levels[lb], j, percent, la == 0 and lb == 0)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            yield left.order[i], right.order[j]
            continue
        if len(i) > 20_000:
            for s in range(0, len(i), 20_000):
                stack.append((la, lb, i[s:s + 20_000], j[s:s + 20_000]))
            continue
        if la >= lb or same:
            i, owner = left.below(la, i)
            j, la = j[owner], la - 1
        if lb > la or same:
            j, owner = right.below(lb, j)
            i, lb = i[owner], lb - 1
        stack.append((la, lb, i, j))


class Forest:
    """Which rows are connected, as one label per row."""

    def __init__(self, labels: np.ndarray):
        self.labels = labels.copy()

    def join(self, a: int, b: int) -> bool:
        x, y = self.labels[a], self.labels[b]
        if x == y:
            return False
        self.labels[self.labels == max(x, y)] = min(x, y)
        return True


def _set_maker(size: int, percent: int, wanted: np.ndarray | None):
    """Per text: size, digest, and either signature and keys, or (of the texts
    that the filter ``wanted`` lets through) the whole set."""
    def make(batches):
        words = _Words()
        for b in batches:
            if len(words) > KNOWN:
                words = _Words()
            ids, texts = b.column(0), b.column(1)
            keep = range(b.num_rows) if wanted is None else _let_through(ids, wanted)
            n, digests, extra = [], [], []
            for i in keep:
                tokens = token_set(texts[i].as_py(), words, size)
                n.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                extra.append((signature(tokens).tobytes(), tokens[:front(len(tokens), percent)].view(np.int64))
                             if wanted is None else tokens.tobytes())
            ids = ids if wanted is None else ids.take(pa.array(keep, pa.int64()))
            head = [ids, pa.array(n, pa.int64()), pa.array(digests, pa.binary())]
            if wanted is None:
                yield pa.RecordBatch.from_arrays([*head, pa.array([x for x, _ in extra], pa.binary()),
                                                  pa.array([x for _, x in extra], pa.list_(pa.int64()))],
                                                 names=["id", "n", "digest", "bitmap", "keys"])
            else:
                yield pa.RecordBatch.from_arrays([*head, pa.array(extra, pa.binary())], names=["id", "n", "digest", "tokens"])
    return make


def _let_through(ids: pa.Array, wanted: np.ndarray) -> list[int]:
    known = np.flatnonzero(~np.array(ids.is_null()))
    return known[hits(np.array(ids.take(pa.array(known, pa.int64()))), wanted)].tolist()


def _per_group(keys: list[str], work):
    """Runs ``work`` on each run of rows with equal ``keys`` (rows come sorted
    by them); holds one group and one batch at a time."""
    def run(batches):
        held = None
        for b in batches:
            b = pa.concat_batches([held, b]) if held is not None else b
            if not b.num_rows:
                continue
            columns = [np.asarray(b.column(k)) for k in keys]
            cuts = (np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist()
            yield _links([x for s, e in zip([0, *cuts], cuts) for x in work(b.slice(s, e - s))])
            held = b.slice(cuts[-1] if cuts else 0)
        if held is not None:
            yield _links(work(held))
    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())],
                                      names=["a", "b"])


def _trees(group: pa.RecordBatch, sizes: np.ndarray, bitmaps: list[np.ndarray]):
    """The trees of a chunk pair's two sides (the same one for a chunk with itself)."""
    rows = folded(bitmaps)
    if group.column("i")[0].as_py() == group.column("j")[0].as_py():
        tree = SignatureTree(sizes, rows)
        return tree, tree, np.arange(len(sizes)), np.arange(len(sizes))
    second = np.array(group.column("second"), bool)
    a, b = np.flatnonzero(~second), np.flatnonzero(second)
    if not len(a) or not len(b):
        return None
    return SignatureTree(sizes[a], rows[a]), SignatureTree(sizes[b], rows[b]), a, b


def _forest_of_bounds(percent: int):
    def search(group: pa.RecordBatch) -> list[tuple[int, int]]:
        """Forest over the pairs that signatures don't rule out."""
        sid, guest, sizes = (np.array(group.column(c)) for c in ("sid", "guest", "n"))
        links = []
        if len(sid) > 1 and (trees := _trees(group, sizes, [np.frombuffer(x, np.uint64) for x in group.column("bitmap").to_pylist()])):
            left, right, rows_a, rows_b = trees
            forest = Forest(np.arange(len(sid)))
            for i, j in dual_traversal(left, right, percent):
                a, b = rows_a[i], rows_b[j]
                open_ = (forest.labels[a] != forest.labels[b]) & ~(guest[a] & guest[b])
                links += [(sid[x], sid[y]) for x, y in zip(a[open_].tolist(), b[open_].tolist()) if forest.join(x, y)]
        return links
    return search


def _forest_of_links(percent: int):
    def verify(group: pa.RecordBatch) -> list[tuple[int, int]]:
        """Forest over the pairs that link, beyond those already connected."""
        sid, sizes, links = np.array(group.column("sid")), np.array(group.column("n")), []
        sets = [np.frombuffer(x, np.uint64) for x in group.column("tokens").to_pylist()]
        if len(sid) > 1 and (trees := _trees(group, sizes, [signature(s) for s in sets])):
            left, right, rows_a, rows_b = trees
            forest = Forest(np.unique(np.array(group.column("label")), return_inverse=True)[1])
            for i, j in dual_traversal(left, right, percent):
                a, b = rows_a[i], rows_b[j]
                order = np.argsort(a, kind="stable")
                a, b = a[order], b[order]
                starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(a)]):
                    x = a[s]
                    others = b[s:e][forest.labels[b[s:e]] != forest.labels[x]]
                    if not len(others):
                        continue
                    tokens = np.concatenate([sets[y] for y in others])
                    at = np.minimum(np.searchsorted(sets[x], tokens), len(sets[x]) - 1)
                    shared = np.add.reduceat(sets[x][at] == tokens, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
                    linked = 100 * shared >= percent * (sizes[x] + sizes[others] - shared)
                    links += [(sid[x], sid[y]) for y in others[linked].tolist() if forest.join(x, y)]
        return links
    return verify


def _pair_checker(percent: int):
    def check(batches):
        """The pairs of sets (a, b) that their signatures don't rule out."""
        for b in batches:
            keep = []
            for k, (na, nb, x, y) in enumerate(zip(*[b.column(c).to_pylist() for c in ("na", "nb", "bitmap_a", "bitmap_b")])):
                x, y = folded([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                most = min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))
                if (100 + percent) * most >= percent * (na + nb):
                    keep.append(k)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep)], names=["a", "b"])
    return check


def _grouped(rows: DataFrame, keys: list[str], work) -> DataFrame:
    """The links that ``work`` finds in each group of ``rows`` by ``keys``."""
    return (rows.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lean(_per_group(keys, work)), "a long, b long"))


def _chunk(chunks: Column, salt: int = 0) -> Column:
    return F.pmod(F.xxhash64("sid", F.lit(salt)), chunks).cast("int")


def _all_chunk_pairs(rows: DataFrame, chunks: Column) -> DataFrame:
    """Each row to all pairs (i <= j) of its own chunk with the others."""
    own = rows.withColumn("own", _chunk(chunks)).withColumn("other", F.explode(F.sequence(F.lit(0), chunks.cast("int") - 1)))
    return (own.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .withColumn("second", F.col("own") == F.col("j")).drop("own", "other"))


def _size_class(n: Column, percent: int) -> Column:
    """Sizes whose ratio is at least ``percent`` fall into the same or neighbouring classes."""
    width = max(math.log(100.0 / percent), 1e-6) * 1.000001  # a little wider, so that rounding loses nothing
    return F.floor(F.log(n.cast("double")) / width).cast("int")


def _once_per_members(groups: DataFrame) -> DataFrame:
    """Of the groups (``key``, ``class``) with the same members one: the keys of a
    passage meet the same sets, which need comparing once. Members are told by
    their number and two independent 64-bit hashes, as sets are by their digest."""
    return (groups.groupBy("m", "a", "b", "members0", "members1").agg(F.min(F.struct("key", "class")).alias("one"))
            .select("one.key", "one.class", "m", "a", "b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                       percent: int = 80) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by
    links) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with releasing(docs.sparkSession) as step:
        rows = stored(src.mapInArrow(lean(_set_maker(shingle, percent, None)),
                                     "id long, n long, digest binary, bitmap binary, keys array<long>"), "jaccard-rows")
        known = rows.where("id IS NOT NULL AND n > 0")
        # 1. one row per distinct set
        sets = known.groupBy("digest", "n").agg(F.min("id").alias("first_id"), F.min(F.struct("id", "bitmap", "keys")).alias("one"))
        sets = stored(sets.select(F.monotonically_increasing_id().alias("sid"), "digest", "n", "first_id", "one.bitmap", "one.keys"), "jaccard-sets")

        # 2. keys of several sets, in the same or neighbouring size classes
        keys = sets.select("sid", "n", F.explode("keys").alias("key"))
        shared = keys.groupBy("key").agg(F.count("*").alias("m"), F.min("n").alias("lo")).where("m > 1").select("key")
        cells = (keys.join(shared, "key").withColumn("class", _size_class(F.col("n"), percent))
                 .withColumn("guest", F.explode(F.array(F.lit(False), F.lit(True))))
                 .select("key", (F.col("class") - F.col("guest").cast("int")).alias("class"), "sid", "guest"))
        cells = stored(cells, "jaccard-cells")
        busy = _once_per_members(cells.groupBy("key", "class").agg(
            F.count("*").alias("m"), F.count_if(~F.col("guest")).alias("owners"), F.min("sid").alias("a"), F.max("sid").alias("b"),
            *[F.bit_xor(F.xxhash64("sid", "guest", F.lit(salt))).alias(f"members{salt}") for salt in (0, 1)])
            .where("m > 1 AND owners > 0"))
        busy = stored(busy, "jaccard-busy")
        signed = sets.select("sid", "n", "bitmap")
        # two sets alone: a pair, often met under many keys
        pairs = (busy.where("m = 2").select("a", "b").distinct()
                 .join(signed.toDF("a", "na", "bitmap_a"), "a").join(signed.toDF("b", "nb", "bitmap_b"), "b"))
        more = busy.where("m > 2").select("key", "class", F.ceil(F.col("m") / SIGNATURE_CHUNK).alias("chunks"))
        met = _all_chunk_pairs(cells.join(more, ["key", "class"]).join(signed, "sid"), F.col("chunks"))
        maybe = (pairs.mapInArrow(lean(_pair_checker(percent)), "a long, b long")
                 .unionByName(_grouped(met, ["key", "class", "i", "j"], _forest_of_bounds(percent))))
        groups = stored(components(maybe).select(F.col("node").alias("sid"), F.col("component").alias("grp")), "jaccard-groups")
        step.release(rows, sets, groups)

        # 3. whole sets, once per set, to the tasks of their group
        needed = groups.join(sets.select("sid", "digest", "first_id"), "sid")
        wanted = filter_of(needed.select("first_id"))
        again = src.mapInArrow(lean(_set_maker(shingle, percent, wanted)), "id long, n long, digest binary, tokens binary")
        again = (again.groupBy(F.col("id").alias("first_id"), "digest")
                 .agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")))
        whole = stored(needed.join(again, ["first_id", "digest"]).select("sid", "grp", "n", "tokens"), "jaccard-whole")
        count = whole.groupBy("grp").agg(F.ceil(F.count("*") / SET_CHUNK).alias("chunks"), F.count("*").alias("m"))
        held = whole.join(count, "grp").withColumn("label", F.col("sid"))
        verify = _forest_of_links(percent)
        own = held.withColumn("i", _chunk(F.col("chunks")))
        pivots = (held.where((F.col("chunks") > 1) & (F.pmod(F.xxhash64("sid", F.lit(7)), F.col("m")) < PIVOTS))
                  .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)))
                  .where(F.col("i") != _chunk(F.col("chunks"))))
        links = _grouped(own.unionByName(pivots).withColumn("j", F.col("i")).withColumn("second", F.lit(False)),
                         ["grp", "i", "j"], verify)
        # ids that several sets share connect them
        of_id = known.select("id", "digest").distinct().join(sets.select("sid", "digest"), "digest")
        first = of_id.groupBy("id").agg(F.min("sid").alias("a"), F.count("*").alias("m")).where("m > 1")
        links = stored(links.unionByName(of_id.join(first, "id").select("a", F.col("sid").alias("b"))), "jaccard-links")
        step.release(rows, sets, whole, links)
        if whole.join(count.where("chunks > 1"), "grp", "left_semi").limit(1).count():
            links = links.unionByName(_links_between_chunks(held, components(links), verify))
        # 4. components of sets, named by their smallest id
        found = components(links)
        named = sets.join(found.withColumnRenamed("node", "sid"), "sid", "left").select(
            "digest", "first_id", F.coalesce("component", "sid").alias("component"))
        smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        by_set = named.join(smallest, "component").select("digest", "component_id")
        judged = (rows.select("id", "n", "digest").join(by_set, "digest", "left")
                  .select("id", F.col("n").alias("n_shingles"),
                          F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))
        return step.keep(stored(judged, "jaccard-classes"))  # three numbers a row: all other tables go


def _links_between_chunks(held: DataFrame, found: DataFrame, verify) -> DataFrame:
    """Links in groups of several chunks that don't lie within one chunk or at a
    pivot: rows outside the group's largest component meet all others."""
    rows = (held.where("chunks > 1").drop("label").join(found.withColumnRenamed("node", "sid"), "sid", "left")
            .withColumn("label", F.coalesce("component", "sid")).drop("component"))
    rows = stored(rows, "jaccard-rest")
    sizes = rows.groupBy("grp", "label").agg(F.count("*").alias("k"))
    main = sizes.groupBy("grp").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("all"))
    main = main.select("grp", F.col("top.label").alias("main"), F.ceil((F.col("all") - F.col("top.k")) / SET_CHUNK).cast("int").alias("rest_chunks"))
    rows = rows.join(main, "grp").withColumn("rest", F.col("label") != F.col("main")).where("rest_chunks > 0")
    # chunks of the rest are numbered from 0, those of the largest component from 1,000,000,000
    base = 1_000_000_000
    chunk = F.when(F.col("rest"), _chunk(F.col("rest_chunks"), 1)).otherwise(base + _chunk(F.col("chunks"), 1))
    rows = rows.withColumn("own", chunk)
    to_rest = (rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rest_chunks") - 1)))
               .select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    to_main = (rows.where("rest").withColumn("other", F.explode(F.sequence(F.lit(base), F.lit(base) + F.col("chunks").cast("int") - 1)))
               .select("*", F.col("own").alias("i"), F.col("other").alias("j")))
    return _grouped(to_rest.unionByName(to_main).withColumn("second", F.col("own") == F.col("j")), ["grp", "i", "j"], verify)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that link, over any path, with a smaller id."""
    found = jaccard_components(docs, id_col, **options)
    return drop_rows(docs, id_col, found.where("component_id < id").select("id").distinct())
