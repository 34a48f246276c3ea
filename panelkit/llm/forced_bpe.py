"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A token can only span two neighbouring bytes if that byte pair occurs inside
some token of the vocabulary. Every other neighbouring pair is therefore a
certain cut: no merge ever crosses it. After the special tokens and the
pre-token pattern have split a text, each piece is cut at such pairs, the
fragments are encoded independently (lowest merge rank first, leftmost among
equal ranks) and their ids are concatenated. Fragments are short and repeat,
so each task remembers those it has met, in tables of bounded size.

The vocabulary is read on the driver and shipped with the task, so executors
need not see the file. Null texts count as empty and give no ids. Special
tokens inside a text are encoded as such. Rows are independent of each other:
repeated rows, extra columns and empty tables need no care; a very long
fragment is merged through a heap (n log n).
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm._memory import lean

#: The public byte-level pre-token pattern (white space as the Unicode property).
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: What the pattern finds in ASCII texts, with plain classes.
ASCII_PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
                  r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: Entries that a task's tables of known words and of known fragments may hold.
KNOWN = 300_000
#: Rows that a task holds as Python objects at once.
SLICE = 256
#: Fragments up to this length are merged by looking for the lowest rank again and again.
SHORT = 24


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where printable, else the next free one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Tables of one vocabulary; made in each task from the file's text."""

    def __init__(self, packed: bytes):
        import regex

        spec = json.loads(zlib.decompress(packed))
        alphabet = byte_alphabet()
        raw = lambda tok: bytes(map(alphabet.__getitem__, tok))
        self.ids = {raw(tok): i for tok, i in spec["model"]["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        #: rank of each pair of ids, and by rank the id of both joined
        self.ranks, self.joined_id = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = raw(a), raw(b)
            self.ranks[self.ids[a], self.ids[b]] = rank
            self.joined_id.append(self.ids[a + b])
        #: joined[a, b]: whether byte a is ever followed by byte b inside a token
        self.joined = np.zeros((256, 256), bool)
        tokens = np.frombuffer(b"".join(self.ids), np.uint8)
        inside = np.ones(len(tokens) - 1, bool)
        inside[np.cumsum([len(tok) for tok in self.ids])[:-1] - 1] = False  # a token's last byte and the next one's first
        self.joined[tokens[:-1][inside], tokens[1:][inside]] = True
        self.apart = set(map(tuple, np.argwhere(~self.joined).tolist()))
        #: the bytes of every id, to look up many at once
        self.pieces = pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of) + 1)], pa.large_binary())
        self.byte_id = [self.ids[bytes([b])] for b in range(256)]
        self._words, self._ascii_words = regex.compile(PRETOKEN).findall, re.compile(ASCII_PRETOKEN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                      + ")").split if self.special else None

    def words(self, text: str) -> list[str]:
        """The pre-tokens of ``text``."""
        return self._ascii_words(text) if text.isascii() else self._words(text)

    def fragments(self, piece: bytes) -> list[bytes]:
        """``piece`` cut at every byte pair that no token contains."""
        if len(piece) <= SHORT:
            cuts = [i for i, pair in enumerate(zip(piece, piece[1:]), 1) if pair in self.apart]
        else:
            b = np.frombuffer(piece, np.uint8)
            cuts = (np.flatnonzero(~self.joined[b[:-1], b[1:]]) + 1).tolist()
        if not cuts:
            return [piece]
        ends = [0, *cuts, len(piece)]
        return [piece[i:j] for i, j in zip(ends, ends[1:])]

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the pair of lowest rank, leftmost first, is
        joined until no pair has a rank."""
        ids, n, ranks = [self.byte_id[b] for b in fragment], len(fragment), self.ranks
        if n <= SHORT:
            rank_of, none, joined_id = ranks.get, len(self.joined_id), self.joined_id
            found = [rank_of(p, none) for p in zip(ids, ids[1:])]
            while found and (rank := min(found)) != none:
                i = found.index(rank)
                ids[i] = joined_id[rank]
                del ids[i + 1], found[i]
                if i:  # only the neighbours' pairs have changed
                    found[i - 1] = rank_of((ids[i - 1], ids[i]), none)
                if i < len(found):
                    found[i] = rank_of((ids[i], ids[i + 1]), none)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = self.joined_id[ranks[pair]], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := (ids[i], ids[k])) in ranks:
                    heapq.heappush(heap, (ranks[p], i, p))
            if (h := before[i]) >= 0 and (p := (ids[h], ids[i])) in ranks:
                heapq.heappush(heap, (ranks[p], h, p))
        return [i for i in ids if i >= 0]


class Known(dict):
    """Packed ids by key; made on demand, emptied when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= KNOWN:
            self.clear()
        self[key] = out = self.make(key)
        return out


class Encoder:
    """Whole texts to packed ids, remembering words and fragments met."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.fragment = Known(lambda f: _pack(codec.merge(f)))
        self.word = Known(lambda w: b"".join([self.fragment[f] for f in codec.fragments(w.encode())]))

    def __call__(self, text: str | None) -> bytes:
        codec, word = self.codec, self.word.__getitem__
        if codec.specials is None:
            return b"".join(map(word, codec.words(text or "")))
        return b"".join([_pack([codec.special[part]]) if part in codec.special else b"".join(map(word, codec.words(part)))
                         for part in codec.specials(text or "")])


def _pack(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _decoded(codec: Codec, ids: list[bytes | None]) -> list[str]:
    """The texts of many rows' ids: all their bytes are looked up at once, and
    lie one row after the other."""
    ids = [i or b"" for i in ids]
    flat = np.frombuffer(b"".join(ids), "<u4")
    found = codec.pieces.take(pa.array(flat)) if flat.max(initial=0) < len(codec.pieces) else None
    if found is None or found.null_count:
        raise KeyError("an id that the vocabulary does not hold")
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
    _, offsets, data = found.buffers()
    at = np.frombuffer(offsets, np.int64)[found.offset + ends].tolist() if offsets else [0] * len(ends)
    whole = memoryview(data) if data else memoryview(b"")
    return [str(whole[i:j], "utf-8", "replace") for i, j in zip(at, at[1:])]


def _by_slices(packed: bytes, make):
    """Maps slices of a few rows, so that a task holds few texts at once;
    ``make(codec)`` gives the function from a slice to its columns."""
    def run(batches):
        work = make(Codec(packed))
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                columns = work(b.slice(at, SLICE))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return lean(run)


def _encoding(codec: Codec, and_decode: bool):
    encoder = Encoder(codec)

    def work(b):
        ids = [encoder(t.as_py()) for t in b.column(1)]
        out = {"id": b.column(0), "ids": pa.array(ids, pa.binary())}
        return out | ({"decoded": pa.array(_decoded(codec, ids), pa.string())} if and_decode else {})
    return work


def _decoding(codec: Codec):
    return lambda b: {"id": b.column(0), "ids": b.column(1), "decoded": pa.array(_decoded(codec, b.column(1).to_pylist()), pa.string())}


def unsupported(spec: dict) -> list[str]:
    """What a vocabulary file asks for that is not done here."""
    model, first = spec["model"], spec.get("pre_tokenizer") or {}
    found = [f"{k} of the model" for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                                           "ignore_merges") if model.get(k)]
    if model.get("type", "BPE") != "BPE":
        found.append(f"model {model['type']}")
    if spec.get("normalizer"):
        found.append("a normalizer")
    if first.get("type") != "ByteLevel" or first.get("add_prefix_space") or not first.get("use_regex", True):
        found.append("a pre-tokenizer other than byte level with its pattern and no prefix space")
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        found.append("a decoder other than byte level")
    if any(a.get(k) for a in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        found.append("added tokens with conditions")
    return found


def read_vocabulary(path: str) -> bytes:
    """A byte-level BPE file of the tokenizers library, packed for shipping
    (under 1 MB). Files that ask for anything else are refused."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if found := unsupported(json.loads(text)):
        raise ValueError(f"vocabulary not supported: {', '.join(found)}")
    return zlib.compress(text.encode(), 6)


def _ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def _schema(df: DataFrame, decoded: bool) -> T.StructType:
    fields = [T.StructField("id", df.schema["id"].dataType), T.StructField("ids", T.BinaryType())]
    return T.StructType(fields + ([T.StructField("decoded", T.StringType())] if decoded else []))


def encode(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``ids``: the token ids as little-endian unsigned 32-bit integers."""
    src = _ids_and_texts(docs, id_col, text_col)
    return src.mapInArrow(_by_slices(vocabulary, lambda codec: _encoding(codec, False)), _schema(src, False))


def decode(encoded: DataFrame, vocabulary: bytes) -> DataFrame:
    """``encoded`` with column ``decoded``, the text of its ``ids``; bytes that
    are no UTF-8 become the replacement character."""
    src = encoded.select("id", "ids")
    return src.mapInArrow(_by_slices(vocabulary, _decoding), _schema(src, True))


def round_trip(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`decode` of :func:`encode` in one pass: ``id``, ``ids``, ``decoded``."""
    src = _ids_and_texts(docs, id_col, text_col)
    return src.mapInArrow(_by_slices(vocabulary, lambda codec: _encoding(codec, True)), _schema(src, True))
