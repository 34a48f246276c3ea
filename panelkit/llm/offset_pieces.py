"""Offset-preserving SentencePiece encoding and decoding (BPE models).

A text is first normalised: at each place the longest prefix that the model's
compiled character map knows is replaced, spaces become the mark U+2581 and
the dummy prefix is set in front. Every byte of the result keeps the place of
the source prefix it came from. The normalised text is cut at byte pairs that
no piece of the vocabulary holds (no merge crosses them), each distinct
fragment of a slice is merged once (best score first, leftmost among equals)
and unknown characters fall back to their bytes. Since the pieces tile the
normalised text, their running lengths give normalised spans, which the kept
places project back to spans of original bytes. All but the merging of
fragments not met before is array work.

The model is read on the driver and shipped with the task. Null texts count as
empty and give the begin and end ids alone. Rows are independent: repeated
rows, null ids, extra columns and empty tables need no care. A task holds one slice of texts
at a time, at least one text; a very long fragment is merged through a heap
(n log n). Spans are 32-bit: texts under 4 GB.

Models that ask for what is not done here (unigram, pieces marked user defined
or unused, no byte fallback, marks as suffix, unescaped spaces, a
denormalising map) are refused when read.
"""

from __future__ import annotations

import heapq
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the mark that stands for a space.
MARK = "▁"
#: Piece types of the file format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Fragments that a task remembers.
KNOWN = 400_000
#: Bytes of text that a task works on at once (a longer text is a slice alone).
SLICE = 4 << 20
#: Fragments up to this length are merged by looking for the best pair again and again.
SHORT = 24


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at
    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"field of kind {kind} in a model file")
        yield key >> 3, value


def read_model(path: str) -> bytes:
    """A BPE model file of the sentencepiece library, packed for shipping."""
    with open(path, "rb") as f:
        return pack_model(f.read())


def pack_model(data: bytes) -> bytes:
    """A serialised model, checked and packed for shipping."""
    packed = zlib.compress(data, 6)
    Pieces(packed)
    return packed


class CharMap:
    """The compiled character map: a double-array trie whose values are places
    in a block of replacements that end with a zero byte."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0]
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replacements = blob[4 + size:]
        #: may[a, b]: whether a key can start with byte a when byte b follows
        self.may = np.zeros((256, 256), bool)
        for a in range(256):
            node = self._child(self._base(0, self.units[0]), a)
            if node is None:
                continue
            base, unit = node
            if unit >> 8 & 1:
                self.may[a] = True
            else:
                self.may[a] = [self._child(base, b) is not None for b in range(256)]

    @staticmethod
    def _base(at: int, unit: int) -> int:
        return at ^ (unit >> 10 << ((unit & 512) >> 6))

    def _child(self, base: int, byte: int):
        at = base ^ byte
        unit = self.units[at] if at < len(self.units) else 0x80000000
        return (self._base(at, unit), unit) if unit & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int):
        """(end, replacement) of the longest key that starts at ``at``, or None."""
        base, found = self._base(0, self.units[0]), None
        for i in range(at, len(text)):
            node = self._child(base, text[i])
            if node is None:
                break
            base, unit = node
            if unit >> 8 & 1:
                found = i + 1, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        end, place = found
        return end, self.replacements[place:self.replacements.index(b"\0", place)]


class Pieces:
    """Tables of one model; made in each task from the packed file."""

    def __init__(self, packed: bytes):
        self.ids, self.scores, self.byte_id, self.surface, kinds = {}, [], [None] * 256, [], []
        spec = {"trainer": {}, "normalizer": {}, "denormalizer": {}}
        for number, value in _fields(zlib.decompress(packed)):
            if number == 1:
                piece = dict(_fields(value))
                text, kind = piece[1].decode(), piece.get(3, NORMAL)
                kinds.append(kind)
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                if kind == NORMAL:
                    self.ids[text] = len(kinds) - 1
                    self.surface.append(text.replace(MARK, " ").encode())
                elif kind == BYTE:
                    byte = int(text[3:5], 16)
                    self.byte_id[byte] = len(kinds) - 1
                    self.surface.append(bytes([byte]))
                elif kind in (CONTROL, UNKNOWN):
                    self.surface.append(b"")
                else:
                    raise ValueError(f"pieces of type {kind} are not supported: {text!r}")
            elif number in (2, 3, 5):
                spec[{2: "trainer", 3: "normalizer", 5: "denormalizer"}[number]] = dict(_fields(value))
        trainer, normalizer = spec["trainer"], spec["normalizer"]
        for ok, what in ((trainer.get(3, 1) == 2, "only BPE models"), (None not in self.byte_id, "only models with byte fallback"),
                         (not trainer.get(24, 0), "no marks as suffix"), (normalizer.get(5, 1), "only escaped spaces"),
                         (not spec["denormalizer"].get(2), "no denormalising map")):
            if not ok:
                raise ValueError(f"model not supported: {what}")
        self.kinds = np.array(kinds)
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown = trainer.get(44, " ⁇ ".encode()).decode()
        self.prefix, self.squeeze = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        self.charmap = CharMap(normalizer[2]) if normalizer.get(2) else None
        inner = [text.replace(MARK, " ").encode() for text in self.ids]
        tokens = np.frombuffer(b"".join(inner), np.uint8)
        inside = np.ones(len(tokens) - 1, bool)
        inside[np.cumsum([len(t) for t in inner])[:-1] - 1] = False  # a piece's last byte and the next one's first
        #: apart[a * 256 + b]: byte a is never followed by byte b inside a piece
        self.apart = np.ones(65536, bool)
        self.apart[tokens[:-1][inside].astype(np.int32) * 256 + tokens[1:][inside]] = False
        self.known: dict[bytes, bytes] = {}

    # -- normalisation ---------------------------------------------------

    def _mapped(self, data: np.ndarray, ends: np.ndarray):
        """Bytes after the character map, the source place of each, the ends of
        the texts among them, and where each text's leading spaces stop."""
        raw = data.tobytes()
        out, places, new_ends, leads, total, start = [], [], [], [], 0, 0
        for end in ends.tolist():
            text = raw[start:end]
            b = data[start:end]
            after = np.append(b[1:], 0)
            candidates = np.flatnonzero(self.charmap.may[b, after] & ((b & 0xC0) != 0x80)).tolist()
            at = lead = 0
            leading = True
            for c in candidates:
                if c < at or (hit := self.charmap.longest(text, c)) is None:
                    continue
                if leading and text[at:c].strip(b" "):
                    lead, leading = at + len(text[at:c]) - len(text[at:c].lstrip(b" ")), False
                if leading and hit[1] != b" ":
                    lead, leading = c, False
                out += [text[at:c], hit[1]]
                places += [np.arange(start + at, start + c), np.full(len(hit[1]), start + c)]
                total += c - at + len(hit[1])
                at = hit[0]
            if leading:
                lead = at + len(text[at:]) - len(text[at:].lstrip(b" "))
            out.append(text[at:])
            places.append(np.arange(start + at, end))
            total += end - start - at
            new_ends.append(total)
            leads.append(start + lead)
            start = end
        return (np.frombuffer(b"".join(out), np.uint8), np.concatenate(places).astype(np.int64), np.array(new_ends, np.int64),
                np.array(leads, np.int64))

    def normalised(self, data: np.ndarray, ends: np.ndarray):
        """All texts of a slice normalised: bytes (0x20 for the mark), the
        source place of each byte, the texts' ends among them, and the source
        place at which each text's last piece ends."""
        starts = np.append(0, ends[:-1])
        if self.charmap is None:
            out, src, stops = data, np.arange(len(data)), ends
            lead = starts
            if self.squeeze:
                solid = np.flatnonzero(out != 32)
                lead = np.minimum(np.append(solid, len(out))[np.searchsorted(solid, starts)], ends)
        else:
            out, src, stops, lead = self._mapped(data, ends)

        def kept(keep, out, src, stops):
            return out[keep], src[keep], np.append(0, np.cumsum(keep))[stops]
        if self.squeeze and len(out):
            space = out == 32
            before = np.append(True, space[:-1])
            first = np.append(0, stops[:-1])
            before[first[first < len(out)]] = True
            out, src, stops = kept(~(space & before), out, src, stops)
        if len(out) > 2:
            mark = np.flatnonzero((out[:-2] == 0xE2) & (out[1:-1] == 0x96) & (out[2:] == 0x81))
            if len(mark):
                out = out.copy()
                out[mark] = 32
                keep = np.ones(len(out), bool)
                keep[mark + 1] = keep[mark + 2] = False
                out, src, stops = kept(keep, out, src, stops)
        last = ends.copy()
        if self.squeeze:
            first = np.append(0, stops[:-1])
            solid = np.append(-1, np.flatnonzero(out != 32))
            tail = np.maximum(solid[np.searchsorted(solid, stops) - 1] + 1, first)
            cut = tail < stops
            last[cut] = src[tail[cut]]
            step = np.zeros(len(out) + 1, np.int64)
            np.add.at(step, tail, 1)
            np.add.at(step, stops, -1)
            out, src, stops = kept(np.cumsum(step)[:-1] == 0, out, src, stops)
            filled = np.diff(stops, prepend=0) > 0
        else:
            filled, lead = ends > starts, starts
        if self.prefix:
            first = np.append(0, stops[:-1])[filled]
            out, src = np.insert(out, first, 32), np.insert(src, first, lead[filled])
            stops = stops + np.cumsum(filled)
        return out, src, stops, last

    # -- merging ---------------------------------------------------------

    def merged(self, fragment: str) -> list[str]:
        """Pieces of a fragment: the neighbours whose joint piece scores best,
        leftmost first, are joined until no pair is a piece."""
        ids, scores, parts, n = self.ids, self.scores, list(fragment), len(fragment)
        if n <= SHORT:
            while len(parts) > 1:
                best, place = None, -1
                for i in range(len(parts) - 1):
                    found = ids.get(parts[i] + parts[i + 1])
                    if found is not None and (best is None or scores[found] > best):
                        best, place = scores[found], i
                if place < 0:
                    break
                parts[place:place + 2] = [parts[place] + parts[place + 1]]
            return parts
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i, j):
            joint = parts[i] + parts[j]
            if (found := ids.get(joint)) is not None:
                heapq.heappush(heap, (-scores[found], i, j, joint))
        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, joint = heapq.heappop(heap)
            if not parts[i] or not parts[j] or after[i] != j or len(parts[i]) + len(parts[j]) != len(joint):
                continue
            parts[i], parts[j] = joint, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if (h := before[i]) >= 0:
                offer(h, i)
        return [p for p in parts if p]

    def fragment(self, data: bytes) -> bytes:
        """(id, length in bytes) of the pieces of a fragment, packed. Of the
        bytes of an unknown character the last has its length, the others 0."""
        found = self.known.get(data)
        if found is None:
            pairs = []
            for part in self.merged(data.decode().replace(" ", MARK)):
                raw = part.replace(MARK, " ").encode()
                if (known := self.ids.get(part)) is not None:
                    pairs += [known, len(raw)]
                else:
                    for i, byte in enumerate(MARK.encode() if part == MARK else raw):
                        pairs += [self.byte_id[byte], 0]
                    pairs[-1] = len(raw)
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[data] = found = struct.pack(f"<{len(pairs)}i", *pairs)
        return found

    # -- slices ----------------------------------------------------------

    def encode(self, data: np.ndarray, ends: np.ndarray):
        """Texts of a slice to ids and source spans: (ids, begins, ends, number
        of ids of each text), begin and end ids included."""
        starts = np.append(0, ends[:-1])
        out, src, stops, last = self.normalised(data, ends)
        n, texts = len(out), len(ends)
        head = np.zeros(n, bool)
        if n:
            head[1:] = self.apart[out[:-1].astype(np.int32) * 256 + out[1:]] & ((out[1:] & 0xC0) != 0x80)
            head[np.append(0, stops[:-1])[np.diff(stops, prepend=0) > 0]] = True
        heads = np.flatnonzero(head)
        offsets = np.append(heads, n).astype(np.int32)
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out))]
                                            ).dictionary_encode()
        packed = [self.fragment(f) for f in coded.dictionary.to_pylist()]
        table = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2)
        sizes = np.array([len(p) // 8 for p in packed], np.int64)
        which = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[which] if len(which) else np.zeros(0, np.int64)
        at = np.append(0, np.cumsum(counts))
        rows = np.repeat((np.cumsum(sizes) - sizes)[which] - at[:-1], counts) + np.arange(at[-1]) if len(which) else np.zeros(0, np.int64)
        ids, lengths = table[rows, 0], table[rows, 1].astype(np.int64)
        to = np.cumsum(lengths)
        begins = src[to - lengths] if len(to) else to
        following = np.append(src[1:], 0)
        following[stops[np.diff(stops, prepend=0) > 0] - 1] = last[np.diff(stops, prepend=0) > 0]
        closes = np.where(lengths > 0, following[to - 1], begins) if len(to) else to
        token_ends = at[np.searchsorted(heads, stops)]
        per_text = np.diff(token_ends, prepend=0)
        owner = np.repeat(np.arange(texts), per_text)
        total = len(ids) + 2 * texts
        place = np.arange(len(ids)) + 2 * owner + 1
        first = np.append(0, np.cumsum(per_text + 2)[:-1]) if texts else np.zeros(0, np.int64)
        final = first + per_text + 1
        all_ids, spans = np.empty(total, "<u4"), np.empty((total, 2), "<u4")
        all_ids[place], spans[place, 0], spans[place, 1] = ids, begins - starts[owner], closes - starts[owner]
        all_ids[first], spans[first] = self.begin, 0
        all_ids[final], spans[final] = self.end, (ends - starts)[:, None]
        return all_ids, spans, per_text + 2

    def decode_one(self, ids) -> str:
        """Text of any ids, as the library joins them: bytes that are no UTF-8
        become one replacement character each."""
        out, run, leading = [], bytearray(), self.prefix or self.squeeze

        def flush():
            while run:
                try:
                    out.append(run.decode())
                    run.clear()
                except UnicodeDecodeError as e:
                    out.append(run[:e.start].decode() + "�" * (e.end - e.start))
                    del run[:e.end]
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                run += self.surface[i]
                leading = False
                continue
            flush()
            if kind == CONTROL:
                continue
            piece = self.unknown if kind == UNKNOWN else self.surface[i].decode()
            if leading and kind == NORMAL and piece.startswith(" "):
                piece, leading = piece[1:], self.squeeze
            if piece:
                leading = False
                out.append(piece)
        flush()
        return "".join(out)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of a slice of ids; array work where every text is one begin id,
        pieces that join to UTF-8, and one end id."""
        if len(counts) == 0:
            return pa.array([], pa.string())
        kinds = self.kinds[ids]
        stops = np.cumsum(counts)
        first, final = stops - counts, stops - 1
        plain = (not self.squeeze and counts.min() >= 2 and not (kinds == UNKNOWN).any()
                 and (kinds == CONTROL).sum() == 2 * len(counts) and (kinds[first] == CONTROL).all() and (kinds[final] == CONTROL).all())
        if plain:
            taken = pa.array(self.surface, pa.binary()).take(pa.array(ids.astype(np.int64)))
            offsets = np.frombuffer(taken.buffers()[1], np.int32)[:len(ids) + 1].astype(np.int64)
            data = np.frombuffer(taken.buffers()[2] or b"", np.uint8)[:offsets[-1]]
            begin, end = offsets[first], offsets[stops]
            lead = np.zeros(len(counts), bool)
            if self.prefix:
                lead = (end > begin) & (kinds[np.minimum(first + 1, len(ids) - 1)] == NORMAL)
                lead[lead] = data[begin[lead]] == 32
            data = np.delete(data, begin[lead])
            texts = pa.StringArray.from_buffers(len(counts), pa.py_buffer(np.append(0, np.cumsum(end - begin - lead)).astype(np.int32)),
                                                pa.py_buffer(data))
            try:
                texts.validate(full=True)
                return texts
            except pa.ArrowInvalid:
                pass
        return pa.array([self.decode_one(ids[a:b].tolist()) for a, b in zip(first, stops)], pa.string())


def _cuts(sizes: np.ndarray, limit: int):
    """Slices of rows of at most ``limit`` bytes, or one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, base + limit, "right")), at + 1)
        yield at, to
        at = to


def _bytes_of(column: pa.Array):
    """Bytes and ends of the values of a column; null counts as empty."""
    values = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(values) else np.zeros(0, np.uint8)
    return data, (offsets[1:] - offsets[0]).astype(np.int64)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    sizes = counts * (values.itemsize * (values.shape[1] if values.ndim > 1 else 1))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
        None, pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _sliced(packed: bytes, work, source: int, limit: int):
    """Maps slices of rows, cut by the bytes of column ``source``."""
    def run(batches):
        pieces = Pieces(packed)
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(source)), 0).to_numpy(zero_copy_only=False)
            for at, to in _cuts(sizes, limit):
                columns = work(pieces, b.slice(at, to - at))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return run


def _encoding(and_decode: bool):
    def work(pieces, b):
        ids, spans, counts = pieces.encode(*_bytes_of(b.column(1)))
        out = {"id": b.column(0), "ids": _binary(ids, counts), "spans": _binary(spans, counts)}
        return out | ({"decoded": pieces.decode(ids, counts)} if and_decode else {})
    return work


def _decoding(pieces, b):
    data, ends = _bytes_of(b.column(1))
    ids = np.frombuffer(data.tobytes(), "<u4")
    return {"id": b.column(0), "ids": b.column(1), "decoded": pieces.decode(ids, np.diff(ends, prepend=0) // 4)}


def _schema(df: DataFrame, *columns: str) -> T.StructType:
    kinds = {"ids": T.BinaryType(), "spans": T.BinaryType(), "decoded": T.StringType()}
    return T.StructType([T.StructField("id", df.schema["id"].dataType)] + [T.StructField(c, kinds[c]) for c in columns])


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``ids`` (little-endian unsigned 32-bit integers) and ``spans``
    (for each id two such integers: first byte and end in the UTF-8 text)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_sliced(model, _encoding(False), 1, SLICE), _schema(src, "ids", "spans"))


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``id``, ``ids`` and ``decoded``, the text of the ids; null ids are an empty text."""
    src = encoded.select("id", "ids")
    return src.mapInArrow(_sliced(model, _decoding, 1, SLICE), _schema(src, "ids", "decoded"))


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`decode` of :func:`encode` in one pass: ``id``, ``ids``, ``spans``, ``decoded``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_sliced(model, _encoding(True), 1, SLICE), _schema(src, "ids", "spans", "decoded"))
