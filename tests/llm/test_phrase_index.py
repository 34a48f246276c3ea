"""Phrase collocations: the index against plain counting."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from panelkit.llm import phrase_index as px


def plain_pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def grams(pieces, length):
    return Counter(tuple(p[i:i + length]) for p in pieces for i in range(len(p) - length + 1))


def brute(rows, top=2000, longest=4, least=30):
    out = []
    for lang in sorted({r[2] or "und" for r in rows}):
        pieces = [p for r in rows if (r[2] or "und") == lang for p in plain_pieces(r[1])]
        f = {}
        for k in range(1, longest + 1):
            f |= grams(pieces, k)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p: max((b for q, b in cands.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))), default=0)
                  for p in cands}
        scored = []
        for p, a in cands.items():
            if 100 * inside[p] >= 80 * a and inside[p]:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        n = sum(len(p) for p in pieces)
        out += [(lang, i + 1, p.decode(), a, left, right, n, -s) for i, (s, _, p, a, left, right) in enumerate(sorted(scored)[:top])]
    return out


def corpus(seed, docs=120):
    rng = random.Random(seed)
    words = ["the", "of", "Öl", "data", "big", "new", "york", "city", "a", "x\x01y", "été"]
    rows = []
    for i in range(docs):
        out = []
        for _ in range(rng.randrange(60)):
            out.append(rng.choice(["new york city hall", "big data", "the the the", rng.choice(words), rng.choice(words), "rare%d" % rng.randrange(500)]))
            out.append(rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", " ; "]))
        rows.append((i, "".join(out).upper() if i % 7 == 0 else "".join(out), rng.choice(["en", "en", "fr", None])))
    return rows


def test_words_and_breaks_are_those_of_plain_splitting():
    texts = [r[1] for r in corpus(1, 30)] + ["", ".", "a", "b. ", " c", "d..e\n\nf", "g"]
    raw = [t.encode() for t in texts]
    words, ids = px.words_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]))
    names = ["|"] + words.to_pylist()
    low = "|".join(" ".join(p) for t in texts for p in [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", t)] if p)
    assert " ".join(names[i] for i in ids).replace(" | ", "|") == low


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5])
def test_index_counts_all_phrases_by_extension_to_both_sides(length):
    rng = np.random.default_rng(length)
    ids = rng.integers(0, 6, 3_000)
    phrases, counts = px.BidirectionalIndex(ids, length).phrases(length)
    got = {tuple(p): n for p, n in zip(phrases.tolist(), counts.tolist())}
    assert len(got) == len(phrases)
    pieces = [[int(w) for w in p.split()] for p in " ".join(map(str, ids)).split("0")]
    assert got == grams(pieces, length)


def test_both_intervals_stay_in_step():
    ids = np.random.default_rng(7).integers(0, 5, 800)
    index = px.BidirectionalIndex(ids, 4)
    text = np.append(0, ids)

    def places(t):
        rows = [tuple(np.roll(t, -i)[:4].tolist()) for i in range(len(t))]
        return sorted(rows)
    forward, backward = places(text), places(text[::-1])
    found, spans = index.words()
    for step, right in ((2, True), (3, False)):
        found, spans = index.extend(found, spans, right)
        for p, a, b, n in zip(found.tolist(), *spans):
            assert all(r[:step] == tuple(p) for r in forward[a:a + n])
            assert all(r[:step] == tuple(p[::-1]) for r in backward[b:b + n])


@pytest.mark.parametrize("stray", [False, True])
def test_cut_keeps_what_longer_phrases_need(stray):
    """Also where the filter lets other phrases through."""
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 9, 5_000)
    gid = np.arange(1, 9) * 7
    plain = lambda seq: [[int(w) for w in p.split()] for p in " ".join(map(str, seq)).split("0")]
    pieces, filters, left = plain(ids), [], ids
    for k in (2, 3):
        often = [p for p, n in grams(pieces, k).items() if n >= 9]
        bits = np.zeros(px.FILTER_BITS, bool)
        bits[(px.phrase_hash([gid[np.array(often)[:, i] - 1] for i in range(k)]) % np.uint64(px.FILTER_BITS)).astype(np.int64)] = True
        if stray:
            bits[::2] = True
        filters.append(np.packbits(bits, bitorder="little"))
        left = px.narrowed(ids, gid, filters)
        got, want = grams(plain(left), k + 1), grams(pieces, k + 1)
        sure = {p for p in want if all(p[i:i + k] in set(often) for i in range(2))}
        if k == 2:
            assert {p: got[p] for p in sure} == {p: want[p] for p in sure}
            assert stray or set(got) == sure
        frequent = {p: n for p, n in want.items() if n >= 9}
        assert {p: got[p] for p in frequent} == frequent


def test_runs_are_packed_and_folded_whole():
    rng = np.random.default_rng(5)
    columns = [rng.integers(0, 5, 900) * 10**8, rng.integers(0, 4, 900), rng.integers(1, 9, 900)]
    back = px.unpack(px.pack(*columns), 900, 3)
    assert all((a == b).all() for a, b in zip(back, columns))
    *words, n = px._folded(back)
    want = Counter()
    for a, b, k in zip(*columns):
        want[a, b] += k
    assert {(a, b): k for a, b, k in zip(*words, n)} == want and len(n) == len(want)


@pytest.mark.parametrize("shard_bytes", [px.SHARD, 2_000])
def test_collocations_equal_plain_counting(spark, make_docs, shard_bytes):
    rows = corpus(2) + [(3, "big data " * 40, "en"), (None, "new york city hall " * 5, None), (900, None, "en"), (901, "", None), (902, "the " * 30_000, "de")]
    got = px.collocations(make_docs(rows), shard_bytes=shard_bytes).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))
    assert {"und", "de", "en"} <= {r["lang"] for r in got}


def test_many_buckets_give_the_same(spark, make_docs, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(px, "BUCKET", 40)
    got = px.collocations(make_docs(rows), shard_bytes=3_000).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_top_and_empty_tables(spark, make_docs):
    rows = corpus(5)
    got = px.collocations(make_docs(rows), top=3, min_count=5).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, top=3, least=5))
    assert px.collocations(make_docs([])).collect() == []
