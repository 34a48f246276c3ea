"""Spelling variants: the index against edit distances of all pairs."""
import random
import zlib
from collections import Counter

import pytest
from panelkit.llm import sliced_index as si


def one_error(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts: dict[str, int]) -> dict:
    out, forms = {}, {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if one_error(w, v)]
        best = min(near, default=None)
        forms[w] = best[1] if best and -best[0] >= 2 * n else None
        out[w] = [n, len(near), forms[w], -best[0] if forms[w] else None]
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def words_of(seed: int, letters: str, number: int, longest: int) -> dict[str, int]:
    rng = random.Random(seed)
    out = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, longest))): rng.choice([3, 3, 4, 6, 12, 30, 30, 400])
           for _ in range(number)}
    for w in list(out)[::3]:
        i = rng.randrange(len(w))
        out.setdefault(rng.choice([w[:i] + "z" + w[i + 1:], w[:i] + w[i] + w[i:], w[:i] + "é" + w[i:]]), rng.choice([3, 7, 9]))
    return out


def found(df) -> dict:
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("chunk", [si.CHUNK, 7])
def test_near_words_are_those_of_all_pairs(spark, chunk):
    counts = words_of(1, "ab", 250, 9) | words_of(2, "abcdefghij", 300, 12) | {"x" * 400: 3, "x" * 401: 9, "x" * 300 + "y" * 100: 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r["word"]: (r["n_near"], r["best"]["n"], r["best"]["word"]) for r in si.near_words(df, chunk).collect()}
    want = {}
    for w in counts:
        near = [(-m, v) for v, m in counts.items() if one_error(w, v)]
        if near:
            want[w] = (len(near), -min(near)[0], min(near)[1])
    assert got == want


def test_short_words_are_found_too(spark):
    counts = {w: 3 for w in ("a", "b", "ab", "ba", "abc", "bc", "c", "cb", "aab", "aaab", "abbba", "abba")}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r["word"]: r["n_near"] for r in si.near_words(df).collect()} == \
        {w: k for w in counts if (k := sum(one_error(w, v) for v in counts))}


def test_whole_operator_with_odd_rows(spark, make_docs):
    base = words_of(3, "abcé", 80, 8)
    rng = random.Random(4)
    stream = [w for w, n in base.items() for _ in range(n)]
    rng.shuffle(stream)
    rows = [(i, " ".join(stream[i::40])) for i in range(40)] + [(5, " ".join(stream[5::40]).upper()), (None, "abcab abcab, abcab"),
            (50, None), (51, ""), (52, "1" * 1000), (53, "q" * 200_000 + " " + "q" * 200_000 + "!" + "q" * 200_000)]
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for ch in (text or "") + " ":
            if "A" <= ch <= "Z" or "a" <= ch <= "z" or "À" <= ch <= "ÿ":
                run += ch.lower() if ch <= "Z" else ch
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                at = h % len(run)
                counts[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
            run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = found(si.variants(make_docs(rows)))
    assert got == brute(counts) and any(v[2] for v in got.values()) and "q" * 200_000 in got
    assert si.variants(make_docs([])).collect() == []


def test_roots_follow_chains(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(100)] + [("side", "w050")]
    got = dict(si.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {w: "w100" for w, _ in chain}
