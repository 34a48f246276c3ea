"""The Jaccard join against brute force over all pairs."""
import random
import re

import numpy as np
import pytest
from panelkit.llm import _drop, digest_tree
from panelkit.llm import signature_tree as st
from panelkit.llm.components import components
from panelkit.llm.queries import QUERIES


def shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def by_hand(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    live = [n for n in range(len(rows)) if sets[n] and rows[n][0] is not None]
    for p, a in enumerate(live):
        for b in live[p + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 40, 120, 300]))] for _ in range(n // 6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        text = " ".join(words)
        if rng.random() < 0.3:
            text = passage + " " + text
        rows.append((i, text.upper() if rng.random() < 0.2 else text))
    return rows


EDGE = [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "ONE"), (9005, "one two"), (None, "one"), (9006, "w " * 30_000),
        (9007, "w w w"), (9008, "Straße ist lang genug hier"), (9009, "strasse ist lang genug hier"), (9010, "a b c d"), (9010, "one")]


@pytest.mark.parametrize("shingle,percent", [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_components_equal_all_pairs(make_docs, shingle, percent):
    rows = corpus(240, shingle) + EDGE
    assert found(st.jaccard_components(make_docs(rows), shingle=shingle, percent=percent)) == by_hand(rows, shingle, percent)


def test_keys_of_the_same_sets_are_searched_once(make_docs, monkeypatch):
    searched, grouped = [], st._grouped

    def counting(rows, keys, work):
        if keys[0] == "key":
            searched.append(rows.select("key", "class").distinct().count())
        return grouped(rows, keys, work)
    monkeypatch.setattr(st, "_grouped", counting)
    passage = " ".join(f"word{i}" for i in range(200))
    rows = [(i, f"{passage} end{i}") for i in range(6)] + [(10 + i, f"{i}first {passage}") for i in range(3)]
    assert found(st.jaccard_components(make_docs(rows))) == by_hand(rows, 5, 80)
    assert searched and searched[0] <= 4  # of some forty keys and two size classes


def test_large_groups_go_through_chunks(make_docs, monkeypatch):
    monkeypatch.setattr(st, "SIGNATURE_CHUNK", 16)
    monkeypatch.setattr(st, "SET_CHUNK", 8)
    monkeypatch.setattr(st, "PIVOTS", 2)
    rng = random.Random(11)
    base = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(220):  # chains of edits: far ends don't link directly
        words = list(base)
        for _ in range(1 + i // 40):
            words[rng.randrange(60)] = f"new{rng.randrange(30)}"
        rows.append((i, " ".join(words)))
    rows += corpus(80, 3)[40:]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert found(st.jaccard_components(make_docs(rows), shingle=2, percent=90)) == by_hand(rows, 2, 90)


def test_empty_table(make_docs):
    assert st.jaccard_components(make_docs([])).collect() == []
    assert st.drop_near_copies(make_docs([])).collect() == []
    only = [(1, None), (2, "a b c d e f")]
    assert found(st.jaccard_components(make_docs(only))) == by_hand(only, 5, 80)


def test_query_equals_all_pairs(spark, sf, documents):
    assert found(QUERIES["op7_signature_tree"](spark, sf)) == by_hand(documents, 3, 90)


def test_one_of_each_group_stays(make_docs):
    text = " ".join(f"w{i}" for i in range(100))
    df = make_docs([(3, text), (2, text + " end"), (8, "other words here to keep"), (None, text), (5, None)])
    out = st.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "5", "8", "None"]


def test_bounds_never_prune_a_link():
    rng = np.random.default_rng(6)
    sets = []
    for n in (5, 40, 41, 300, 330):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for _ in range(6):
            own = base.copy()
            own[: rng.integers(0, max(1, n // 8))] = rng.integers(0, 2**63)
            sets.append(np.unique(own))
    sizes = np.array([len(s) for s in sets])
    tree = st.SignatureTree(sizes, st.folded([st.signature(s) for s in sets]))
    for percent in (80, 90):
        left = {(min(a, b), max(a, b)) for i, j in st.dual_traversal(tree, tree, percent) for a, b in zip(i.tolist(), j.tolist())}
        linked = set()
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (sizes[a] + sizes[b] - both):
                    linked.add((a, b))
        assert linked and linked <= left and len(left) < len(sets) * (len(sets) - 1) // 2


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (100, 102), (7, 7), (200, 150)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("bits", [1 << 24, 1 << 15])
def test_rows_are_dropped_by_a_filter_and_a_join_of_the_doubtful(spark, monkeypatch, bits):
    monkeypatch.setattr(_drop, "FILTER_BITS", bits)
    ids = [None, None, 0, -5, 2**62, 2**62 + 1, *range(1000, 5000), 1000]
    df = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "doc_id long, text string")
    for gone in ([], [0, 2**62], list(range(1000, 5000, 2))):
        out = _drop.drop_rows(df, "doc_id", spark.createDataFrame([(i,) for i in gone], "id long"))
        want = sorted((f"text {n}" for n, i in enumerate(ids) if i is None or i not in set(gone)))
        assert sorted(r.text for r in out.collect()) == want and out.columns == df.columns


def test_texts_that_stay_are_not_joined(make_docs):
    rows = [(i, " ".join(f"w{i % 40}x{k}" for k in range(30))) for i in range(60)]
    for out in (st.drop_near_copies(make_docs(rows)), digest_tree.drop_copies(make_docs(rows), keep="min")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lstrip().startswith("Union") or "Union" in plan.split("Join")[0]
        assert sorted(r.doc_id for r in out.collect()) == list(range(40))
