"""Connected components: right, and in few rounds on long paths."""
import random

import pytest
from panelkit.llm import components as cc


def brute(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.fixture
def counted(monkeypatch):
    made = []
    real = cc.stored

    def counting(df, label):
        made.append(label)
        return real(df, label)
    monkeypatch.setattr(cc, "stored", counting)
    return made


def run(spark, links):
    rows = cc.components(spark.createDataFrame(links, "a long, b long")).collect()
    out = {r.node: r.component for r in rows}
    assert len(out) == len(rows)
    return out


def test_an_ordered_path_takes_one_contraction(spark, counted):
    path = [(i, i + 1) for i in range(1000)]
    assert run(spark, path) == {i: 0 for i in range(1001)}
    assert counted.count("links") == 2  # the links, and none left
    assert counted.count("hooks") <= 12  # the hooks, and log2(1000) doublings


def test_stars_and_mixed_graphs(spark, counted):
    star = [(i, 500) for i in range(500)]
    assert run(spark, star) == {i: 0 for i in range(501)}
    assert counted.count("links") <= 3
    rng = random.Random(1)
    ids = list(range(10_000, 10_400))
    rng.shuffle(ids)
    mixed = ([(a, b) for a, b in zip(ids[:150], ids[1:151])] + [(ids[200], x) for x in ids[201:260]] + [(5, 5), (6, 7), (7, 6), (6, 7)]
             + [(rng.choice(ids[260:]), rng.choice(ids[260:])) for _ in range(120)])
    counted.clear()
    want = brute([(a, b) for a, b in mixed if a != b])
    assert run(spark, mixed) == want and counted.count("links") <= 6
    assert run(spark, []) == {}
