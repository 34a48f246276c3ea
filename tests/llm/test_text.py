"""Licenses, line dedup, language and quality against brute force, planted cases and held-out rows."""
import itertools
from collections import defaultdict

import numpy as np
import pytest
from panelkit.llm import lang_viterbi, license_templates, line_mph, quality_ftrl
from panelkit.llm.license_templates import BASE, TEMPLATES, Automaton, regex_of, words_of
from panelkit.llm.queries import QUERIES
from pyspark.sql import functions as F

LONG = "this is a line of more than forty code points"


def kept_by_hand(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars and i is not None:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if not (len(h := holders.get(key(x), ())) >= min_docs and i != max(h))]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


LINES = [(1, None), (2, ""), (3, f"{LONG}\nx"), (4, f"  {LONG.upper()}\t\ny\n{LONG}"), (5, f"a\n{LONG}\r"), (6, LONG), (7, f"{LONG}\n{LONG}"),
         (7, f"{LONG}\n{LONG}"), (8, "é" * 39), (9, "é" * 40), (10, "é" * 40), (11, "é" * 40 + "\n"), (12, "é" * 40), (13, "\né" + "é" * 39),
         (None, f"{LONG}\nnull id"), (14, "z" * 200_000), (15, "\n\n\n")]


def test_line_dedup_edges(make_docs):
    for shard_keys, round_keys in ((250_000, 1_500_000), (1, 1)):
        got = line_mph.drop_frequent_lines(make_docs(LINES), shard_keys=shard_keys, round_keys=round_keys).collect()
        assert sorted((tuple(r) for r in got), key=str) == kept_by_hand(LINES)
    assert line_mph.drop_frequent_lines(make_docs([])).collect() == []
    assert [tuple(r) for r in line_mph.drop_frequent_lines(make_docs([(1, "a")])).collect()] == [(1, 1, 0, "a")]


def test_line_dedup_rounds_on_the_table(make_docs, documents):
    got = line_mph.drop_frequent_lines(make_docs(documents), min_docs=2, shard_keys=7, round_keys=30).collect()
    assert sorted((tuple(r) for r in got), key=str) == kept_by_hand(documents, min_docs=2)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        h1, h2 = rng.integers(0, 2**64, n, np.uint64), rng.integers(0, 2**64, n, np.uint64)
        if n:
            h1[: n // 2] = h1[0]  # the first halves alone don't tell keys apart
        mph = line_mph.PerfectHash.unpacked(line_mph.PerfectHash.build(h1, h2).packed())
        assert sorted(mph.number(h1, h2).tolist()) == list(range(n))


MIT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
       'documentation files (the "Software"), to deal in the Software without restriction')


def test_templates_accept_mandatory_wording_only(make_docs):
    rows = [(1, "This work is released under the MIT License."), (2, "released under the terms of the MIT license"),
            (3, "released under a MIT license"), (4, "Licensed under CC BY-NC 4.0."), (5, "cc by nc"), (6, "licensed under cc by-nc"),
            (7, "This small thing is licensed under the GNU General Public License, version 3."), (8, "GNU General Public License version 2"),
            (9, MIT), (10, MIT.replace('(the "Software")', "")), (11, MIT.replace("hereby", "")), (12, None), (13, ""),
            (14, "Licensed under the Apache License, Version 2.0. " * 400), (15, "word " * 50_000 + "under the mit license"),
            (16, "Licensed under the Apache License Version 2.1")]
    got = {r.id: sorted({(m.label, m.kind) for m in r.matches}) for r in license_templates.scan_licenses(make_docs(rows)).collect()}
    both = lambda x: [(x, "phrase"), (x, "template")]
    assert got == {1: both("mit"), 2: [("mit", "template")], 3: [], 4: both("cc-by-nc"), 5: [("cc-by-nc", "phrase")],
                   6: [("cc-by-nc", "phrase")], 7: [("gpl-3", "template")], 8: [], 9: [("mit", "template")], 10: [("mit", "template")],
                   11: [], 12: [], 13: [], 14: both("apache-2"), 15: [("mit", "phrase")], 16: [("apache-2", "phrase")]}
    spans = [r for r in license_templates.scan_licenses(make_docs(rows)).collect() if r.id == 1][0].matches
    assert {(m.kind, m.first, m.end) for m in spans} == {("phrase", 4, 8), ("template", 0, 8)}
    assert license_templates.scan_licenses(make_docs([])).collect() == []


def test_automaton_is_its_regular_expression():
    import re
    markup = 'a <<beginOptional>>b <<var;name="v";words="1-2">><<endOptional>> c <<var;name="w";words="0-1">> a'
    automaton, pattern = Automaton("x", markup), re.compile(regex_of(markup))
    for n in range(1, 7):
        for words in itertools.product("abc", repeat=n):
            text = "".join(f" {w}" for w in words) + " "
            assert bool(automaton.matches([w.encode() for w in words])) == bool(pattern.search(text)), words
    with pytest.raises(ValueError):
        Automaton("x", '<<var;name="v";words="0-2">> a')
    assert words_of("A–b\x00c 2.0É") == ["a–b".encode(), b"c", b"2", "0É".encode()]
    assert len(BASE) == 3 and all(Automaton(*t).mandatory for t in TEMPLATES)


def best_path(scores, penalty):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        total = sum(scores[i, p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        best = max(best, total) if best is not None else total
    return best


def test_viterbi_is_optimal():
    rng = np.random.default_rng(3)
    scores = rng.normal(0, 3, (40, 3))
    texts = [rng.integers(0, 40, n).astype(np.int32) for n in (0, 1, 5, 7, 3, 7, 0, 6)]
    for text, path in zip(texts, lang_viterbi.viterbi(texts, scores, 2.0)):
        assert len(path) == len(text)
        if len(text):
            total = scores[text, path].sum() - 2.0 * (np.diff(path) != 0).sum()
            assert total == pytest.approx(best_path(scores[text], 2.0))


def test_language_spans_and_edges(make_docs, spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = lang_viterbi.learn(docs, ~lang_viterbi.held_out())
    texts = dict(docs.where("lang = 'de' AND length(text) > 400").select("doc_id", "text").limit(1).collect())
    german = next(iter(texts.values()))[:300]
    english = docs.where("lang = 'en' AND length(text) > 400").first().text[:300]
    rows = [(1, german + " " + english * 2), (2, None), (3, ""), (4, "123 !? ²½ 456"), (5, "кириллица"), (6, german), (None, german), (6, german)]
    got = {}
    for r in lang_viterbi.label_languages(make_docs(rows), model).collect():
        got[r.id] = r
    assert got[1].lang_pred == "en" and [s.lang for s in got[1].spans][0] == "de" and {s.lang for s in got[1].spans} == {"de", "en"}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].spans == [] for i in (2, 3, 4))
    assert got[5].lang_pred in model.langs and got[5].score == 0
    assert got[6].lang_pred == got[None].lang_pred == "de" and got[6].score > 0.9
    kept = lang_viterbi.drop_rejected(make_docs([(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(20)] + [(50, ""), (51, "42")]))
    assert {r.doc_id for r in kept.collect()} == set(range(20)) and "lang_pred" in kept.columns
    nothing = lang_viterbi.learn(make_docs([]), F.lit(True))
    assert [r.lang_pred for r in lang_viterbi.label_languages(make_docs([(1, "abc")]), nothing).collect()] == ["und"]
    assert lang_viterbi.label_languages(make_docs([]), model).collect() == []


def test_texts_that_fit_no_language_go(make_docs, spark, sf):
    rng = np.random.default_rng(7)
    letters = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(n)) for n in (20, 60, 2000)]
    unlearned = ["wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
                 "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
                 "watu wote wamezaliwa huru hadhi na haki zao ni sawa wote wamejaliwa akili na dhamiri hivyo yapasa watendeane kindugu"]
    clean = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    bad = [(1_000_000 + i, t, None) for i, t in enumerate(letters + unlearned)]
    kept = {r.doc_id for r in lang_viterbi.drop_rejected(make_docs(clean + bad)).collect()}
    assert kept == {r[0] for r in clean}


def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op9_lang_viterbi"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.lang_pred == r.lang for r in got) / len(got)
    assert len(got) > 150 and right >= 0.97, right


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op2_quality_ftrl"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r for r in got if r.quality], [r for r in got if not r.quality]
    auc = sum((a.score > b.score) + 0.5 * (a.score == b.score) for a in good for b in bad) / (len(good) * len(bad))
    right = sum(r.predicted == r.quality for r in got) / len(got)
    assert auc >= 0.95 and right >= 0.93, (auc, right)


def test_quality_edges(make_docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (1, 0)], "doc_id long, quality int")
    docs = make_docs([(1, "A fine sentence, and one more."), (2, "BAD!! BAD!! BAD!!"), (3, None), (None, ""), (4, "x" * 100_000), (4, "?")])
    got = quality_ftrl.score_quality(docs, quality_ftrl.learn(docs, labels, F.lit(True))).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = quality_ftrl.learn(docs, labels.where("false"), F.lit(True))
    assert {r.score for r in quality_ftrl.score_quality(docs, none).collect()} == {0.5}
    assert quality_ftrl.score_quality(make_docs([]), none).collect() == []


def test_ftrl_separates_and_stays_sparse():
    rng = np.random.default_rng(5)
    rows = [(np.concatenate([rng.integers(100, quality_ftrl.SIZE, 30), [7 if y else 8] * 5]), int(y)) for y in rng.integers(0, 2, 300)]
    w = quality_ftrl.train(rows, 3, 0.3, 1.0, 0.1, 0.5)
    assert w[7] > 0.5 and w[8] < -0.5 and (w != 0).mean() < 0.1
