"""Whole results of the quality and language queries against plain versions:
one number after the other, no arrays, no shared code but the constants."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from panelkit.llm import lang_viterbi as lv
from panelkit.llm import quality_ftrl as qf
from panelkit.llm.queries import QUERIES

MASK = 2**64 - 1


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def spark_hash(doc_id):
    """xxhash64 of a long as Spark computes it, signed."""
    h = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), seed=42)
    return h - 2**64 if h >= 2**63 else h


# -- quality -------------------------------------------------------------

def shape(token, before):
    if token.lower() == before:
        return 5
    first = token[0]
    if not (first.isalnum() or first == "_"):
        return 4
    if token.isdigit():
        return 3
    if len(token) > 1 and token.isupper():
        return 2
    return 1 if first.isupper() else 0


def plain_features(text):
    """Bucket -> share of the features."""
    def bucket(x, salt):
        return ((x + salt) * 0x9E3779B97F4A7C15 & MASK) >> (64 - qf.BITS)
    tokens = re.findall(r"\w+|[^\w\s]", text or "")
    words = [zlib.crc32(t.lower().encode(errors="replace")) for t in tokens]
    shapes = [shape(t, tokens[i - 1].lower() if i else None) for i, t in enumerate(tokens)]
    found = Counter([bucket(w, 1) for w in words] + [bucket((a << 20 & MASK) ^ b, 2) for a, b in zip(words, words[1:])]
                    + [bucket(s, 3) for s in shapes] + [bucket(a * 8 + b, 4) for a, b in zip(shapes, shapes[1:])])
    total = sum(found.values())
    return {b: n / total * qf.SCALE for b, n in found.items()}


def plain_ftrl(rows, epochs=3, alpha=0.3, beta=1.0, l1=0.02, l2=0.5):
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)
    for _ in range(epochs):
        for x, y in rows:
            x = {**x, "bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def test_quality_scores_are_those_of_a_plain_learner(spark, sf, documents):
    texts = dict(documents)
    assert len(texts) == len(documents)
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
              if r.doc_id is not None and r.quality is not None and fold(r.doc_id, 4) != 2 and r.doc_id in texts]
    shards = defaultdict(list)
    for doc_id, y in sorted(labels, key=lambda r: (spark_hash(r[0]), r[1], texts[r[0]] or "")):
        shards[spark_hash(doc_id) % 6].append((plain_features(texts[doc_id]), y))
    mean = defaultdict(float)
    for rows in shards.values():
        for i, w in plain_ftrl(rows).items():
            mean[i] += w * len(rows) / len(labels)
    got = {r.doc_id: r for r in QUERIES["op2_quality_ftrl"](spark, sf).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        z = mean["bias"] + sum(mean.get(i, 0.0) * v for i, v in plain_features(text).items())
        r = got[doc_id]
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert r.held_out == (fold(doc_id, 4) == 2) and r.predicted == int(r.score >= 0.7)


# -- language ------------------------------------------------------------

def plain_grams(word):
    marked = [ord(c) for c in f"<{word}>"]
    for n in range(1, lv.LONGEST_GRAM + 1):
        for i in range(len(marked) - n + 1):
            h = n
            for c in marked[i:i + n]:
                h = (h ^ c) * 0x9E3779B97F4A7C15 & MASK
                h ^= h >> 29
            yield (h >> 20) % lv.BUCKETS


def script(c):
    return next((k for k, ranges in lv.SCRIPTS.items() if any(a <= ord(c) <= b for a, b in ranges)), "other")


def words_of(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def test_languages_are_those_of_a_plain_decoder(spark, sf):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    counts = defaultdict(Counter)
    for doc_id, text, lang in docs:
        if text is not None and lang is not None and fold(doc_id, 5) != 0:
            counts[lang].update(words_of(text))
    langs = sorted(counts)
    log_p, writes = {}, {}
    for lang in langs:
        seen, scripts = np.full(lv.BUCKETS, 0.5), Counter()
        for word, n in counts[lang].items():
            for g in plain_grams(word):
                seen[g] += n
            for c in word:
                if c.isalpha():
                    scripts[script(c)] += n
        log_p[lang] = np.log(seen / seen.sum()).astype(np.float32).astype(float).tolist()
        writes[lang] = {s for s, n in scripts.items() if n > lv.SCRIPT_SHARE * sum(scripts.values())}
    known = {}

    def scored(word):
        """(score by language, letters that count) of a word."""
        if word not in known:
            letters = [c for c in word if c.isalpha()]
            able = [all(script(c) in writes[lang] for c in letters) for lang in langs]
            grams = list(plain_grams(word))
            raw = [sum(log_p[lang][g] for g in grams) / lv.LONGEST_GRAM for lang in langs]
            if letters and any(able):
                best = max(s for s, a in zip(raw, able) if a)
                known[word] = [s - best if a else -1e6 for s, a in zip(raw, able)], len(letters), len(letters)
            else:
                known[word] = [0.0] * len(langs), 0, len(letters)
        return known[word]
    got = {r.doc_id: r for r in QUERIES["op9_lang_viterbi"](spark, sf).collect()}
    assert len(got) == len(docs)
    for doc_id, text, _ in docs:
        words = [scored(w) for w in words_of(text)]
        total = sum(n for _, _, n in words)
        want, share = "und", 0.0
        if total:
            state, back = words[0][0], []
            for s, _, _ in words[1:]:
                top = max(range(len(langs)), key=lambda k: (state[k], -k))
                back.append([top if state[k] < state[top] - 12.0 else k for k in range(len(langs))])
                state = [max(state[k], state[top] - 12.0) + s[k] for k in range(len(langs))]
            path = [max(range(len(langs)), key=lambda k: (state[k], -k))]
            for step in reversed(back):
                path.append(step[path[-1]])
            own = [0] * len(langs)
            for k, (_, n, _) in zip(reversed(path), words):
                own[k] += n
            top = max(range(len(langs)), key=lambda k: (own[k], -k))
            want, share = langs[top], own[top] / total
        r = got[doc_id]
        assert r.lang_pred == want and r.score == pytest.approx(share, abs=1e-9)
        assert r.held_out == (fold(doc_id, 5) == 0)


def many_texts():
    """More rows of a language than were once sampled; each has a word of its own."""
    rng = np.random.default_rng(11)
    return [(i, " ".join("".join(rng.choice(list("abcdefgh" if i % 8 else "äöüßopqr"), rng.integers(3, 8))) for _ in range(4)), "xx" if i % 8 else "yy")
            for i in range(6_500)] + [(9_001, None, "xx"), (9_002, "abc", None), (None, "hgf edc", "xx")]


def test_language_model_and_usual_fits_are_of_all_rows(spark):
    rows = many_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = lv.learn(docs, ~lv.held_out())
    for k, lang in enumerate(["xx", "yy"]):
        seen = np.full(lv.BUCKETS, 0.5)
        for doc_id, text, label in rows:
            if doc_id is not None and label == lang and fold(doc_id, 5) != 0:
                for word in words_of(text):
                    for g in plain_grams(word):
                        seen[g] += 1
        assert np.array_equal(model.log_p[:, k], np.log(seen / seen.sum()).astype(np.float32)) and seen.sum() > lv.BUCKETS / 2
    labelled = lv.label_languages(docs, model, payload=True)
    fits = defaultdict(list)
    for r in labelled.collect():
        if r.id is not None and r.fit is not None and r.row.lang == r.lang_pred:
            fits[r.lang_pred, fold(r.id, 5) == 0].append((r.fit, r.spread))
    got = lv.usual_fit(labelled, lv.F.col("row.lang"))
    assert set(got) == {"xx", "yy"} and len(fits["xx", False]) > 4_000 and len(fits["xx", True]) > 1_000
    for lang, (mid, texts, words) in got.items():
        fit, spread = np.array(fits[lang, True]).T
        low, median = np.percentile(fit, [5, 50])
        assert mid == pytest.approx(median, abs=1e-12) and texts == pytest.approx(((median - low) / 1.645) ** 2, rel=1e-9)
        assert words == pytest.approx(spread.mean(), rel=1e-9)


def test_quantiles_are_those_of_percentile(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 500), ("d", 60)) for v in rng.normal(-9, 0.3, n)] + [("e", -3.25)] * 40 + [("e", -3.5)] * 3
    df = spark.createDataFrame(rows, "g string, fit double")
    shares = (0.05, 0.5, 1.0)
    want = {r.g: r.p for r in df.groupBy("g").agg(lv.F.percentile("fit", list(shares)).alias("p")).collect()}
    got = lv._quantiles(df, ["g"], "fit", shares)
    assert {k[0] for k in got} == set(want)
    for (g,), v in got.items():
        assert v == pytest.approx(want[g], abs=1e-12)
    assert lv._quantiles(df.where("g = 'z'"), ["g"], "fit", shares) == {}
