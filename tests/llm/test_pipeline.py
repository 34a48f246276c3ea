"""The pipeline against a brute-force version, stage by stage."""
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from panelkit.llm import lang_viterbi, pareto_mix
from panelkit.llm._tables import table
from panelkit.llm.queries import vocabulary_path

from tests.llm.test_jaccard import by_hand


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output rows of every stage."""
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf)
        if name != "encode":
            assert result.schema.simpleString() == docs.schema.simpleString()
        kept = result.collect()
        out.append((name, docs.collect(), kept))
        docs = spark.createDataFrame(kept, result.schema)
    return out


def test_language_keeps_clean_documents(spark, sf, stages):
    _, before, after = stages[0]
    docs = table(spark, sf, "documents")
    model = lang_viterbi.learn(docs, ~lang_viterbi.held_out())
    judged = {r.id: r for r in lang_viterbi.label_languages(docs, model).collect()}
    want = {r.doc_id for r in before if judged[r.doc_id].lang_pred != "und" and judged[r.doc_id].score >= 0.2}
    assert {r.doc_id for r in after} == want and len(want) >= 0.97 * len(before)


def test_exact_and_near_copies_go(stages):
    _, before, after = stages[1]
    first = {}
    for r in before:
        key = r.text.encode().lower()
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert {r.doc_id for r in after} == set(first.values()) and len(after) < len(before)
    _, before, after = stages[2]
    want = {i for i, _, c in by_hand([(r.doc_id, r.text) for r in before], 5, 80) if i == c}
    assert {r.doc_id for r in after} == want and len(after) < len(before)


def test_mix_drops_and_repeats(spark, stages):
    _, before, after = stages[3]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    copies = {r.id: r.copies for r in pareto_mix.mix(spark.createDataFrame(before, schema)).collect()}
    times = Counter(r.doc_id for r in after)
    assert times == Counter({i: c for i, c in copies.items() if c}) and max(times.values()) <= 3
    rows = {r.doc_id: tuple(r) for r in before}
    assert all(tuple(r) == rows[r.doc_id] for r in after)


def test_encoding_is_the_library(stages):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary_path())
    _, before, after = stages[4]
    texts = defaultdict(list)
    for r in before:
        texts[r.doc_id].append(r.text)
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    for r in after:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(texts[r.doc_id][0], add_special_tokens=False).ids
        assert r.decoded == texts[r.doc_id][0]


def test_run_gives_the_last_stage(spark, sf, stages):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "ids", "decoded"]
    assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r.doc_id for r in stages[4][2])


def test_stages_take_odd_rows(spark, make_docs):
    odd = [(1, None), (2, ""), (None, "the of and a word"), (4, "x" * 50_000), (5, "The of and a word"), (6, "42"), (None, None)]
    for rows in (odd, []):
        docs = make_docs(rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            if name != "encode":
                assert out.columns == docs.columns
            assert out.count() <= 3 * len(rows)
