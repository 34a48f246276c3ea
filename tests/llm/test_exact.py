"""Exact dedup and BPE against brute force and the tokenizers library."""
import hashlib
from collections import defaultdict

import numpy as np
import pytest
from panelkit.llm import digest_tree, forced_bpe
from panelkit.llm.queries import QUERIES, vocabulary_path

EDGE = [(1, None), (2, ""), (3, "Äb C"), (4, "Äb c"), (5, "äb c"), (6, "x" * 300_000), (6, "x" * 300_000),
        (7, "a b"), (7, "A b"), (None, "a B"), (None, "q"), (None, "q"), (8, " "), (9, "\n")]


def by_text(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    return groups


def check_dedup(got, rows, pick):
    groups = by_text(rows)
    by_sha = {hashlib.sha256(t).hexdigest(): ids for t, ids in groups.items()}
    assert sorted((str(r.id) for r in got)) == sorted(str(i) for i, _ in rows)
    kept = defaultdict(int)
    for r in got:
        ids = by_sha[bytes(r.digest).hex()]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (pick(known) if known else None)
        kept[bytes(r.digest).hex()] += r.kept
        assert not r.kept or r.id == r.keep_id
    assert all(kept[s] == 1 for s in by_sha)


def test_tree_dedup_edges(make_docs):
    for parts, fan_in, keep in ((1, 16, "max"), (5, 2, "max"), (7, 2, "min")):
        got = digest_tree.tree_dedup(make_docs(EDGE, parts), keep=keep, fan_in=fan_in).collect()
        check_dedup(got, EDGE, max if keep == "max" else min)


def test_tree_dedup_hot_text_and_rows(make_docs):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(600)]
    df = make_docs(rows, 9)
    check_dedup(digest_tree.tree_dedup(df, fan_in=3).collect(), rows, max)
    out = digest_tree.drop_copies(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {i for i in range(600) if i % 3 == 0} | {599}
    assert digest_tree.tree_dedup(make_docs([])).collect() == []
    assert digest_tree.drop_copies(make_docs([])).collect() == []


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def test_bpe_edges(make_docs):
    texts = [None, "", " ", "  a  b ", "Ünïcödé ñandú déjà-vu", "it's we'll I'VE don't", "x" * 20_000, "ab" * 9_000,
             "日本語テキスト 한국어 العربية 😀😀", "tab\tnew\n\n\nline \r\n end  ", "a<|endoftext|>b <|endoftext|>", "<|endoftext|",
             "1234567 ½ Ⅷ ²", " nbsp em　 ideo\x1c\x1d\x85", "\x00\x01 ctrl \x7f", "é combining", "ǅ ʰ ª º _a_b"]
    lib = library()
    vocabulary = forced_bpe.read_vocabulary(vocabulary_path())
    out = forced_bpe.decode(forced_bpe.encode(make_docs(list(enumerate(texts))), vocabulary), vocabulary).collect()
    assert len(out) == len(texts)
    for r in out:
        want = lib.encode(texts[r.id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want, texts[r.id]
        assert r.decoded == lib.decode(want, skip_special_tokens=False)
    both = {r.id: (bytes(r.ids), r.decoded) for r in forced_bpe.round_trip(make_docs(list(enumerate(texts))), vocabulary).collect()}
    assert both == {r.id: (bytes(r.ids), r.decoded) for r in out}
    assert forced_bpe.encode(make_docs([]), vocabulary).collect() == []


def test_bpe_query_is_the_library(spark, sf, documents):
    lib = library()
    got = {r.doc_id: r for r in QUERIES["op5_forced_bpe"](spark, sf).collect()}
    assert len(got) == len(documents)
    for i, t in documents:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_other_vocabularies_are_refused(tmp_path):
    import json

    import pytest
    with pytest.raises(ValueError, match="normalizer"):
        forced_bpe.read_vocabulary(vocabulary_path("word_bpe_49k.json"))
    with open(vocabulary_path()) as f:
        spec = json.load(f)
    assert forced_bpe.unsupported(spec) == []
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="prefix space"):
        forced_bpe.read_vocabulary(str(tmp_path / "v.json"))


def test_forced_cuts_never_split_a_token():
    codec = forced_bpe.Codec(forced_bpe.read_vocabulary(vocabulary_path()))
    assert not codec.joined.all()
    assert all(codec.fragments(t) == [t] for t in codec.ids)


def test_decode_of_ids_that_cut_a_character(spark):
    vocabulary = forced_bpe.read_vocabulary(vocabulary_path())
    ids = np.array(library().encode("日本", add_special_tokens=False).ids[:-1], "<u4")
    df = spark.createDataFrame([(1, ids.tobytes()), (2, None)], "id long, ids binary")
    got = {r.id: r.decoded for r in forced_bpe.decode(df, vocabulary).collect()}
    assert got == {1: library().decode(ids.tolist(), skip_special_tokens=False), 2: ""}


def test_bpe_merges_look_up_each_changed_pair_once():
    """A short fragment's ranks are kept between its merges."""
    class Counting(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)
    codec = forced_bpe.Codec(forced_bpe.read_vocabulary(vocabulary_path()))
    for fragment in (b" international", b" thouenorthinghonation", b"e", b"aaaaaaaaaaaaaaaaaaaaaaaa"):
        want = codec.merge(fragment)
        codec.ranks = Counting(codec.ranks)
        assert codec.merge(fragment) == want and codec.ranks.asked <= 3 * len(fragment)
        assert b"".join(codec.bytes_of[i] for i in want) == fragment


def test_bpe_ascii_words_and_joint_decoding():
    import random

    import regex
    codec, rng = forced_bpe.Codec(forced_bpe.read_vocabulary(vocabulary_path())), random.Random(3)
    plain = regex.compile(forced_bpe.PRETOKEN).findall
    for _ in range(3_000):
        text = "".join(rng.choices([chr(i) for i in range(128)] + list("   \n\t'sdmrevl12ab") * 3, k=rng.randint(0, 20)))
        assert codec.words(text) == plain(text)
    rows = [[], [codec.byte_id[0xE4]], codec.byte_id[65:70], None, [codec.byte_id[0xBD], codec.byte_id[0x41]]]
    packed = [None if r is None else np.array(r, "<u4").tobytes() for r in rows]
    want = [b"".join(codec.bytes_of[i] for i in r or []).decode(errors="replace") for r in rows]
    assert forced_bpe._decoded(codec, packed) == want and forced_bpe._decoded(codec, []) == [] and forced_bpe._decoded(codec, [None, b""]) == ["", ""]
    with pytest.raises(KeyError):
        forced_bpe._decoded(codec, [np.array([60_000], "<u4").tobytes()])
