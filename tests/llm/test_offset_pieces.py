"""Pieces, spans and decoding against the sentencepiece library."""
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from panelkit.llm import offset_pieces as op
from sentencepiece import sentencepiece_model_pb2 as proto

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a", " a b  ", "▁a", "a▁▁b ▁", "\n x\n\n\t", "\U0001F600x", "a\0b", "<0x0A>", "<s> </s><unk>", "\xa0x　y",
       "ஃ ஃஃ", "ａＢ  ①  é ㍿ ​ x ", "​", "À́b", "¨ x", "  ­ x", "café" * 40, " " * 70,
       "a" * 300, "▁" * 5, "\u0001\u0002 \u0001", "x" + " " * 40 + "y", "क़ẛ̣ ﬁ ½"]


def model_bytes(**changes) -> bytes:
    model = proto.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    for key, value in changes.items():
        setattr(model.normalizer_spec, key, value)
    return model.SerializeToString()


def rule(name: str) -> bytes:
    spec = proto.ModelProto()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=name).serialized_model_proto())
    return spec.normalizer_spec.precompiled_charsmap


def texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    letters = "ab eÉ̀éａ ①㍿​▁ \n\t­ஃ\U0001F600.,fiﬁKÅ"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(400)]


MODELS = {
    "given": model_bytes(),
    "squeezed": model_bytes(remove_extra_whitespaces=True),
    "no prefix": model_bytes(add_dummy_prefix=False),
    "nmt_nfkc": model_bytes(precompiled_charsmap=rule("nmt_nfkc"), remove_extra_whitespaces=True),
    "nfkc_cf": model_bytes(precompiled_charsmap=rule("nfkc_cf")),
}


@pytest.mark.parametrize("name", MODELS)
def test_ids_spans_and_text_equal_the_library(name):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODELS[name])
    pieces = op.Pieces(op.pack_model(MODELS[name]))
    given = texts(1)
    raw = [t.encode() for t in given]
    ids, spans, counts = pieces.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]))
    decoded = pieces.decode(ids, counts).to_pylist()
    at = 0
    for text, n, back in zip(given, counts, decoded):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids[at:at + n].tolist() == want, text
        whole = library.encode(text.encode(), return_type="proto").pieces
        assert [tuple(s) for s in spans[at + 1:at + n - 1].tolist()] == [(p.begin, p.end) for p in whole], text
        assert tuple(spans[at]) == (0, 0) and tuple(spans[at + n - 1]) == (len(text.encode()),) * 2
        assert back == library.decode(want), text
        at += n
    assert at == len(ids)


@pytest.mark.parametrize("name", ["given", "squeezed", "no prefix"])
def test_any_ids_decode_as_the_library_does(name):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODELS[name])
    pieces = op.Pieces(op.pack_model(MODELS[name]))
    rng = random.Random(2)
    pool = [0, 1, 2, 13, 28705, 259, 264, 229, 153, 132, 200, 65, 230, 155, 133, 1318, 337]
    cases = [[], [1], [1, 2], [229, 153, 132, 264]] + [[rng.choice(pool) for _ in range(rng.randrange(1, 9))] for _ in range(500)]
    counts = np.array([len(c) for c in cases])
    got = pieces.decode(np.array([i for c in cases for i in c], "<u4"), counts).to_pylist()
    assert got == [library.decode(c) for c in cases]


def test_unsupported_models_are_refused():
    model = proto.ModelProto()
    model.ParseFromString(MODELS["given"])
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="BPE"):
        op.pack_model(model.SerializeToString())
    with pytest.raises(ValueError, match="escaped"):
        op.pack_model(model_bytes(escape_whitespaces=False))


def test_long_fragments_take_the_heap_and_agree():
    pieces = op.Pieces(op.pack_model(MODELS["given"]))
    rng = random.Random(3)
    for _ in range(200):
        fragment = "".join(rng.choice("theandionr") for _ in range(rng.randrange(1, op.SHORT + 1)))
        short = pieces.merged(fragment)
        limit, op.SHORT = op.SHORT, 0
        try:
            assert pieces.merged(fragment) == short
        finally:
            op.SHORT = limit


def test_rows_nulls_repeats_and_odd_columns(spark, make_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(7, ODD[7]), (None, "a b"), (99, None), (100, "word " * 50_000)]
    got = op.round_trip(make_docs(rows), op.read_model(PATH)).collect()
    assert len(got) == len(rows)
    found = sorted((r["id"] if r["id"] is not None else -1, bytes(r["ids"]), r["decoded"]) for r in got)
    coded = [(i if i is not None else -1, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in rows]
    assert found == sorted((i, np.array(ids, "<u4").tobytes(), library.decode(ids)) for i, ids in coded)
    again = op.decode(op.encode(make_docs(rows), op.read_model(PATH)), op.read_model(PATH)).collect()
    assert sorted((str(r["id"]), r["decoded"]) for r in again) == sorted((str(r["id"]), r["decoded"]) for r in got)
    assert op.round_trip(make_docs([]), op.read_model(PATH)).collect() == []


def test_query_equals_the_library(spark, sf, documents):
    import hashlib

    from panelkit.llm.queries import QUERIES
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op11_offset_pieces"](spark, sf).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert got[doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                               hashlib.sha256(library.decode(ids).encode()).hexdigest())
