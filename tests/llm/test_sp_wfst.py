"""Shortest paths against the sentencepiece library, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark import cloudpickle

from sparkloom.llm import common, sp_wfst

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "   a   b   ", "\n", "\n\n a\n", "a\nb", "▁", "a▁b", "▁▁ ▁x", "日本語テキスト", "😀é́", "\t\x00x",
       "x" * 3000, "<s> </s> <unk> <0x41>", "foo  \n  bar", " \n ", "ab cd\n", "123 45,6", "ЖЖ слово", " x　y"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_library(library, sf):
    texts = ODD + pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()
    got = sp_wfst.Machines(PATH).encode(texts)
    for t, g in zip(texts, got, strict=True):
        assert np.frombuffer(g, "<i4").tolist() == library.encode(t), t[:80]


def test_random_strings(library):
    r = random.Random(5)
    m = sp_wfst.Machines(PATH)
    alphabet = "abcdeinorst  \n.,ABé日1"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(3000)]
    for t, g in zip(texts, m.encode(texts), strict=True):
        ids = np.frombuffer(g, "<i4")
        assert ids.tolist() == library.encode(t), repr(t)
        assert m.decode(ids) == t


def test_operator_and_decoding(spark):
    rows = [(i, t, [1]) for i, t in enumerate([*ODD, None, "same", "same"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    got = sp_wfst.encode(df, PATH)
    out = {r.doc_id: r for r in got.collect()}
    for i, t, _ in rows:
        assert out[i].round_trip == ("▁" not in (t or "")) and out[i].n_ids == len(out[i].ids)
    back = {r.doc_id: r.text for r in sp_wfst.decode(got, PATH).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t, _ in rows)
    assert sp_wfst.encode(df.limit(0), PATH).count() == 0


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """A model of additive weights, written by hand: random pieces over a few letters; scores of 1/64 add up without rounding."""
    from sentencepiece import sentencepiece_model_pb2
    r = random.Random(11)
    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = 1, True
    model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.escape_whitespaces = True, True
    model.normalizer_spec.remove_extra_whitespaces = False
    pieces = {"".join(r.choice("abcdé") for _ in range(r.randrange(2, 6))) for _ in range(150)}
    pieces |= {sp_wfst.ESCAPE + p for p in r.sample(sorted(pieces), 40)} | set("abcé.") | {sp_wfst.ESCAPE}
    for piece, kind in [("<unk>", 2), ("<s>", 3), ("</s>", 3), *((f"<0x{i:02X}>", 6) for i in range(256)), *((p, 1) for p in sorted(pieces))]:
        model.pieces.add(piece=piece, type=kind, score=-r.randrange(64, 768) / 64 if kind == 1 else 0.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_weights_decide_in_a_unigram_model(unigram):
    """Shortest paths equal the library's, and on short texts the least sum over all ways to cut the text."""
    lib, m, r = sentencepiece.SentencePieceProcessor(model_file=unigram), sp_wfst.Machines(unigram), random.Random(12)
    texts = ["", " ", "ab cd", "日a"] + ["".join(r.choice("aabbccdé .x日") for _ in range(r.randrange(1, 40))) for _ in range(1500)]
    for t, g in zip(texts, m.encode(texts), strict=True):
        ids = np.frombuffer(g, "<i4").tolist()
        assert ids == lib.encode(t), repr(t)
        assert m.decode(np.array(ids, int)) == t

    def ways(unit):
        if not unit:
            yield 0.0, []
        for j in range(1, len(unit) + 1):
            k = m.piece.get(unit[:j])
            if k is not None or j == 1:
                own = [k] if k is not None else [m.byte_id[x] for x in unit[:1].encode()]
                for cost, rest in ways(unit[j:]):
                    yield cost + (-m.score[k] if k is not None else m.fallback), own + rest
    for _ in range(150):
        unit = "".join(r.choice("aabbccdé日") for _ in range(r.randrange(1, 10)))
        found = list(ways(unit))
        least = min(found)[0]
        assert m.shortest(unit) in [ids for cost, ids in found if cost == least]


def test_other_operators_drop_the_caches_of_the_machines():
    path = public_tokenizers.path("piece_bpe_32k.model")
    kept = sp_wfst.Machines.of(path)
    sent = [cloudpickle.loads(cloudpickle.dumps(common.released(lambda batches: batches, owner))) for owner in ("sp_wfst", "")]
    assert list(sent[0]([1, 2])) == [1, 2] and sp_wfst.Machines.of(path) is kept
    assert list(sent[1]([3])) == [3] and not sp_wfst.Machines._HELD
