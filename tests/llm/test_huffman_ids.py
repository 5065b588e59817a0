"""Token files: optimal code lengths, exact round trips, random access."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkloom.llm import huffman_ids as h
from sparkloom.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_lengths_are_optimal_and_limited():
    r = np.random.default_rng(1)
    counts = r.integers(1, 1000, 300)
    heap = counts.tolist()
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    lengths = h.code_lengths(counts)
    assert (counts * lengths).sum() == cost
    steep = np.array([1 << min(i, 50) for i in range(60)])
    lengths = h.code_lengths(steep)
    assert lengths.max() <= 16 and sum(2.0 ** -int(x) for x in lengths) <= 1
    assert h.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        h.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("n", [1, 255, 256, 257, 70_000])
def test_blocks_round_trip(n):
    r = np.random.default_rng(n)
    ids = np.minimum(r.zipf(1.3, n), 40_000)
    counts = np.bincount(ids)
    lengths = h.code_lengths(counts)
    data = h.pack_block(np.array([4]), np.array([n]), ids, h.canonical_codes(lengths), lengths)
    doc_ids, sizes, back = h.unpack_block(data, h.decode_table(lengths))
    assert doc_ids.tolist() == [4] and sizes.tolist() == [n] and (back == ids).all()
    with pytest.raises(ValueError):
        h.unpack_block(b"x" * 100, h.decode_table(lengths))


ALPHABET = "abcABCstrvemldSTD''''  \n\t\r012.,!?<>|*#$%&éÉßÿØ÷×_`~^\"\\\x7f\x80\xa0"


def test_pieces_equal_whole_texts(sf):
    r = random.Random(3)
    import pyarrow.parquet as pq
    texts = pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()
    texts += ["", "  a\n\nb\t c", "ΑΣ ΑΣ. İx é e ́", "don't <|endoftext|>x a　b c", "x" * 5000, "it's 12,5 日本 語"]
    t = Tokenizer.from_file(PATH)
    texts += ["".join(r.choice(ALPHABET) for _ in range(r.randrange(80))) for _ in range(3000)]
    got = h.WordEncoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_files_round_trip(spark):
    rows = [(5, "b b b"), (3, None), (9, ""), (3, "same id"), (None, "no id"), (1, "long " * 3000)]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, ids int").repartition(3)
    path = scratch_path(spark, "ids")
    tokens = h.token_ids(df, PATH, 2)
    h.write_ids(tokens, path, block_ids=100)
    got = sorted(h.read_ids(spark, path).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(PATH)
    want = {(d, tuple(t.encode(x or "", add_special_tokens=False).ids + [2])) for d, x in rows}
    assert {(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got} == want
    assert [r.doc_id for r in got] == [None, 1, 3, 3, 5, 9]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)


def test_empty_table(spark):
    path = scratch_path(spark, "ids")
    h.encode_corpus(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert h.read_ids(spark, path).count() == 0


def test_more_ids_than_sixteen_bits_can_tell():
    r = np.random.default_rng(5)
    ids = np.concatenate([np.arange(100_000), r.zipf(1.3, 300_000) % 100_000])
    r.shuffle(ids)
    lengths = h.code_lengths(np.bincount(ids))
    assert h.bit_limit(100_000) == 21 and h.bit_limit(65_536) == 16 and lengths.max() > 16 and lengths.min() > 0
    assert abs(sum(2.0 ** -lengths.astype(float)) - 1) < 1e-9
    data = h.pack_block(np.array([1, 2]), np.array([150_000, 250_000]), ids, h.canonical_codes(lengths), lengths)
    _, sizes, back = h.unpack_block(data, h.decode_table(lengths))
    assert (back == ids).all() and sizes.tolist() == [150_000, 250_000]
