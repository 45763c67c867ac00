import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from strutwise.llm import pieces as P
from strutwise.llm import tokenio as K
from strutwise.llm.common import new_path

SIGNS = [*" \n\t▁aàbßé.,'’0 1²Ⅷ_　\xa0日本🙂\r\x1c\x85​", "  ", "'s", "'ll", "the ", "ing", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "́", "ﬁ"]


def texts(n: int) -> list[str]:
    rng = random.Random(4)
    return ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(n)]


def test_pieces_are_those_of_the_library():
    codec, some = P.codec(P.model_path()), texts(3000)
    assert codec.apart
    assert codec.encode(some) == [codec.model.encode(t) + [2] for t in some]
    codec.table.most = 10  # the table starts anew all the time
    assert codec.encode(some[:500]) == [codec.model.encode(t) + [2] for t in some[:500]]


def test_pieces_of_documents(docs, clashing, none):
    model = P.codec(P.model_path()).model
    got = P.encoded(docs, decode=True).collect()
    for r in got:
        ids = model.encode(r.text or "") + [2]
        assert r.ids == ids and r.decoded == model.decode(ids)
    assert sorted(str(r.ids) for r in P.encoded(clashing).collect()) == sorted(str(r.ids) for r in got)
    assert P.encoded(none).count() == 0


def test_piece_query(spark, sf):
    model = P.codec(P.model_path()).model
    want = {r.doc_id: model.encode(r.text or "") + [2] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in P.op9_pieces(spark, sf).collect():
        ids = want.pop(r.doc_id)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert not want


def test_ids_are_those_of_the_library():
    engine = K.tokens(K.tokenizer_path())
    for t in texts(3000):
        assert engine(t).tolist() == engine.library.encode(t, add_special_tokens=False).ids


def test_the_faster_engine_needs_merges_in_order_of_ids():
    with open(K.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    assert K.same_order(spec) and K.tokens(K.tokenizer_path()).fast is not None
    merges = spec["model"]["merges"]
    swapped = {**spec, "model": {**spec["model"], "merges": [merges[1], merges[0], *merges[2:]]}}
    assert not K.same_order(swapped) and not K.same_order({**spec, "normalizer": {"type": "NFC"}})


@pytest.mark.parametrize("n,kinds", [(0, 5), (1, 5), (2, 2), (1000, 300), (30_000, 50_000)])
def test_codes(n, kinds):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n) - 1, kinds - 1)
    lengths = K.code_lengths(np.bincount(ids, minlength=kinds))
    used = lengths[lengths > 0].astype(int)
    assert used.max(initial=0) <= K.MOST_BITS and (len(used) < 2 or (2.0**-used).sum() == 1)
    book = K.Codebook(lengths)
    for spacing in (1, 7, 256):
        assert book.decode(book.encode(ids, spacing)).tolist() == ids.tolist()


def test_lengths_are_limited_and_optimal():
    fib = [1, 1]
    while len(fib) < 30:
        fib.append(fib[-1] + fib[-2])
    lengths = K.code_lengths(np.array(fib))
    assert lengths.max() == 16 and (2.0 ** -lengths.astype(int)).sum() == 1
    assert K.code_lengths(np.array([5, 9, 12, 13, 16, 45])).tolist() == [4, 4, 3, 3, 3, 1]


def test_a_block_must_be_known():
    with pytest.raises(ValueError):
        K.Codebook(np.array([1, 1])).decode(b"nope")
    with pytest.raises(ValueError):
        K.Codebook(np.array([1, 0])).encode(np.array([1]))


def test_files_of_odd_documents(spark, docs, clashing):
    engine = K.tokens(K.tokenizer_path())
    for df, block in ((docs, 50), (clashing, 1 << 18)):
        path = new_path(spark, "test-ids")
        K.write_ids(df, path, block_ids=block)
        got = sorted(K.read_ids(spark, path).collect(), key=lambda r: r.start)
        want = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
        at = 0
        for r, w in zip(got, want, strict=True):
            ids = [*engine.library.encode(w.text or "", add_special_tokens=False).ids, 0]
            assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (w.doc_id, at, ids)
            at += len(ids)


def test_empty_files(spark, none):
    path = new_path(spark, "test-ids")
    K.write_ids(none, path)
    assert K.read_ids(spark, path).count() == 0


def test_id_query(spark, sf):
    engine, at = K.tokens(K.tokenizer_path()).library, 0
    got = {r.doc_id: r for r in K.op4_huffman_ids(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*engine.encode(d.text or "", add_special_tokens=False).ids, 0]
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got
