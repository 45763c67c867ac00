import hashlib
import pickle

import numpy as np
import pyarrow as pa
import pytest

from strutwise.llm import substrings as S
from strutwise.llm.fmindex import FMIndex, WaveletTree
from strutwise.llm.words import sequences, sliding_min, word_hashes


def brute(rows, length):
    """(id, words, removed, kept words) by looking at every window."""
    last, first, split = 1 << 63, {}, []
    for i, t in rows:
        w = (t or "").encode().split()
        split.append((last if i is None else i, i, w))
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, last), split[-1][0])
    out = []
    for at, i, w in split:
        keep = [True] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < at:
                keep[k : k + length] = [False] * length
        out.append((i, len(w), keep.count(False), b" ".join(x for x, y in zip(w, keep) if y).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def test_sequences_and_minima():
    h = np.random.default_rng(0).integers(0, 3, 500).astype(np.uint64)
    for n in (1, 2, 3, 7, 13, 50):
        s, seen = sequences(h, n), {}
        assert len(s) == 501 - n and all(seen.setdefault(tuple(h[i : i + n]), s[i]) == s[i] for i in range(len(s))) and len(set(seen.values())) == len(seen)
        assert (sliding_min(h, n) == [h[i : i + n].min() for i in range(501 - n)]).all()


def test_wavelet_rank():
    x = np.random.default_rng(1).integers(0, 300, 1000)
    tree = WaveletTree(x, 9)
    at, symbol = np.arange(1001), np.random.default_rng(2).integers(0, 300, 1001)
    assert (tree.rank(symbol, at) == [(x[:a] == s).sum() for a, s in zip(at, symbol)]).all()


@pytest.mark.parametrize("n,kinds,length", [(1, 1, 1), (6, 2, 3), (400, 3, 13), (2000, 40, 5)])
def test_backward_search(n, kinds, length):
    rng = np.random.default_rng(n)
    text = rng.integers(1, kinds + 1, n).astype(np.uint64) << np.uint64(40)
    text[rng.random(n) < 0.02] = 0
    index = FMIndex(text, length)
    at = np.array([i for i in range(n - length + 1) if text[i : i + length].all()], dtype=np.int64)
    left, right = index.matches(at, length)
    for i, a, b in zip(at, left, right):
        assert sorted(index.order[a:b]) == [j for j in at if (text[j : j + length] == text[i : i + length]).all()]


@pytest.mark.parametrize("slice_bytes", [200, 12 << 20])
@pytest.mark.parametrize("length", [4, 13])
def test_odd_documents(docs, rows, slice_bytes, length):
    assert got(S.without_repeats(docs, length=length, slice_bytes=slice_bytes)) == brute([r[:2] for r in rows], length)


def test_clashing_columns_stay(clashing, rows):
    out = S.without_repeats(clashing, slice_bytes=500)
    assert got(out) == brute([r[:2] for r in rows], 13)
    assert {r.hash for r in out.select("hash").collect()} == {"own hash"}


def test_passages_over_many_documents_and_indexes(spark, monkeypatch):
    monkeypatch.setattr(S, "INDEX_WORDS", 500)
    monkeypatch.setattr(S, "SHARD_BYTES", 4000)
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 30)}"
    shared = [[word() for _ in range(rng.integers(10, 40))] for _ in range(6)]
    rows = []
    for i in rng.permutation(150):
        w = []
        for _ in range(rng.integers(0, 5)):
            w += shared[rng.integers(0, 6)] if rng.random() < 0.6 else [word() for _ in range(rng.integers(1, 20))]
        rows.append((int(i), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(S.without_repeats(df, slice_bytes=1500)) == brute(rows, 13)


@pytest.mark.parametrize("ids", [(1, 2), (2, 1)])
@pytest.mark.parametrize("length", [13, 50])
def test_greatest_window_of_an_index(ids, length):
    # one of the two orders has the smallest document at the end of the suffix order
    text = np.full(2 * length, 9, dtype=np.uint16)
    found = S._search(np.array(ids), np.array([7, 7]), np.array([0, 0]), np.array([1, 1]), np.array([5, 5], dtype=np.uint32), text, length)
    assert found == [(2, 7, np.array([[0, length]], dtype="<i4").tobytes())]


def test_windows_of_different_check_are_not_equal():
    text = np.full(26, 9, dtype=np.uint16)
    assert S._search(np.array([1, 2]), np.array([7, 7]), np.array([0, 0]), np.array([1, 1]), np.array([5, 6], dtype=np.uint32), text, 13) == []


def hot_rows():
    """Texts in which every window holds one common triple; all else is random, but for some shared passages."""
    rng = np.random.default_rng(8)
    least = min(((S._grams(S._symbols(word_hashes(pa.array([f"t{k} t t"]))[0]))[0], k) for k in range(3000)))[1]
    triple, passage = [f"t{least}", "t", "t"], [f"p{k}" for k in range(7)]
    rows = []
    for i in rng.permutation(120):
        w = []
        for _ in range(40):
            w += triple + (passage if rng.random() < 0.3 else [f"x{rng.integers(0, 1 << 40)}" for _ in range(7)])
        rows.append((int(i), " ".join(w)))
    return rows


def test_a_hot_minimizer_is_split(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 20_000)
    rows = hot_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    routes = S._routes(df.select("text"), 13, 40, 20_000)
    assert len(routes.levels) > 1
    sizes = {}
    for a in range(0, len(rows), 10):
        flat, counts = word_hashes(pa.array([t for _, t in rows[a : a + 10]]))
        for s, kind, body in S._slice_rows(np.array([i for i, _ in rows[a : a + 10]]), np.zeros(10, dtype=np.int64), flat, counts, routes):
            sizes[s] = sizes.get(s, 0) + len(body) * (kind == 0)
    assert max(sizes.values()) < sum(sizes.values()) / 8
    again = pickle.loads(pickle.dumps(routes))
    assert [n for n, _ in again.levels] == [n for n, _ in routes.levels] and all((a == b).all() for (_, a), (_, b) in zip(again.levels[:-1], routes.levels[:-1]))
    assert got(S.without_repeats(df, slice_bytes=20_000)) == brute(rows, 13)


def test_equal_windows_end_the_splitting(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    passage = " ".join(f"q{k}" for k in range(20))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert len(S._routes(df.select("text"), 13, 20, 300).levels) <= 4
    assert got(S.without_repeats(df, slice_bytes=300)) == brute(rows, 13)


def test_word_hashes():
    odd = ["a b", "", "  ", None, "b", "a", " a\tb\u0085c \x1c d", "x" * 600_000 + " y " + "x" * 600_000, "b\x0bb", "ab a"]
    for kind in (pa.string(), pa.large_string()):
        for cut in (0, 3):
            hashes, counts = word_hashes(pa.array(odd, kind).slice(cut))
            words = [(t or "").encode().split() for t in odd[cut:]]
            assert counts.tolist() == [len(w) for w in words]
            seen = {}
            assert all(seen.setdefault(w, h) == h for w, h in zip((x for w in words for x in w), hashes.tolist())) and len(set(seen.values())) == len(seen)
    assert [len(x) for x in word_hashes(pa.array([], pa.string()))] == [0, 0]


def test_empty_and_short_windows(none):
    assert S.without_repeats(none).count() == 0
    with pytest.raises(ValueError):
        S.without_repeats(none, length=S.GRAM)


def test_stage_cuts_texts_and_keeps_rows(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"a b\n{passage}\tc", "en", "s", 0), (2, f"  d\n{passage}  e\nf ", "en", "s", 0), (3, None, None, None, None), (4, "g  h\n", "en", "s", 5), (5, passage, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = S.passage_stage(spark, docs, "")
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert out.columns == docs.columns
    assert got == {1: (rows[0][1], 0), 2: ("  d\ne\nf ", 8), 3: (None, None), 4: ("g  h\n", 5), 5: ("", 0)}


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in brute(rows, 13)]
    assert sorted((tuple(r) for r in S.op10_fm_repeats(spark, sf).collect()), key=str) == sorted(want, key=str)
