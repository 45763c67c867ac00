import hashlib

import numpy as np
import pytest

from strutwise.llm import suffixes as S


def brute(rows, length):
    """(id, bytes, removed, spans, kept) by looking at every window of every distinct (id, text)."""
    last, first, own = 1 << 63, {}, {}
    split = [(last if i is None else i, i, (t or "").encode()) for i, t in rows]
    for at, _, b in split:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, at), at)
            own[at, b, w] = min(own.get((at, b, w), k), k)
    out = []
    for at, i, b in split:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if first[w] < at or own[at, b, w] < k:
                gone[k : k + length] = b"\x01" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()), key=str)


@pytest.mark.parametrize("n,kinds,length", [(1, 1, 1), (60, 1, 40), (500, 2, 30), (5000, 3, 100), (3000, 200, 7)])
def test_suffix_order(n, kinds, length):
    text = np.random.default_rng(n).integers(0, kinds, n).astype(np.uint8)
    at = np.arange(max(1, n - length + 1))
    order, opens = S.suffix_order(text, at, length)
    whole = text.tobytes()
    want = sorted(at, key=lambda k: (whole[k : k + length], k))
    assert order.tolist() == want
    assert opens.tolist() == [k == 0 or whole[want[k] : want[k] + length] != whole[want[k - 1] : want[k - 1] + length] for k in range(len(want))]


def test_levels_merge_geometrically():
    rng, family, seen, length = np.random.default_rng(4), S.SuffixFamily(30), set(), 30
    for k in range(40):
        text = rng.integers(0, 2, 400).astype(np.uint8)
        text[100:200] = np.tile([k % 5, 1], 50)
        at = np.arange(371)
        gone = family.add(text, at, np.full(371, k), np.zeros(371, dtype=np.int64))
        whole, want = text.tobytes(), []
        for i in at:
            want.append(whole[i : i + length] in seen)
            seen.add(whole[i : i + length])
        assert gone.tolist() == want
        sizes = [len(x.order) for x in family.levels]
        assert sum(sizes) == len(seen) and all(2 * b <= a for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 1 + np.log2(len(seen))
    for level in family.levels:
        assert (S._compared(level.words, level.order[:-1], level.words, level.order[1:], length) < 0).all()


@pytest.mark.parametrize("slice_bytes,batch", [(700, 300), (4 << 20, 1 << 18)])
@pytest.mark.parametrize("length", [25, 100])
def test_odd_documents(docs, rows, slice_bytes, batch, length):
    assert got(S.without_repeated_bytes(docs, length=length, slice_bytes=slice_bytes, batch_bytes=batch)) == brute([r[:2] for r in rows], length)


def test_clashing_columns_stay(clashing, rows):
    out = S.without_repeated_bytes(clashing, slice_bytes=2000)
    assert got(out) == brute([r[:2] for r in rows], 100)
    assert {r.hash for r in out.select("hash").collect()} == {"own hash"}


def test_empty_tables_and_limits(none):
    assert S.without_repeated_bytes(none).count() == 0
    for wrong in ({"length": S.GRAM}, {"batch_bytes": 1 << 20}):
        with pytest.raises(ValueError):
            S.without_repeated_bytes(none, **wrong)


def made(seed, n, kinds):
    """Documents of few letters, with passages that many share, periods inside, and texts under one id."""
    rng = np.random.default_rng(seed)
    letters = lambda k: "".join(chr(97 + x) for x in rng.integers(0, kinds, k))
    shared = [letters(rng.integers(80, 300)) for _ in range(5)] + ["é" * 70, "ab" * 90]
    out = []
    for i in rng.permutation(n):
        parts = [shared[rng.integers(0, 7)] if rng.random() < 0.5 else letters(rng.integers(1, 90)) for _ in range(rng.integers(0, 6))]
        out.append((int(i) // 2 * 2 if i % 5 == 0 else int(i), "".join(parts)))
    return out


@pytest.mark.parametrize("kinds", [2, 20])
def test_shared_passages_over_slices_batches_and_levels(spark, kinds):
    rows = made(kinds, 160, kinds)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(S.without_repeated_bytes(df, slice_bytes=3000, shard_bytes=4000, batch_bytes=1000)) == brute(rows, 100)


def test_a_hot_key_is_split(spark):
    rng = np.random.default_rng(3)
    letters = lambda k: "".join(chr(97 + x) for x in rng.integers(0, 26, k))
    grams = [letters(S.GRAM) for _ in range(1500)]
    least = min(grams, key=lambda g: S.sequences(S._BYTE[np.frombuffer(g.encode(), np.uint8)], S.GRAM)[0])
    passage = letters(50)
    rows = [(i, "".join((passage if rng.random() < 0.2 else letters(50)) + least for _ in range(20))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    routes = S._routes(df.select("text"), 100, 30, 20_000, S.GRAM, S._weigh)
    assert len(routes.levels) > 1
    assert got(S.without_repeated_bytes(df, slice_bytes=20_000, shard_bytes=4000)) == brute(rows, 100)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute(rows, 100)]
    assert sorted((tuple(r) for r in S.op11_suffix_family(spark, sf).collect()), key=str) == sorted(want, key=str)


def test_only_windows_that_may_repeat_meet_the_family(monkeypatch):
    """Texts that share short strings everywhere, and one passage: only windows of the passage are indexed and asked for."""
    import pyarrow as pa

    rng, asked, add = np.random.default_rng(9), [], S.SuffixFamily.add
    letters = lambda k: "".join(chr(97 + x) for x in rng.integers(0, 26, k))
    grams, passage = [letters(30) for _ in range(5)], letters(150)
    texts = ["".join(letters(20) + grams[rng.integers(0, 5)] for _ in range(40)) + (passage if i in (3, 70) else "") for i in range(80)]

    def counted(self, text, at, *rest):
        asked.append(len(at))
        return add(self, text, at, *rest)

    monkeypatch.setattr(S.SuffixFamily, "add", counted)
    routes, ids = S._Routes(100, 1, S.GRAM), pa.array(range(80), pa.int64())
    sent = []
    for a in range(0, 80, 20):
        batch = pa.RecordBatch.from_arrays([ids[a : a + 20], ids[a : a + 20], pa.array(texts[a : a + 20])], names=["__id", "__hash", "text"])
        sent += S._send(routes, 1 << 20)([batch])
    got = S._matched(routes, S.BATCH)(pa.Table.from_batches(sent)).to_pylist()
    covered = {(r["id"], k) for r in got for b, e in np.frombuffer(r["spans"], "<i4").reshape(-1, 2).tolist() for k in range(b, e)}
    at = texts[70].index(passage)
    assert covered == {(70, k) for k in range(at, at + 150)}
    assert 0 < sum(asked) <= 2 * 51


@pytest.mark.parametrize("kinds", [2, 3, 26])
def test_segments_of_split_shards_and_marks(kinds):
    """Segments from a shard on are those of all; a mark says that the least gram lies in the segment more than once."""
    rng = np.random.default_rng(kinds)
    raw = rng.integers(97, 97 + kinds, 70_000).astype(np.uint8)
    raw[500:1300] = np.tile(rng.integers(97, 123, 40).astype(np.uint8), 20)
    doc = np.sort(rng.integers(0, 60, len(raw)))
    routes = S._Routes(100, 7, S.GRAM).split(np.arange(7) < 2, 3)
    start, windows, key, shard, like, again = S._segments(raw, doc, routes)
    few = S._segments(raw, doc, routes, 7, marked=False)
    assert (shard >= 7).any() and all(np.array_equal(x, y[shard >= 7]) for x, y in zip(few[:5], (start, windows, key, shard, like)))
    grams = S.sequences(S._BYTE[raw], S.GRAM)
    want = [int((g == g.min()).sum()) > 1 for g in (grams[s : s + w + 100 - S.GRAM] for s, w in zip(start, windows))]
    assert again.tolist() == want and any(want) and not all(want)
