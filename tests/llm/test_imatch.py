import hashlib
import math
import random

import regex
import xxhash
from pyspark.sql import functions as F

from strutwise.llm import imatch as I


def chain(values, seed=42):
    """Spark's xxhash64 of several values, signed."""
    for v in values:
        seed = xxhash.xxh64_intdigest(v, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def long(x):
    return (x % (1 << 64)).to_bytes(8, "little")


def hashed_terms(text):
    return {chain([w.encode()]) for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w}


def python_prints(texts):
    """Fingerprints by the definition, with Python sets."""
    seen = {}
    for t in texts:
        for s in hashed_terms(t):
            seen[s] = seen.get(s, 0) + 1
    low, high = max(2, math.ceil(I.BAND[0] * len(texts))), max(2, math.floor(I.BAND[1] * len(texts)))
    kept = {s for s, n in seen.items() if low <= n <= high}

    def one(text):
        every = sorted(hashed_terms(text))
        inside = [x for x in every if x in kept]
        values = [chain(map(long, inside)) if inside else chain([*map(long, every), b"all"])]
        for k, bits in enumerate(I.SUBSETS):
            own = [x for x in inside if chain([long(x), k.to_bytes(4, "little")]) % (1 << bits) == 0]
            values.append(chain(map(long, own)) if own else None)
        return ".".join("" if v is None else long(v)[::-1].hex() for v in values)

    return one


def alike(a, b):
    held = [(x, y) for x, y in zip(a.split("."), b.split(".")) if x or y]
    return sum(x == y for x, y in held) / len(held)


def check_all(result, rows):
    """Every column of the query against Python, for rows (id, text)."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()), reverse=True)
    prints = python_prints([t for _, t in order])
    want = []
    for k, (i, text) in enumerate(order):
        follow, half = order[(k + 1) % len(order)][1], len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        own, other, then = prints(text), prints(edited), prints(follow)
        want.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, round(alike(own, other), 12), round(alike(own, then), 12)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12)) for r in result.collect()]
    assert sorted(got) == sorted(want)


def test_query(spark, sf, monkeypatch):
    monkeypatch.setattr(I, "RANGE", 200_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    result = I.op6_imatch(spark, sf)
    check_all(result, docs)
    near = result.agg(F.sum("near_edited"), F.sum("near_next")).first()
    assert near[0] > 5 * near[1]


def test_a_large_lexicon_is_joined(spark, sf, monkeypatch):
    monkeypatch.setattr(I, "MOST", 50)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check_all(I.op6_imatch(spark, sf), docs)


def test_texts_with_very_many_terms_have_no_lexicon_by_chance(spark):
    # every term is in one document only: nothing lies in the band, however full a table of slots would be
    docs = spark.range(0, 600, 1, 6).select(
        F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda k: F.concat(F.lit("w"), F.col("id"), F.lit("x"), k)), " ").alias("text")
    )
    words = I.lexicon(docs)
    table = spark.range(1).select(words.table.alias("t")).first().t
    assert len(table) == words.size == 64 and all(at not in I._places(x, 64) for at, x in enumerate(table))


def test_two_place_tables():
    rng = random.Random(1)
    for n in (0, 1, 40, 3000):
        kept = sorted({rng.getrandbits(64) - (1 << 63) for _ in range(n)} | ({0} if n else set()))
        table = I.two_place_table(kept)
        size = len(table)
        has = lambda t: t in (table[t & (size - 1)], table[(t >> 32) & (size - 1)])
        assert size & (size - 1) == 0 and all(map(has, kept))
        assert not any(has(t) for t in [*range(1, 200), *(rng.getrandbits(64) - (1 << 63) for _ in range(2000))])


def test_ranges_and_tasks_beyond_the_limit(spark, monkeypatch):
    monkeypatch.setattr(I, "RANGES", 4)
    monkeypatch.setattr(I, "RANGE", 40)
    monkeypatch.setattr(I, "TASK", 10)
    monkeypatch.setattr(I, "UNIT", 10)
    rows = [(k, f"t{k}") for k in range(300)]
    got = {r.doc_id: r.next_text for r in I.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", {}).collect()}
    assert got == {k: f"t{(k - 1) % 300}" for k in range(300)}


def test_odd_rows_and_clashing_columns(clashing, none, rows):
    names = ["__key", "__text", "__range", "__both", "__lead", "__at", "__top", "next_text", "edited", "half"]
    wide = clashing.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    check_all(I.edited_likeness(wide), [(r[0], r[1]) for r in rows])
    assert I.edited_likeness(none).count() == 0


def test_odd_documents(docs, none):
    words = I.lexicon(docs)
    got = docs.select("doc_id", "text", I.as_text(I.fingerprint(F.col("text"), words)).alias("f")).collect()
    by = {}
    for r in got:
        assert by.setdefault(r.text, r.f) == r.f
    assert by[None] == by[""] == by[" \t\n "] != by["one two three"]
    assert none.select(I.fingerprint(F.col("text"), I.lexicon(none))).count() == 0


def test_order_case_and_signs_do_not_matter(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["alpha beta gamma", "GAMMA, beta -- alpha!", "alpha beta", "alpha beta gamma"])], "doc_id long, text string")
    words = I.lexicon(df, band=(0.0, 1.0))
    f = [r[0] for r in df.orderBy("doc_id").select(I.as_text(I.fingerprint(F.col("text"), words))).collect()]
    assert f[0] == f[1] == f[3] != f[2]


def test_terms_outside_the_band_do_not_matter(spark):
    rows = [(k, f"common mid{k % 4} rare{k}") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = I.lexicon(df, band=(0.05, 0.5))
    f = {r.doc_id: r.f for r in df.select("doc_id", I.as_text(I.fingerprint(F.col("text"), words)).alias("f")).collect()}
    assert f[0] == f[4] == f[36] and len(set(f.values())) == 4


def test_next_rows(spark, docs, none, monkeypatch):
    monkeypatch.setattr(I, "RANGE", 30)
    monkeypatch.setattr(I, "UNIT", 10)
    rows = [(k, f"t{k}") for k in range(50)] + [(None, "null"), (60, "x"), (60, "y"), (60, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text, r.next_text) for r in I.with_next(df, "doc_id", "text", {}).collect())
    order = sorted(rows, key=lambda r: (r[0] if r[0] is not None else -1, r[1]), reverse=True)
    want = sorted((r[0] if r[0] is not None else -1, r[1], order[(k + 1) % len(order)][1]) for k, r in enumerate(order))
    assert got == want
    assert I.with_next(none, "doc_id", "text", {}).count() == 0
    assert I.with_next(docs, "doc_id", "text", {}).count() == docs.count()


def test_main_path_has_no_python(spark, sf):
    plan = I.op6_imatch(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
