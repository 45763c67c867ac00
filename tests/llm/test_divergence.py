import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from strutwise.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, prior=5, scale=10**9, top=50):
    groups, docs, counts = defaultdict(set), Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for (lng, t), n in docs.items() if lng == lang and n >= least]
        share = {}
        for s in sources:
            size = sum(counts[lang, s][t] for t in kept)
            share[s] = {t: 1 + scale * (counts[lang, s][t] + prior) // (size + prior * len(kept)) for t in kept}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + scale * (whole[t] + prior) // (sum(whole.values()) + prior * len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            term = [(q[t] - share[s][t], t.encode()) for t in kept if counts[lang, s][t] and share[s][t] > q[t]]
            out += [(lang, s, "pair", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(pair))]
            out += [(lang, s, "term", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(term)[:top])]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_terms():
    odd = ["Ab-cÉ1x", None, "", "zz", "zZ", "ÀB_c\u0085d\x7fe 😀F", "[a]{b}@`"]
    for cut in (0, 2):
        terms, doc = D.terms_of(pa.array(odd).slice(cut))
        want = [(k, t) for k, s in enumerate(odd[cut:]) for t in TERM.findall((s or "").translate(LOWER))]
        assert list(zip(doc.tolist(), terms.to_pylist())) == want
    assert D.terms_of(pa.array(["1 2"], pa.large_string()))[0].to_pylist() == [] and len(D.terms_of(pa.array([], pa.string()))[0]) == 0


@pytest.mark.parametrize("least,top", [(1, 50), (2, 3), (4, 50), (99, 50)])
@pytest.mark.parametrize("slice_bytes", [300, 4 << 20])
def test_odd_documents(docs, rows, least, top, slice_bytes):
    out = D.source_divergence(docs, least=least, top=top, slice_bytes=slice_bytes)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert got(out) == brute([(r[1], r[2], r[3]) for r in rows], least, top=top)


def test_clashing_columns_and_empty_tables(clashing, rows, none):
    from pyspark.sql import functions as F

    more = clashing.select("*", *[F.lit("own").alias(c) for c in ("term", "n", "docs", "a", "b", "x", "y", "m", "item", "value", "rank", "all")])
    assert got(D.source_divergence(more, least=2)) == brute([(r[1], r[2], r[3]) for r in rows], 2)
    assert D.source_divergence(none).count() == 0


def test_joint_histogram_has_implied_zeros(spark):
    cells = spark.createDataFrame([("l", "t1", "a", 3), ("l", "t1", "b", 2), ("l", "t2", "a", 3), ("l", "t3", "b", 7)], "lang string, term string, source string, n long")
    pairs = spark.createDataFrame([("l", "a", "b", 9), ("l", "a", "c", 9), ("l", "b", "c", 9)], "lang string, a string, b string, terms long")
    found = {tuple(r) for r in D.joint_histogram(cells, pairs).collect()}
    assert found == {
        ("l", "a", "b", 3, 2, 1), ("l", "a", "b", 3, 0, 1), ("l", "a", "b", 0, 7, 1), ("l", "a", "b", 0, 0, 6),
        ("l", "a", "c", 3, 0, 2), ("l", "a", "c", 0, 0, 7), ("l", "b", "c", 2, 0, 1), ("l", "b", "c", 7, 0, 1), ("l", "b", "c", 0, 0, 7),
    }


def test_counts_beyond_nine_thousand_million(spark):
    n = 20_000_000_000
    row = spark.createDataFrame([(n, 3 * n, 4)], "n long, size long, terms long").select(D._share("n", "size", "terms", 5, 10**9).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (3 * n + 20)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang", "source").collect()]
    assert got(D.op13_divergence(spark, sf)) == brute(rows, 30)
