import glob
import os
import re
from collections import Counter

import duckdb
import sentencepiece
from pyspark.sql import functions as F
from test_forest import brute as forest_brute
from test_mixing import water_fill

import corpus_pipeline as P
from strutwise.llm.pieces import model_path
from strutwise.llm.registry import ORACLE_SQL, QUERIES


def test_stages_on_odd_documents(spark, docs, none):
    for start in (docs, none):
        now = start
        for _, stage in P.STAGES[:-1]:
            now = stage(spark, now, "")
            assert now.columns == start.columns
        assert {"doc_id", "ids"} <= set(P.STAGES[-1][1](spark, now, "").columns)


def test_stages_keep_columns_of_any_name(spark, clashing, rows):
    now = clashing.withColumn("__text", F.lit("own"))
    for name, stage in P.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.columns == [*clashing.columns, "__text"], name
    left = now.select("units", "hash", "score", "__text").distinct().collect()
    assert left == [("own units", "own hash", "own score", "own")]
    last = P.STAGES[-1][1](spark, now, "")
    assert set(last.columns) == {*clashing.columns, "__text", "ids", "n_tokens"} - {"text"}


def cut(text, spans):
    """A text without the words of some spans; the white space behind a word goes with it."""
    words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    gone = {k for a, b in spans for k in range(a, b)}
    if not gone:
        return text
    ends = [a for a, _ in words[1:]] + [len(text)]
    lead = b"" if 0 in gone else text[: words[0][0]]
    return lead + b"".join(text[words[k][0] : ends[k]] for k in range(len(words)) if k not in gone)


def without_passages(rows, length):
    """Texts without windows of ``length`` words that start in a document with a smaller id."""
    first, split = {}, [(i, t.encode(), t.encode().split()) for i, t in rows]
    for i, _, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, i), i)
    return {i: cut(t, [(k, k + length) for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] < i]).decode() for i, t, w in split}


def test_run_against_plain_python(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lettered = [(i, r.text) for i, r in docs.items() if r.text and any(map(str.isalpha, r.text))]
    classes = {i: c for i, c, *_ in forest_brute(lettered)}
    heads = [(i, t) for i, t in lettered if classes[i] == i]
    texts = without_passages(heads, 50)
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    taken, mixed, whole = Counter(), Counter(), Counter()
    for r in P.run(spark, sf).collect():
        assert r.ids == library.encode(texts[r.doc_id]) + [library.eos_id()] and r.n_tokens == len(r.ids)
        assert (r.lang, r.source) == (docs[r.doc_id].lang, docs[r.doc_id].source)
        taken[r.doc_id] += 1
        mixed[r.source] += words[r.doc_id]
    for i, n in words.items():
        whole[docs[i].source] += n
    goal = water_fill(whole)
    assert set(taken) <= set(texts) and max(taken.values()) <= 3
    for s, t in goal.items():
        own = [i for i in texts if docs[i].source == s]
        assert abs(mixed[s] - t) <= max(words[i] for i in own)
        low = int(t / whole[s] + 1e-9) if whole[s] else 1
        assert all(taken[i] in (low, low + 1) for i in own)


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_sql(spark, sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    for name, sql in ORACLE_SQL.items():
        want, df = con.sql(sql), QUERIES[name](spark, sf)
        assert sorted(df.columns) == sorted(want.columns), name
        got = [str(tuple(r)) for r in df.select(*want.columns).collect()]
        assert sorted(got) == sorted(str(r) for r in want.fetchall()), name
