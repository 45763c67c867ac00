"""How far the sources of a language lie from each other and from the language, in exact term counts.

Texts become counts of (language, source, term) in Arrow batches: terms are cut
out of the bytes of many texts at once and combined before anything is
shuffled. All further work is on counts.

Distances between two sources come from their joint count histogram: how many
kept terms have count x in one and y in the other. Terms that only one has, or
neither, are cells of it too, by inclusion and exclusion from the sources' own
histograms, so they are never listed. The distance is evaluated once for each
distinct pair of counts, times the cell's number of terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.llm.batches import by_size, bytes_of
from strutwise.llm.common import stored

#: Documents of a language that hold a kept term; what is added to every count; parts of one; ranks of terms.
LEAST, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of text whose terms are counted at once.
SLICE_BYTES = 4 << 20
_COUNTS = "lang string, source string, term string, n long, docs long"
#: What bytes are of terms (letters of ASCII and all beyond it), and the bytes with A-Z lower-cased.
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, one text after another, and the text of each by its place; a null text has none."""
    raw, edges = bytes_of(texts)
    term = _TERM[raw]
    first = term.copy()
    first[1:] &= ~term[:-1]
    edge = edges[:-1][edges[:-1] < len(raw)]
    first[edge] = term[edge]  # terms don't run on from text to text
    at = np.flatnonzero(first)
    # the terms' bytes lie side by side once all others are gone
    place = np.r_[np.cumsum(term)[at] - 1, term.sum()] if len(at) else np.zeros(1, dtype=np.int64)
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(place.astype(np.int64).tobytes()), pa.py_buffer(_LOWER[raw[term]].tobytes()))
    return words, np.searchsorted(edges, at, "right") - 1


def _counted(slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", slice_bytes):
            words, doc = terms_of(batch.column(2))
            if not len(words):
                continue
            coded = words.dictionary_encode()
            many = len(coded.dictionary)
            pairs, counts = np.unique(doc * many + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            lang, source = (batch.column(k).dictionary_encode() for k in (0, 1))
            wide = len(source.dictionary)
            group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * wide + source.indices.to_numpy(zero_copy_only=False)
            cells, where = np.unique(group[pairs // many] * many + pairs % many, return_inverse=True)
            own = cells // many
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(own // wide)), source.dictionary.take(pa.array(own % wide)), coded.dictionary.take(pa.array(cells % many)).cast(pa.string()),
                    pa.array(np.bincount(where, weights=counts).astype(np.int64)), pa.array(np.bincount(where).astype(np.int64)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    return run


def _share(count: str, total: str, terms: str, prior: int, scale: int) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), exact; null where there are no terms."""
    number = lambda x: f"cast({x} as decimal(20,0))"
    return F.expr(f"1 + {number(scale)} * cast({count} + {prior} as decimal(18,0)) div nullif({number(f'{total} + {prior} * {terms}')}, cast(0 as decimal(20,0)))")


def source_divergence(docs: DataFrame, least: int = LEAST, prior: int = PRIOR, scale: int = SCALE, top: int = TOP, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs in ``docs`` (``text, lang, source``).

    Each language keeps the terms that ``least`` of its rows hold. A group's
    share of a term is smoothed by ``prior`` and counted in parts of ``scale``.
    Part ``pair``: every other source of the language and the summed distance of
    shares. Part ``term``: the ``top`` terms whose share lies farthest above the
    language's. Ranks go by value, then by item in byte order. Null text, lang or
    source counts as empty; repeated rows count each time; a group without terms
    is a group; a language without kept terms has pairs of value 0 and no
    terms. Further columns are ignored, whatever their names. An empty table
    gives no rows.
    """
    text = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(text.mapInArrow(_counted(slice_bytes), _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    cells = stored(counts.drop("docs").join(kept, ["lang", "term"]), "kept-terms")
    # a row for each language and for each group; Spark broadcasts them only below its own limit of size
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("total"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = stored(
        text.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("size", F.lit(0)).alias("size")),
        "term-groups",
    )
    pairs = _distances(cells, groups, prior, scale)
    above = cells.join(groups, ["lang", "source"]).withColumn(
        "value", _share("n", "size", "terms", prior, scale) - _share("`all`", "total", "terms", prior, scale)
    ).where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(by))
    return ranked(pairs).unionByName(ranked(above).where(F.col("rank") <= top))


def joint_histogram(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """``lang, a, b, x, y, m``: ``m`` kept terms have count ``x`` in source ``a`` and ``y`` in ``b``, zeros included.

    ``cells``: ``lang, term, source, n`` with counts above 0; ``pairs``: ``lang, a, b, terms``.
    """
    one, other = (cells.select("lang", "term", F.col("source").alias(s), F.col("n").alias(c)) for s, c in (("a", "x"), ("b", "y")))
    both = one.join(other, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b", "x", "y").agg(F.count("*").alias("m"))
    cell = lambda x, y, m: F.struct(F.expr(x).cast("long").alias("x"), F.expr(y).cast("long").alias("y"), F.expr(m).cast("long").alias("m"))
    spread = lambda rows, *out: rows.select("lang", "a", "b", F.inline(F.array(*out)))
    own = cells.groupBy("lang", "source", "n").agg(F.count("*").alias("m"))
    signed = spread(both, cell("x", "y", "m"), cell("x", "0", "-m"), cell("0", "y", "-m"), cell("0", "0", "m"))
    signed = signed.unionByName(spread(pairs.join(own.withColumnRenamed("source", "a"), ["lang", "a"]), cell("n", "0", "m"), cell("0", "0", "-m")))
    signed = signed.unionByName(spread(pairs.join(own.withColumnRenamed("source", "b"), ["lang", "b"]), cell("0", "n", "m"), cell("0", "0", "-m")))
    signed = signed.unionByName(spread(pairs, cell("0", "0", "terms")))
    return signed.groupBy("lang", "a", "b", "x", "y").agg(F.sum("m").alias("m")).where("m <> 0")


def _distances(cells: DataFrame, groups: DataFrame, prior: int, scale: int) -> DataFrame:
    """A row for each source and each other source of its language: the sum of distances over all kept terms."""
    first = groups.select("lang", F.col("source").alias("a"), "terms", F.col("size").alias("size_a"))
    second = groups.select("lang", F.col("source").alias("b"), F.col("size").alias("size_b"))
    pairs = first.join(second, "lang").where("a < b")
    far = joint_histogram(cells, pairs).join(pairs, ["lang", "a", "b"]).withColumn(
        "f", F.abs(_share("x", "size_a", "terms", prior, scale) - _share("y", "size_b", "terms", prior, scale))
    ).groupBy("lang", "a", "b").agg(F.sum(F.col("f") * F.col("m")).alias("value"))
    value = pairs.select("lang", "a", "b").join(far, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    way = lambda s, i: F.struct(F.col(s).alias("source"), F.lit("pair").alias("part"), F.col(i).alias("item"))
    return value.select("lang", F.explode(F.array(way("a", "b"), way("b", "a"))).alias("w"), "value").select("lang", "w.*", "value")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between all sources of each language, and the terms that stand out in each, over whole texts.

    Nulls count as empty, repeated rows each time; an empty table gives no rows;
    columns other than text, lang and source aren't read.
    """
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30
), l AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL
), s AS (
  SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL
), p AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(size, 0) + 5 * v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (k.n + 5) // (total + 5 * v)::HUGEINT AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM parts
QUALIFY part = 'pair' OR rank <= 50
"""
