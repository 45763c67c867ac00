"""I-Match document fingerprints over randomised lexicon subsets, in DataFrame functions only.

Terms are longest runs of letters and digits, in lower case. The lexicon keeps
terms whose inverse document frequency lies in a band; document frequencies are
counted exactly, by term, over all documents. At most (mean distinct terms of a
document) / (the band's lower share) terms can lie in the band, however many
documents there are, so the lexicon travels inside the expressions: a table in
which a term can stand in one of two places. Should it have more than ``MOST``
terms, the terms of each text meet it in a join instead. A fingerprint has one value for each lexicon subset: the hash of the
sorted distinct terms of the text in it. The first subset is the whole lexicon;
the others keep a random half down to a 128th of it, so that the smaller ones
survive edits that change the larger ones.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strutwise.llm.common import stored

#: Terms of a lexicon that travels in expressions (some 5 MB); more are joined.
MOST = 1 << 18
#: Document frequencies, as shares of all documents, that the lexicon keeps: idf from ln 4 to ln 500.
BAND = (0.002, 0.25)
#: Bits that keep a term in each randomised subset: subset k of n bits has one in 2**n terms.
SUBSETS = (1,) * 4 + (3,) * 4 + (5,) * 8 + (7,) * 16
#: Bytes of text in a range, whose rows are ordered together, and bytes of text that a task takes. Bounds of ranges travel
#: in expressions too, 512 KB at most: beyond 256 GB of text ranges are longer, a task each, and stream through their sort.
RANGE, RANGES, TASK = 4 << 20, 1 << 16, 16 << 20
#: Bytes of text that one row stands for where the bounds of ranges are found.
UNIT = 16 << 10


def _hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def terms(text: Column) -> Column:
    """Sorted distinct hashes of a text's terms; a null text has none."""
    return F.sort_array(F.array_distinct(_hashes(text)))


class Lexicon(NamedTuple):
    """The kept terms as a table of two-place hashing, or as rows ``term`` to join."""

    table: Column | None
    size: int
    rows: DataFrame | None


def _places(term: int, size: int) -> tuple[int, int]:
    return term & (size - 1), (term >> 32) & (size - 1)


def two_place_table(kept: list[int]) -> list[int]:
    """Every term in one of its two places, all other places with values that don't belong there; a power of two long."""
    size = 1 << max(6, (5 * len(kept) // 2).bit_length())
    while True:
        table: list[int | None] = [None] * size
        for term in kept:
            moving, at = term, _places(term, size)[0]
            for _ in range(500):
                moving, table[at] = table[at], moving
                if moving is None:
                    break
                one, other = _places(moving, size)
                at = other if at == one else one
            else:
                break  # no room along this way: a larger table
        else:
            # 0 belongs in place 0 only, 2**32 + 1 in place 1 only
            return [((1 << 32) + 1 if at == 0 else 0) if x is None else x for at, x in enumerate(table)]
        size *= 2


def lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> Lexicon:
    """The terms whose document frequency, as a share of all rows, lies in the band and is 2 or more."""
    total = docs.count()
    found = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    kept = found.where(F.col("df").between(max(2, math.ceil(band[0] * total)), max(2, math.floor(band[1] * total)))).select("term")
    listed = [r.term for r in kept.limit(MOST + 1).collect()]
    if len(listed) > MOST:
        return Lexicon(None, 0, stored(kept, "lexicon"))
    table = two_place_table(sorted(listed))
    return Lexicon(F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>"), len(table), None)


def with_prints(rows: DataFrame, text: str, lexicon: Lexicon, out: str) -> DataFrame:
    """Adds the fingerprint of a text (see :func:`fingerprint`), by expressions alone or by a join of its terms."""
    if lexicon.rows is None:
        return rows.withColumn(out, fingerprint(F.col(text), lexicon))
    named = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "fingerprint-rows")
    held = named.select("__row", F.explode(terms(F.col(text))).alias("term")).join(lexicon.rows, "term")
    inside = held.groupBy("__row").agg(F.sort_array(F.collect_list("term")).alias("__inside"))
    both = F.struct(terms(F.col(text)).alias("every"), F.coalesce("__inside", F.expr("cast(array() as array<bigint>)")).alias("inside"))
    return named.join(inside, "__row", "left").withColumn(out, _computed_once(both)).drop("__row", "__inside")


def fingerprint(text: Column, lexicon: Lexicon) -> Column:
    """Array of subset hashes; null where a text has no term in a subset.

    The first is never null: if no term is in the lexicon it is the hash of all
    terms, so texts that only share having none don't look alike.
    """
    every, last = terms(text), F.lit(lexicon.size - 1)
    held = lambda t, at: F.get(lexicon.table, at.bitwiseAND(last).cast("int")) == t
    inside = F.filter(every, lambda t: held(t, t) | held(t, F.shiftright(t, 32)))
    return _computed_once(F.struct(every.alias("every"), inside.alias("inside")))


def _computed_once(sets: Column) -> Column:
    return F.transform(F.array(sets), lambda x: _subsets(x["every"], x["inside"]))[0]


def _drawn(subset: int, bits: int):
    return lambda t: F.xxhash64(t, F.lit(subset)).bitwiseAND(F.lit((1 << bits) - 1)) == 0


def _subsets(every: Column, inside: Column) -> Column:
    whole = F.when(F.size(inside) > 0, F.xxhash64(inside)).otherwise(F.xxhash64(every, F.lit("all")))
    parts = []
    for k, bits in enumerate(SUBSETS):
        own = F.filter(inside, _drawn(k, bits))
        parts.append(F.transform(F.array(own), lambda a: F.when(F.size(a) > 0, F.xxhash64(a)))[0])
    return F.array(whole, *parts)


def as_text(prints: Column) -> Column:
    """A fingerprint as hex values joined by dots; a subset without terms is empty."""
    return F.array_join(F.transform(prints, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x), 16, "0")), F.lit(""))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal values among the subsets in which either text has terms."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), None).otherwise(F.coalesce((x == y).cast("int"), F.lit(0))))
    held = F.filter(pairs, lambda x: x.isNotNull())
    return F.aggregate(held, F.lit(0), lambda s, x: s + x).cast("double") / F.size(held)


def ranges(docs: DataFrame, key: str, text: str) -> tuple[Column, int, int]:
    """The range of each key (higher ranges hold higher keys, null the lowest), the number of ranges, and bytes of all texts.

    Bounds are quantiles of the keys by the bytes of their texts, so ranges
    hold about equal volumes.
    """
    units = F.ceil((F.coalesce(F.octet_length(text), F.lit(0)) + 1) / F.lit(UNIT)).cast("int")
    weighed = docs.select(F.col(key).alias("__key"), units.alias("__units"))
    volume = int(weighed.agg(F.coalesce(F.sum("__units"), F.lit(0))).first()[0]) * UNIT
    many = min(RANGES, max(1, -(-volume // RANGE)))
    bounds: list[int] = []
    if many > 1:
        shares = [k / many for k in range(1, many)]
        found = weighed.select("__key", F.explode(F.sequence(F.lit(1), F.col("__units")))).agg(F.percentile_approx("__key", shares, 10 * many).alias("b")).first().b or []
        bounds = sorted(set(found))
    if not bounds:
        return F.when(F.col(key).isNull(), -1).otherwise(0), 1, volume
    fixed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= len(bounds)) & (F.get(fixed, at + s - 1) <= F.col(key)), at + s).otherwise(at),
    )
    return F.when(F.col(key).isNull(), -1).otherwise(place), len(bounds) + 1, volume


def with_next(docs: DataFrame, key: str, text: str, columns: dict[str, Column]) -> DataFrame:
    """``key``, ``text`` and ``columns`` (name and what it holds of a row) with ``next_<c>`` of the next row by descending key.

    Null keys come last, ties are ordered by text, and after the last row comes
    the first. Rows are ordered inside ranges of keys, and the first row of
    each range is also the last of the range before it. These rows are found by
    key alone and read again, so ``columns`` are computed once for all others.
    Rows that tie on key and text are equal in all that is compared, so their
    order doesn't show. Other columns of ``docs`` are left out.
    """
    place, many, volume = ranges(docs, key, text)
    both = {text: F.col("__text"), **columns}
    placed = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"), (place.cast("int") + 1).alias("__range"))
    # a row per range, RANGES and one at most; the texts of its greatest key, then the greatest of them
    tops = placed.groupBy("__range").agg(F.max("__key").alias("__top")).withColumnRenamed("__range", "__at")
    greatest = (
        placed.join(F.broadcast(tops), (F.col("__range") == F.col("__at")) & F.col("__key").eqNullSafe(F.col("__top")))
        .groupBy("__at").agg(F.max("__text").alias("__text"))
    )
    down = Window.orderBy("__at")
    lower = tops.select(F.col("__at").alias("__range"), F.coalesce(F.lag("__at").over(down), F.max("__at").over(Window.partitionBy())).alias("__next"))
    extra = lower.join(greatest, F.col("__next") == F.col("__at")).select(F.lit(None).cast("long").alias("__key"), "__text", "__range", F.lit(1).alias("__extra"))
    # a task takes a few ranges; ``columns`` are computed there, so they aren't shuffled
    tasks = min(many + 1, max(docs.sparkSession.sparkContext.defaultParallelism, volume // TASK))
    dealt = placed.withColumn("__extra", F.lit(0)).unionByName(extra).repartitionById(tasks, F.col("__range"))
    rows = dealt.select("__key", "__range", "__extra", F.struct(*[c.alias(n) for n, c in both.items()]).alias("__both"))
    order = Window.partitionBy("__range").orderBy("__extra", F.col("__key").desc_nulls_last(), F.col(f"__both.{text}").desc())
    return rows.withColumn("__lead", F.lead("__both").over(order)).where("__extra = 0").select(
        F.col("__key").alias(key), *[F.col(f"__both.{c}").alias(c) for c in both], *[F.col(f"__lead.{c}").alias(f"next_{c}") for c in both]
    )


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they are.

    A null text counts as empty and has the fingerprint of no terms. Repeated
    ids are ordered by text, a null id comes last. Texts of any length are
    whole. Other columns of the table are not read. An empty table gives no rows.
    """
    return edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = lexicon(docs)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.char_length("text") - half), F.left("next_text", half))
    if words.rows is None:
        near = with_next(docs, "doc_id", "text", {"prints": fingerprint(F.col("__text"), words)})
    else:
        near = with_prints(with_prints(with_next(docs, "doc_id", "text", {}), "text", words, "prints"), "next_text", words, "next_prints")
    rows = with_prints(
        near.select("doc_id", "prints", "next_prints", F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited")), "edited", words, "edited_prints"
    )
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("prints")).alias("fingerprint"), as_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )
