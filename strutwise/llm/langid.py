"""Language identification with error-correcting output codes.

Each language has a codeword; one linear classifier per codeword bit, on hashed
character n-grams of the whole text, predicts that bit. Decoding adds up the
logistic losses of all bits for each codeword, each bit weighted by how well it
held on rows kept back from its fit, and takes the nearest codeword. A text
whose two nearest codewords lie close together is flagged as ambiguous.

The model is fitted on a bounded sample of labelled rows (``sample`` rows for
each language, ``in_all`` at most, both parameters, drawn by a hash of the id);
nothing else is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.llm.batches import by_size
from strutwise.llm.common import keeps_columns

BITS = 12
DIMS = 1 << BITS
#: Rows fitted on, about: so many for each language, and so many in all; languages that a model can hold.
SAMPLE, SAMPLE_IN_ALL, LANGUAGES = 600, 4000, 1000
#: Texts whose score is below this are flagged as ambiguous.
AMBIGUOUS = 0.6
UNKNOWN = "und"
_HASH = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def features(text: str) -> np.ndarray | None:
    """Square roots of hashed 1-, 2- and 3-gram counts of the letters, scaled to length 1; None without letters."""
    lowered = text.lower()
    if not any(map(str.isalpha, lowered)):
        return None
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _is_letter(points)
    kept = np.where(letter, points, np.uint32(32))
    kept = np.concatenate([[np.uint32(32)], kept, [np.uint32(32)]]).astype(np.uint32)
    kept = kept[np.r_[True, (kept[1:] != 32) | (kept[:-1] != 32)]]  # one space between words
    with np.errstate(over="ignore"):
        one = kept * _HASH[0]
        two = one[:-1] ^ (kept[1:] * _HASH[1])
        three = two[:-1] ^ (kept[2:] * _HASH[2])
        counts = np.zeros(DIMS)
        for k, grams in enumerate((one[kept != 32], two, three)):
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(2246822507) + np.uint32(k)
            counts += np.bincount(mixed >> np.uint32(32 - BITS), minlength=DIMS)
    counts = np.sqrt(counts)
    return (counts / np.linalg.norm(counts)).astype(np.float32)


_letters = np.zeros(0, dtype=bool)


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if not len(_letters):
        _letters = np.array([chr(i).isalpha() for i in range(0x10000)])
    return (points < 0x10000) & _letters[np.minimum(points, 0xFFFF)] | (points >= 0x10000)


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """n codewords of +1 and -1: every split of up to 7 languages, else random splits with the widest least distance."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.vstack([np.ones(len(splits)), *(1.0 - 2 * (splits >> k & 1) for k in range(n - 1))])
    rng, best, found = np.random.default_rng(seed), -1, None
    length = 8 * int(np.ceil(np.log2(n)))
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], size=(n, length))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        least = ((length - code @ code.T) / 2 + np.eye(n) * length).min()
        if least > best:
            best, found = least, code
    return found


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword and its score (0 to 1) for each row of features."""
        margin = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]) @ self.trust
        if len(self.languages) == 1:
            return np.zeros(len(x), dtype=int), np.ones(len(x))
        # each bit's loss is a negative log likelihood; shared bits cancel between codewords
        odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        return loss.argmin(axis=1), odds.max(axis=1) / odds.sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 120) -> Model:
    """One ridge-penalised logistic regression per bit (all bits at once, accelerated gradient steps)."""
    code = codewords(len(languages))
    kept_back = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), dtype=bool)
    goal = code[y].astype(np.float32)
    share = 1.0 / np.maximum(np.bincount(y, minlength=len(languages)), 1)
    weight = (share[y] / share[y].sum()).astype(np.float32)

    def solve(used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # rows that are not used weigh nothing: the features are never copied
        w = (weight * used / (weight * used).sum())[:, None]
        theta, bias = np.zeros((DIMS, code.shape[1]), dtype=np.float32), np.zeros(code.shape[1], dtype=np.float32)
        ahead, ahead_bias, rate, scale = theta, bias, np.float32(4.0 / 1.1), np.float32(0.3)
        for k in range(steps):
            m = np.clip((x @ ahead + scale * ahead_bias) * goal, -30, 30)
            pull = -(goal / (1 + np.exp(m))) * w
            new = ahead - rate * (x.T @ pull + np.float32(1e-5) * ahead)
            new_bias = ahead_bias - rate * (scale * pull.sum(axis=0))
            step = np.float32(k / (k + 3))
            ahead, ahead_bias = new + step * (new - theta), new_bias + step * (new_bias - bias)
            theta, bias = new, new_bias
        return theta, bias * scale

    trust = np.ones(code.shape[1])
    if kept_back.any() and len(languages) > 1:
        w, b = solve(~kept_back)
        right = ((x @ w + b)[kept_back] * goal[kept_back] > 0).mean(axis=0)
        trust = np.clip(2 * right - 1, 0.05, 1.0)
    w, b = solve(np.ones(len(x), dtype=bool))
    return Model(languages, code, w.astype(np.float32), b.astype(np.float32), trust / trust.sum() * min(3.0, code.shape[1]) if len(languages) > 1 else trust)


def sampled(rows: DataFrame, key: str, text: str, lang: str, sample: int, seed: int, in_all: int = SAMPLE_IN_ALL) -> DataFrame:
    """About ``sample`` rows for each language by a hash of key and seed, ``in_all`` in all, as (language, order, features).

    More than ``LANGUAGES`` distinct labels are no languages: an error.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages among the labels")
    if not sizes:
        return None
    sample = min(sample, in_all / len(sizes))
    rate = F.create_map(*[F.lit(v) for name, n in sorted(sizes.items()) for v in (name, min(1.0, sample / n))])
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.where(drawn < rate[F.col(lang)]).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.lit(seed)).alias("at")
    )

    def run(batches):
        for batch in by_size(batches, "text"):
            found = [features(t) for t in batch.column(1).to_pylist()]
            keep = [k for k, f in enumerate(found) if f is not None]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), batch.column(2).take(pa.array(keep, pa.int64())), pa.array([found[k].astype(np.float16).tobytes() for k in keep], pa.binary())],
                names=["lang", "at", "x"],
            )

    return picked.mapInArrow(run, "lang string, at long, x binary")


def train(docs: DataFrame, keep: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, seed: int = 7, in_all: int = SAMPLE_IN_ALL) -> Model:
    """Fits on the rows that ``keep`` holds for; rows without language, text or letters take no part."""
    rows = docs.where(keep & F.col(lang).isNotNull() & F.col(text).isNotNull())
    found = sampled(rows, key, text, lang, sample, seed, in_all)
    got = found.toArrow().sort_by([("at", "ascending"), ("lang", "ascending")]) if found is not None else pa.table({"lang": []})
    labels = got["lang"].to_pylist()
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((DIMS, 1), np.float32), np.zeros(1, np.float32), np.ones(1))
    x = np.empty((len(labels), DIMS), dtype=np.float32)
    for k, row in enumerate(got["x"]):
        x[k] = np.frombuffer(row.as_buffer(), np.float16)
    del got
    return fit(x, np.array([languages.index(name) for name in labels]), languages)


def identified(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    A text that is null, empty or without letters, and any text if no language
    was learned, gets ``und`` and score 0. Equal texts get equal results. Other
    columns, however named, are kept; those three are replaced.
    """
    df = df.drop("lang_pred", "score", "ambiguous")
    at = df.columns.index(text)
    # the model holds 4,096 weights for each bit: its size does not follow the data
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])

    def run(batches):
        m = shared.value
        for batch in by_size(batches, text):
            found = [features(t) if t and m.languages else None for t in batch.column(at).to_pylist()]
            names, scores = np.array([UNKNOWN] * len(found), dtype=object), np.zeros(len(found))
            known = [k for k, f in enumerate(found) if f is not None]
            if known:
                best, score = m.predict(np.stack([found[k] for k in known]))
                names[known] = [m.languages[b] for b in best]
                scores[known] = score
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores), pa.array((scores < AMBIGUOUS) & (names != UNKNOWN))], names=[*batch.schema.names, "lang_pred", "score", "ambiguous"]
            )

    return df.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text is a multiple of 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op7_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of documents, learned from rows that are not held out.

    A text that is null or has no letters is ``und`` with score 0; rows without
    language are predicted like others. Repeated rows and equal texts get equal
    results; a null id is not held out. An empty table gives no rows. Columns
    beyond id, text and language are not read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, ~held_out())
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identified(rows, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def lettered(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has letters."""
    at = df.columns.index(text)

    def run(batches):
        for batch in by_size(batches, text):
            yield batch.filter(pa.array([bool(t) and features(t) is not None for t in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)


@keeps_columns
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those predicted ``und`` go. The columns of ``docs``.

    Where no language could be learned, documents with letters stay. Null and
    empty texts go, rows with null in other columns and repeated rows stay as
    they are, columns of any name are kept. An empty table gives no rows.
    """
    model = train(docs, ~held_out())
    if not model.languages:
        return lettered(docs)
    names = docs.columns
    return identified(docs, model).where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"`{c}`") for c in names])
