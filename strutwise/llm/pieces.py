"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the model crosses from a character to a following marker (the sign
that stands for a space), so a text splits into marked words: a run of markers
and the characters up to the next one. Each worker keeps a table of the distinct
marked words it has met and their ids: a word is segmented once while it is in
the table, and its ids are joined back by position; the result is that of the
library on the whole text. The table is bounded: it starts anew beyond
``batches.CHUNKS`` words, and words longer than ``batches.LONG_CHUNK`` signs are
segmented each time. A model with pieces that cross markers is encoded whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strutwise.llm.batches import ChunkTable, by_size

MARK = "▁"
_WORD = re.compile(r" +[^ ]*")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCodec:
    """Encodes like ``SentencePieceProcessor.encode`` with an end id, decodes like its ``decode``."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        mark = self.model.piece_to_id(MARK)
        # chunks stand for their places only if spaces are markers, one for one, with one put first
        self.apart = (
            not any(MARK in p.lstrip(MARK) for p in pieces if not self.model.is_control(self.model.piece_to_id(p)))
            and self.model.encode(" ") == self.model.encode(MARK)
            and [self.model.id_to_piece(i) for i in self.model.encode("a  b ")][-1:] == [MARK]
            and self.model.encode("a") != self.model.encode(" a")
        )
        self.end = self.model.eos_id()

        shared = list(range(len(pieces)))  # one number object for each id, whatever many words have it

        def encode(words: list[str]) -> list[tuple[int, ...]]:
            # the library puts the first marker itself
            found = self.model.encode([w[1:] for w in words], num_threads=1)
            return [tuple(map(shared.__getitem__, ids)) if w != " " else (mark,) for w, ids in zip(words, found)]

        self.table = ChunkTable(encode)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.apart:
            words = [_WORD.findall(f" {t.replace(MARK, ' ')}") if t else [] for t in texts]
            found = [list(chain.from_iterable(x)) for x in self.table(words)]
        else:
            found = self.model.encode(texts, num_threads=1)
        for ids in found:
            ids.append(self.end)
        return found

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.model.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encoded(df: DataFrame, text: str = "text", path: str | None = None, decode: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array of int, end id last) and, if asked for, ``decoded`` (string).

    A null text is encoded as an empty one: the end id alone, decoded to an
    empty string. Repeated rows are encoded alike. Columns named ``ids``
    and, if asked for, ``decoded`` are replaced, all others kept. The model file is read on each
    executor from ``path``.
    """
    path = path or model_path()
    df = df.drop("ids", *["decoded"] * decode)
    more = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] + [T.StructField("decoded", T.StringType(), False)] * decode
    at = df.columns.index(text)

    def run(batches):
        made = codec(path)
        for batch in by_size(batches, text):
            ids = made.encode([t or "" for t in batch.column(at).to_pylist()])
            new = [pa.array(ids, pa.list_(pa.int32()))] + ([pa.array(made.decode(ids), pa.string())] if decode else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *[f.name for f in more]])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *more]))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents encoded with an end id and decoded again.

    A null or empty text has the end id alone and decodes to an empty string.
    Texts of any length are whole; repeated rows are alike; other columns are
    not read; an empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded(docs, decode=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its ids, end id last: the columns of ``docs`` but for the text, ``ids`` and ``n_tokens``.

    A null or empty text has the end id alone; repeated rows stay; columns of
    any other name are kept. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("text", "ids", "n_tokens")]
    return encoded(docs).select(*[F.col(f"`{c}`") for c in names], "ids", F.size("ids").cast("long").alias("n_tokens"))
