"""What several operators share: input columns, scratch tables, hashed words.

Words are hashed whole batches at a time in numpy: a batch of texts is one array
of bytes, and words are runs of bytes in it.  A text is never cut, but it is
hashed in pieces that end at separators, so that helper arrays stay small.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.session import shared_folder

# Bytes of text that are worked on at once.
PIECE_BYTES = 1 << 20
# Bytes that travel between Spark and a Python worker at once; the session's own
# bound is meant for short rows, and two tasks hold several such batches each.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")

U64 = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Everything of ASCII but letters and digits; bytes of other letters belong to words.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_POWER = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256).astype(U64)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids and texts only, so that other columns cannot clash; a null text is empty.

    Sets the session to small Arrow batches, as all that follows goes through them.
    """
    docs.sparkSession.conf.set(*BATCH_BYTES)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, where every executor can reach it."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table written once: later steps survive lost executors and read it anew."""
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that every bit depends on all."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (and the last ends)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    at = np.frombuffer(ends, np.int64, n + 1, offset=8 * texts.offset)
    first, last = int(at[0]), int(at[-1])
    if last == first:
        return np.zeros(0, np.uint8), at - first
    return np.frombuffer(data, np.uint8, last - first, offset=first), at - first


def _pieces(data: np.ndarray, apart: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about PIECE_BYTES that end behind a separator or with the data."""
    begin = 0
    while begin < len(data):
        end = begin + PIECE_BYTES
        while end < len(data):
            ahead = np.flatnonzero(apart[data[end : end + PIECE_BYTES]])
            if len(ahead):
                end += int(ahead[0]) + 1
                break
            end += PIECE_BYTES
        end = min(end, len(data))
        yield begin, end
        begin = end


def words_of(
    data: np.ndarray, at: np.ndarray, apart: np.ndarray = SPACES, fold: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of all words, and each text's first word (and the end).

    Words are the longest runs of bytes that are no separators, A-Z lower-cased.
    Texts are parted as if by a separator.
    """
    hashes, starts, ends = [], [], []
    edges = at[1:-1]
    for begin, end in _pieces(data, apart):
        part = data[begin:end]
        inside = ~apart[part]
        cuts = edges[np.searchsorted(edges, begin, "right") : np.searchsorted(edges, end, "left")]
        cuts = cuts - begin
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[cuts - 1] = inside[cuts - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(s):
            continue
        lengths = e - s
        base = np.zeros(len(s), np.int64)
        np.cumsum(lengths[:-1], out=base[1:])
        chars = part[inside]
        place = np.arange(len(chars)) - np.repeat(base, lengths)
        power = np.full(int(lengths.max()), _POWER, U64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        value = _BYTE[LOWER[chars] if fold else chars]
        value *= power[place]
        hashes.append(mixed(np.add.reduceat(value, base) + lengths.astype(U64)))
        starts.append(s + begin)
        ends.append(e + begin)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, np.zeros(len(at), np.int64)
    s = np.concatenate(starts)
    return np.concatenate(hashes), s, np.concatenate(ends), np.searchsorted(s, at)


def text_slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PIECE_BYTES of text; a longer text is one by itself."""
    _, at = bytes_of(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(at, at[begin] + PIECE_BYTES, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def by_slices(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], text: str = "text"):
    """A function for mapInArrow that works on slices of bounded text."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out

    return run
