"""Best-fit packing of documents into sequences of tokens, by sums of squares.

A document is placed where the squared counts of open sequences per residual gap
add up to the least afterwards.  That keeps gaps of all sizes about equally
frequent, so that something fits into each.  As all lengths of a group are known,
long ones go first, and a new sequence is begun only where no open one has room.

Documents are dealt at random into groups of a fixed mean size, each packed by
one task with counts for 1024 gaps; a group leaves a few sequences unfilled,
whatever the size of the corpus.  Only lengths travel, never tokens.

Every row is a document of its own, repeated rows and null ids too.  A null or
empty text is the end mark alone.  A longer document is cut into full sequences,
its first piece takes what is left over.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.common import by_slices, read, texts_of, written
from floodmark.llm.token_counts import SPLIT, byte_characters, vocabulary

CAPACITY = 1024
END_ID = 2
# Mean number of pieces packed together, about 1 MB of lengths in a task.
GROUP_PIECES = 16_384


class Encoder:
    """Token ids of texts for one worker.

    The vocabulary's own library takes about five times as long here as another
    that does the same merges from the same file, so the latter encodes all texts
    but those with special strings, which the two treat differently.
    """

    def __init__(self, tokenizer: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        model = json.loads(tokenizer)
        byte = {c: b for b, c in byte_characters().items()}
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {
            bytes(map(byte.__getitem__, token)): n
            for token, n in model["model"]["vocab"].items()
            if token not in special
        }
        self.merges = Encoding("merges", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.special = regex.compile("|".join(map(regex.escape, special)) or "(?!)")

    def encode(self, text: str) -> np.ndarray:
        if self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.merges.encode_to_numpy(text).astype("<u4", copy=False)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces; only the first may fall short."""
    short = n % capacity
    starts = [0] * (short > 0) + list(range(short, n, capacity))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)
    end = np.uint32(end_id)

    def run(batches):
        encoder = Encoder(shipped.value)

        def tokens(part):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = np.append(encoder.encode(text), end)
                rows += [
                    (doc, n, s, length, zlib.crc32(ids[s : s + length]))
                    for n, (s, length) in enumerate(cut(len(ids), capacity))
                ]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

        yield from by_slices(tokens)(batches)

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, none above the capacity.

    With N(g) open sequences of gap g, an item of size s that goes into a gap g
    changes the sum by 2 (N(g-s) - N(g) + 1), or by 1 - 2 N(g) where it fits
    exactly.  Ties go to the smallest gap.
    """
    none = 2 * capacity * len(lengths)
    counts = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    made = 0
    for n, s in enumerate(lengths.tolist()):
        gap = capacity
        if s < capacity:
            change = 2 * (counts[: capacity - s] - counts[s:capacity] + 1)
            change[0] -= 2 * counts[0] + 1  # counts[0] is no gap
            change[counts[s:capacity] == 0] = none
            best = int(change.argmin())
            if change[best] < none:
                gap = s + best
        if gap == capacity:
            made, number = made + 1, made
        else:
            counts[gap] -= 1
            number = open_[gap].pop()
        sequence[n], offset[n] = number, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_[gap - s].append(number)
    return sequence, offset


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The pieces of all rows with the sequence each is in and its offset there."""
    found = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    groups = max(1, round(found.count() / GROUP_PIECES))
    dealt = found.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))

    def fill(rows: pa.Table) -> pa.Table:
        # Large ones first; among equals an order that any rerun repeats.
        order = [("length", "descending"), *[(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")]]
        rows = rows.sort_by(order)
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        number = (sequence * groups + rows["grp"].to_numpy()).astype(np.int64)
        rows = rows.append_column("sequence_id", pa.array(number))
        return rows.append_column("offset", pa.array(offset)).drop_columns(["grp"])

    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("grp").applyInArrow(fill, out)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(read(spark, sf_dir, "documents"), vocabulary())
