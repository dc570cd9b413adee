"""Benchmark passages in training texts, by n-gram seeds and local alignment.

1. Words are runs of letters and digits, A-Z lower-cased.  Every three-word
   sequence of a benchmark item is a seed, however many documents hold it.
2. Where a text holds a seed, the item is laid beside it, and overlapping layings
   become one window of the text.
3. Smith-Waterman alignment of the words (2 for a match, -1 for a mismatch or a
   gap) finds the best local match in each window.  A window is passed over only
   where no alignment can reach the threshold: within any stretch of it, 2 for each
   word of the item less 1 for each other word is no less than a score there.
4. A score of 1 is the whole item, word for word.  Pairs at or above ``threshold``
   are contamination.

The corpus is only read, never shuffled: benchmark items are shipped to all tasks
in blocks of at most ``block_bytes`` of text (or one item), a pass over the corpus
for each block, so a benchmark of any size is worked off and none is dropped.

Null and empty texts match nothing, as do items without words; items of one or two
words are one sequence.  Equal items are each reported, repeated rows too.  A null
id stays null.  Empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.common import MARKS, U64, by_slices, bytes_of, mixed, read, texts_of, words_of

SEED_WORDS = 3
THRESHOLD = 0.5
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
# Alignments are worked on together while their matrices stay below this many cells.
CELLS = 1 << 20
# Layings and words of windows looked at together.
TOGETHER = 1 << 20
_ODD = np.random.default_rng(13).integers(1, 2**63, SEED_WORDS).astype(U64) * U64(2) + U64(1)

_MATCHES = (
    "doc_id long, text_hash long, item_id long, score double, begin int, end int, item_begin int, item_end int, seeds int"
)


def sequences(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = max(len(hashes) - size + 1, 0)
    total = np.full(n, U64(size))
    for k in range(size):
        total += hashes[k : k + n] * _ODD[k]
    return mixed(total)


class Items:
    """A block of benchmark items with their words and the sequences they hold."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        data, at = bytes_of(pa.array(texts, pa.string()))
        hashes, _, _, first = words_of(data, at, MARKS)
        self.words = [hashes[b:e] for b, e in zip(first[:-1], first[1:])]
        self.grams = [sequences(w, min(SEED_WORDS, len(w))) if len(w) else w for w in self.words]
        self.known = {
            size: np.unique(np.concatenate([*(g for g, w in zip(self.grams, self.words) if min(SEED_WORDS, len(w)) == size), np.zeros(0, U64)]))
            for size in range(1, SEED_WORDS + 1)
        }

        n = len(ids)
        grams = np.concatenate([*self.grams, np.zeros(0, U64)])
        owner = np.repeat(np.arange(n), [len(g) for g in self.grams])
        offset = np.concatenate([*(np.arange(len(g)) for g in self.grams), np.zeros(0, np.int64)])
        self.seeds, number = np.unique(grams, return_inverse=True)
        order = np.lexsort((offset, owner, number))
        # Places of each seed, by item, so that any range of items can be looked up.
        self.owner, self.offset = owner[order], offset[order]
        self.place_key = number[order] * n + self.owner
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        salt = np.repeat(np.arange(n).astype(U64) * _ODD[0], self.sizes)
        self.owned = np.unique(mixed(np.concatenate([*self.words, np.zeros(0, U64)]) + salt))

    def layings(self, text, place, gram, low: int = 0, high: int | None = None):
        """Item, text and begin of all layings by the hits, in bounded lots that hold each item whole."""
        n = len(self.ids)
        high = n if high is None else high
        number = np.searchsorted(self.seeds, gram)
        start = np.searchsorted(self.place_key, number * n + low)
        many = np.searchsorted(self.place_key, number * n + high) - start
        total = int(many.sum())
        if total > TOGETHER and high - low > 1:
            middle = (low + high) // 2
            yield from self.layings(text, place, gram, low, middle)
            yield from self.layings(text, place, gram, middle, high)
        elif total:
            hit = np.repeat(np.arange(len(gram)), many)
            at = np.arange(total) - np.repeat(np.cumsum(many) - many - start, many)
            yield self.owner[at], text[hit], place[hit] - self.offset[at]

    def reach(self, hashes: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """What no alignment of the item in the words from begin to end can exceed."""
        width = end - begin
        best = np.zeros(len(item), np.int64)
        lots = np.cumsum(width) // TOGETHER
        for lot in np.split(np.arange(len(item)), np.flatnonzero(np.diff(lots)) + 1):
            wide = width[lot]
            first = np.cumsum(wide) - wide
            word = hashes[np.arange(wide.sum()) - np.repeat(first - begin[lot], wide)]
            key = mixed(word + np.repeat(item[lot].astype(U64) * _ODD[0], wide))
            near = np.minimum(np.searchsorted(self.owned, key), len(self.owned) - 1)
            value = np.where(self.owned[near] == key, MATCH, np.maximum(MISMATCH, GAP))
            # Best sum of a stretch; every window lies so far below the last that minima do not pass on.
            total = np.cumsum(value) - np.repeat(np.arange(len(lot)) * (2 * MATCH * len(value) + 1), wide)
            best[lot] = np.maximum(np.maximum.reduceat(total - np.minimum.accumulate(total - value), first), 0)
        return best

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the block's sequences among the words of one or more texts."""
        at, found = [], []
        for size, known in self.known.items():
            if len(known) and len(hashes) >= size:
                grams = sequences(hashes, size)
                near = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                some = np.flatnonzero(known[near] == grams)
                at.append(some)
                found.append(np.c_[grams[some], np.full(len(some), size, U64)])
        if not at:
            return np.zeros(0, np.int64), np.zeros((0, 2), U64)
        return np.concatenate(at), np.concatenate(found)


def _inside(at, found, first) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits that end in the text they begin in: text, place in it, hash."""
    text = np.searchsorted(first, at, "right") - 1
    fits = at + found[:, 1].astype(np.int64) <= first[text + 1]
    return text[fits], at[fits] - first[text[fits]], found[fits, 0]


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best score, and begin and end in window and item, of one item in several windows.

    A row of the matrix is one item word.  Within it, gaps in the item are a running
    maximum, since each costs the same.  Beginnings travel with the scores.
    """
    n, width = windows.shape
    steps = -GAP * np.arange(width + 1)
    score = np.zeros((n, width + 1), np.int64)
    begin = np.tile(np.arange(width + 1), (n, 1))
    row_begin = np.zeros((n, width + 1), np.int64)
    best = np.zeros(n, np.int64)
    spans = np.zeros((4, n), np.int64)
    every = np.arange(n)
    for i, word in enumerate(item):
        diagonal = score[:, :-1] + np.where(windows == word, MATCH, MISMATCH)
        above = score[:, 1:] + GAP
        use = diagonal >= above
        now = np.zeros_like(score)
        now[:, 1:] = np.maximum(np.maximum(diagonal, above), 0)
        at = np.tile(np.arange(width + 1), (n, 1))
        row = np.full((n, width + 1), i + 1)
        alive = now[:, 1:] > 0
        at[:, 1:] = np.where(alive, np.where(use, begin[:, :-1], begin[:, 1:]), at[:, 1:])
        row[:, 1:] = np.where(alive, np.where(use, row_begin[:, :-1], row_begin[:, 1:]), row[:, 1:])
        # Where a cell further left minus its distance is more, the gap comes from there.
        lifted = now + steps
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.where(lifted == top, np.arange(width + 1), 0)
        source = np.maximum.accumulate(source, axis=1)
        score = top - steps
        begin, row_begin = np.take_along_axis(at, source, 1), np.take_along_axis(row, source, 1)
        last = score.argmax(axis=1)
        better = score[every, last] > best
        best[better] = score[every, last][better]
        for k, value in enumerate((begin[every, last], last, row_begin[every, last], np.full(n, i + 1))):
            spans[k, better] = value[better]
    return best, *spans


def _windows(items: Items, item, text, begin) -> tuple[np.ndarray, ...]:
    """Stretches of text beside which the item may lie, with a quarter of it to spare.

    Item, text, begin and end of each, and in how many ways the item is laid beside the text.
    """
    order = np.lexsort((begin, text, item))
    item, text, begin = item[order], text[order], begin[order]
    other = np.ones(len(item), bool)
    other[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1])
    new = other.copy()
    new[1:] |= begin[1:] != begin[:-1]
    item, text, begin, other = item[new], text[new], begin[new], other[new]
    pair = np.cumsum(other) - 1
    seeds = np.bincount(pair)[pair]
    size = items.sizes[item]
    spare = size // 4 + 2
    apart = other
    apart[1:] |= begin[1:] - begin[:-1] > (size + 2 * spare)[1:]
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(item)) - 1
    return item[first], text[first], (begin - spare)[first], (begin + size + spare)[last], seeds[first]


def matches(texts: DataFrame, items: Items, threshold: float) -> DataFrame:
    """All pairs of a row and an item of the block that reach the threshold, at the best place."""
    shipped = texts.sparkSession.sparkContext.broadcast(items)

    def find(part):
        block = shipped.value
        data, at = bytes_of(part.column("text"))
        hashes, starts, ends, first = words_of(data, at, MARKS)
        by_item = defaultdict(list)
        for laid in block.layings(*_inside(*block.hits(hashes), first)):
            item, text, begin, end, seeds = _windows(block, *laid)
            begin = np.maximum(first[text] + begin, first[text])
            end = np.minimum(first[text] + end, first[text + 1])
            near = block.reach(hashes, item, begin, end) / (MATCH * block.sizes[item]) >= threshold
            for n, *window in np.c_[item, text, begin, end, seeds][near].tolist():
                by_item[n].append(window)
        found: dict[tuple[int, int], tuple] = {}
        for item, windows in by_item.items():
            words = block.words[item]
            windows.sort(key=lambda w: w[2] - w[1])
            while windows:
                # Windows of like width at once; a short one is filled up with words of no text.
                width = max(windows[-1][2] - windows[-1][1], 1)
                some = windows[-max(1, CELLS // width) :]
                windows = windows[: -len(some)]
                filled = np.zeros((len(some), width), U64)
                for row, (_, b, e, _) in zip(filled, some):
                    row[: e - b] = hashes[b:e]
                for (text, b, e, seeds), score, x, y, u, v in zip(some, *align(words, filled)):
                    y = min(int(y), e - b)
                    ratio = float(score) / (MATCH * len(words))
                    if ratio >= threshold and ratio > found.get((text, item), (0,))[0]:
                        begin, end = int(starts[b + x] - at[text]), int(ends[b + y - 1] - at[text])
                        found[text, item] = (ratio, begin, end, int(u), int(v), seeds)
        if not found:
            return None
        rows = sorted(found.items())
        column = lambda k: [value[k] for _, value in rows]
        at_text = pa.array([text for (text, _), _ in rows])
        ids, names_of = part.column("doc_id").take(at_text), part.column("text_hash").take(at_text)
        item_ids = pa.array([block.ids[item] for (_, item), _ in rows], pa.int64())
        ints = [pa.array(column(k), pa.int32()) for k in range(1, 6)]
        names = ["doc_id", "text_hash", "item_id", "score", "begin", "end", "item_begin", "item_end", "seeds"]
        return pa.RecordBatch.from_arrays([ids, names_of, item_ids, pa.array(column(0)), *ints], names)

    return texts.mapInArrow(by_slices(find), _MATCHES)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per contaminated row and benchmark item.

    text_hash is xxhash64 of the text, begin and end are bytes of it, item_begin and
    item_end words of the item, seeds the number of places where a seed laid the item beside the text.
    """
    texts = texts_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    wanted = texts_of(benchmark, item_id_col, item_text_col).filter("text <> ''")
    volume = wanted.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0
    blocks = -(-2 * volume // block_bytes)
    found = docs.sparkSession.createDataFrame([], _MATCHES)
    for n in range(blocks):
        mine = wanted.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == n)
        rows = mine.orderBy("doc_id", "text").toArrow()
        if rows.num_rows:
            items = Items(rows["doc_id"].to_pylist(), rows["text"].to_pylist())
            found = found.union(matches(texts, items, threshold))
    return found


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark passage, with the passage and its place."""
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
