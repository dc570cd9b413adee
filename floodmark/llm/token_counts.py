"""Token counts by rank-synchronous array merging of byte pairs.

A batch of pre-tokens is one ragged array of symbols.  In each round every
pre-token applies its own lowest-ranked pair at all its places at once; a
pre-token without a known pair is done, and its symbols are counted.  Texts fall
into pieces at single spaces, which no pre-token spans, and a worker remembers
the counts of pieces it has seen, so that only new ones are merged.

Each row counts for itself, so repeated rows, ties and extra columns change
nothing: a null or empty text has no tokens and no bytes, a null id stays null,
an empty table gives no rows.  A text is never cut, however long.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from floodmark.llm.common import by_slices, bytes_of, read, texts_of

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
# What the pre-tokenizer of byte-level vocabularies splits by; a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pieces whose counts a worker remembers; beyond that it starts anew.
REMEMBERED = 400_000
NONE = np.iinfo(np.int32).max

# A space behind another character; the text may always be parted before it.
PARTING = re.compile(r"(?<=\S) ")
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]


def split_texts(texts: list[str]) -> list[list[str]]:
    """Each text in pieces, parted before white space that begins with a space.

    No pre-token spans such a place.  Where a space follows other white space, as
    in few texts, only the first of the run may part.
    """
    together = "".join(texts)
    white = [f"{c} " for c in WHITE if c in together]
    return [PARTING.split(t) if any(w in t for w in white) else t.split(" ") for t in texts]


class Pieces:
    """What is known of pieces; ``learn`` gives the values of new ones.

    At most ``remembered`` pieces are kept, beyond that the memory starts anew.
    """

    def __init__(self, learn, remembered: int):
        self.learn, self.remembered = learn, remembered
        self.first: dict = {"": self.learn([""])[0]}
        self.rest: dict = {}

    def look_up(self, texts: list[str]):
        """For each text the value of its first piece and an iterator over those of the rest."""
        split = split_texts(texts)
        self._known(self.first, {p[0] for p in split}, "")
        self._known(self.rest, {p for pieces in split for p in pieces[1:]}, " ")
        for pieces in split:
            yield self.first[pieces[0]], map(self.rest.__getitem__, pieces[1:])

    def _known(self, memory: dict, wanted: set, before: str) -> None:
        new = wanted.difference(memory)
        if new and len(memory) + len(new) > self.remembered:
            memory.clear()
            new = wanted
        if new:
            names = list(new)
            memory.update(zip(names, self.learn([before + p for p in names])))


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in vocabulary files.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class PairMerger:
    """Counts what is left of byte sequences after all merges of a vocabulary."""

    def __init__(self, tokenizer: str):
        model = json.loads(tokenizer)
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.special = [t["content"] for t in model["added_tokens"]]
        self.byte_symbol = np.array(
            [vocabulary[c] for _, c in sorted(byte_characters().items())], np.int32
        )
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of[at], NONE)

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Number of symbols of each sequence of at least one byte."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        counts = lengths.copy()
        symbol = self.byte_symbol[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        rank = np.full(len(symbol), NONE, np.int32)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[begin, len(owner)])
            lowest = np.minimum.reduceat(rank, begin)
            done = lowest == NONE
            counts[owner[begin[done]]] = size[done]
            if done.all():
                break
            goal = np.repeat(np.where(done, -1, lowest), size)
            hit = np.flatnonzero(rank == goal)
            # Of overlapping places (a run of equal symbols) every other one counts.
            fresh = np.r_[True, np.diff(hit) != 1]
            run = np.cumsum(fresh) - 1
            hit = hit[(hit - hit[fresh][run]) % 2 == 0]
            symbol[hit] = self.merged[rank[hit]]
            keep = np.repeat(~done, size)
            changed = np.zeros(len(symbol), bool)
            changed[hit] = True
            keep[hit + 1] = False
            symbol, owner, rank, changed = symbol[keep], owner[keep], rank[keep], changed[keep]
            changed[:-1] |= changed[1:]
            at = np.flatnonzero(changed)
            rank[at] = NONE
            at = at[at < len(symbol) - 1]
            at = at[owner[at] == owner[at + 1]]
            rank[at] = self.ranks(symbol[at], symbol[at + 1])
        return counts


class Counter:
    """Token counts of texts for one worker."""

    def __init__(self, tokenizer: str):
        self.merger = PairMerger(tokenizer)
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("|".join(map(regex.escape, self.merger.special)) or "(?!)")
        self.known: dict[str, int] = {}
        self.pieces = Pieces(self.learn, REMEMBERED)

    def learn(self, new: list[str]) -> list[int]:
        """The numbers of tokens of texts, each by itself."""
        # Texts are split one a line where a line end between them is a pre-token of its own:
        # none within, no white space before it, and no more than one behind it.
        plain = [
            bool(t) and "\n" not in t and len(t.lstrip()) >= len(t) - 1 and t.rstrip() == t for t in new
        ]
        lines = [t for t, one in zip(new, plain) if one]
        joined = "\n".join(lines)
        if self.special.search(joined):
            plain, lines, joined = [False] * len(new), [], ""
        found = self.split.findall(joined)
        mark = np.fromiter((t == "\n" for t in found), bool, len(found))
        owner = np.flatnonzero(plain)[np.cumsum(mark)] if lines else np.zeros(0, np.int64)
        totals, others, of = np.zeros(len(new), np.int64), [], []
        for n, (text, one) in enumerate(zip(new, plain)):
            if not one:
                totals[n] = len(self.special.findall(text))
                parts = [t for part in self.special.split(text) for t in self.split.findall(part)]
                others += parts
                of += [n] * len(parts)
        found, owner = found + others, np.r_[owner, np.array(of, np.int64)]
        numbers = self._of_pre_tokens(found)
        numbers[: len(mark)][mark] = 0
        np.add.at(totals, owner, numbers)
        return totals.tolist()

    def _of_pre_tokens(self, found: list[str]) -> np.ndarray:
        new = [t for t in dict.fromkeys(found) if t not in self.known]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(dict.fromkeys(found))
            counts = self.merger.count([t.encode() for t in new])
            self.known.update(zip(new, counts.tolist()))
        return np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))

    def counts(self, texts: list[str]) -> list[int]:
        return [first + sum(rest) for first, rest in self.pieces.look_up(texts)]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit``) of each row.

    ``tokenizer`` is the text of a byte-level vocabulary file, a few MB for any corpus.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        counter = Counter(shipped.value)

        def count(part):
            _, at = bytes_of(part.column("text"))
            tokens = counter.counts(part.column("text").to_pylist())
            over = [n > limit for n in tokens]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        yield from by_slices(count)(batches)

    return texts_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def vocabulary(name: str = TOKENIZER) -> str:
    """The text of a public vocabulary file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, by the merges of the byte-level vocabulary."""
    return count_tokens(read(spark, sf_dir, "documents"), vocabulary())
