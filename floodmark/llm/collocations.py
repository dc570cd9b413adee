"""Phrases whose words keep company more often than chance, for every language.

Prefix-free parsing: a text is cut at content triggers, windows of ``OVERLAP`` words
whose hash is a multiple of ``TRIGGER``, and every chunk reaches to the end of the
trigger window after it, so neighbours share ``OVERLAP`` words.  Equal passages
are cut alike wherever they stand, and the dictionary holds each distinct chunk of
a language once, with the number of its places in the parse.  Phrases are counted
inside distinct chunks, weighted by that number.  A phrase of at most ``OVERLAP`` + 1
words lies whole within the chunk that holds its first word outside the shared
end, and is counted there only.  Where no trigger follows for ``MOST_WORDS`` words
the text is cut all the same; that place depends on the chunk alone.

Counts are grouped by the phrase itself, never by a hash alone.  Words come first;
a pair is counted only if both words are frequent enough, a longer phrase only if
all its pairs are.  What is frequent travels as a bit set of hashes, of at most
``MOST_BITS`` bits: a chance hit costs a count that is dropped later, and nothing
that is frequent can be missed, however full the set becomes.

A candidate's score is that of its weakest cut into two parts.  All its parts are as
frequent as itself at least, so their counts are at hand.  Arithmetic is in decimals
of 38 digits.

Null and empty texts have no words, and a null language is ``und``.  Rows count as
often as they occur.  Ids and other columns are not read.  No rows give no phrases.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.common import (
    BATCH_BYTES,
    LOWER,
    U64,
    by_slices,
    bytes_of,
    mixed,
    read,
    words_of,
    written,
)

UNKNOWN_LANG = "und"
LONGEST = 5
LEAST_COUNT = 100
MOST_PHRASES = 2000
# A phrase falls to a longer one that has this many hundredths of its count.
WITHIN_PERCENT = 100

OVERLAP = LONGEST - 1
TRIGGER = 96
MOST_WORDS = 4096
BITS_PER_ITEM = 64
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26
# Parts of a language whose best phrases are found before the best of all.
TOP_PARTS = 32

_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
APART = np.zeros(256, bool)
APART[[0x20, 0x09, *_ENDS]] = True
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[list(_ENDS)] = True

CHUNKS = "lang string, chunk string, last boolean, owned long"
# A phrase with its language before it, parted by a line end, which no phrase holds: one
# short column is less to shuffle than two.
COUNTS = "key string, f long"
_STEP = U64(0x9E3779B97F4A7C15)
_SECOND = U64(0xD6E8FEB86659FD93)


def _windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many words, by its first word."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), U64)
    for k in range(size):
        out = mixed(out * _STEP + hashes[k : k + n] if n > 0 else out)
    return out


def _cuts(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of all chunks, and whether each is the last of its text.

    ``first`` holds each text's first word and, at its end, the number of words.
    """
    edge = np.unique(first[:-1][np.diff(first) > 0])
    text_end = np.r_[edge[1:], len(hashes)] if len(edge) else edge
    hit = np.flatnonzero(_windows(hashes, OVERLAP) % U64(TRIGGER) == 0)
    begin = np.union1d(edge, hit)
    gap = np.diff(np.r_[begin, len(hashes)])
    more = np.maximum(gap - 1, 0) // MOST_WORDS
    if more.any():
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        begin = np.union1d(begin, np.repeat(begin, more) + step * MOST_WORDS)
    end_of = text_end[np.searchsorted(edge, begin, "right") - 1]
    # A cut needs its whole window within the text.
    begin = begin[np.isin(begin, edge) | (begin + OVERLAP <= end_of)]
    last = np.r_[np.isin(begin[1:], edge), True] if len(begin) else np.zeros(0, bool)
    return begin, last


def _joined(data, starts, ends, piece_ends) -> tuple[np.ndarray, np.ndarray]:
    """All words, each with one byte behind it: a line end where its piece ends, else a space.

    Returns the bytes and where each word begins (and the last ends).
    """
    lengths = ends - starts
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    shift = np.repeat(starts - at[:-1], lengths + 1)
    out = LOWER[data[np.minimum(np.arange(at[-1]) + shift, len(data) - 1)]]
    out[at[1:] - 1] = np.where(piece_ends, ord("\n"), ord(" "))
    return out, at


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Stretches of bytes as texts; they may overlap."""
    lengths = end - begin
    at = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    taken = data[np.arange(at[-1]) + np.repeat(begin - at[:-1], lengths)]
    return pa.LargeStringArray.from_buffers(
        len(begin), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(taken))
    ).cast(pa.string())


def parse_slice(part: pa.RecordBatch) -> pa.RecordBatch | None:
    """The chunks of some texts; words are parted by one space, pieces by one line end."""
    data, at = bytes_of(part.column("text"))
    hashes, starts, ends, first = words_of(data, at, APART)
    if not len(hashes):
        return None
    mark = np.flatnonzero(ENDS_PIECE[data])
    piece_ends = np.searchsorted(mark, np.r_[starts[1:], len(data)]) > np.searchsorted(mark, ends)
    piece_ends[first[1:][np.diff(first) > 0] - 1] = True
    text, word_at = _joined(data, starts, ends, piece_ends)
    begin, last = _cuts(hashes, first)
    next_begin = np.r_[begin[1:], len(hashes)]
    end = np.where(last, next_begin, next_begin + OVERLAP)
    row = np.searchsorted(first, begin, "right") - 1
    return pa.RecordBatch.from_arrays(
        [
            part.column("lang").take(pa.array(row)),
            # Without the byte behind its last word: only the next word tells whether a piece ends.
            _strings(text, word_at[begin], word_at[end] - 1),
            pa.array(last),
            pa.array(next_begin - begin),
        ],
        ["lang", "chunk", "last", "owned"],
    )


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The dictionary: lang, chunk, last (no text follows it), owned (words that count in it), weight."""
    docs.sparkSession.conf.set(*BATCH_BYTES)
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    chunks = texts.mapInArrow(by_slices(parse_slice), CHUNKS)
    return chunks.groupBy("lang", "chunk", "last", "owned").agg(F.count(F.lit(1)).alias("weight"))


@dataclass(frozen=True)
class BitSet:
    """Hashes of phrases, of a fixed number of bits."""

    words: np.ndarray  # 64 bits each

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes % U64(64 * len(self.words))
        return (self.words[bit >> U64(6)] >> (bit & U64(63))) & U64(1) == 1


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    codes = langs.dictionary_encode()
    names = codes.dictionary.to_pylist()
    each = np.zeros(len(names), U64)
    for n, name in enumerate(names):
        data = np.frombuffer(name.encode() + b"\x00", np.uint8)
        value = U64(len(data))
        for byte in data:
            value = mixed(np.array([value * _STEP + U64(byte)], U64))[0]
        each[n] = value
    return each[codes.indices.to_numpy(zero_copy_only=False)]


def _hashed(part: pa.RecordBatch, text: str):
    """Words of each row's text, all in a row: bytes, hashes with their language, starts, ends, first."""
    data, at = bytes_of(part.column(text))
    hashes, starts, ends, first = words_of(data, at, APART, fold=False)
    with np.errstate(over="ignore"):
        lang = np.repeat(_lang_hashes(part.column("lang")), np.diff(first))
        return data, mixed(hashes + lang), starts, ends, first


def _grouped(part, data, row, weight, key, second, begin, end) -> pa.RecordBatch | None:
    """Phrases of a slice with summed weights; equal ones may come in several rows."""
    if not len(key):
        return None
    order = np.argsort(key, kind="stable")
    key, second = key[order], second[order]
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (second[1:] != second[:-1])])
    chosen = order[new]
    lang = part.column("lang").take(pa.array(row[chosen]))
    phrase = _strings(data, begin[chosen], end[chosen])
    return pa.RecordBatch.from_arrays(
        [pc.binary_join_element_wise(lang, phrase, "\n"), pa.array(np.add.reduceat(weight[order], new))],
        ["key", "f"],
    )


def _count_slice(part, smallest: int, largest: int, frequent: BitSet | None):
    """Weighted counts of the phrases of a slice of the dictionary that may be frequent."""
    with np.errstate(over="ignore"):
        data, hashes, starts, ends, first = _hashed(part, "chunk")
        if not len(hashes):
            return None
        n = len(hashes)
        row = np.repeat(np.arange(part.num_rows), np.diff(first))
        weight = part.column("weight").to_numpy()[row]
        place = np.arange(n) - first[row]
        counted = place < part.column("owned").to_numpy()[row]
        # Whether a word and the next stand in one piece.
        linked = np.zeros(n, bool)
        linked[:-1] = (data[ends[:-1]] != ord("\n")) & (row[1:] == row[:-1])
        pair = np.zeros(n, U64)
        pair[:-1] = _windows(hashes, 2)
        if frequent is None:
            possible = np.ones(n, bool)
        elif smallest == 2:
            known = frequent.has(hashes)
            possible = known & np.r_[known[1:], False]
        else:
            possible = frequent.has(pair)
        runs = np.ones(n, bool)
        key, second = hashes.copy(), mixed(hashes * _SECOND)
        found = []
        for size in range(1, min(largest, n) + 1):
            if size > 1:
                # A phrase goes on while its last pair stands in one piece and may be frequent.
                more = linked & possible
                runs[: n - size + 2] &= more[size - 2 :]
                runs[n - size + 1 :] = False
                key[: n - size + 1] = mixed(key[: n - size + 1] * _STEP + hashes[size - 1 :])
                second[: n - size + 1] = mixed(second[: n - size + 1] * _SECOND + hashes[size - 1 :])
            if size >= smallest:
                at = np.flatnonzero(runs & counted)
                found.append((at, key[at], second[at], ends[at + size - 1]))
        if not found:
            return None
        at, key, second, end = (np.concatenate(x) for x in zip(*found))
        return _grouped(part, data, row[at], weight[at], key, second, starts[at], end)


def counts(
    dictionary: DataFrame, smallest: int, largest: int, frequent: Broadcast | None = None
) -> DataFrame:
    """key (language and phrase) and f, the number of places, of phrases that may be frequent."""

    def run(part):
        return _count_slice(part, smallest, largest, frequent.value if frequent else None)

    found = dictionary.mapInArrow(by_slices(run, "chunk"), COUNTS)
    return found.groupBy("key").agg(F.sum("f").alias("f"))


def bit_set(phrases: DataFrame, size: int) -> BitSet:
    """The hashes of a table of phrases of so many words.

    Only the set's own 64-bit words, MOST_BITS / 64 at most, come to the driver.
    """
    spark = phrases.sparkSession
    wanted = max(LEAST_BITS, min(MOST_BITS, BITS_PER_ITEM * phrases.count()))
    bits = 1 << (wanted - 1).bit_length()

    def run(part):
        with np.errstate(over="ignore"):
            _, hashes, _, _, first = _hashed(part, "phrase")
            value = hashes if size == 1 else _windows(hashes, size)[first[:-1]]
        bit = value % U64(bits)
        return pa.RecordBatch.from_arrays(
            [pa.array((bit >> U64(6)).astype(np.int64)), pa.array((bit & U64(63)).astype(np.int32))],
            ["place", "bit"],
        )

    found = phrases.mapInArrow(by_slices(run, "phrase"), "place long, bit int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    filled = found.groupBy("place").agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(bits // 64, U64)
    words[filled["place"].to_numpy()] = filled["bits"].to_numpy().view(U64)
    return BitSet(words)


def _frequent(found: DataFrame, least: int, name: str) -> DataFrame:
    """lang, phrase, n_words and f of the frequent ones."""
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("left(key, char_length(key) - char_length(substring_index(key, '\n', -1)) - 1)")
    kept = found.filter(F.col("f") >= least).select(
        lang.alias("lang"), phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("n_words"), "f"
    )
    return written(kept, name)


def phrase_counts(dictionary: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST) -> DataFrame:
    """All phrases of 1 to ``longest`` words with at least so many places."""
    context = dictionary.sparkSession.sparkContext
    words = _frequent(counts(dictionary, 1, 1), least, "words")
    pairs = counts(dictionary, 2, 2, context.broadcast(bit_set(words, 1)))
    pairs = _frequent(pairs, least, "pairs")
    if longest < 3:
        return words.union(pairs)
    longer = counts(dictionary, 3, longest, context.broadcast(bit_set(pairs, 2)))
    return words.union(pairs).union(_frequent(longer, least, "phrases"))


def _part(begin: Column, length: Column) -> Column:
    """Words of a phrase as a phrase."""
    return F.array_join(F.slice("words", begin, length), " ")


def scored(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates with a, their weakest cut's l and r, n and score.

    ``found`` holds all frequent phrases, ``sizes`` the words n of each language.
    """
    words = F.split("phrase", " ")
    cut = (
        found.filter("n_words > 1")
        .withColumn("words", words)
        .select(
            "lang", "phrase", F.col("f").alias("a"),
            F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"), "words", "n_words",
        )
        .select(
            "lang", "phrase", "a", "k",
            _part(F.lit(1), F.col("k")).alias("left"),
            _part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"),
        )
    )
    of_left = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    of_right = found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = "cast({} as decimal(19, 0))"
    above = f"1000 * cast({whole.format('a')} * {whole.format('n')} as decimal(38, 0))"
    below = f"{whole.format('l')} * {whole.format('r')}"
    score = F.expr(f"({above}) div ({below})").alias("score")
    weakest = (
        cut.join(of_left, ["lang", "left"])
        .join(of_right, ["lang", "right"])
        .join(sizes, "lang")
        .select("lang", "phrase", "a", "n", "l", "r", "k", score)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    )
    return weakest.select("lang", "phrase", *[f"best.{c}" for c in ("a", "l", "r", "n", "score")])


def contained(found: DataFrame, percent: int = WITHIN_PERCENT) -> DataFrame:
    """lang and phrase of candidates that stand inside a longer one nearly as frequent."""
    inner = (
        found.filter("n_words > 2")
        .withColumn("words", F.split("phrase", " "))
        .select("lang", "words", "n_words", "f",
                F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size"))
        .select("lang", "words", "size", "f",
                F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("at"))
        .select("lang", _part(F.col("at"), F.col("size")).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("f_longer"))
    )
    wide = "cast({} as decimal(20, 0))"
    enough = F.expr(f"100 * {wide.format('f_longer')} >= {percent} * {wide.format('f')}")
    return found.join(inner, ["lang", "phrase"]).filter(enough).select("lang", "phrase")


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    most: int = MOST_PHRASES,
    percent: int = WITHIN_PERCENT,
) -> DataFrame:
    """Each language's best phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    ``longest`` may be 2 to 5, as chunks overlap for phrases of five words.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases of 2 to {LONGEST} words")
    dictionary = written(parse(docs, text_col, lang_col), "chunks")
    weighted = F.sum(F.col("owned").cast("decimal(19,0)") * F.col("weight"))
    sizes = dictionary.groupBy("lang").agg(weighted.cast("long").alias("n"))
    found = phrase_counts(dictionary, least, longest)
    stays = scored(found, sizes).join(contained(found, percent), ["lang", "phrase"], "left_anti")
    return best(stays, most)


def best(candidates: DataFrame, most: int) -> DataFrame:
    """The first candidates of each language; those of parts of a language first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)).alias("part")
    rank = F.row_number()
    in_part = rank.over(Window.partitionBy("lang", "part").orderBy(*order))
    in_lang = rank.over(Window.partitionBy("lang").orderBy(*order))
    return (
        candidates.select("*", part)
        .withColumn("rank", in_part)
        .filter(F.col("rank") <= most)
        .withColumn("rank", in_lang.cast("long"))
        .filter(F.col("rank") <= most)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of all documents."""
    return mine(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, doc_row, piece, unnest(list) as text
    from (
        select lang, row_number() over () as doc_row, string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]') as list, 0 as piece
        from documents
    )
), parted as (
    select lang, list_filter(string_split_regex(text, '[\x20\x09]+'), lambda x: x <> '') as words from pieces
), placed as (
    select lang, words, unnest(range(1, len(words) + 1)) as pos from parted where len(words) > 0
), sized as (
    select lang, array_to_string(words[pos : pos + size - 1], ' ') as phrase, size
    from placed, (values (1), (2), (3), (4), (5)) as sizes(size) where pos + size - 1 <= len(words)
), totals as (
    select lang, count(*) as n from placed group by lang
), found as (
    select lang, phrase, size, count(*) as f from sized group by all having count(*) >= 100
), cut as (
    select lang, phrase, f as a, size, string_split(phrase, ' ') as words, unnest(range(1, size)) as k
    from found where size > 1
), scored as (
    select c.lang, c.phrase, a, k, l.f as l, r.f as r, n,
        ((1000::hugeint * a * n) // (l.f::hugeint * r.f))::bigint as score
    from cut c
    join found l on l.lang = c.lang and l.phrase = array_to_string(words[1 : k], ' ')
    join found r on r.lang = c.lang and r.phrase = array_to_string(words[k + 1 : c.size], ' ')
    join totals t on t.lang = c.lang
), weakest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_size as (
    select lang, string_split(phrase, ' ') as words, size, f, unnest(range(2, size)) as part from found where size > 2
), inner_at as (
    select lang, words, part, f, unnest(range(1, size - part + 2)) as pos from inner_size
), inside as (
    select lang, array_to_string(words[pos : pos + part - 1], ' ') as phrase, max(f) as f from inner_at group by 1, 2
), kept as (
    select w.* from weakest w left join inside i on i.lang = w.lang and i.phrase = w.phrase
    where i.f is null or 100 * i.f < 100 * w.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
    phrase, a, l, r, n, score
from kept qualify rank <= 2000
"""
