"""Exact removal of repeated lines and passages across a corpus.

Units are lines, and clauses: runs of words up to one that ends in ``. ! ? , ; :``,
read across line ends, so that they do not depend on wrapping.  Normalised, a unit is
its words (parted by ASCII white space) with A-Z lower-cased; two independent 64-bit
hashes of the word sequence, in their order, and of the kind of unit are its digest.
Of all units with one digest the earliest stays, by id (null ids last), text and place.

A repeated line goes, together with the line end before it (behind it for a first
line).  Clauses are short and recur by chance, so they go in company only: neighbouring
clauses that all stand in earlier texts and have ``STRETCH_WORDS`` words between them,
together with the white space behind them (before them at the end of a text).  What
stays is unchanged, and its places in the original text are returned.

Digests are counted over the whole corpus first, with one number per digest, text and
task in the shuffle.  Those that occur in one text only are left out by a bit set of
bounded size; a chance hit there costs a row and changes nothing.  Owners are then
found among the others, and the rows to remove meet their texts in a join that splits
hot keys.

Lines without words are never removed on their own.  Empty and null texts come back
empty.  Rows that are equal in id and text are one document: each keeps what the other
keeps.  Every row is returned, also one of which nothing is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.collocations import BitSet
from floodmark.llm.common import BATCH_BYTES, U64, by_slices, bytes_of, mixed, read, words_of, written

STRETCH_WORDS = 20
BITS_PER_ITEM = 64
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26

# A unit is a line by its number, or a clause by -2 less its number.
FIRST_CLAUSE = -2
# Stands for a line that recurs within its own text.
OWN = -1

_UNITS = "doc_id long, text_hash long, unit int, digest_a long, digest_b long"
_SPAN = "array<struct<begin: int, end: int>>"
_CLAUSE_ENDS = np.zeros(256, bool)
_CLAUSE_ENDS[list(b".!?,;:")] = True
_SALTS = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0x165667B19E3779F9, 0x27D4EB2F165667C5))


class Words:
    """Words of some texts with the lines and clauses they stand in, numbered within each text."""

    def __init__(self, texts: pa.Array):
        data, at = bytes_of(texts)
        self.data, self.at = data, at
        self.hashes, self.starts, self.ends, self.first = words_of(data, at)
        if not len(self.hashes):
            self.row = self.line = self.clause = np.zeros(0, np.int64)
            return
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.first))
        line_ends = np.flatnonzero(data == ord("\n"))
        before = np.searchsorted(line_ends, self.starts)
        self.line = before - np.searchsorted(line_ends, at[:-1])[self.row]
        closed = np.cumsum(_CLAUSE_ENDS[data[self.ends - 1]])
        opened = np.r_[0, closed[:-1]]
        self.clause = opened - opened[self.first[:-1][self.row]]

    def units(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, number, two digests and words of every line (kind 0) or clause (kind 1) with words."""
        number = (self.line, self.clause)[kind]
        if not len(number):
            none = np.zeros(0, np.int64)
            return none, none, none, none, none
        row = self.row
        begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (number[1:] != number[:-1])])
        size = np.diff(np.r_[begin, len(row)])
        place = (np.arange(len(row)) - np.repeat(begin, size)).astype(U64)
        digests = []
        for salt in _SALTS[kind]:
            # The place of a word is part of its hash, so the sum depends on their order.
            value = mixed(self.hashes ^ mixed(place + U64(salt)))
            digests.append(np.add.reduceat(value, begin).view(np.int64))
        return row[begin], number[begin], *digests, size


def _distinct_units(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row, unit and digests of the distinct units of each text, by their first place there.

    A text with a line twice has the unit OWN besides.
    """
    words = Words(part.column("text"))
    columns = []
    for kind in (0, 1):
        row, number, a, b, _ = words.units(kind)
        order = np.lexsort((number, b, a, row))
        row, number, a, b = (x[order] for x in (row, number, a, b))
        new = np.r_[True, (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(row)]
        if kind == 0:
            twice = np.unique(row[~new])
            zero = np.zeros(len(twice), np.int64)
            columns.append((twice, np.full(len(twice), OWN), zero, zero))
        unit = number[new] if kind == 0 else FIRST_CLAUSE - number[new]
        columns.append((row[new], unit, a[new], b[new]))
    return tuple(np.concatenate(x) for x in zip(*columns))


def repeated_digests(texts: DataFrame) -> BitSet:
    """The digests that more than one row of the texts holds."""

    def find(part):
        _, unit, a, _ = _distinct_units(part)
        return pa.RecordBatch.from_arrays([pa.array(a[unit != OWN])], ["digest"])

    counted = texts.select("text").mapInArrow(by_slices(find), "digest long").groupBy("digest").count()
    repeated = written(counted.filter("count > 1").select("digest"), "repeated")
    wanted = max(LEAST_BITS, min(MOST_BITS, BITS_PER_ITEM * repeated.count()))
    bits = 1 << (wanted - 1).bit_length()
    bit = F.pmod("digest", F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    filled = repeated.groupBy(F.expr(f"pmod(digest, {bits}) div 64").alias("place")).agg(F.bit_or(one).alias("bits"))
    # At most MOST_BITS / 64 numbers come to the driver.
    found = filled.toArrow()
    words = np.zeros(bits // 64, U64)
    words[found["place"].to_numpy()] = found["bits"].to_numpy().view(U64)
    return BitSet(words)


def units(texts: DataFrame) -> DataFrame:
    """The distinct units of each row that other rows may hold too, with their first place there."""
    shipped = texts.sparkSession.sparkContext.broadcast(repeated_digests(texts))

    def find(part):
        row, unit, a, b = _distinct_units(part)
        stays = (unit == OWN) | shipped.value.has(a.view(U64))
        at = pa.array(row[stays])
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(at), part.column("text_hash").take(at),
             pa.array(unit[stays].astype(np.int32)), pa.array(a[stays]), pa.array(b[stays])],
            ["doc_id", "text_hash", "unit", "digest_a", "digest_b"],
        )

    return texts.mapInArrow(by_slices(find), _UNITS)


def _rank() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")


def foreign_units(found: DataFrame) -> DataFrame:
    """doc_id, text_hash and the first places of units that an earlier text holds, OWN included."""
    own = found.filter(F.col("unit") == OWN).select("doc_id", "text_hash", "unit")
    found = found.filter(F.col("unit") != OWN)
    owner = found.groupBy("digest_a", "digest_b").agg(F.min(_rank()).alias("owner"), F.max(_rank()).alias("other"))
    shared = owner.filter("owner <> other").select("digest_a", "digest_b", "owner")
    foreign = found.join(shared, ["digest_a", "digest_b"]).filter(_rank() != F.col("owner"))
    foreign = foreign.select("doc_id", "text_hash", "unit").union(own)
    return foreign.groupBy("doc_id", "text_hash").agg(F.collect_list("unit").alias("foreign"))


def _lines_gone(words: Words, gone: set[int]) -> set[int]:
    """Lines of a text that stand in an earlier one, or earlier in it."""
    _, number, a, b, _ = (x.tolist() for x in words.units(0))
    first_of, drop = {}, set()
    for line, digest in zip(number, zip(a, b)):
        if first_of.setdefault(digest, line) != line or line in gone:
            drop.add(line)
        elif first_of[digest] in gone:
            drop.add(line)
    return drop


def _stretches(words: Words, gone: set[int]) -> list[tuple[int, int]]:
    """First and last word of neighbouring clauses that earlier texts hold, long enough to go."""
    _, number, a, b, size = (x.tolist() for x in words.units(1))
    first_of, found = {}, []
    at = begin = 0
    for clause, digest, n in zip(number, zip(a, b), size):
        first = first_of.setdefault(digest, clause)
        if FIRST_CLAUSE - first not in gone:
            if at - begin >= STRETCH_WORDS:
                found.append((begin, at - 1))
            begin = at + n
        at += n
    if at - begin >= STRETCH_WORDS:
        found.append((begin, at - 1))
    return found


def _removed(text: str, foreign: list[int]) -> tuple[str, list[dict], list[dict]]:
    """What stays of the text, and the stretches kept and removed, in characters."""
    words = Words(pa.array([text]))
    gone = set(foreign)
    data = text.encode()
    off = np.zeros(len(data) + 1, bool)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10).tolist()
    drop = _lines_gone(words, gone)
    if drop:
        bounds = [-1, *ends, len(data)]
        kept_before = False
        for line in range(len(bounds) - 1):
            begin, end = bounds[line] + 1, bounds[line + 1]
            if line not in drop:
                kept_before = True
            elif kept_before:
                off[begin - 1 : end] = True
            else:
                off[begin : end + 1] = True
    for first, last in _stretches(words, gone):
        if last + 1 < len(words.starts):
            off[words.starts[first] : words.starts[last + 1]] = True
        else:
            before = words.ends[first - 1] if first else 0
            off[before : words.ends[last]] = True
    off = off[:-1]
    # Bytes within a character share its fate; only its first one is counted.
    is_first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    flags = off[is_first]
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    removed = [{"begin": int(b), "end": int(e)} for b, e in zip(edges[::2], edges[1::2])]
    marks = [0, *(x for span in removed for x in (span["begin"], span["end"])), len(flags)]
    kept = [{"begin": b, "end": e} for b, e in zip(marks[::2], marks[1::2]) if e > b]
    return "".join(text[span["begin"] : span["end"]] for span in kept), kept, removed


def remove_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, text (what stays), kept and removed (stretches of the original text) of each row.

    The columns ``carry`` come back too, in a struct ``carried``.
    """
    docs.sparkSession.conf.set(*BATCH_BYTES)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(True).alias("none")]).alias("carried"),
    ).withColumn("text_hash", F.xxhash64("text"))
    found = written(units(texts.drop("carried")), "units")
    foreign = foreign_units(found)
    on = texts["doc_id"].eqNullSafe(foreign["doc_id"]) & (texts["text_hash"] == foreign["text_hash"])
    marked = texts.join(foreign, on, "left").select(texts["doc_id"], "text", "foreign", "carried")
    carried = texts.schema["carried"].dataType.simpleString()

    def cut(part):
        rows = [
            # A text without foreign units stays as it is, unread.
            _removed(text, foreign) if foreign else (text, [{"begin": 0, "end": len(text)}] if text else [], [])
            for text, foreign in zip(part.column("text").to_pylist(), part.column("foreign").to_pylist())
        ]
        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        text, kept, removed = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(text, pa.string()), pa.array(kept, span), pa.array(removed, span),
             part.column("carried")],
            ["doc_id", "text", "kept", "removed", "carried"],
        )

    out = marked.mapInArrow(
        by_slices(cut), f"doc_id long, text string, kept {_SPAN}, removed {_SPAN}, carried {carried}"
    )
    return out if carry else out.drop("carried")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines and passages that an earlier one or an earlier place holds."""
    cut = remove_repeated_lines(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", *[_listed(c) for c in ("kept", "removed")])


def _listed(spans: str) -> Column:
    """Stretches as text: begin-end,begin-end."""
    each = F.transform(spans, lambda s: F.concat_ws("-", s["begin"], s["end"]))
    return F.array_join(each, ",").alias(spans)


# Texts as tokens, words and single characters of white space, each of which goes or stays
# as a whole; offsets are counted in characters.
OP10_SQL = r"""
with tokens as (
    select doc_id, n, token, regexp_matches(token, '^[\x20\x09-\x0D]$') as is_space,
        sum(length(token)) over (partition by doc_id order by n) - length(token) as begin_at
    from (
        select doc_id, unnest(list) as token, generate_subscripts(list, 1) as n
        from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+|[\x20\x09-\x0D]') as list
            from documents)
    )
), placed as (
    select *, count(*) filter (token = chr(10)) over earlier as line,
        count(*) filter (not is_space and regexp_matches(token, '[.!?,;:]$')) over earlier as clause,
        count(*) filter (not is_space) over earlier as word
    from tokens
    window earlier as (partition by doc_id order by n rows between unbounded preceding and 1 preceding)
), spoken as (
    select *, translate(token, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as said
    from placed where not is_space
), lines as (
    select doc_id, line, string_agg(said, ' ' order by n) as unit from spoken group by 1, 2
), lines_gone as (
    select doc_id, line from lines qualify row_number() over (partition by unit order by doc_id, line) > 1
), clauses as (
    select doc_id, clause, string_agg(said, ' ' order by n) as unit, count(*) as size, min(word) as first_word
    from spoken group by 1, 2
), judged as (
    select *, min(doc_id) over (partition by unit) < doc_id as is_foreign,
        row_number() over (partition by doc_id order by clause) as nth
    from clauses
), islands as (
    select *, nth - row_number() over (partition by doc_id order by clause) as island from judged where is_foreign
), stretches as (
    select doc_id, min(first_word) as first_word, sum(size) + min(first_word) - 1 as last_word
    from islands group by doc_id, island having sum(size) >= 20
), sizes as (
    select doc_id, count(*) filter (not is_space) as n_words from tokens group by doc_id
), first_kept as (
    select doc_id, min(line) as line from (select distinct doc_id, line from placed
        union select doc_id, line + 1 from placed where token = chr(10))
    where (doc_id, line) not in (select doc_id, line from lines_gone) group by doc_id
), flagged as (
    select p.*,
        case when token = chr(10) then
                (p.doc_id, p.line + 1) in (select doc_id, line from lines_gone) and k.line is not null and k.line <= p.line
                or (p.doc_id, p.line) in (select doc_id, line from lines_gone) and (k.line is null or k.line > p.line)
            else (p.doc_id, p.line) in (select doc_id, line from lines_gone) end
        or exists (select 1 from stretches s where s.doc_id = p.doc_id and case
            when not is_space then p.word between s.first_word and s.last_word
            when p.word >= z.n_words then false
            when p.word - 1 between s.first_word and s.last_word then true
            else s.last_word = z.n_words - 1 and p.word = s.first_word end) as gone
    from placed p join sizes z on z.doc_id = p.doc_id left join first_kept k on k.doc_id = p.doc_id
), runs as (
    select *, n - row_number() over (partition by doc_id, gone order by n) as run from flagged
), spans as (
    select doc_id, gone, min(begin_at) as begin_at, max(begin_at + length(token)) as end_at
    from runs group by doc_id, gone, run
), listed as (
    select doc_id,
        string_agg(begin_at::int || '-' || end_at::int, ',' order by begin_at) filter (not gone) as kept,
        string_agg(begin_at::int || '-' || end_at::int, ',' order by begin_at) filter (gone) as removed
    from spans group by doc_id
), texts as (
    select doc_id, string_agg(token, '' order by n) filter (not gone) as text from flagged group by doc_id
)
select d.doc_id, coalesce(t.text, '') as text, coalesce(kept, '') as kept, coalesce(removed, '') as removed
from documents d left join texts t on t.doc_id = d.doc_id left join listed l on l.doc_id = d.doc_id
"""
