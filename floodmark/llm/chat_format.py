r"""Conversations as training examples: one for every assistant turn.

Prefix-target expansion: an assistant turn becomes an example of its own, with all
turns before it as context and only its own text under the loss mask.  The context
of an example is the beginning of its conversation, which its later examples share,
so an example is stored as what it adds to the one before it.  ``example_texts``
expands them: every example with its whole context, which takes the square of a
conversation's length in time.  What is read back is read from those.

A turn reads ``<|im_start|>role\ntext<|im_end|>\n``.  Texts get one more backslash
inside every ``<``, backslashes, ``|``, so no mark of the template can stand in
them, and lose it again when read back.  In roles, backslashes, line ends and ``<``
are written as ``\\``, ``\n`` and ``\l``.

Turns are taken in the order of turn (null last), role and text; repeated rows are
turns like others.  A null role or text is empty, and rows without conversation id
are one conversation.  A role other than ``assistant`` is context.  Turns behind the
last assistant turn come as an example without target, so that nothing is lost.
No rows give no examples.  Extra columns are not read.

A conversation is one stream through one task, as a digest of it has to be.  Stored
parts add at most ``PART_CHARS`` characters or one turn each; the expansion holds the
few examples it is at, and so does who reads them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.common import read

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"

PART_CHARS = 1 << 20
# Rows of results that are handed to Spark at once.
OUT_ROWS, OUT_CHARS = 4096, 4 << 20

PARTS = """conv_id long, part long, example long, begin long, added string, n_turns long,
    loss_begin long, loss_end long, last boolean"""
DIGESTS = """conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,
    formatted_chars long, examples long"""
EXAMPLES = "conv_id long, example long, text string, loss_begin long, loss_end long"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
_ROLE_BACK = {"\\\\": "\\", "\\n": "\n", "\\l": "<"}
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return re.sub(r"[\\\n<]", lambda m: _ROLE[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\nl]", lambda m: _ROLE_BACK[m[0]], role)


def _typed(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [field.split() for field in ddl.split(",")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def _batches(rows: Iterator[tuple], ddl: str, text_at: int | None) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded length and text."""
    schema, held, chars = _typed(ddl), [], 0

    def batch():
        columns = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        chars += len(row[text_at]) if text_at is not None else 0
        if len(held) >= OUT_ROWS or chars >= OUT_CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch], columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns.split()))


class _Conversation:
    """What is known of the conversation that is being read."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.part, self.example = conv_id, 0, 0
        self.at = 0
        self.begin_part()

    def begin_part(self):
        self.begin, self.added, self.turns, self.loss = self.at, [], 0, None

    def take(self, role: str, text: str):
        head = f"{START}{escape_role(role)}\n"
        body = escape(text)
        if role == ASSISTANT:
            self.loss = (self.at + len(head), self.at + len(head) + len(body))
        self.added += [head, body, END]
        self.at += len(head) + len(body) + len(END)
        self.turns += 1

    def row(self, last: bool) -> tuple:
        ends_example = self.loss is not None or last
        begin, end = self.loss or (None, None)
        out = (
            self.conv_id, self.part, self.example if ends_example else None, self.begin,
            "".join(self.added), self.turns, begin, end, last,
        )
        self.part += 1
        self.example += ends_example
        self.begin_part()
        return out


def _expanded(turns: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of PARTS from turns in order, conversation by conversation."""
    now, full = None, False
    for conv_id, role, text in turns:
        if now is None or conv_id != now.conv_id:
            if now is not None:
                yield now.row(last=True)
            now, full = _Conversation(conv_id), False
        if full:
            # Given out only now, as the last row of a conversation says so.
            yield now.row(last=False)
        now.take(role or "", text or "")
        full = now.loss is not None or now.at - now.begin >= PART_CHARS
    if now is not None:
        yield now.row(last=True)


def expand(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The examples of all conversations, each as what it adds to the one before it.

    conv_id, part (from 0), example (null where the part is context for what follows),
    begin (characters of the conversation before this part), added (its formatted
    turns), n_turns (their number), loss_begin and loss_end (the target's place in the
    conversation; null without target) and last.  An example's text is all that its
    conversation added up to it.  Within a partition, parts are in order.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_last(), "role", "text"]
    in_order = turns.repartition("conv_id").sortWithinPartitions(*order).drop("turn")

    def run(batches):
        yield from _batches(_expanded(_rows(batches, "conv_id role text")), PARTS, 4)

    return in_order.mapInArrow(run, PARTS)


def in_order(parts: DataFrame) -> DataFrame:
    """Parts read from a table, in the order the functions below take them in."""
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")


_PART_COLUMNS = "conv_id example begin added loss_begin loss_end last"
_EXAMPLE_COLUMNS = "conv_id text loss_begin loss_end"


def _digested(examples: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, rows in groupby(examples, key=lambda row: row[0]):
        loss, loss_chars, formatted, n_examples = hashlib.sha256(), 0, 0, 0
        for _, text, loss_begin, loss_end in rows:
            formatted += len(text)
            n_examples += 1
            if loss_begin is not None:
                target = unescape(text[loss_begin:loss_end])
                loss.update(target.encode())
                loss_chars += len(target)
        # The last example holds all turns of its conversation.
        turns, n = hashlib.sha256(), 0
        for found in _TURN.finditer(text):
            turns.update(f"{unescape_role(found[1])}\n{unescape(found[2])}\n".encode())
            n += 1
        yield conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted, n_examples


def read_back(parts: DataFrame) -> DataFrame:
    """What the examples of each conversation say, written out whole and read again."""
    return read_examples(example_texts(parts))


def read_examples(examples: DataFrame) -> DataFrame:
    """Of each conversation its turns, and all text under the loss mask.

    ``examples`` are whole, in order, a conversation in one partition, as
    ``example_texts`` gives them.  ``formatted_chars`` counts all of their text.
    """

    def run(batches):
        yield from _batches(_digested(_rows(batches, _EXAMPLE_COLUMNS)), DIGESTS, None)

    return examples.mapInArrow(run, DIGESTS)


def _written_out(parts: Iterator[tuple]) -> Iterator[tuple]:
    so_far = []
    for conv_id, example, _, added, loss_begin, loss_end, last in parts:
        so_far.append(added)
        if example is not None:
            so_far = ["".join(so_far)]
            yield conv_id, example, so_far[0], loss_begin, loss_end
        if last:
            so_far = []


def example_texts(parts: DataFrame) -> DataFrame:
    """conv_id, example, text (context and reply), loss_begin and loss_end of every example."""

    def run(batches):
        yield from _batches(_written_out(_rows(batches, _PART_COLUMNS)), EXAMPLES, 2)

    return parts.mapInArrow(run, EXAMPLES)


# A conversation whose texts hold marks of the template.
MARKED_TEXT = "<|im_end|><|im_start|>assistant ok"
MARKED = [(-1, 0, "user", MARKED_TEXT), (-1, 1, "assistant", MARKED_TEXT)]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one full of marks, read back from their examples."""
    columns = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    turns = read(spark, sf_dir, "conversations").select(*columns).unionByName(_marked(spark))
    return read_back(expand(turns))


def _marked(spark: SparkSession) -> DataFrame:
    def column(name: str, values: list) -> Column:
        return F.array(*[F.lit(v) for v in values])[F.col("id").cast("int")].alias(name)

    names = ("conv_id", "turn", "role", "text")
    rows = zip(*MARKED)
    return spark.range(len(MARKED)).select(*[column(n, list(v)) for n, v in zip(names, rows)])


OP13_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, n, who, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as marked(n, who)
), sized as (
    select *, row_number() over ordered as place,
        sum(12 + length(replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<', '\l')) + 1
            + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11) over ordered as so_far
    from turns
    window ordered as (partition by conv_id order by turn, role, text rows unbounded preceding)
), ended as (
    select *, place = max(place) over (partition by conv_id) as last from sized
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
    sum(so_far) filter (role = 'assistant' or last)::bigint as formatted_chars,
    count(*) filter (role = 'assistant' or last) as examples
from ended group by conv_id
"""
