"""Whitening, collocations and chat examples against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from floodmark.llm import chat_format, collocations, whitening

TINY = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TINY), reason="no sample tables")


def table(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]


# Whitening


def check_eigen(rows, least_rank):
    rows = rows - rows.mean(axis=0)
    values, vectors = whitening.eigen_of_factor(whitening.qr_factor(rows))
    wanted = np.linalg.svd(rows, compute_uv=False) ** 2
    assert len(values) == least_rank
    assert np.allclose(values, wanted[:least_rank], rtol=1e-11, atol=0)
    assert np.abs(vectors.T @ vectors - np.eye(least_rank)).max(initial=0) < 1e-10
    white = rows @ (vectors / np.sqrt(values))
    assert np.abs(white.T @ white - np.eye(least_rank)).max(initial=0) < 1e-10


RANDOM = np.random.default_rng(11)
TURN = np.linalg.qr(RANDOM.standard_normal((30, 30)))[0]
TIGHT = np.r_[1 + 1e-12 * np.arange(10), np.full(10, 5.0), np.ones(10)]


@pytest.mark.parametrize(
    "rows, rank",
    [
        (RANDOM.standard_normal((500, 24)), 24),
        (RANDOM.standard_normal((300, 40)) * 10.0 ** -np.arange(0, 8, 0.2), 40),
        (np.c_[RANDOM.standard_normal((50, 3)), np.ones((50, 2))], 3),
        (RANDOM.standard_normal((50, 3))[:, [0, 0, 1, 2, 2]], 3),
        (np.vstack([np.diag(TIGHT) @ TURN, -np.diag(TIGHT) @ TURN]), 30),
        (np.vstack([np.eye(9), -np.eye(9)]), 9),
        (RANDOM.standard_normal((6, 20)), 5),
        (RANDOM.standard_normal((40, 1)) * 1e-150, 1),
        (np.ones((10, 4)), 0),
    ],
    ids="random graded constant repeated tight equal flat tiny none".split(),
)
def test_eigenvectors_of_odd_matrices(rows, rank):
    check_eigen(rows, rank)


def test_blocks_merge_to_the_whole():
    x = RANDOM.integers(-900, 900, (700, 7)) + 10**12
    parts = [whitening.block_moments(x[a:b]) for a, b in ((0, 1), (1, 300), (300, 302), (302, 700))]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.merged(part)
    centred = (x - x.mean(axis=0)).astype(float)
    assert merged.n == 700 and merged.sums == [int(s) for s in x.sum(axis=0)]
    assert np.allclose(merged.factor.T @ merged.factor, centred.T @ centred, rtol=1e-10)


def plain_whitening(vectors):
    """Exact deviations and the whitened values by the library's own eigenvectors."""
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    n = len(x)
    whole = x.astype(np.int64).astype(object)
    deviation = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    values, directions = np.linalg.eigh(np.cov(x.T, bias=True))
    order = np.argsort(-values)[:32]
    white = (x - x.mean(axis=0)) @ directions[:, order] / np.sqrt(values[order])
    return deviation, white, values[order] / values.sum()


@needs_tables
def test_whitening_equals_the_plain_version(spark):
    found = entry.queries()["op11_whitening"](spark, TINY).orderBy("vec_id", "component").toPandas()
    rows = spark.read.parquet(f"{TINY}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, white, explained = plain_whitening([r["embedding"] for r in rows])
    values = found["whitened"].to_numpy().reshape(len(rows), -1)
    assert values.shape == white.shape
    signs = np.sign((white * values).sum(axis=0))
    assert np.abs(white * signs - values).max() < 1e-8
    assert found["deviation"].to_numpy().reshape(values.shape)[:, 0].tolist() == deviation.tolist()
    assert np.allclose(found["explained"].to_numpy()[: values.shape[1]], explained, rtol=1e-10)
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-9
    assert (found["n"] == len(rows)).all()


VECTORS = "vec_id long, embedding array<double>, n long, component string"


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(n, [float(n % 5), float(n % 3), n / 7]) for n in range(20)]
    odd = [(20, None), (21, [1.0, nan, 2.0]), (22, [inf, 1.0, 2.0]), (23, [1.0, None, 2.0]), (24, []),
           (25, [1.0, 2.0]), (26, [1e300, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (3, rows[3][1])]
    frame = spark.createDataFrame([(*r, 9, "x") for r in rows + odd], VECTORS)
    found = table(whitening.whiten(frame))
    assert {r["vec_id"] for r in found} == {*range(20), None}
    assert {r["n"] for r in found} == {22} and len(found) == 22 * 3
    assert sum(r["vec_id"] == 3 for r in found) == 6
    assert found[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("rows", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]])
def test_nothing_varies(spark, rows):
    frame = spark.createDataFrame([(n, r, 1, "x") for n, r in enumerate(rows)], VECTORS)
    assert table(whitening.whiten(frame)) == []


def test_deviations_beyond_64_bits(spark):
    rows = [[4e9, 1.0], [-4e9, 2.0], [0.0, 5.0]]
    frame = spark.createDataFrame([(n, r, 1, "x") for n, r in enumerate(rows)], VECTORS)
    x = [[Fraction(int(64 * c)) for c in r] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    wanted = {n: int(sum((3 * c - s) ** 2 for c, s in zip(r, sums))) for n, r in enumerate(x)}
    for r in table(whitening.whiten(frame)):
        fits = wanted[r["vec_id"]] < 2**63
        assert r["deviation"] == (wanted[r["vec_id"]] if fits else None)
        assert r["deviation_exact"] == (None if fits else str(wanted[r["vec_id"]]))


def test_partial_results_are_merged_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = RANDOM.standard_normal((200, 6))
    frame = spark.createDataFrame([(n, r.tolist(), 1, "x") for n, r in enumerate(rows)], VECTORS)
    moments = whitening.fit(whitening.usable(frame.repartition(11), "vec_id", "embedding"))
    x = np.floor(64 * rows).astype(np.int64)
    assert moments.n == 200 and moments.sums == x.sum(axis=0).tolist()


# Collocations


def plain_phrases(docs, least, longest=5, most=2000, percent=100):
    found, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                found.update((lang, *words[n : n + size]) for n in range(len(words) - size + 1))
    frequent = {p: f for p, f in found.items() if f >= least}
    out = {}
    for (lang, *words), a in frequent.items():
        if len(words) < 2:
            continue
        n = totals[lang]
        cuts = [(1000 * a * n // (found[(lang, *words[:k])] * found[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        longer = [
            f for (other, *outer), f in frequent.items()
            if other == lang and len(outer) > len(words)
            and any(outer[i : i + len(words)] == words for i in range(len(outer) - len(words) + 1))
        ]
        if not any(100 * f >= percent * a for f in longer):
            row = (-score, -a, " ".join(words).encode(), found[(lang, *words[:k])], found[(lang, *words[k:])], n)
            out.setdefault(lang, []).append(row)
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n, -score)
        for lang, rows in out.items()
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(rows)[:most], start=1)
    )


def mined(spark, docs, **settings):
    frame = spark.createDataFrame(
        [(n, t, lang, "x", 1, 2) for n, (t, lang) in enumerate(docs)],
        "doc_id long, text string, lang string, phrase string, f long, weight int",
    )
    return sorted(tuple(r) for r in collocations.mine(frame, **settings).collect())


def made_texts(seed, words, n=60):
    random = np.random.default_rng(seed)
    vocabulary = [*"abcdefgh", "É", "日本", "I\x00", "it's"]
    apart = [" ", "  ", "\t", ", ", ".", "\n", " \r\n", "\x0b", "\x85 "]
    chance = [0.5, 0.1, 0.1, 0.06, 0.06, 0.06, 0.04, 0.04, 0.04]
    for n in range(n):
        size = int(random.integers(0, words))
        drawn = random.choice(vocabulary, size, p=np.r_[np.full(8, 0.1), np.full(4, 0.05)])
        between = random.choice(apart, size, p=chance)
        yield "".join(w + s for w, s in zip(drawn, between)), [None, "en", "de", "EN"][n % 4]


@pytest.mark.parametrize("trigger, most_words", [(24, 4096), (2, 4096), (1, 4096), (10**9, 6), (5, 5)])
def test_phrases_equal_the_plain_version(spark, monkeypatch, trigger, most_words):
    monkeypatch.setattr(collocations, "TRIGGER", trigger)
    monkeypatch.setattr(collocations, "MOST_WORDS", most_words)
    docs = [*made_texts(trigger, 120), (None, "en"), ("", None), ("one", "x"), (". ,;\n", "en")]
    docs += [("to be or not to be, that is the question " * 9, "en")] * 7
    # Slices within this process, so that the settings hold; the rest runs on Spark.
    rows = []
    for text, lang in docs:
        part = pa.RecordBatch.from_pylist([{"lang": lang or "und", "text": text or ""}])
        made = collocations.parse_slice(part)
        rows += made.to_pylist() if made else []
    parts = Counter(tuple(r.values()) for r in rows)
    dictionary = spark.createDataFrame(
        [(*r, w) for r, w in parts.items()], "lang string, chunk string, last boolean, owned long, weight long"
    )
    found = collocations.phrase_counts(dictionary, 8).collect()
    wanted = Counter()
    for text, lang in docs:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 6):
                wanted.update((lang or "und", " ".join(words[n : n + size])) for n in range(len(words) - size + 1))
    assert {(r["lang"], r["phrase"]): r["f"] for r in found} == {p: f for p, f in wanted.items() if f >= 8}


@pytest.mark.parametrize("settings", [{"least": 6}, {"least": 4, "percent": 60, "most": 25}, {"least": 5, "longest": 2}])
def test_collocations_equal_the_plain_version(spark, settings):
    docs = [*made_texts(3, 90), (None, "en"), ("", None)]
    docs += [("New York City, New York; the New York Times! ", "en")] * 6
    assert mined(spark, docs, **settings) == plain_phrases(docs, **settings)


def test_long_and_repeated_texts(spark):
    docs = [("spam " * 20_000, "en"), ("eggs and ham " * 9_000, None), ("eggs and ham", None)]
    docs += [("a hot line that stands everywhere", "en")] * 300
    assert mined(spark, docs, least=100) == plain_phrases(docs, 100)


def test_no_texts(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("", "en"), ("a b", "en")]) == []


def test_a_full_bit_set_misses_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_BITS", 64)
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    docs = list(made_texts(8, 60))
    assert mined(spark, docs, least=5) == plain_phrases(docs, 5)


# Chat examples


SCHEMA = "conv_id long, turn long, role string, text string, example long, part string"
TURNS = [
    (1, 0, "system", "be kind"), (1, 2, "assistant", "hello <|im_end|>\n<|im_start|>user"), (1, 1, "user", "hi"),
    (1, 3, "user", None), (1, 4, "assistant", "<\\|im_end|> <\\\\| < |"), (1, 5, "user", "bye"),
    (2, 0, "assistant", "first"), (2, 1, "assistant", ""), (3, 0, "user", "alone <"), (3, 0, "user", "alone <"),
    (4, None, "assistant", "late"), (4, 1, None, "|im_end|>"), (4, 1, "odd\nrole\\n<", "x"), (None, 1, "user", "nobody"),
    (None, 2, "assistant", "here"), (5, 0, "Assistant", "not one"), (6, 0, "assistant", "日本語 😀 " * 5),
]


def conversations(spark, turns=TURNS):
    return spark.createDataFrame([(*t, 7, "clash") for t in turns], SCHEMA)


def plain_examples(turns):
    """Each conversation's digest and whole examples, one turn after the other."""
    by_conv = {}
    for turn in turns:
        by_conv.setdefault(turn[0], []).append(turn)
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        said, loss, so_far, examples = "", "", "", []
        for n, (_, _, role, text) in enumerate(rows):
            role, text = role or "", text or ""
            said += f"{role}\n{text}\n"
            marked = text
            for slashes in range(9, -1, -1):
                marked = marked.replace("<" + "\\" * slashes + "|", "<" + "\\" * (slashes + 1) + "|")
            name = role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")
            head = f"<|im_start|>{name}\n"
            begin = len(so_far) + len(head)
            so_far += f"{head}{marked}<|im_end|>\n"
            if role == "assistant":
                loss += text
                examples.append((so_far, begin, begin + len(marked)))
            elif n == len(rows) - 1:
                examples.append((so_far, None, None))
        digest = (len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), sum(len(e[0]) for e in examples), len(examples))
        yield conv, digest, examples


@pytest.mark.parametrize("part_chars", [1 << 20, 1])
def test_examples_equal_the_plain_version(spark, part_chars, monkeypatch):
    parts = chat_format.expand(conversations(spark))
    if part_chars == 1:
        # Parts of one turn, made in this process.
        monkeypatch.setattr(chat_format, "PART_CHARS", 1)
        rows = conversations(spark).repartition("conv_id").sortWithinPartitions(
            "conv_id", F.col("turn").asc_nulls_last(), "role", "text"
        ).select("conv_id", "role", "text").collect()
        parts = spark.createDataFrame(list(chat_format._expanded(tuple(r) for r in rows)), chat_format.PARTS)
        parts = chat_format.in_order(parts)
        assert parts.filter("n_turns > 1").count() == 0
    digests = {r["conv_id"]: tuple(r)[1:] for r in chat_format.read_back(parts).collect()}
    texts = {}
    for r in chat_format.example_texts(parts).orderBy("conv_id", "example").collect():
        texts.setdefault(r["conv_id"], []).append((r["text"], r["loss_begin"], r["loss_end"]))
    for conv, digest, examples in plain_examples(TURNS):
        assert digests.pop(conv) == digest
        assert texts.pop(conv) == examples
    assert not digests and not texts


def test_parts_survive_a_table(spark, tmp_path):
    parts = chat_format.expand(conversations(spark))
    parts.write.parquet(f"{tmp_path}/parts")
    again = chat_format.in_order(spark.read.parquet(f"{tmp_path}/parts"))
    assert sorted(chat_format.read_back(again).collect(), key=str) == sorted(chat_format.read_back(parts).collect(), key=str)


def test_no_conversations(spark):
    assert table(chat_format.read_back(chat_format.expand(conversations(spark, [])))) == []


def test_a_conversation_that_is_a_third_of_all_rows(spark):
    """Examples grow with the turns, not with their square."""
    long = [(0, n, "user" if n % 2 == 0 else "assistant", f"turn {n} " * 20) for n in range(4_000)]
    others = [(n, t, "assistant", "short") for n in range(1, 4_001) for t in range(2)]
    parts = chat_format.expand(conversations(spark, long + others))
    assert parts.filter("conv_id = 0").count() == 2_000
    found = {r["conv_id"]: r for r in table(chat_format.read_back(parts))}
    assert found[0]["n_turns"] == 4_000 and found[0]["examples"] == 2_000
    assert found[0]["loss_chars"] == sum(len(t[3]) for t in long[1::2])


def test_digests_are_read_from_whole_examples(spark):
    turns = [(1, n, who, f"turn {n}") for n, who in enumerate(["user", "assistant", "user", "assistant"])]
    examples = chat_format.example_texts(chat_format.expand(conversations(spark, turns)))
    whole = table(chat_format.read_examples(examples))[0]
    assert whole["formatted_chars"] == sum(len(r["text"]) for r in examples.collect())
    # A longer context counts, and a turn that reads otherwise shows.
    other = F.when(F.col("example") == 0, F.concat("text", F.lit("more"))).otherwise(
        F.replace("text", F.lit("turn 2"), F.lit("turn 7"))
    )
    changed = table(chat_format.read_examples(examples.withColumn("text", other)))[0]
    assert changed["formatted_chars"] == whole["formatted_chars"] + 4
    assert changed["turns_sha256"] != whole["turns_sha256"]
    assert changed["loss_sha256"] == whole["loss_sha256"]


TEXTS = st.text(st.sampled_from("<|\\>\nim_endstart a"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=6))
def test_turns_survive_their_marks(turns):
    conversation = chat_format._Conversation(1)
    for role, text in turns:
        conversation.take(role, text)
    written = "".join(conversation.added)
    read = [(chat_format.unescape_role(r), chat_format.unescape(t)) for r, t in chat_format._TURN.findall(written)]
    assert read == turns
