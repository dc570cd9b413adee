"""Passages shared by many documents: repeated clauses go, unlike documents stay apart."""

from __future__ import annotations

import numpy as np
import pytest

from floodmark.llm import decontamination, line_dedup, near_dedup, packing, token_counts

RANDOM = np.random.default_rng(17)
DOCS = "doc_id long, text string"


def words(n):
    return [f"w{x}" for x in RANDOM.integers(0, 10**9, n)]


def prose(n):
    """Words with a clause end after every few, wrapped at odd places."""
    out = words(n)
    for k in range(4, n, 6):
        out[k] += ".,;:!?"[k % 6]
    return out


def wrapped(parts):
    return "".join(w + ("\n" if RANDOM.random() < 0.1 else " ") for w in parts).rstrip()


@pytest.fixture(scope="module")
def passages(spark):
    """A passage of sixty words in seven documents, each wrapped its own way, and clean ones."""
    passage = prose(60)
    texts = {n: wrapped(prose(40) + passage + prose(30)) for n in range(7)}
    texts |= {n: wrapped(prose(80)) + " yes, no, yes. no." for n in range(7, 20)}
    texts[20], texts[21] = texts[8], texts[8]
    frame = spark.createDataFrame(list(texts.items()), DOCS)
    found = {r["doc_id"]: r for r in line_dedup.remove_repeated_lines(frame).collect()}
    return passage, texts, found


def test_passages_go_whatever_their_wrapping(passages):
    passage, texts, found = passages
    assert found[0]["text"] == texts[0]
    for n in range(1, 7):
        left = set(found[n]["text"].split()) & set(passage)
        # Clauses cut by the passage's ends stay.
        assert len(left) <= 12 and len(found[n]["text"].split()) <= 70 + 12


def test_clean_documents_stay_as_they_are(passages):
    _, texts, found = passages
    assert all(found[n]["text"] == texts[n] for n in range(7, 20))
    assert found[20]["text"] == "" == found[21]["text"]


def test_stretches_part_the_original(passages):
    _, texts, found = passages
    for n, row in found.items():
        assert "".join(texts[n][s["begin"] : s["end"]] for s in row["kept"]) == row["text"]
        both = sorted((s["begin"], s["end"]) for s in row["kept"] + row["removed"])
        assert [0, *(e for _, e in both)] == [*(b for b, _ in both), len(texts[n])]


def test_short_stretches_stay(spark):
    shared = " ".join(prose(line_dedup.STRETCH_WORDS - 2)) + "."
    texts = [(n, wrapped([*prose(20), "end."]) + f" {shared} " + wrapped(prose(20))) for n in range(3)]
    found = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated_lines(spark.createDataFrame(texts, DOCS)).collect()}
    assert found == dict(texts)


def brute_force(texts):
    sets = {n: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for n, t in texts.items()}
    least = {n: n for n in texts}

    def find(n):
        while least[n] != n:
            n = least[n]
        return n

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                least[high] = low
    return {n: find(n) for n in texts}


@pytest.mark.parametrize("pivots", [512, 40])
def test_a_bucket_of_unlike_members(spark, monkeypatch, pivots):
    """Three quarters of every text is common to all: similar, but never enough; some are copies besides."""
    monkeypatch.setattr(near_dedup, "PIVOTS", pivots)
    common = words(60)
    texts = {n: " ".join(common + words(20)) for n in range(150)}
    for n in range(150, 180):
        copy = texts[n - 150].split()
        copy[int(RANDOM.integers(60, 80))] = "changed"
        texts[n] = " ".join(copy)
    frame = spark.createDataFrame(list(texts.items()), DOCS)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert found == brute_force(texts)


def test_rounds_do_not_grow_with_a_bucket(spark, monkeypatch):
    """Unlike members are settled in three rounds, though a cell holds a few of them only."""
    monkeypatch.setattr(near_dedup, "PIVOTS", 4)
    tables, write = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda frame, name: tables.append(name) or write(frame, name))
    common = words(60)
    texts = {n: " ".join(common + words(20)) for n in range(120)}
    for n in range(120, 150):
        copy = texts[n - 90].split()
        copy[int(RANDOM.integers(60, 80))] = "changed"
        texts[n] = " ".join(copy)
    frame = spark.createDataFrame(list(texts.items()), DOCS)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert found == brute_force(texts)
    assert tables.count("open") == 3


def test_cells_hold_every_pair_of_a_bucket(spark, monkeypatch):
    """Members of different components meet just once, whatever the number of cells."""
    members = [(k, n, n % 40 if n < 60 else 1000 * k) for k, size in ((1, 100), (2, 3)) for n in range(size)]
    expected = {(min(a[1], b[1]), max(a[1], b[1])) for a in members for b in members if a[0] == b[0] and a[2] != b[2]}
    at = spark.createDataFrame(members, "key long, node long, label long").selectExpr(
        "*", "100L as n", "1L as company", *[f"0L as p{k}" for k in range(near_dedup.PARITY_LONGS)]
    )
    for size in (1000, 7):
        monkeypatch.setattr(near_dedup, "PIVOTS", size)
        pairs = near_dedup.pairs_of_rest(at.filter("key = 1"), 75).collect()
        assert {tuple(sorted(p)) for p in pairs} == {p for p in expected} and len(pairs) == len(expected)
        few = near_dedup.pairs_of_rest(at.filter("key = 2"), 75).collect()
        assert sorted(tuple(sorted(p)) for p in few) == [(0, 1), (0, 2), (1, 2)]


def test_ids_beyond_doubles_stay_exact(spark):
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, "one two"), (None, "one two"), (-big, "three")], DOCS)
    packed = packing.pack(docs, token_counts.vocabulary()).collect()
    assert sorted((r["doc_id"] or 0) for r in packed) == [-big, 0, big]
    items = spark.createDataFrame([(big, "one two"), (None, "three")], "item_id long, text string")
    found = decontamination.find_contamination(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(big, big), (None, big), (-big, None)}
