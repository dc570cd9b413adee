"""The queries against plain versions, exact round trips or held-out labels, on small sample tables."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from compare import connect, differences
from floodmark.llm import decontamination, graph_search, licences, near_dedup, packing, toxicity

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(TINY), reason="no sample tables")


def run(spark, name, folder=TINY):
    return [row.asDict(recursive=True) for row in entry.queries()[name](spark, folder).collect()]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()
    return {row["doc_id"]: row["text"] or "" for row in rows}


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, TINY), connect(TINY), entry.oracle_sql()[name]) is None


def test_token_counts_are_the_library_s(spark, texts, tokenizer):
    found = {r["doc_id"]: r["n_tokens"] for r in run(spark, "op9_token_counts")}
    assert found == {n: len(tokenizer.encode(t, add_special_tokens=False).ids) for n, t in texts.items()}


ODD = ["", " ", "  a  b", "\n\n x\t y <|endoftext|> z<|endoftext|>", "aaaaaaaaaaaa aaa", "it's we'll ’s", "\x1c a \x85b  \n c", "a　 b"]


def test_odd_texts_have_the_library_s_tokens(tokenizer):
    from floodmark.llm import token_counts

    vocabulary = token_counts.vocabulary()
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]
    assert token_counts.Counter(vocabulary).counts(ODD) == [len(ids) for ids in wanted]
    encoder = packing.Encoder(vocabulary)
    assert [encoder.encode(t).tolist() for t in ODD] == wanted


def test_packing_holds_every_token_once(spark, texts, tokenizer):
    found = run(spark, "op2_best_fit_packing")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        at = 0
        for r in parts:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 1024 for r in parts[1:])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in found)
    assert len(by_sequence) <= -(-total // 1024) * 1.03 + 1


def test_packing_is_close_to_the_bound():
    lengths = np.random.default_rng(3).integers(1, 1024, 5_000)
    sequence, offset = packing.sum_of_squares(np.sort(lengths)[::-1], 1024)
    assert sequence.max() + 1 <= lengths.sum() / 1024 * 1.01 + 2
    assert (offset + np.sort(lengths)[::-1] <= 1024).all()


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[n : n + 5]) for n in range(len(words) - 4)}


def test_near_duplicates_equal_all_pairs(spark, texts):
    sets = {n: shingles(t) for n, t in texts.items()}
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ids = sorted(n for n in sets if sets[n])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    found = {r["doc_id"]: r for r in run(spark, "op5_near_dedup")}
    for n in sets:
        assert found[n]["n_shingles"] == len(sets[n])
        assert found[n]["component_id"] == find(n) and found[n]["kept"] == (find(n) == n)


def test_groups_without_a_common_original(spark):
    """Chains, stars around a late member, and members that are near no other."""
    rng = np.random.default_rng(4)
    base = [f"w{n}" for n in range(200)]
    rows, n = [], 0
    for edits in (1, 2, 3, 4, 5, 6, 8, 12):
        for _ in range(12):
            words = list(base)
            for at in rng.choice(200, edits, replace=False):
                words[at] = f"x{rng.integers(10**9)}"
            n += 1
            rows.append((n, " ".join(words)))
    rows.append((10_000, " ".join(base)))
    chain = list(base)
    for step in range(20):
        chain = chain[5:] + [f"c{step}_{k}" for k in range(5)]
        rows.append((20_000 + step, " ".join(chain)))
    sets = {n: shingles(t) for n, t in rows}
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {n: find(n) for n in sets}


def test_bayes_keeps_pairs_above_the_bound():
    steps = near_dedup.least_matches(0.75, 1e-6, 128, 32)
    assert [n for n, _ in steps] == [32, 64, 96, 128]
    rng = np.random.default_rng(1)
    matches = rng.random((200_000, 128)) < 0.75
    dropped = np.zeros(len(matches), bool)
    for n, least in steps:
        dropped |= matches[:, :n].sum(axis=1) < least
    assert dropped.mean() < 1e-4


def plain_alignment(item, text):
    best, rows = 0, [[0] * (len(text) + 1)]
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, rows[-1][j] + (2 if a == b else -1), rows[-1][j + 1] - 1, row[j] - 1))
            best = max(best, row[-1])
        rows.append(row)
    return best


def test_alignment_equals_the_plain_one():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item = rng.integers(1, 9, rng.integers(1, 14)).astype(np.uint64)
        windows = rng.integers(1, 9, (3, rng.integers(1, 30))).astype(np.uint64)
        best, begin, end, item_begin, item_end = decontamination.align(item, windows)
        for k, window in enumerate(windows):
            assert best[k] == plain_alignment(item.tolist(), window.tolist())
            inner = window[begin[k] : end[k]], item[item_begin[k] : item_end[k]]
            assert plain_alignment(inner[1].tolist(), inner[0].tolist()) == best[k]


def test_edited_and_repeated_passages_are_found(spark):
    words = [f"item{n}" for n in range(40)]
    changed = [w if n % 6 else f"other{n}" for n, w in enumerate(words) if n % 11]
    clean = [f"clean{n}" for n in range(300)]
    docs = [(n, " ".join([*clean[:n], *words, *clean])) for n in range(30)]
    docs += [(100, " ".join([*clean, *changed])), (101, " ".join(clean)), (102, " ".join([*words[:8], *clean]))]
    benchmark = spark.createDataFrame([(7, " ".join(words)), (8, "unrelated words of another item")], "item_id long, text string")
    found = decontamination.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), benchmark, block_bytes=64
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(n, 7) for n in [*range(30), 100]}
    for r in found:
        text = dict(docs)[r["doc_id"]].encode()[r["begin"] : r["end"]].decode()
        assert text.startswith("item1 " if r["doc_id"] == 100 else "item0 ")


@pytest.mark.parametrize("copies", [5, 10, 1000])
def test_copies_of_an_edited_passage_are_found(spark, copies):
    words = [f"item{n}" for n in range(40)]
    edited = [f"other{n}" if n % 5 == 4 else w for n, w in enumerate(words)]
    docs = [(n, " ".join([f"own{n}", *edited, "end"])) for n in range(copies)]
    docs += [(-1, " ".join([f"clean{n}" for n in range(90)])), (-2, " ".join(words[:8]))]
    found = decontamination.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(7, " ".join(words))], "item_id long, text string"),
    ).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(copies))
    assert all(r["score"] == pytest.approx(57 / 80) for r in found)


def test_no_alignment_exceeds_its_reach():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 9, rng.integers(1, 14))) for _ in range(8)]
    items = decontamination.Items(list(range(8)), texts)
    hashes = np.concatenate([items.words[n] for n in rng.integers(0, 8, 12)])
    begin = rng.integers(0, len(hashes) - 1, 60)
    end = np.minimum(begin + rng.integers(1, 30, 60), len(hashes))
    item = rng.integers(0, 8, 60)
    for n, b, e, most in zip(item, begin, end, items.reach(hashes, item, begin, end)):
        assert plain_alignment(items.words[n].tolist(), hashes[b:e].tolist()) <= most


def test_contamination_equals_plain_search(spark, texts):
    items = spark.read.parquet(f"{TINY}/benchmark.parquet").collect()
    word = lambda t: re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    whole = {n: f" {' '.join(word(t))} " for n, t in texts.items()}
    wanted = {(n, r["item_id"]) for n, t in whole.items() for r in items if f" {' '.join(word(r['text']))} " in t}
    found = run(spark, "op3_decontamination")
    assert wanted <= {(r["doc_id"], r["item_id"]) for r in found}
    assert {(r["doc_id"], r["item_id"]) for r in found if r["score"] == 1.0} == wanted


def area(score, label):
    score, label = np.array(score), np.array(label, bool)
    above = (score[label][:, None] > score[~label]).mean() + (score[label][:, None] == score[~label]).mean() / 2
    return above


@pytest.mark.parametrize(("name", "label", "of", "rest", "least"), [("op4_toxicity", "toxic", 3, 1, 0.85), ("op6_quality", "quality", 5, 0, 0.97)])
def test_held_out_labels(spark, name, label, of, rest, least):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = run(spark, name, SMALL)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of == rest) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert area([r["score"] for r in held], [labels[r["doc_id"]] for r in held]) >= least


def test_segments_equal_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(200):
        scores = rng.integers(-4, 5, rng.integers(1, 14)).astype(float)

        def split(begin, end):
            """The best segment, the shortest of equals, and those on either side of it."""
            options = [(scores[b:e].sum(), b - e, -b, b, e) for b in range(begin, end) for e in range(b + 1, end + 1)]
            top = max(options, default=(0,))
            if top[0] <= 0:
                return []
            b, e = top[3:]
            return [*split(begin, b), (b, e, top[0]), *split(e, end)]

        found = toxicity.maximal_segments(scores)
        assert sum(s for *_, s in found) == pytest.approx(sum(s for *_, s in split(0, len(scores))))


def test_shards_are_permuted_exactly(spark, texts):
    found = run(spark, "op7_uniform_sharding")
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in found} == {
        n: (len(t.encode()) + 1, zlib.crc32(t.encode())) for n, t in texts.items()
    }
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in by_shard.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_recall_of_graphs(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(4_000, 24)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = graph_search.Graph(vectors).build()
    queries = vectors[::20]
    found, _ = graph.nearest(queries, graph_search.BEAM)
    wanted = np.argsort(-(queries @ vectors.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b[:20])) / 20 for a, b in zip(wanted, found)]) >= 0.9


def test_an_outlier_does_not_hide_other_neighbours(spark):
    vectors = np.random.default_rng(5).normal(size=(1_500, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[7] *= 1e4
    rows = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in graph_search.nearest_neighbours(rows, rows.filter("vec_id % 20 = 0")).collect():
        found[r["query_id"]].add(r["vec_id"])
    wanted = {q: [n for n in np.argsort(-(vectors @ vectors[q])).tolist() if n != q][:20] for q in range(0, 1_500, 20)}
    assert sum(len(found[q] & set(w)) for q, w in wanted.items()) >= 0.9 * 20 * len(wanted)


def test_nearest_neighbours_equal_brute_force(spark):
    rows = spark.read.parquet(f"{TINY}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    found = defaultdict(list)
    for r in sorted(run(spark, "op8_graph_search"), key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    queries = [n for n in vectors if n % 20 == 0]
    assert set(found) == set(queries)
    for q in queries:
        order = sorted((-float(vectors[q] @ v), n) for n, v in vectors.items() if n != q)[:20]
        hits += len({n for _, n in order} & {n for n, _ in found[q]})
        assert all(s == pytest.approx(float(vectors[q] @ vectors[n]), abs=1e-12) for n, s in found[q])
    assert hits >= 0.9 * 20 * len(queries)


def test_licence_lines_are_those_planted(spark, texts):
    planted = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "All rights reserved.": "reserved",
    }
    wanted = [(n, k, planted[line]) for n, t in texts.items() for k, line in enumerate(t.split("\n")) if line in planted]
    found = [(r["doc_id"], r["paragraph"], r["family"]) for r in run(spark, "op1_licence_scan") if r["confirmed"]]
    assert sorted(found) == sorted(wanted)


def test_wrapped_notices_are_confirmed(spark):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by"
    mit = "# Permission is hereby granted, free of charge, to any\n# person obtaining a copy of this software and associated"
    bsd = " * Redistribution and use in source\n * and binary forms, with or\n * without modification, are permitted provided"
    prose = "\n".join(f"Some clean line of other words number {n}" for n in range(30))
    narrow = "\n".join("Licensed under CC BY-NC 4.0.".split())
    made = [(gpl, "gpl", 0), (f"{prose}\n{mit}\n{prose}", "mit", 30), (f"/*\n *\n{bsd}\n */", "bsd", 2), (narrow, "cc-by-nc", 0)]
    docs = [(n, text) for n, (text, _, _) in enumerate(made)] + [(None, gpl), (9, prose), (10, gpl.replace("\n", "\n\n"))]
    found = licences.scan_licences(spark.createDataFrame(docs, "doc_id long, text string")).filter("confirmed").collect()
    wanted = [(n, family, place) for n, (_, family, place) in enumerate(made)] + [(None, "gpl", 0)]
    assert sorted(((r["doc_id"], r["family"], r["paragraph"]) for r in found), key=str) == sorted(wanted, key=str)
    assert all(r["last_paragraph"] > r["paragraph"] for r in found)


def test_many_headers_do_not_hide_weaker_notices(spark):
    header = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by"
    weak = "Released under GPL version 2 or any later version"
    docs = [(n, f"{header}\nfile {n} of many") for n in range(300)] + [(1000, weak)]
    found = licences.scan_licences(spark.createDataFrame(docs, "doc_id long, text string"), sample_docs=100).filter("confirmed")
    assert [(r["paragraph"], r["family"]) for r in found.filter("doc_id = 1000").collect()] == [(0, "gpl")]


def test_calibration_counts_every_distinct_line_once(spark):
    """One alarm in a thousand lines is allowed; copies of a line and suspect lines do not count."""
    model = object.__new__(licences.Classifier)
    model.bias = [0.0, 0.0]
    scored = [(f"some words {n}", 2.0 + n) for n in range(3)] + [("GNU General Public License", 9.0), ("nothing", -1.0)]
    scored = spark.createDataFrame(scored, "line string, margin double")
    assert 3.0 < model.calibrate(scored, 1001, 0.001) < 3.01
    assert model.calibrate(scored, 3001, 0.001) == 0.0


def test_other_sentences_are_unknown(spark):
    lines = [*licences.OTHERS, "The license to drive was lost.", "Nothing of note here at all."]
    docs = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "doc_id long, text string")
    assert not [r for r in licences.scan_licences(docs).collect() if r["confirmed"]]


def test_pipeline_equals_its_parts(spark, texts):
    """What the pipeline packs is what is left after the plain decisions of the other queries."""
    packed = {r["doc_id"] for r in run(spark, "pipeline")}
    toxic = {r["doc_id"] for r in run(spark, "op4_toxicity") if r["predicted"]}
    leaked = {r["doc_id"] for r in run(spark, "op3_decontamination")}
    groups = defaultdict(list)
    for r in run(spark, "op5_near_dedup"):
        groups[r["component_id"]].append(r["doc_id"])
    assert not packed & toxic
    for members in groups.values():
        left = [n for n in sorted(members) if n not in toxic]
        # The group may fall apart where its toxic members go; its first one always stays.
        if left and left[0] not in leaked:
            assert left[0] in packed
    alone = {m[0] for m in groups.values() if len(m) == 1} - toxic
    assert alone - leaked <= packed
