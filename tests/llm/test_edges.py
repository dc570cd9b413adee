"""Every operator on nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from floodmark.llm import (
    decontamination,
    graph_search,
    licences,
    line_dedup,
    near_dedup,
    packing,
    quality,
    sharding,
    token_counts,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, node long, shard int"
LONG = " ".join(f"word{n % 977}" for n in range(60_000))


def rows():
    texts = [None, "", " \n\t ", "two words", "All rights reserved.", "All rights reserved.", LONG, LONG + " end", "\x00 odd 日本語 😀"]
    made = [(n, t, "en", "s", len(t or ""), 0.1, 1, 7, 3) for n, t in enumerate(texts)]
    made += [made[3], made[3], (None, "no id at all", None, None, None, None, None, None, None)]
    made += [(None, None, None, None, None, None, None, None, None), (3, "another text of three", "en", "s", 1, 0.0, 0, 1, 1)]
    return made


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(0, 1, 0), (3, 1, 1), (4, 0, 0), (6, 1, 0), (None, 1, 1), (99, 0, 1)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "two words"), (2, None), (3, ""), (None, "no id at all"), (5, "!!")], "item_id long, text string"
    )


def table(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]


def test_token_counts(docs, none):
    found = table(token_counts.count_tokens(docs, token_counts.vocabulary()))
    assert len(found) == len(rows())
    assert all(r["n_tokens"] == 0 and r["n_bytes"] == 0 for r in found if r["doc_id"] in (0, 1))
    assert [r["over_limit"] for r in found if r["doc_id"] == 6] == [True]
    assert not table(token_counts.count_tokens(none, token_counts.vocabulary()))


def test_packing(docs, none):
    found = table(packing.pack(docs, token_counts.vocabulary()))
    lone = [r for r in found if r["doc_id"] in (0, 1)]
    assert [r["length"] for r in lone] == [1, 1]
    assert len([r for r in found if r["doc_id"] is None]) == 2
    assert not table(packing.pack(none, token_counts.vocabulary()))


def test_sharding(docs, none):
    found = table(sharding.shard_uniformly(docs))
    sizes = np.bincount([r["shard"] for r in found], minlength=8)
    assert sizes.sum() == len(rows()) and sizes.max() - sizes.min() <= 1
    for shard in range(8):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sizes[shard]))
    assert {"lang", "score", "node", "shard", "slot"} <= set(found[0])
    assert not table(sharding.shard_uniformly(none))


def test_near_duplicates(docs, none):
    found = table(near_dedup.near_duplicates(docs))
    assert len(found) == len(rows())
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["component_id"] == 4 and not by_id[5]["kept"]
    assert by_id[7]["component_id"] == 6
    assert all(by_id[n]["n_shingles"] == 0 and by_id[n]["component_id"] == n and by_id[n]["kept"] for n in (0, 1, 2))
    assert all(r["kept"] and r["component_id"] is None for r in found if r["doc_id"] is None)
    assert not table(near_dedup.near_duplicates(none))


def test_repeated_lines(docs, none):
    found = table(line_dedup.remove_repeated_lines(docs, carry=("lang", "score")))
    assert len(found) == len(rows())
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[4]["text"] == "All rights reserved." and by_id[5]["text"] == ""
    assert by_id[0]["text"] == "" and by_id[2]["text"] == " \n\t "
    assert by_id[6]["text"] == LONG
    # Repeated rows are one document: each keeps its line.
    assert sum(r["text"] == "two words" for r in found) == 3
    assert {r["carried"]["lang"] for r in found} == {"en", None}
    assert not table(line_dedup.remove_repeated_lines(none))


def test_decontamination(docs, none, benchmark):
    found = table(decontamination.find_contamination(docs, benchmark))
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in found} == {(3, 1, 1.0), (None, None, 1.0)}
    assert len(found) == 4
    assert not table(decontamination.find_contamination(none, benchmark))
    assert not table(decontamination.find_contamination(docs, benchmark.limit(0)))


def test_toxicity(docs, none, labels):
    found = table(toxicity.score_toxicity(docs, labels))
    assert len(found) == len(rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert not table(toxicity.score_toxicity(none, labels))
    assert {r["score"] for r in table(toxicity.score_toxicity(docs, labels.limit(0)))} == {0.0}


def test_quality(docs, none, labels):
    found = table(quality.score_quality(docs, labels))
    assert len(found) == len(rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert not table(quality.score_quality(none, labels))
    assert {r["score"] for r in table(quality.score_quality(docs, labels.limit(0)))} == {0.5}


def test_licences(docs, none):
    found = table(licences.scan_licences(docs))
    assert [(r["doc_id"], r["family"], r["confirmed"]) for r in sorted(found, key=lambda r: r["doc_id"])] == [
        (4, "reserved", True),
        (5, "reserved", True),
    ]
    assert not table(licences.scan_licences(none))


def test_graph_search(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0])]
    vectors += [(6, [nan, 1.0]), (7, [1.0, inf]), (8, [1.0, None]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = table(graph_search.nearest_neighbours(frame, frame.filter("vec_id in (0, 2, 5)")))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [
        (0, 1, 1, 1.0),
        (0, 2, 2, 0.0),
        (2, 1, 0, 0.0),
        (2, 2, 1, 0.0),
    ]
    empty = frame.limit(0)
    assert not table(graph_search.nearest_neighbours(empty, empty))
    same = spark.createDataFrame([(n, [0.5, 0.5]) for n in range(60)], "vec_id long, embedding array<float>")
    found = table(graph_search.nearest_neighbours(same, same.filter("vec_id = 40"), k=20))
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == list(range(20))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, labels, benchmark):
    path = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, docs, none, folder, number):
    _, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, docs, folder)
    if number < len(corpus_pipeline.STAGES) - 1:
        assert found.columns == docs.columns
    assert found.count() > 0
    assert stage(spark, none, folder).count() == 0


def test_checksums_are_unsigned(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = table(sharding.op7_uniform_sharding(spark, str(tmp_path)))
    wanted = sorted((zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 1) for r in rows())
    assert sorted((r["text_crc32"], r["size"]) for r in found) == wanted
