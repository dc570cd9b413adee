"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Largest inner product is searched.  One more component turns it into the smallest
angle, and equal vectors become one node, so that copies cannot crowd a graph.
Nodes are dealt at random into shards of a fixed mean size.  A shard's graph is a
handful of flat arrays (neighbours by node and layer, codes, vectors), a row of a
written table.  Queries come in blocks to every shard; the shards' results are
scored again in double precision on the original vectors, and merged.

Nodes are inserted in batches, and a batch is searched for as a whole: each step of
the beam search is one array operation for all of its vectors.  Neighbours are
chosen by the usual rule of diversity, links go both ways, and a full list keeps
its diverse ones.

Null and empty vectors, vectors of zeros, with null or non-finite components or of
another length than most have no part.  A row without id has none either.
Repeated rows are candidates of their own; equal ids are one candidate.  Ties go
to the smaller id.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.common import read, written

NEIGHBOURS = 16
BEAM = 160
BUILD_BEAM = 64
BATCH = 256
# Mean number of distinct vectors per graph, and queries searched for together.
SHARD_VECTORS = 8_192
BLOCK_QUERIES = 16_384
TOGETHER = 256


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector (doubles) and its norm of rows that can take part, one per id and vector."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter("vec_id is not null and size(vector) > 0").filter(F.forall("vector", finite))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("norm", norm).filter("norm > 0")


class Graph:
    """A hierarchical graph over unit vectors, nearest by inner product."""

    def __init__(self, vectors: np.ndarray, seed: int = 1):
        self.vectors = vectors
        n = len(vectors)
        random = np.random.default_rng(seed)
        scale = 1 / np.log(NEIGHBOURS)
        self.level = np.minimum((-np.log(random.random(n)) * scale).astype(np.int64), 6)
        # Taken in the order of their levels, the first node of each layer is its entrance.
        self.order = np.argsort(-self.level, kind="stable")
        self.entrance = int(self.order[0])
        self.top = int(self.level[self.entrance])
        # Neighbours by layer: a row per node, padded with -1; the lowest layer has twice as many.
        width = [2 * NEIGHBOURS] + [NEIGHBOURS] * self.top
        self.links = [np.full((n, w), -1, np.int32) for w in width]

    def build(self) -> Graph:
        first = self.order[:1]
        done, n = len(first), len(self.order)
        while done < n:
            # Batches grow with the graph, so that few nodes miss their own batch.
            batch = self.order[done : done + max(1, min(BATCH, done // 2))]
            # Nodes of one batch are each other's candidates too.
            inner = self.vectors[batch] @ self.vectors[batch].T
            np.fill_diagonal(inner, -np.inf)
            near = np.full(len(batch), self.entrance)
            for layer in range(self.top, -1, -1):
                some = np.flatnonzero(self.level[batch] >= layer)
                rest = np.flatnonzero(self.level[batch] < layer)
                if len(rest):
                    near[rest] = self.search(self.vectors[batch[rest]], near[rest], 1, layer)[0][:, 0]
                if not len(some):
                    continue
                found, score = self.search(self.vectors[batch[some]], near[some], BUILD_BEAM, layer)
                near[some] = found[:, 0]
                k = min(NEIGHBOURS, len(some) - 1)
                if k:
                    mates = inner[np.ix_(some, some)]
                    best = np.argpartition(-mates, k - 1, axis=1)[:, :k]
                    found = np.c_[found, batch[some][best]]
                    score = np.c_[score, np.take_along_axis(mates, best, 1)]
                    turn = np.argsort(-score, axis=1, kind="stable")
                    found, score = np.take_along_axis(found, turn, 1), np.take_along_axis(score, turn, 1)
                self._connect(batch[some], found, score, layer)
            done += len(batch)
        return self

    def _diverse(self, found: np.ndarray, score: np.ndarray, keep: int) -> np.ndarray:
        """Of candidates in falling order, those nearer to the node than to one kept, then the nearest of the rest."""
        n, m = found.shape
        valid = found >= 0
        if m > keep:
            vectors = self.vectors[np.maximum(found, 0)]
            mutual = vectors @ vectors.transpose(0, 2, 1)
            chosen = np.zeros((n, m), bool)
            closest = np.full((n, m), -np.inf, np.float32)
            for j in range(m):
                take = np.flatnonzero(valid[:, j] & (closest[:, j] <= score[:, j]))
                chosen[take, j] = True
                closest[take] = np.maximum(closest[take], mutual[take, :, j])
            rank = np.where(valid, np.where(chosen, 0, 1), 2)
            turn = np.argsort(rank, axis=1, kind="stable")[:, :keep]
            found = np.take_along_axis(found, turn, 1)
        return found

    def _connect(self, nodes: np.ndarray, found: np.ndarray, score: np.ndarray, layer: int) -> None:
        """Link new nodes to diverse ones of those found, and these back to them."""
        links = self.links[layer]
        some = slice(0, 3 * NEIGHBOURS)
        kept = self._diverse(found[:, some], score[:, some], NEIGHBOURS)
        links[nodes, : kept.shape[1]] = kept
        to, by = kept.ravel(), np.repeat(nodes, kept.shape[1])
        order = np.argsort(to, kind="stable")[(to < 0).sum() :]
        to, by = to[order], by[order]
        begin = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])[: len(to)]
        many = np.diff(np.r_[begin, len(to)])
        place = np.arange(len(to)) - np.repeat(begin, many)
        targets = to[begin]
        # Each target's old links and the new ones beside them; nodes of one batch may be both.
        beside = np.full((len(targets), links.shape[1] + (int(many.max()) if len(to) else 0)), -1, np.int64)
        beside[:, : links.shape[1]] = links[targets]
        row = np.repeat(np.arange(len(targets)), many)
        again = (links[to] == by[:, None]).any(axis=1)
        beside[row[~again], links.shape[1] + place[~again]] = by[~again]
        for at in range(0, len(targets), BATCH):
            mine, options = targets[at : at + BATCH], beside[at : at + BATCH]
            value = np.einsum("ijk,ik->ij", self.vectors[np.maximum(options, 0)], self.vectors[mine])
            value[options < 0] = -np.inf
            turn = np.argsort(-value, axis=1, kind="stable")
            options, value = np.take_along_axis(options, turn, 1), np.take_along_axis(value, turn, 1)
            used = int((options >= 0).sum(axis=1).max())
            chosen = self._diverse(options[:, :used], value[:, :used], links.shape[1])
            links[mine] = -1
            links[mine, : chosen.shape[1]] = chosen

    def search(self, queries: np.ndarray, start: np.ndarray, beam: int, layer: int):
        """The best ``beam`` nodes of a layer found for each query, and their inner products."""
        n, links = len(queries), self.links[layer]
        seen = np.zeros((n, len(self.vectors)), bool)
        every = np.arange(n)
        found = np.full((n, beam), -1, np.int64)
        score = np.full((n, beam), -np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        found[:, 0], open_[:, 0], seen[every, start] = start, True, True
        score[:, 0] = np.einsum("ij,ij->i", self.vectors[start], queries)
        active = every
        while True:
            active = active[open_[active].any(axis=1)]
            if not len(active):
                return found, score
            best = np.where(open_[active], score[active], -np.inf).argmax(axis=1)
            node = found[active, best]
            open_[active, best] = False
            near = links[node].astype(np.int64)
            valid = (near >= 0) & ~seen[active[:, None], near]
            row, col = np.nonzero(valid)
            seen[active[row], near[row, col]] = True
            value = np.full(near.shape, -np.inf, np.float32)
            value[row, col] = np.einsum("ij,ij->i", self.vectors[near[row, col]], queries[active[row]])
            all_found = np.concatenate([found[active], near], axis=1)
            all_score = np.concatenate([score[active], value], axis=1)
            all_open = np.concatenate([open_[active], valid], axis=1)
            turn = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam] if beam > 1 else all_score.argmax(axis=1)[:, None]
            order = np.argsort(-np.take_along_axis(all_score, turn, 1), axis=1, kind="stable")
            turn = np.take_along_axis(turn, order, 1)
            found[active] = np.take_along_axis(all_found, turn, 1)
            score[active] = np.take_along_axis(all_score, turn, 1)
            open_[active] = np.take_along_axis(all_open, turn, 1) & (score[active] > -np.inf)

    def nearest(self, queries: np.ndarray, beam: int):
        near = np.full(len(queries), self.entrance)
        for layer in range(self.top, 0, -1):
            near = self.search(queries, near, 1, layer)[0][:, 0]
        return self.search(queries, near, beam, 0)

    def arrays(self) -> dict:
        return {
            "n": len(self.vectors), "dims": self.vectors.shape[1], "entrance": self.entrance, "top": self.top,
            "vectors": self.vectors.astype(np.float32).tobytes(), "links": [x.tobytes() for x in self.links],
        }

    @classmethod
    def of(cls, row) -> Graph:
        graph = object.__new__(cls)
        n = int(row["n"])
        graph.entrance, graph.top = int(row["entrance"]), int(row["top"])
        graph.vectors = np.frombuffer(row["vectors"], np.float32).reshape(n, int(row["dims"]))
        graph.links = [np.frombuffer(x, np.int32).reshape(n, -1) for x in row["links"]]
        return graph


_INDEX = (
    "shard long, n long, dims int, entrance int, top int, ids binary, vectors binary, links array<binary>"
)


def deal(nodes: DataFrame) -> tuple[DataFrame, int]:
    """The nodes with a shard each, and how many shards there are.  ``nodes`` has node, vector and norm.

    Norms of a shard differ by less than a factor of two, so that single-precision
    products of its scaled vectors stay apart, whatever the norms elsewhere.
    """
    level = F.floor(F.log2("norm"))
    # At most as many rows as a double has exponents.
    sizes = nodes.groupBy(level.alias("level")).count().orderBy("level").collect()
    counts = [max(1, round(r["count"] / SHARD_VECTORS)) for r in sizes]
    spans = [x for r, n, end in zip(sizes, counts, np.cumsum(counts).tolist()) for x in (F.lit(r["level"]).cast("long"), F.array(F.lit(end - n), F.lit(n)))]
    if not spans:
        return nodes.withColumn("shard", F.lit(0).cast("long")), 1
    span = F.element_at(F.create_map(*spans), level)
    return nodes.withColumn("shard", (span[0] + F.pmod(F.xxhash64("node"), span[1])).cast("long")), sum(counts)


def build_index(nodes: DataFrame) -> DataFrame:
    """A row per shard: its graph as flat arrays.  ``nodes`` has shard, node and vector."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        vectors = np.stack(rows["vector"].to_numpy())
        # The added component makes all norms equal, so the largest product is the smallest angle.
        squares = (vectors**2).sum(axis=1)
        added = np.sqrt(np.maximum(squares.max() - squares, 0))
        graph = Graph((np.c_[vectors, added] / np.sqrt(squares.max())).astype(np.float32)).build()
        ids = rows["node"].to_numpy(np.int64).tobytes()
        return pd.DataFrame([{"shard": int(rows["shard"].iloc[0]), "ids": ids, **graph.arrays()}])[
            [c.split()[0] for c in _INDEX.split(", ")]
        ]

    return nodes.groupBy("shard").applyInPandas(build, _INDEX)


def search_index(index: DataFrame, shards: int, queries: DataFrame, k: int, beam: int) -> DataFrame:
    """query_id and node: the k best nodes of every shard.  ``queries`` has query_id and vector."""
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = queries.select(
        "query_id", "vector", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"), every(shards).alias("shard")
    )
    # One copy of a shard's graph for each block of queries.
    held = index.withColumn("block", every(blocks))

    def look(rows: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in graphs.iterrows():
            graph, ids = Graph.of(row), np.frombuffer(row["ids"], np.int64)
            for begin in range(0, len(rows), TOGETHER):
                some = rows.iloc[begin : begin + TOGETHER]
                vectors = np.stack(some["vector"].to_numpy())
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                found, _ = graph.nearest(np.c_[unit, np.zeros(len(unit))].astype(np.float32), max(beam, k))
                query = np.repeat(some["query_id"].to_numpy(np.int64), k)
                found = found[:, :k].ravel()
                out.append(pd.DataFrame({"query_id": query, "node": ids[found]})[found >= 0])
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "node": []}, dtype=np.int64)

    pairs = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block"))
    return pairs.applyInPandas(look, "query_id long, node long")


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    beam: int = BEAM,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score (inner product) of the k nearest other rows found.

    ``queries`` has the columns of ``vectors``; a row is no neighbour of its own id.
    """
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    common = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common[0] if common else 0
    same = F.size("vector") == dims
    # Of equal vectors the k + 1 smallest ids, which hold the k first ones besides any query.
    least = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.filter(same).distinct().withColumn("n", least).filter(F.col("n") <= k + 1)
    classes = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"), F.max("norm").alias("norm"))
    classes = written(classes.withColumn("node", F.col("members")[0]), "vectors")
    asked = asked.filter(same).distinct()
    of = written(asked.groupBy("vector").agg(F.min("vec_id").alias("query_id")), "queries")
    # A shard has some thousand nodes; two classes share a node only where ids are repeated.
    dealt, shards = deal(classes.select("node", "vector", "norm"))
    index = written(build_index(dealt.select("shard", "node", "vector")), "index")
    found = search_index(index, shards, of, k + 1, beam).distinct()
    product = F.aggregate(F.zip_with("vector", "other", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    found = (
        found.join(of, "query_id")
        .join(classes.select("node", "members", F.col("vector").alias("other")), "node")
        .select("query_id", "members", product.alias("score"))
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("members")[0])
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    # Queries of equal vectors were searched for once.
    each = asked.join(of, "vector").select("query_id", F.col("vec_id").alias("asked_id"))
    pairs = each.join(found, "query_id").select("asked_id", "score", F.explode("members").alias("vec_id"))
    pairs = pairs.filter("asked_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("asked_id").orderBy(F.desc("score"), "vec_id"))
    return (
        pairs.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select(F.col("asked_id").alias("query_id"), "rank", "vec_id", "score")
    )


def op8_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    vectors = read(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"))
