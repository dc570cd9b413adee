"""Near-duplicate groups by MinHash and sequential Bayesian verification.

1. A document is the set of its distinct five-word shingles, as 64-bit hashes.
   Documents of equal sets are one node, so exact copies cost one row each.
2. Nodes with an equal band of four out of 128 minhashes are candidates: a pair at
   the bound of 0.75 is missed by all 32 bands once in 190,000 times.
3. Candidate pairs compare their signatures 32 positions at a time.  After each
   batch the posterior probability of a similarity at or above the bound is known
   (beta law with a flat prior), and a pair below the miss probability is dropped.
4. Survivors are verified on the full sets, in whole numbers.

A bucket's members are not paired with each other at once.  In the first round each
meets one pivot only, the member with the most company in all of its buckets, as the
original of a group of copies has; that settles most groups.  Pivots have met all
others and leave.  Where the rest of a bucket still spans several components, its
next 8 members are the pivots of a second round, and only members of other components
meet them.  What is open then is settled in one last round: all members outside the
bucket's largest component meet all members of other components.  So there are three
rounds at any bucket size, and no pair that matters is left out.
Pairs meet only if the parities of their hashed shingles in 1,024 bits allow the
bound: bits that differ are shingles not shared, so nothing that could pass is cut.

In the last round a bucket is dealt into cells of some thousand members a side, and
cells into as many tasks as their pairs ask for, so a hot bucket is spread.  Its pairs
grow with the square of a bucket of unlike members, its memory with a cell.
Signatures, sets and labels are written tables.

Empty texts and those without words have no shingles and are linked with nothing.
With fewer words than five, the whole sequence is the one shingle.  Rows that share
an id are one document with several texts, linked as any of them is.  A row
without id is linked with nothing and kept, its component is null.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.common import (
    U64,
    by_slices,
    bytes_of,
    mixed,
    read,
    texts_of,
    words_of,
    written,
)
from floodmark.llm.components import components

SHINGLE_WORDS = 5
BOUND = 0.75
BANDS, ROWS = 32, 4
BATCH = 32
MISS = 1e-6
PARITY_LONGS = 16
# The pivots of a bucket in each round but the last, where all that are left are.
FIRST_PIVOTS = (1, 8)
# The pivots, and the members they meet, in a cell of the last round.
PIVOTS = 2048
# The pairs of a task in the last round, and the most tasks.
TASK_PAIRS = 2**20
MOST_TASKS = 20_000

_SEEDS = np.random.default_rng(11)
_ODD = _SEEDS.integers(1, 2**63, 64).astype(U64) * U64(2) + U64(1)
_FLIP = _SEEDS.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_SPREAD = _SEEDS.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PARITY = [f"p{k}" for k in range(PARITY_LONGS)]
_NODE = "doc_id long, n_shingles long, set_a long, set_b long"


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, at = bytes_of(texts)
    hashes, _, _, first = words_of(data, at)
    n = len(hashes) - size + 1
    rolled = np.zeros(max(n, 0), U64)
    for k in range(size):
        rolled += hashes[k : k + max(n, 0)] * _ODD[k]
    rolled = mixed(rolled)
    sets = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin >= size:
            sets.append(np.unique(rolled[begin : end - size + 1]))
        elif end > begin:
            whole = (hashes[begin:end] * _ODD[: end - begin]).sum(dtype=U64)
            sets.append(mixed(np.array([whole + U64(end - begin)], U64)))
        else:
            sets.append(rolled[:0])
    return sets


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of each permutation over each set, none of them empty."""
    sizes = np.array([len(s) for s in sets])
    begin = np.cumsum(sizes) - sizes
    all_ = np.concatenate(sets)
    low = (all_ >> U64(32)).astype(np.uint32) ^ all_.astype(np.uint32)
    least = np.empty((len(sets), len(_FLIP)), np.uint32)
    value = np.empty_like(low)
    for k, (flip, spread) in enumerate(zip(_FLIP, _SPREAD)):
        np.bitwise_xor(low, flip, out=value)
        value *= spread
        value ^= value >> np.uint32(15)
        least[:, k] = np.minimum.reduceat(value, begin)
    return least


def binaries(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def parities_of(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the parity of its shingles in each of 1,024 classes, as 16 longs."""
    bits = 64 * PARITY_LONGS
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = owner * bits + (np.concatenate(sets) % U64(bits)).astype(np.int64)
    odd = np.bincount(place, minlength=len(sets) * bits) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(sets), PARITY_LONGS)


def signatures(texts: DataFrame) -> DataFrame:
    """Of each row the number of its shingles, two digests and the parities of the set, the signature."""

    def sign(part):
        sets = shingle_sets(part.column("text"))
        counts = np.array([len(s) for s in sets], np.int64)
        some = [s for s in sets if len(s)]
        signs = iter([row.tobytes() for row in signatures_of(some)] if some else [])
        parity = iter(parities_of(some).tolist() if some else [])
        a = np.array([s.sum(dtype=U64) for s in sets], U64)
        b = np.array([mixed(s).sum(dtype=U64) for s in sets], U64)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(counts), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
             pa.array([next(parity) if n else None for n in counts], pa.list_(pa.int64())),
             binaries([next(signs) if n else None for n in counts])],
            ["doc_id", "n_shingles", "set_a", "set_b", "parity", "signature"],
        )

    return texts.mapInArrow(by_slices(sign), f"{_NODE}, parity array<long>, signature binary")


def full_sets(texts: DataFrame) -> DataFrame:
    """node and shingles (sorted 64-bit hashes as bytes) of each row."""

    def sets(part):
        found = shingle_sets(part.column("text"))
        return pa.RecordBatch.from_arrays(
            [part.column("node"), binaries([s.tobytes() for s in found])], ["node", "shingles"]
        )

    return texts.mapInArrow(by_slices(sets), "node long, shingles binary")


def band_keys(nodes: DataFrame) -> DataFrame:
    """node and key for each band of its signature."""

    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sign = matrix(batch.column("signature"))
            wide = sign.reshape(len(sign), BANDS, ROWS).astype(U64)
            key = np.full((len(sign), BANDS), 0, U64) + np.arange(BANDS, dtype=U64) * _ODD[40]
            for r in range(ROWS):
                key = mixed(key ^ (wide[:, :, r] * _ODD[41 + r]))
            node = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(key.ravel().view(np.int64))], ["node", "key"]
            )

    return nodes.select("node", "signature").mapInArrow(keys, "node long, key long")


def matrix(signs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signs.to_pylist()), np.uint32).reshape(len(signs), -1)


def least_matches(bound: float, miss: float, total: int, batch: int) -> list[tuple[int, int]]:
    """After how many positions how many must match for a pair to stay.

    With m of n matching and a flat prior, similarity follows Beta(m+1, n-m+1),
    which exceeds the bound with the probability of at most m successes in n+1
    trials at the bound.
    """
    kept = []
    for n in range(batch, total + 1, batch):
        above, m = 0.0, -1
        while above < miss:
            m += 1
            above += comb(n + 1, m) * bound**m * (1 - bound) ** (n + 1 - m)
        kept.append((n, m))
    return kept


def likely(pairs: DataFrame, bound: float, miss: float) -> DataFrame:
    """The pairs a, b whose signatures leave a similarity at the bound possible."""
    steps = least_matches(bound, miss, BANDS * ROWS, BATCH)

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = matrix(batch.column("sign_a")), matrix(batch.column("sign_b"))
            alive = np.arange(len(left))
            matches = np.zeros(len(left), np.int64)
            for n, least in steps:
                part = slice(n - BATCH, n)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return pairs.mapInArrow(compare, "a long, b long")


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sets reach the bound, counted in full."""

    def compare(batches):
        for batch in batches:
            keep = []
            for n in range(batch.num_rows):
                left = np.frombuffer(batch.column("set_a")[n].as_buffer(), U64)
                right = np.frombuffer(batch.column("set_b")[n].as_buffer(), U64)
                short, long = sorted((left, right), key=len)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                both = int((long[at] == short).sum())
                if 100 * both >= percent * (len(left) + len(right) - both):
                    keep.append(n)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return pairs.mapInArrow(compare, "a long, b long")


def _with_both(pairs: DataFrame, of: DataFrame, column: str, names: tuple[str, str]) -> DataFrame:
    """The pairs with what ``of`` holds of either end."""
    for end, name in zip("ab", names):
        pairs = pairs.join(of.select(F.col("node").alias(end), F.col(column).alias(name)), end)
    return pairs.select("a", "b", *names)


def possible(percent: int):
    """Whether n and p0 to p15, and the same with _a, allow a similarity at the bound.

    The parities are columns, not an array: with an array's bounds checks the join's code
    was over the 8,000 bytes up to which the JVM compiles a method.
    """
    differ = [F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_a"))) for p in _PARITY]
    return sum(differ, F.lit(0)) * (100 + percent) <= (F.col("n") + F.col("n_a")) * (100 - percent)


def first_pivots(at: DataFrame, number: int) -> DataFrame:
    """Of each bucket the members with most company, all columns but the key with _a."""
    # A rank up to a small number is cut to it in the map tasks already.
    rank = F.dense_rank().over(Window.partitionBy("key").orderBy(F.desc("company"), "node"))
    return _as_pivots(at.withColumn("rank", rank).filter(F.col("rank") <= number).drop("rank"))


def _as_pivots(at: DataFrame, *keys: str) -> DataFrame:
    kept = ("key", *keys)
    return at.select(*kept, *[F.col(c).alias(f"{c}_a") for c in at.columns if c not in kept])


def pairs_with(at: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """The pairs of pivots and later members of other components that may reach the bound."""
    later = "company < company_a or (company = company_a and node > node_a)"
    pairs = at.join(pivots, "key").filter("label <> label_a").filter(later)
    return pairs.filter(possible(percent)).select(F.col("node_a").alias("a"), F.col("node").alias("b"))


def pairs_of_rest(at: DataFrame, percent: int) -> DataFrame:
    """All pairs within a bucket, but of different components, that may reach the bound.

    Members of the bucket's largest component are no pivots.  Pivots are dealt into
    ``rows`` and members into ``columns`` of about PIVOTS each; a cell is one of each.
    """
    counts = at.groupBy("key", "label").count()
    sizes = counts.groupBy("key").agg(
        F.max(F.struct("count", "label")).alias("most"), F.sum("count").alias("all")
    )
    outside = F.col("all") - F.col("most.count")
    sizes = written(
        sizes.select(
            "key",
            F.col("most.label").alias("main"),
            F.ceil(outside / PIVOTS).alias("rows"),
            F.ceil(F.col("all") / PIVOTS).alias("columns"),
            (outside.cast("double") * F.col("all")).alias("pairs"),
        ),
        "sizes",
    )
    total = sizes.agg(F.sum("pairs")).first()[0]
    tasks = int(min(total // TASK_PAIRS + 1, MOST_TASKS))

    def dealt(into):
        return F.pmod(F.xxhash64("node"), into)

    def each(of):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    cell = ("key", "row", "column")
    at = at.join(sizes.drop("pairs"), "key")
    pivots = at.filter("label <> main").withColumn("row", dealt("rows")).withColumn("column", each("columns"))
    members = at.withColumn("column", dealt("columns")).withColumn("row", each("rows"))
    pivots = _as_pivots(pivots.drop("company", "main", "rows", "columns"), "row", "column")
    members = members.drop("company", "rows", "columns")
    pairs = (
        # A number of tasks that is given is not lowered for a small number of bytes.
        members.repartition(tasks, *cell)
        .join(pivots.repartition(tasks, *cell).hint("merge"), list(cell))
        .filter("label <> label_a")
        .filter("label = main or node > node_a")
        .filter(possible(percent))
    )
    return pairs.select(F.col("node_a").alias("a"), F.col("node").alias("b"))


def near_duplicates(
    docs: DataFrame,
    percent: int = 75,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row."""
    texts = texts_of(docs, id_col, text_col)
    signed = written(signatures(texts), "signatures")
    digest = ["n_shingles", "set_a", "set_b"]
    some = signed.filter("doc_id is not null and n_shingles > 0")
    # Equal sets have equal signatures, so any of them will do.
    nodes = written(
        some.groupBy(*digest).agg(
            F.min("doc_id").alias("node"),
            F.first("parity").alias("parity"),
            F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    members = some.select("doc_id", *digest).join(nodes.select("node", *digest), digest)
    members = members.select("doc_id", "node")
    # Documents with several texts join the classes of all of them.
    shared = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    several = shared.filter("a < z").select("doc_id", "a")
    same = members.join(several, "doc_id").select("a", F.col("node").alias("b"))

    keys = band_keys(nodes)
    full = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    full = full.filter("low < high").select("key")
    buckets = written(keys.join(full, "key").distinct(), "buckets")
    # Company in all buckets; the pivots of a bucket are those of its members with most.
    sizes = buckets.groupBy("key").agg((F.count("*") - 1).alias("others"))
    company = buckets.join(sizes, "key").groupBy("node").agg(F.sum("others").alias("company"))
    company = written(company, "company")
    signs = nodes.select("node", "signature")
    parity = [F.col("parity")[k].alias(p) for k, p in enumerate(_PARITY)]
    known = nodes.select("node", F.col("n_shingles").alias("n"), *parity).join(company, "node")
    busy = company.select("node")
    shingles = None
    labels = written(components(same), "labels")
    for number in (*FIRST_PIVOTS, None):
        label = F.coalesce("component", "node").alias("label")
        at = buckets.join(labels, "node", "left").select("key", "node", label)
        open_ = at.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high")
        )
        open_ = open_.filter("low < high").select("key")
        at = written(at.join(open_, "key").join(known, "node"), "open")
        if at.isEmpty():
            break
        if number:
            pivots = first_pivots(at, number)
            pairs = pairs_with(at, pivots, percent)
            met = pivots.select("key", F.col("node_a").alias("node"))
            buckets = at.join(met, ["key", "node"], "left_anti").select("key", "node").distinct()
        else:
            pairs = pairs_of_rest(at, percent)
        both = _with_both(pairs.distinct(), signs, "signature", ("sign_a", "sign_b"))
        pairs = written(likely(both, percent / 100, miss), "likely")
        if shingles is None:
            of = texts.withColumnRenamed("doc_id", "node").join(busy, "node")
            shingles = written(full_sets(of), "sets")
        linked = verified(_with_both(pairs, shingles, "shingles", ("set_a", "set_b")), percent)
        linked = written(linked, "linked")
        if linked.isEmpty():
            continue
        old = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
        labels = written(components(linked.union(old)), "labels")

    label = F.coalesce("component", "node")
    found = members.join(labels, "node", "left").groupBy("doc_id").agg(F.min(label).alias("label"))
    component = F.coalesce("label", "doc_id")
    return signed.join(found, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the group of near duplicates each is in."""
    return near_duplicates(read(spark, sf_dir, "documents"))
