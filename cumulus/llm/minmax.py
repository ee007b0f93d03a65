"""MinHash near-dedup with min-max hashing.

Each permutation keeps both its minimum and its maximum, so 64 hash
evaluations a shingle give 128 signature values. Bands of four values
(two permutations' minima and maxima) bring candidates together: with 32
bands a pair at similarity 0.85 is missed with probability below 1e-10.
Candidate links only say who must be compared; the links themselves are
confirmed on the full shingle sets.

Defined results: null or word-less text has an empty set and links with
nothing; a text of fewer than ``width`` words is one shingle; equal sets
always link; rows are judged one by one, so a repeated doc_id gives a row
each, and of two texts under one id each has its own links and group; a null
doc_id never links and is its own group (null), kept. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.llm.common import components, emit, runs, stored, whole_row, wide
from cumulus.llm.textsets import mix, overlap, shingle_set

PERMUTATIONS = 64
BAND_VALUES = 4
#: Shingles that one comparison task holds (about 100 MB in Python).
TASK_SHINGLES = 1_000_000

_SIG = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("n_shingles", pa.int64()),
                  ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SIG_DDL = "doc_id bigint, text_key string, n_shingles bigint, set_key binary, bands array<bigint>"
_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_CHUNK = 8192


def multipliers(n: int) -> np.ndarray:
    """n odd 64-bit multipliers: x -> m * x permutes the 64-bit integers."""
    return np.random.default_rng(20240607).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_max(s: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation, interleaved."""
    lo = np.full(len(mult), np.iinfo(np.uint64).max, dtype=np.uint64)
    hi = np.zeros(len(mult), dtype=np.uint64)
    for at in range(0, len(s), _CHUNK):
        y = mult[:, None] * s[None, at : at + _CHUNK]
        np.minimum(lo, y.min(axis=1), out=lo)
        np.maximum(hi, y.max(axis=1), out=hi)
    return np.stack([lo, hi], axis=1).ravel()


def band_keys(sig: np.ndarray, values: int) -> np.ndarray:
    """One 64-bit key for each band of ``values`` signature entries."""
    g = sig[: len(sig) // values * values].reshape(-1, values)
    acc = np.arange(1, len(g) + 1, dtype=np.uint64)
    for k in range(values):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + g[:, k])
    return acc.view(np.int64)


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def text_key() -> Column:
    return F.md5("text")


def signatures(docs: DataFrame, width: int, permutations: int, band_values: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = multipliers(permutations)
        for batch in batches:
            rows = []
            for doc, text, key in zip(*map(pa.Array.to_pylist, batch.columns)):
                s = shingle_set(text, width)
                if len(s):
                    rows.append((doc, key, len(s), set_key(s), band_keys(min_max(s, mult), band_values)))
                else:
                    rows.append((doc, key, 0, None, None))
            yield emit(rows, _SIG)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_key().alias("text_key")) \
        .mapInArrow(run, _SIG_DDL)


def _linked(na: int, nb: int, inter: int, percent: int) -> bool:
    return 100 * inter >= percent * (na + nb - inter)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _intersections(sets: list[np.ndarray]):
    """i -> sizes of the intersections of set i with every set, through one
    inverted index of the shingles held by this task."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    owner = owner[order]
    keys, start, count = np.unique(flat[order], return_index=True, return_counts=True)

    def of(i: int) -> np.ndarray:
        r = np.searchsorted(keys, sets[i])
        r = r[count[r] > 1]
        n = count[r]
        total = int(n.sum())
        at = np.repeat(start[r] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total) if total else []
        return np.bincount(owner[at] if total else [], minlength=len(sets))

    return of


def _group_edges(rows: list[dict], width: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the exact links among one task's nodes. Rows of
    side 1 are compared with all, rows of side 0 only with side 1. A row whose
    text has another set than its node (another text of the same id) is none."""
    known: dict[int, np.ndarray] = {}
    sides: dict[int, int] = {}
    for r in rows:
        if r["node"] not in known:
            s = shingle_set(r["text"], width)
            if set_key(s) != r["set_key"]:
                continue
            known[r["node"]] = s
        sides[r["node"]] = max(r["side"], sides.get(r["node"], 0))
    nodes = sorted(known)
    sets, side = [known[d] for d in nodes], [sides[d] for d in nodes]
    forest = _Forest(len(nodes))
    size = np.array([len(s) for s in sets])
    if len(nodes) <= 6:
        for i in range(len(nodes)):
            for j in range(i):
                if (side[i] or side[j]) and forest.find(i) != forest.find(j) and \
                        _linked(size[i], size[j], overlap(sets[i], sets[j]), percent):
                    forest.join(i, j)
    else:
        inter = _intersections(sets)
        for i in range(len(nodes)):
            if not side[i]:
                continue
            n = inter(i)
            for j in np.nonzero((100 * n >= percent * (size[i] + size - n)) & (n > 0))[0].tolist():
                forest.join(i, j)
    return [(d, nodes[forest.find(i)]) for i, d in enumerate(nodes) if forest.find(i) != i]


def _compare(members: DataFrame, docs: DataFrame, keys: list[str], width: int, percent: int) -> DataFrame:
    """Exact links inside each group of ``keys``; members has doc_id, node,
    set_key, side and the keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, *keys):
            edges = _group_edges(group, width, percent)
            if edges:
                yield emit(edges, _EDGE)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # always a merge join: a broadcast below some size would only make the
    # shuffle jump when the members outgrow it
    rows = wide(texts.join(members.hint("merge"), "doc_id"), *keys).sortWithinPartitions(*keys)
    return rows.select("text", "node", "set_key", "side", *keys).mapInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame, width: int, percent: int, permutations: int = PERMUTATIONS,
            band_values: int = BAND_VALUES, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """One row a row of ``docs``: doc_id, text_key, n_shingles and component,
    the smallest (doc_id, text_key) reachable; null without a set or an id.

    1. signatures; equal sets collapse to one node, which stands for the
       smallest doc_id that has the set;
    2. in each band bucket every node links with the smallest one, which
       gives clusters of nodes that may be linked (a linear number of
       candidate links, whatever a bucket's size);
    3. each cluster is compared exactly inside tasks of at most about
       ``task_shingles`` shingles, through an inverted index and without
       emitting pairs; the cluster's first node joins every chunk;
    4. in clusters of several chunks, nodes outside the largest component
       are compared with every chunk, so that no link is lost.
    """
    sig = stored(signatures(docs, width, permutations, band_values), "minmax-sig")
    sets = (sig.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key")
            .agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.max("n_shingles").alias("n")))
    sets = stored(sets.select("set_key", "rep.*", "n", F.monotonically_increasing_id().alias("node")), "minmax-sets")
    # the band keys of equal sets are equal, so any member's row will do
    reps = sig.where("n_shingles > 0").select("doc_id", "text_key", "bands").join(
        sets.select("doc_id", "text_key", "node"), ["doc_id", "text_key"])
    banded = reps.select("node", F.explode("bands").alias("band"))  # full repeats of a row do no harm
    firsts = banded.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last")) \
        .where("first < last").select("band", "first")
    pairs = banded.join(firsts, "band").where("node > first").select(
        F.col("node").alias("a"), F.col("first").alias("b"))
    cluster = components(pairs, name="minmax-clusters")
    members = stored(cluster.join(sets, "node")
                     .select("node", "doc_id", "set_key", F.col("root").alias("cluster"), "n").distinct(),
                     "minmax-members")
    weight = members.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(task_shingles)).cast("int").alias("chunks"))
    chunked = members.join(weight, "cluster")
    first = chunked.node == chunked.cluster
    one = chunked.select("doc_id", "node", "set_key", "cluster", F.lit(1).alias("side"), F.explode(
        F.when(first, F.sequence(F.lit(0), F.col("chunks") - 1))
        .otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))).alias("chunk"))
    edges = stored(_compare(one, docs, ["cluster", "chunk"], width, percent), "minmax-edges")
    large = stored(chunked.where("chunks > 1"), "minmax-large")
    if not large.isEmpty():
        edges = _rest(edges, large, docs, width, percent, task_shingles)
    linked = components(edges, name="minmax-components").join(sets.select("node", "doc_id", "text_key"), "node")
    least = F.struct("doc_id", "text_key")
    smallest = linked.groupBy("root").agg(F.min(least).alias("component"))
    of_node = linked.join(smallest, "root").select("node", "component")
    of_set = sets.join(of_node, "node", "left").select("set_key", F.coalesce("component", least).alias("component"))
    return sig.withColumn("set_key", F.when(F.col("doc_id").isNotNull(), F.col("set_key"))).join(
        of_set, "set_key", "left").select("doc_id", "text_key", "n_shingles", "component")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, permutations: int = PERMUTATIONS,
                    band_values: int = BAND_VALUES, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable over links of Jaccard >= percent/100), kept."""
    out = classes(docs, width, percent, permutations, band_values, task_shingles)
    out = out.select("doc_id", "n_shingles", F.coalesce("component.doc_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id's, and if several
    of its rows are in the group, the one whose text, then whose other columns
    hash lowest. Rows without words or without an id all stay."""
    out = classes(docs, width, percent).where("component IS NOT NULL")
    verdict = out.groupBy("doc_id", "text_key").agg(
        F.min(F.struct("doc_id", "text_key") == F.col("component")).alias("kept"))
    others = [F.col("row").getField(c).cast("string") for c in docs.columns]
    rows = docs.select(whole_row(docs), F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"))
    rows = rows.join(verdict.hint("merge"), ["doc_id", "text_key"], "left").where("kept OR kept IS NULL")
    # rows that repeat id and text lie together already; the window only counts them
    again = Window.partitionBy("doc_id", "text_key").orderBy(F.xxhash64(*others))
    rows = rows.withColumn("again", F.row_number().over(again)).where("kept IS NULL OR again = 1")
    return rows.select("row.*")


def _rest(edges: DataFrame, large: DataFrame, docs: DataFrame, width: int, percent: int,
          task_shingles: int) -> DataFrame:
    """Links of nodes outside a large cluster's largest component with nodes
    of any chunk."""
    root = components(edges, name="minmax-partial").select("node", "root")
    at = stored(large.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "minmax-at")
    most = at.groupBy("cluster", "root").count().groupBy("cluster").agg(
        F.max_by("root", F.struct("count", -F.col("root"))).alias("main"))
    out = at.join(most, "cluster").where("root <> main")
    parts = out.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(task_shingles)).cast("int").alias("parts"))
    outside = out.join(parts, "cluster").select(
        "doc_id", "node", "set_key", "cluster", F.lit(1).alias("side"),
        F.pmod(F.hash("node"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    every = at.join(parts, "cluster").select(
        "doc_id", "node", "set_key", "cluster", F.lit(0).alias("side"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("node"), "chunks").cast("int").alias("chunk"))
    more = _compare(outside.unionByName(every), docs, ["cluster", "part", "chunk"], width, percent)
    return stored(edges.unionByName(more), "minmax-all-edges")
