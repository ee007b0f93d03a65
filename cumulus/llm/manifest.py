"""Merkle dataset manifest: a tree of digests over a table's rows.

Each row is a leaf. Leaves are numbered inside their part (a column's value)
by key, every ``arity`` consecutive nodes become their parent until one node,
the part's subroot, is left; the subroots in order of their part become the
root in the same way. A level is one sibling-shift self-join: each node is
sent to the computed indices of its siblings (index XOR 1 for a binary tree,
slot offsets modulo the arity otherwise), an equi join brings every node its
run's others, and the rows of slot zero emit the parents. Proofs go the other
way, a join of nodes with their parent a level.

Numbering sorts by range and adds up the counts of the sorted partitions, so
a part that holds most rows is spread over many tasks; joins are on (part,
index), which no part can skew. Levels are written tables.

Defined results: H is lowercase hex SHA-256 over concatenated strings; a null
value is hashed as ``-``, any other as its UTF-8 length, ``:`` and itself. A
null part is a part of its own, before the others. A lone leaf is its own
subroot and a lone subroot the root, unhashed. Null keys come first; rows with
equal keys are ordered by leaf, so repeated rows get neighbouring leaves and
their order can't matter. An empty table has no nodes and no proofs. Columns
that are not asked for are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.llm.common import stored

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def part_key(part: Column) -> Column:
    """The part as a string that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, part: str, *order: str, name: str = "manifest") -> DataFrame:
    """``rows`` with idx (from 0, by ``order`` within ``part``) and n (rows of
    the part). Sorted by range; a task numbers its own rows, and the counts
    by (partition, part) give the offsets."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.rand(11))  # equal rows may be spread
    dealt = salted.repartitionByRange(width, part, *order, "_salt").withColumn("_pid", F.spark_partition_id())
    kept = stored(dealt, name + "-sorted")
    counts = kept.groupBy(part, "_pid").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, "_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                            F.sum("_c").over(Window.partitionBy(part)).alias("n"))
    here = Window.partitionBy(part, "_pid").orderBy(*order, "_salt")
    own = kept.withColumn("_r", F.row_number().over(here) - 1)
    return own.join(offsets, [part, "_pid"]).withColumn("idx", F.col("_off") + F.col("_r")) \
        .drop("_pid", "_salt", "_r", "_off")


def shifted(idx: Column, arity: int) -> Column:
    """The indices of a node's siblings."""
    if arity == 2:
        return F.array(idx.bitwiseXOR(F.lit(1)))
    slot = F.pmod(idx, F.lit(arity))
    return F.transform(F.sequence(F.lit(1), F.lit(arity - 1)),
                       lambda k: idx - slot + F.pmod(slot + k, F.lit(arity)))


def with_siblings(nodes: DataFrame, arity: int, *more: str) -> DataFrame:
    """Nodes (key, idx, n, h) with the digests of their run's others to the
    left and to the right, concatenated: before, after."""
    sent = nodes.where("n > 1").select("key", F.explode(shifted(F.col("idx"), arity)).alias("idx"),
                                       F.col("idx").alias("at"), F.col("h").alias("d"))
    met = nodes.join(sent, ["key", "idx"], "left")
    side = F.struct("at", "d")
    grouped = met.groupBy("key", "idx", "n", "h", *more).agg(
        F.sort_array(F.collect_list(F.when(F.col("at") < F.col("idx"), side))).alias("lo"),
        F.sort_array(F.collect_list(F.when(F.col("at") > F.col("idx"), side))).alias("hi"))
    return grouped.select("key", "idx", "n", "h", *more, F.array_join("lo.d", "").alias("before"),
                          F.array_join("hi.d", "").alias("after"))


def climb(nodes: DataFrame, arity: int, *more: str, name: str = "manifest") -> list[DataFrame]:
    """The levels from ``nodes`` up, each a written table (key, idx, n, h,
    before, after); a key's last level has its one node with n = 1. The first
    also carries the columns ``more``."""
    levels = [stored(with_siblings(nodes, arity, *more), f"{name}-level0")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        up = levels[-1].where(F.pmod("idx", F.lit(arity)) == 0).where("n > 1").select(
            "key", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(F.col("h"), F.col("after")).alias("h"))
        levels.append(stored(with_siblings(up, arity), f"{name}-level{len(levels)}"))
        most = -(-most // arity)
    return levels


def descend(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The nodes of the first level with the columns of ``tops`` (key, path,
    others) and path: (before, after) a level, from the node to the top."""
    others = [c for c in tops.columns if c not in ("key", "path")]
    below = None
    for level in reversed(levels):
        done = level.where("n = 1").join(tops, "key")
        if below is not None:
            above = below.select("key", F.col("idx").alias("up"), *others, "path")
            joined = level.where("n > 1").withColumn("up", F.expr(f"idx div {arity}")).join(above, ["key", "up"])
            step = F.concat(F.array(F.struct("before", "after")), "path")
            done = joined.withColumn("path", step).select(done.columns).unionByName(done)
        below = done
    return below


@dataclass
class Manifest:
    """levels: nodes (key, idx, n, h, before, after) by height, the first with
    the leaves' own columns; subroots: key, subroot, root, path."""
    levels: list[DataFrame]
    subroots: DataFrame
    arity: int

    def root(self) -> DataFrame:
        return self.subroots.select("root").distinct()

    def proofs(self) -> DataFrame:
        """One row a leaf: its columns, subroot, root and path."""
        return descend(self.levels, self.subroots, self.arity)


def build(leaves: DataFrame, *more: str, arity: int = ARITY, name: str = "manifest") -> Manifest:
    """The tree over ``leaves``: part, key, leaf and the columns ``more``."""
    rows = stored(leaves.select(part_key(F.col("part")).alias("part"), F.col("key").alias("id"),
                                F.col("leaf").alias("h"), *more), name + "-leaves")
    nodes = numbered(rows, "part", "id", "h", name=name).withColumnRenamed("part", "key")
    levels = climb(nodes, arity, "id", *more, name=name)
    ends = levels[0].where("n = 1").select("key", "h")
    for level in levels[1:]:
        ends = ends.unionByName(level.where("n = 1").select("key", "h"))
    ends = numbered(ends.withColumn("all", F.lit("")), "all", "key", "h", name=name + "-top")
    top = climb(ends.select(F.col("all").alias("key"), "idx", "n", "h", F.col("key").alias("part")), arity, "part",
                name=name + "-top")
    roots = top[-1].where("n = 1").select("key", F.col("h").alias("root")).withColumn(
        "path", F.array().cast("array<struct<before:string,after:string>>"))
    subroots = stored(descend(top, roots, arity).select(F.col("part").alias("key"), F.col("h").alias("subroot"),
                                                        "root", "path"), name + "-subroots")
    return Manifest(levels, subroots, arity)


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along a path of siblings; a level
    without siblings (a run of one) is hashed all the same."""
    return F.aggregate(path, start, lambda h, p: digest(p["before"], h, p["after"]))


def tampered(text: Column, key: Column) -> Column:
    """Lower-cases A-Z where 3 divides the key's CRC-32."""
    hit = F.crc32(key.cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def verification(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """The manifest of documents, every leaf's proof, and the verdict on rows
    that were tampered with afterwards."""
    changed = tampered(F.col("text"), F.col("doc_id"))
    leaves = docs.select(F.col("lang").alias("part"), F.col("doc_id").alias("key"),
                         leaf(*[F.col(f) for f in FIELDS]).alias("leaf"),
                         leaf(*[changed if f == "text" else F.col(f) for f in FIELDS]).alias("found"))
    out = build(leaves, "found", arity=arity).proofs()
    out = out.withColumn("folded_root", folded(F.col("found"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), F.col("h").alias("leaf"), "subroot", "root",
                      proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


ORACLE_SQL = r"""
WITH RECURSIVE
tab0(i, k, v) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM tab0 WHERE k < 8),
tab AS (SELECT i, v FROM tab0 WHERE k = 8),
crc(id, s, c) AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT id, substr(s, 2), xor(c // 256, v) FROM crc JOIN tab ON i = xor(c % 256, ascii(s)::BIGINT) WHERE s <> ''),
hit AS (SELECT id FROM crc WHERE s = '' AND (4294967295 - c) % 3 = 0),
d AS (SELECT doc_id, lang, coalesce('=' || lang, '-') AS key,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
    CASE WHEN doc_id IN (SELECT id FROM hit) THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS bad
  FROM documents),
leaves AS (SELECT doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(bad) || ':' || bad, '-')) AS found FROM d),
lf AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY key) AS n FROM leaves),
nodes(key, lvl, idx, n, h) AS (
  SELECT key, 0, idx, n, leaf FROM lf
  UNION ALL SELECT key, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1
  GROUP BY key, lvl, idx // 8, (n + 7) // 8),
subs AS (SELECT key, h, row_number() OVER (ORDER BY encode(key)) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, idx, n, h) AS (
  SELECT 0, idx, n, h FROM subs
  UNION ALL SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1
  GROUP BY lvl, idx // 8, (n + 7) // 8),
alln AS (
  SELECT key, lvl, idx, n, h FROM nodes WHERE n > 1
  UNION ALL SELECT key, 1000 + lvl, idx, n, h FROM tops, (SELECT DISTINCT key FROM subs) WHERE n > 1),
sib AS (
  SELECT a.key, a.lvl, a.idx, a.n, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lo,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS hi
  FROM alln a JOIN alln b ON a.key = b.key AND a.lvl = b.lvl AND a.idx // 8 = b.idx // 8 GROUP BY ALL),
walk(doc_id, key, leaf, lvl, idx, n, proof, fold) AS (
  SELECT lf.doc_id, lf.key, leaf, CASE WHEN lf.n > 1 THEN 0 ELSE 1000 END, CASE WHEN lf.n > 1 THEN lf.idx ELSE s.idx END,
    CASE WHEN lf.n > 1 THEN lf.n ELSE s.n END, '', found FROM lf JOIN subs s USING (key)
  UNION ALL
  SELECT w.doc_id, w.key, leaf, CASE WHEN w.lvl < 1000 AND w.n <= 8 THEN 1000 ELSE w.lvl + 1 END,
    CASE WHEN w.lvl < 1000 AND w.n <= 8 THEN s.idx ELSE w.idx // 8 END,
    CASE WHEN w.lvl < 1000 AND w.n <= 8 THEN s.n ELSE (w.n + 7) // 8 END, proof || lo || hi, sha256(lo || fold || hi)
  FROM walk w JOIN sib x ON w.key = x.key AND w.lvl = x.lvl AND w.idx = x.idx JOIN subs s ON w.key = s.key WHERE w.n > 1)
SELECT w.doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = r.h AS verified
FROM walk w JOIN subs s ON w.key = s.key, (SELECT h FROM tops WHERE n = 1) r WHERE w.n = 1 AND w.lvl >= 1000
"""
