"""The Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cumulus.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return digest(*map(field, (r[0], r[3], r[2], r[4], text)))


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + arity]) for i in range(0, len(last), arity)])
    return levels


def walk(levels, at, arity):
    for level in levels[:-1]:
        lo = at // arity * arity
        yield "".join(level[lo:at]), "".join(level[at + 1:lo + arity])
        at //= arity


def expected(rows, arity=8):
    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append(r)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    for p in parts:
        parts[p].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {p: tree([leaf(r, r[1]) for r in parts[p]], arity) for p in parts}
    top = tree([trees[p][-1][0] for p in order], arity) if order else []
    out = []
    for i, p in enumerate(order):
        for at, r in enumerate(parts[p]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            path = [*walk(trees[p], at, arity), *walk(top, i, arity)]
            h = leaf(r, text)
            for lo, hi in path:
                h = digest(lo, h, hi)
            out.append((r[0], leaf(r, r[1]), trees[p][-1][0], top[-1][0], digest(*[a + b for a, b in path]), h,
                        h == top[-1][0]))
    return out


def key(t):
    return str(t)


def run(spark, rows, arity=8, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in extra:
        df = df.withColumn(c, F.lit("x"))
    return sorted(map(tuple, manifest.verification(df, arity).collect()), key=key)


def rows_of(n, langs):
    return [(i * 7 % 1009 + (i // 1009) * 2000, f"Text Ö {i % 50} ABC", langs[i % len(langs)], f"s{i % 3}", i)
            for i in range(n)]


@pytest.mark.parametrize("n, langs, arity", [
    (1, ["en"], 8), (9, ["en"], 8), (600, ["en", "de", "é", None], 8),
    (40, [f"l{i:02d}" for i in range(20)], 8), (37, ["en", "de", "fr"], 2)])
def test_manifest_equals_recomputation(spark, n, langs, arity):
    rows = rows_of(n, langs)
    assert run(spark, rows, arity) == sorted(expected(rows, arity), key=key)


def test_nulls_repeats_ties_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (5, "A", "en", None, 1), (5, "A", "en", None, 1),
            (5, "B", "en", None, 1), (2, "x" * 200000, "en", "s", None)] + [(7, "Same", "en", "s", 4)] * 30
    extra = ["key", "idx", "n", "h", "part", "leaf", "path", "_salt", "_pid", "before", "after", "found", "root", "id"]
    assert run(spark, rows, extra=extra) == sorted(expected(rows), key=key)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_tampering_is_found_exactly_where_text_changed(spark):
    rows = rows_of(200, ["en", "de"])
    got = {r[0]: r[-1] for r in run(spark, rows)}
    assert got == {r[0]: zlib.crc32(str(r[0]).encode()) % 3 != 0 for r in rows}


def test_a_part_of_all_rows_is_dealt_over_many_tasks(spark):
    rows = spark.range(4000).select(F.lit("one").alias("part"), F.col("id"), F.lit("h").alias("h"))
    out = manifest.numbered(rows, "part", "id")
    assert out.where("idx <> id OR n <> 4000").count() == 0
    sorted_rows = rows.withColumn("_salt", F.rand(1)).repartitionByRange(8, "part", "id", "_salt")
    assert sorted_rows.groupBy(F.spark_partition_id()).count().count() > 4
