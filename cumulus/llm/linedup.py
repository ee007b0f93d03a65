"""Line de-duplication by overlapping three-line windows.

The non-blank lines of a document (split at \\n, trimmed of white space for
comparison) form one window for each three consecutive ones. A window that
occurred before, in a smaller doc_id or earlier in the same text, is a later
occurrence; the lines that later occurrences cover are merged and removed.
Every removed line stands in an earlier window, so one copy always stays.

Defined results: fewer than three non-blank lines, empty or null text: left
as is (null: no lines); rows that repeat doc_id and text are one document
and stand or fall alike; null doc_id sorts first; if all non-blank lines go,
the text becomes empty. Other columns pass through; empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cumulus.llm.common import unpacked, whole_row

WINDOW = 3
BLANK = r"^[\x20\x09-\x0D]*$"
_TRIM = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
_LOWEST = -(2**63)


def _key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("_k1"), F.xxhash64("text").alias("_k2")]


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row a window: _k1, _k2 (document), at (first line's number), lines
    (its line numbers) and a 128-bit hash h1, h2."""
    body = docs.where("text IS NOT NULL").select(
        *_key(), F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(
            i.alias("i"), F.regexp_replace(x, _TRIM, "").alias("x"))), lambda s: s["x"] != "").alias("c"))
    n = F.size("c") - (width - 1)
    body = body.where(n > 0).select("_k1", "_k2", "c", F.explode(F.sequence(F.lit(0), n - 1)).alias("j"))
    at = [F.get(F.col("c"), F.col("j") + k) for k in range(width)]
    lines = [a["x"] for a in at]
    return body.select("_k1", "_k2", at[0]["i"].alias("at"), F.array(*[a["i"] for a in at]).alias("lines"),
                       F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit("second"), *lines).alias("h2"))


def covered(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """The merged line numbers that later occurrences cover, a row for each
    document that has any: _k1, _k2, cut."""
    w = windows(docs, width)
    here = F.struct("_k1", "_k2", "at")
    firsts = w.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.max(here).alias("last")) \
        .where("first < last").select("h1", "h2", "first")
    later = w.join(firsts.hint("merge"), ["h1", "h2"]).where(here > F.col("first"))
    return later.select("_k1", "_k2", F.explode("lines").alias("i")).groupBy("_k1", "_k2").agg(
        F.collect_set("i").alias("cut"))


def rewritten(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Each input row as a struct ``row``, beside its new text, n_lines and
    n_removed; no name of the input can clash with one of these."""
    cut = covered(docs, width)
    keyed = docs.select(whole_row(docs), *_key())
    both = keyed.join(cut.hint("merge"), ["_k1", "_k2"], "left")
    text = F.col("row").getField("text")
    lines = F.split(text, "\n", -1)
    n = F.when(text.isNull(), 0).otherwise(F.size(lines))
    both = both.select("row", "cut", lines.alias("lines"), n.cast("bigint").alias("n_lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("cut"))
    left = F.transform(stay, lambda i: F.get(F.col("lines"), i))
    blank = F.forall(left, lambda x: x.rlike(BLANK))
    new = F.when(F.col("cut").isNull(), text).when(blank, F.lit("")).otherwise(F.array_join(left, "\n"))
    return both.select("row", new.alias("text"), "n_lines",
                       F.coalesce(F.size("cut"), F.lit(0)).cast("bigint").alias("n_removed"))


def dedup_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` rewritten and n_lines, n_removed added; input
    columns of these two names give way."""
    return unpacked(rewritten(docs, width), docs.columns, "text", "n_lines", "n_removed")


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, text, t.i AS i, regexp_replace(t.x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS x
  FROM (SELECT doc_id, text, unnest(list_zip(split(text, chr(10)), range(len(split(text, chr(10)))))) AS u FROM documents WHERE text IS NOT NULL),
       LATERAL (SELECT u[1] AS x, u[2] AS i) t),
c AS (SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j FROM l WHERE x <> ''),
w AS (SELECT a.doc_id, a.i AS i0, b.i AS i1, d.i AS i2, a.x || chr(10) || b.x || chr(10) || d.x AS k
      FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.j = a.j + 1 JOIN c d ON a.doc_id = d.doc_id AND d.j = a.j + 2),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i0) AS n FROM w),
cut AS (SELECT doc_id, i0 AS i FROM r WHERE n > 1 UNION SELECT doc_id, i1 FROM r WHERE n > 1 UNION SELECT doc_id, i2 FROM r WHERE n > 1),
raw AS (SELECT doc_id, unnest(list_zip(split(text, chr(10)), range(len(split(text, chr(10)))))) AS u FROM documents WHERE text IS NOT NULL),
kept AS (
  SELECT raw.doc_id, string_agg(u[1], chr(10) ORDER BY u[2]) AS t
  FROM raw LEFT JOIN cut ON raw.doc_id = cut.doc_id AND raw.u[2] = cut.i WHERE cut.i IS NULL GROUP BY 1),
n AS (SELECT doc_id, count(*) AS k FROM cut GROUP BY 1)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(split(text, chr(10))) END AS n_lines,
       coalesce(n.k, 0) AS n_removed,
       md5(CASE WHEN text IS NULL THEN NULL WHEN n.k IS NULL THEN text
                WHEN kept.t IS NULL OR regexp_full_match(kept.t, '[\x20\x09-\x0D]*') THEN '' ELSE kept.t END) AS text_md5
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
