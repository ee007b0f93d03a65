"""Phrase collocation mining over FM-indexes of word ids.

Texts are cut into pieces and words, and packed into shards, each a sequence
of word ids of one language in which a zero ends a piece. A shard's index
holds the Burrows-Wheeler transform of the sequence and of its reverse, sorted
to the depth of the longest phrase; a phrase is a pair of intervals, one in
each, that a word on the left or on the right narrows to the longer phrase's.
Shards enumerate their phrases with counts by such extension, and the counts
are summed across shards.

A phrase is frequent only if its parts are, so the work goes in rounds: words
(summed over all shards, the frequent ones get ids), pairs of frequent words,
then phrases of three and four all of whose pairs are frequent; each shard is
told the frequent words and pairs that it holds, nothing is broadcast. Every
count is exact: nothing is dropped but phrases that can't reach the minimum.

Shards are made where the texts are read: a task packs words until it holds
``SHARD_WORDS`` and then lets the longest of its sequences go, so the memory
of a task is bounded, and a language of most texts is in many shards. A piece
is never cut (phrases end with it), so a piece longer than a shard makes a
longer shard.

Defined results: A-Z are lower-cased; a piece ends at ``.,;:!?`` and at line
breaks (LF, VT, FF, CR); words are parted by blanks and tabs; null texts are
empty; a null language is ``und``, as is a language of that name. Equal rows
count as often as they stand. Ties of score and count go by the phrase in
UTF-8 order. Empty tables and texts without a frequent phrase give no rows.
Columns that are not asked for are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.llm.common import emit, released, stored

#: Words that a task holds before it closes a shard, and the longest phrase.
SHARD_WORDS = 3 << 20
DEPTH = 4
MIN_COUNT = 30
#: A phrase goes if a longer one around it has this share of its count.
SUBSUMED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
#: Shards that a task of the later rounds handles on average.
_SHARDS_A_TASK = 4

_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")

_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.binary())),
                    ("counts", pa.list_(pa.int64())), ("size", pa.int64()), ("seq", pa.binary()), ("kind", pa.string())])
_SHARD_DDL = ("shard bigint, lang string, words array<binary>, counts array<bigint>, size bigint, seq binary, "
              "kind string")


class _Vocabulary(dict):
    """word -> id in order of appearance; -1 for nothing, 0 for a piece's end."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) - 1
        return n


class _Sequence:
    def __init__(self):
        self.ids, self.parts, self.size = _Vocabulary(), [], 0

    def add(self, text: bytes) -> int:
        tokens = text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        got = np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens))
        got = got[got >= 0]
        self.parts.append(got)
        self.size += len(got)
        return len(got)

    def rows(self, shard: int, lang: str) -> list[tuple]:
        seq = np.concatenate(self.parts)
        words = [w for w, i in self.ids.items() if i > 0]
        counts = np.bincount(seq, minlength=len(words) + 1)[1:]
        return [(shard, lang, words, counts, None, None, "words"),
                (shard, lang, None, None, len(seq), pa.compress(seq.tobytes(), codec="zstd", asbytes=True), "sequence")]


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Two rows a shard (shard, lang, kind): ``words``, in the order of their
    ids from 1, with their counts; and ``sequence`` with size and packed ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, total = TaskContext.get().partitionId(), 0, {}, 0

        def close(lang: str) -> pa.RecordBatch:
            return emit(held.pop(lang).rows(part * (1 << 32) + made, lang), _SHARD)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                total += held.setdefault(lang, _Sequence()).add(text.as_py())
                while total >= shard_words:
                    most = max(held, key=lambda k: held[k].size)
                    total -= held[most].size
                    yield close(most)
                    made += 1
        for lang in sorted(held):
            yield close(lang)
            made += 1

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, _SHARD_DDL)


class Index:
    """FM-index of a sequence over 1..symbols, zeros between pieces."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.text, self.symbols = text.astype(np.int32), symbols
        self.bwt, self.key = self._transform(self.text)
        self._back = None

    def _transform(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transform, suffixes sorted by their first four symbols, and its
        (symbol, row) pairs in order: a pair's place is C[symbol] plus the
        symbol's rank before the row."""
        pair = text.astype(np.int64) * (self.symbols + 1) + np.roll(text, -1)
        order = np.argsort(pair)
        pair = pair[order]
        rank = np.empty(len(text), dtype=np.int32)
        rank[order] = np.cumsum(np.append(False, pair[1:] != pair[:-1]), dtype=np.int32)
        pair = rank.astype(np.int64) * (int(rank.max()) + 1) + np.roll(rank, -2)
        del rank
        order = np.argsort(pair, kind="stable")
        del pair
        bwt = text[order - 1]
        order = np.argsort(bwt, kind="stable")
        return bwt, bwt[order].astype(np.int64) * len(text) + order

    def _side(self, left: bool) -> tuple[np.ndarray, np.ndarray]:
        if left:
            return self.bwt, self.key
        if self._back is None:
            self._back = self._transform(self.text[::-1].copy())
        return self._back

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, first row, occurrences) of every word that occurs."""
        count = np.bincount(self.text, minlength=self.symbols + 1)
        first = np.cumsum(count) - count
        at = np.nonzero(count[1:])[0] + 1
        return at, first[at], count[at]

    def extend(self, lo: np.ndarray, other: np.ndarray, count: np.ndarray, left: bool):
        """Every extension by a word on one side of phrases with intervals
        from ``lo`` in that side's transform and from ``other`` in the other's:
        (parent, symbol, lo, other, count)."""
        bwt, key = self._side(left)
        n = len(bwt)
        start = np.cumsum(count) - count
        rows = np.repeat(lo - start, count) + np.arange(int(count.sum()))
        rows = bwt[rows] + np.repeat(np.arange(len(lo)) * (self.symbols + 1), count)
        rows.sort()
        edge = np.nonzero(np.append(True, rows[1:] != rows[:-1])[: len(rows)])[0]
        found = np.diff(np.append(edge, len(rows)))
        parent, symbol = np.divmod(rows[edge], self.symbols + 1)
        del rows
        # smaller symbols of the same parent come first in the other transform
        moved = other[parent] + (np.cumsum(found) - found) - start[parent]
        real = symbol > 0
        parent, symbol, moved, found = parent[real], symbol[real], moved[real], found[real]
        return parent, symbol, np.searchsorted(key, symbol * n + lo[parent]), moved, found


def pairs(index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of two words: (first, second, count)."""
    word, lo, count = index.words()
    parent, symbol, _, _, found = index.extend(lo, lo, count, left=True)
    return symbol, word[parent], found


def longer(index: Index, frequent: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Phrases of three and of four words all of whose pairs are in
    ``frequent`` (sorted, first * (symbols + 1) + second): (words, counts)."""
    base = index.symbols + 1

    def known(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * base + b
        if not len(frequent):
            return np.zeros(len(key), dtype=bool)
        at = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
        return frequent[at] == key

    word, lo, count = index.words()
    parent, b, at, back, n = index.extend(lo, lo, count, left=True)
    c = word[parent]
    keep = known(b, c)
    b, c, at, back, n = b[keep], c[keep], at[keep], back[keep], n[keep]
    parent, a, at, back, n = index.extend(at, back, n, left=True)
    b, c = b[parent], c[parent]
    keep = known(a, b)
    a, b, c, at, back, n = a[keep], b[keep], c[keep], at[keep], back[keep], n[keep]
    yield [a, b, c], n
    parent, d, _, _, n = index.extend(back, at, n, left=False)
    a, b, c = a[parent], b[parent], c[parent]
    keep = known(c, d)
    yield [a[keep], b[keep], c[keep], d[keep]], n[keep]


def _indexed(row: dict) -> tuple[Index, np.ndarray]:
    """A shard's index over its frequent words, and their ids by symbol."""
    seq = np.frombuffer(pa.decompress(row["seq"], decompressed_size=4 * row["size"], codec="zstd"), dtype=np.int32)
    order = np.argsort(row["local"])
    local, ids = row["local"][order], row["ids"][order]
    symbol = np.zeros(int(max(seq.max(), local[-1])) + 1, dtype=np.int64)
    symbol[local] = np.arange(1, len(local) + 1)
    text = symbol[seq]
    text = text[(text > 0) | np.concatenate(([True], text[:-1] > 0))]  # one zero is as good as many
    return Index(np.append(text, 0), len(local)), np.concatenate(([0], ids))


def _rows(batches: Iterator[pa.RecordBatch], arrays: list[str]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns):
                v = column[i]
                row[name] = v.values.to_numpy() if name in arrays else v.as_py()
            yield row


def _batches(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    for at in range(0, size, 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)], pa.int64()) for c in columns.values()],
                                         names=list(columns))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches, ["local", "ids"]):
        index, ids = _indexed(row)
        first, second, count = pairs(index)
        yield from _batches(shard=np.full(len(count), row["shard"]), g1=ids[first], g2=ids[second], c=count)


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches, ["local", "ids", "first", "second"]):
        index, ids = _indexed(row)
        by_id = np.argsort(ids)
        first, second = (by_id[np.searchsorted(ids, row[k], sorter=by_id)] for k in ("first", "second"))
        for words, count in longer(index, np.sort(first * (index.symbols + 1) + second)):
            at = [ids[w] for w in words] + [np.zeros(len(count), dtype=np.int64)] * (DEPTH - len(words))
            yield from _batches(**{f"g{i + 1}": g for i, g in enumerate(at)}, c=count)


def numbered_words(told: DataFrame, min_count: int) -> DataFrame:
    """The frequent words with ids from 1 on without gaps: a written table's
    rows are numbered inside their partition and moved on by the partitions
    before (one row each)."""
    found = told.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
    found = stored(found.withColumn("raw", F.monotonically_increasing_id()), "phrase-words")
    part = F.shiftright("raw", 33)
    counts = found.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("by"))
    return found.withColumn("part", part).join(moved, "part").select(
        "lang", "word", "f", (F.col("by") + F.col("raw").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("id"))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (id, lang, word, f), phrases (p: ids of two to four words, f) of
    at least ``min_count`` occurrences, and totals (lang, n)."""
    spark = docs.sparkSession
    packed = stored(shards(docs, shard_words), "phrase-shards", "kind")
    spelled = packed.where("kind = 'words'")
    told = spelled.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w")).select(
        "shard", "lang", (F.col("i") + 1).cast("bigint").alias("local"), F.col("w.words").alias("word"),
        F.col("w.counts").alias("c"))
    totals = stored(spelled.groupBy("lang").agg(F.sum(F.aggregate(
        "counts", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("n")), "phrase-totals")
    words = stored(numbered_words(told, min_count), "phrase-ids")
    mine = told.join(words.hint("merge").select("lang", "word", "id"), ["lang", "word"]).groupBy("shard").agg(
        F.collect_list(F.struct("local", "id")).alias("m")).select(
        "shard", F.col("m.local").alias("local"), F.col("m.id").alias("ids"))
    mine = stored(mine, "phrase-vocabularies")  # a row holds the words of one shard
    sequences = packed.where("kind = 'sequence'").select("shard", "size", "seq")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sequences.count() // _SHARDS_A_TASK)
    released(packed, "kind=words")
    joined = sequences.repartition(width, "shard").join(mine.repartition(width, "shard").hint("merge"), "shard")
    two = joined.select("shard", "size", "seq", "local", "ids").mapInArrow(
        _pairs, "shard bigint, g1 bigint, g2 bigint, c bigint")
    # one row a shard and pair, so the window of a pair is as long as there are shards
    summed = F.sum("c").over(Window.partitionBy("g1", "g2")).alias("f")
    two = stored(two.select("shard", "g1", "g2", summed).where(F.col("f") >= min_count), "phrase-pairs")
    held = two.groupBy("shard").agg(F.collect_list(F.struct("g1", "g2")).alias("m")).select(
        "shard", F.col("m.g1").alias("first"), F.col("m.g2").alias("second"))
    more = joined.join(held.repartition(width, "shard").hint("merge"), "shard").select(
        "shard", "size", "seq", "local", "ids", "first", "second").mapInArrow(
        _longer, "g1 bigint, g2 bigint, g3 bigint, g4 bigint, c bigint")
    more = more.groupBy("g1", "g2", "g3", "g4").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
    ids = F.array_remove(F.array("g1", "g2", "g3", "g4"), F.lit(0).cast("bigint"))
    phrases = stored(two.groupBy("g1", "g2").agg(F.max("f").alias("f")).select(F.array("g1", "g2").alias("p"), "f")
                     .unionByName(more.select(ids.alias("p"), "f")), "phrase-counts")
    return words, phrases, totals


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def scored(words: DataFrame, phrases: DataFrame, scale: int = SCALE) -> DataFrame:
    """Each phrase at its weakest cut: p, f, l, r, score."""
    known = words.select(F.array("id").alias("p"), "f").unionByName(phrases)
    cut = phrases.select("p", "f", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cut = cut.withColumns({"left": F.slice("p", F.lit(1), F.col("k")),
                           "right": F.slice("p", F.col("k") + 1, F.size("p") - F.col("k"))})
    cut = cut.join(known.select(F.col("p").alias("left"), F.col("f").alias("l")), "left")
    cut = cut.join(known.select(F.col("p").alias("right"), F.col("f").alias("r")), "right")
    cut = cut.withColumn("score", F.expr(
        f"(cast(f as decimal(20,0)) * {scale}BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = cut.groupBy("p", "f").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("p", "f", "b.l", "b.r", "b.score")


def extensions(phrases: DataFrame) -> DataFrame:
    """The largest count of a phrase with one more word on its left or right:
    p, left_most, right_most. A longer phrase around it has no more than the
    one in between, so these decide whether any does."""
    long = phrases.where(F.size("p") > 2)
    n = F.size("p") - 1
    inner = long.select(F.slice("p", F.lit(2), n).alias("p"), F.col("f").alias("left"), F.lit(0).cast("bigint").alias("right")) \
        .unionAll(long.select(F.slice("p", F.lit(1), n), F.lit(0).cast("bigint"), F.col("f")))
    return inner.groupBy("p").agg(F.max("left").alias("left_most"), F.max("right").alias("right_most"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, percent: int = SUBSUMED_PERCENT, scale: int = SCALE,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every phrase that no longer one subsumes: lang, phrase, a, l, r, n,
    score, left_most, right_most."""
    words, phrases, totals = frequent_phrases(docs, min_count, shard_words)
    out = scored(words, phrases, scale).join(extensions(phrases), "p", "left").fillna(0, ["left_most", "right_most"])
    most = F.greatest(_exact("left_most"), _exact("right_most"))
    out = out.where(100 * most < percent * _exact("f"))
    spelled = out.select("p", F.posexplode("p").alias("i", "id")).join(words.select("id", "lang", "word"), "id").groupBy("p") \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", F.col("word").cast("string").alias("w")))),
                                      lambda x: x["w"]), " ").alias("phrase"), F.first("lang").alias("lang"))
    return out.join(spelled, "p").join(totals, "lang").select(
        "lang", "phrase", F.col("f").alias("a"), "l", "r", "n", "score", "left_most", "right_most")


def best_collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The first ``top`` of each language, ranked inside ever fewer salted
    groups, then among the few times ``top`` that the last of these leave."""
    every = collocations(docs, **options)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for groups in (width, 4):
        salted = every.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
        ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        every = ranked.where(F.col("rank") <= top)
    out = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return out.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH low AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM low),
ws AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS g
  FROM ws, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, count(*) AS n FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k AS len, g, string_split(g, ' ') AS w, n AS a FROM f WHERE k >= 2 AND n >= 30),
cut AS (SELECT c.lang, c.len, c.g, a, x.k, array_to_string(w[1 : x.k], ' ') AS lg, array_to_string(w[x.k + 1 :], ' ') AS rg
  FROM c JOIN (SELECT unnest([1, 2, 3]) AS k) x ON x.k < c.len),
sc AS (SELECT cut.lang, cut.len, cut.g, a, cut.k, l.n AS l, r.n AS r, (2000000::HUGEINT * a // (l.n::HUGEINT + r.n))::BIGINT AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.g = lg AND l.k = cut.k
  JOIN f r ON r.lang = cut.lang AND r.g = rg AND r.k = cut.len - cut.k),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM sc) WHERE o = 1),
sub AS (SELECT c.lang, array_to_string(w[i : i + m - 1], ' ') AS g, max(a) AS most
  FROM c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < len AND i + m - 1 <= len GROUP BY 1, 2),
kept AS (SELECT best.* FROM best LEFT JOIN sub USING (lang, g) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank FROM kept)
SELECT lang, rank, g AS phrase, a, l, r, total.n AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
