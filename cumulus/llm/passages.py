"""Substring de-duplication by compact windows.

A text is the sequence of its 5-word shingles. Under each of a few hash
functions, a position's compact window is the widest stretch of which it holds
the minimum, so every subsequence inside that contains the position has the
same min-hash; the Cartesian tree of the hashes gives these windows. Only
positions that are the minimum of some stretch of the shortest passage can have
a wide enough window, and the tree is built over them alone (between two
neighbouring ones all hashes are larger than both, so the extents are exact).

Interval joins inside a text pair the windows of neighbouring hash functions
that share a stretch of the shortest passage: the pair of min-hashes is the
signature of all subsequences there. Texts that share a signature are linked
with the smallest doc_id that has it (a linear number of candidates, however
many texts share it), and verified on the words of both whole texts: stretches
of at least ``words`` words of which 0.8 of the shingles stand in the other
passage. Where a signature's place is in no such stretch, the text meets the
others of that signature in a further round, those that also share the nearest
shingle to the left or right that the smallest hasn't; so on until none is left.

Defined results: equal texts are one class, compared through their smallest
doc_id; null and short texts have no passages; repeats inside one text are not
reported; repeated ids are one document per text; a null doc_id is its own
component; extra columns are ignored; empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cumulus.llm.common import components, emit, stored, wide
from cumulus.llm.minmax import multipliers
from cumulus.llm.textsets import mix, roll, utf8_word_hashes

HASHES = 6
WORDS = 50
SHINGLE = 5
SIMILARITY = 0.8
#: Shortest passages that a window reaches to either side of its centre.
REACH = 4
#: Unmatched shingles that a passage may bridge.
GAP = 12

#: Bytes of text whose windows are found at a time, and of one Arrow batch of texts.
BATCH_BYTES = 1 << 20

_SIG = pa.schema([("k1", pa.int64()), ("doc_id", pa.int64()), ("c", pa.int32())])
_LINK = pa.schema([("k1", pa.int64()), ("doc_id", pa.int64()), ("c", pa.int32()), ("first", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("at", pa.list_(pa.list_(pa.int64()))),
                    ("k1", pa.list_(pa.int64())), ("c", pa.list_(pa.int32()))])


def minima(v: np.ndarray, width: int, stretches: np.ndarray) -> np.ndarray:
    """Sorted positions that hold the minimum of the ``width`` neighbours from
    some of ``stretches`` (sorted first positions) on, of ties the first."""
    if not len(stretches):
        return np.empty(0, dtype=np.int64)
    bits = np.uint64(24)
    if len(v) >= 1 << 24:  # positions no longer fit: in overlapping pieces
        step = (1 << 24) - width
        parts = [stretches[slice(*np.searchsorted(stretches, (at, at + step)))] - at for at in range(0, len(v), step)]
        return np.unique(np.concatenate([i * step + minima(v[i * step : (i + 1) * step + width - 1], width, part)
                                         for i, part in enumerate(parts)]))
    x = (v >> bits << bits) | np.arange(len(v), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    if span < width:
        x = np.minimum(x[: len(x) - (width - span)], x[width - span :])
    x = x[stretches] & np.uint64((1 << 24) - 1)  # never falls from one stretch to the next
    return x[np.r_[True, x[1:] != x[:-1]]].astype(np.int64)


def whole_stretches(starts: np.ndarray, width: int) -> np.ndarray:
    """First positions of all ``width`` neighbours inside one text; text i
    takes the positions from ``starts[i]`` up to ``starts[i + 1]``."""
    to = np.repeat(starts[1:], np.diff(starts))
    return np.nonzero(to - np.arange(len(to)) >= width)[0]


def extents(v: np.ndarray, starts: np.ndarray, stretches: np.ndarray, width: int,
            reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, centre and last of the compact windows of ``width`` positions or
    more, cut ``reach`` positions beside their centre, of several texts one
    after another. Each candidate looks at its neighbours, one after another,
    until one is smaller (to the left: or equal) or out of reach."""
    at = minima(v, width, stretches)
    key = v[at] >> np.uint64(24)
    text = np.searchsorted(starts, at, "right")
    ends = [np.maximum(starts[text - 1], at - reach), np.minimum(starts[text] - 1, at + reach)]
    outer = np.r_[np.iinfo(np.int64).min, at, np.iinfo(np.int64).max]
    for side, end in zip((-1, 1), ends):
        going, bound, step = np.arange(len(at)), end.copy(), 0
        while len(going):
            step += side
            place = outer[going + step + 1]
            inside = place >= bound[going] if side < 0 else place <= bound[going]
            going = going[inside]
            k, mine = key[going + step], key[going]
            stop = k <= mine if side < 0 else k < mine
            end[going[stop]] = place[inside][stop] - side
            going = going[~stop]
    ok = ends[1] - ends[0] + 1 >= width
    return ends[0][ok], at[ok], ends[1][ok]


def compact_windows(v: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(first, centre, last) of one text's compact windows, uncut."""
    starts = np.array([0, len(v)])
    return list(zip(*(x.tolist() for x in extents(v, starts, whole_stretches(starts, width), width, len(v)))))


def signature_rows(h: np.ndarray, starts: np.ndarray, mult: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Signature and centre of the stretches that the windows of two
    neighbouring hash functions share: both centres and ``width`` positions
    lie in the common part. Each signature at all of its centres. ``h`` holds
    several texts, text i from ``starts[i]`` up to ``starts[i + 1]``."""
    keys, centres = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    stretches = whole_stretches(starts, width)
    values = [mix(h * m) for m in mult] if len(stretches) else []
    # a longer passage than the reach has several signatures instead
    found = [extents(v, starts, stretches, width, REACH * width) for v in values]
    for j, (a, c, b) in enumerate(found):
        k = (j + 1) % len(found)
        a2, c2, b2 = found[k]
        low = np.searchsorted(c2, a)
        n = np.searchsorted(c2, b, "right") - low
        for i in range(0, len(c), 4096):
            m = n[i : i + 4096]
            x = np.repeat(np.arange(i, i + len(m)), m)
            y = np.arange(len(x)) + np.repeat(low[i : i + 4096] - np.cumsum(m) + m, m)
            ok = (a2[y] <= c[x]) & (c[x] <= b2[y]) & (np.minimum(b[x], b2[y]) - np.maximum(a[x], a2[y]) >= width - 1)
            x, y = x[ok], y[ok]
            pair = values[j][c[x]] * np.uint64(0x9E3779B97F4A7C15) + values[k][c2[y]] + np.uint64(j)
            keys.append(mix(pair).view(np.int64))
            centres.append(c[x])
    return np.concatenate(keys), np.concatenate(centres)


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several texts one after another; text i's from the i-th up
    to the next of the starts."""
    ws = [utf8_word_hashes(t) for t in texts]
    n = np.array([len(w) for w in ws], dtype=np.int64)
    own = np.maximum(n - SHINGLE + 1, 0)
    starts = np.r_[0, np.cumsum(own)]
    at = np.arange(starts[-1]) + np.repeat(np.cumsum(n) - n - starts[:-1], own)
    return roll(np.concatenate(ws), SHINGLE)[at] if len(at) else np.empty(0, dtype=np.uint64), starts


def by_bytes(texts: list[bytes | None], most: int) -> Iterator[slice]:
    """Runs of texts of about ``most`` bytes."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= most:
            yield slice(at, i + 1)
            at, size = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def among(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``a`` are in the sorted ``b``."""
    if not len(b):
        return np.zeros(len(a), dtype=bool)
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def spread(hit: np.ndarray, gap: int) -> list[np.ndarray]:
    """Sorted positions, parted where more than ``gap`` lie between two."""
    return np.split(hit, np.nonzero(np.diff(hit) > gap)[0] + 1)


def dense(hit: np.ndarray, width: int) -> list[tuple[int, int]]:
    """All stretches of ``width`` positions or more of which ``SIMILARITY``
    are in ``hit``, first and last among them; for each last, the longest."""
    u = np.arange(len(hit)) - SIMILARITY * hit  # from i to j: u[j] + 1 - SIMILARITY >= u[i]
    first = np.searchsorted(-np.minimum.accumulate(u), -(u + 1 - SIMILARITY + 1e-9))
    ok = np.nonzero(hit - hit[first] + 1 >= width)[0]
    return list(zip(hit[first[ok]].tolist(), (hit[ok] + 1).tolist()))


def shared(a: np.ndarray, b: np.ndarray, ours: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Merged stretches of ``a`` (shingle positions, end exclusive) that stand
    in a passage of ``b``. Both texts are compared whole; ``ours`` tells which
    of ``a`` are in ``b``."""
    if np.count_nonzero(ours) < SIMILARITY * width - 1e-6:  # fewer than any passage has
        return []
    order = np.nonzero(ours)[0]
    order = order[np.argsort(a[order], kind="stable")]
    values = a[order]
    hit = np.nonzero(among(b, values))[0]
    out: list[tuple[int, int]] = []
    for theirs in spread(hit, REACH * width) if len(hit) else []:
        y = np.unique(b[theirs])
        lo = np.searchsorted(values, y)
        n = np.searchsorted(values, y, "right") - lo
        if n.sum() < SIMILARITY * width:
            continue
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        for mine in spread(np.sort(order[at]), GAP):
            if mine[-1] - mine[0] + 1 >= width:
                out += dense(mine, width)
    merged: list[tuple[int, int]] = []
    for s, e in sorted(out):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def further(a: np.ndarray, ours: np.ndarray, at: list[tuple[int, int]], k: np.ndarray,
            c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows (signature ``k``, centre ``c``) of ``a`` outside the stretches
    found in the other text, each with the nearest shingle to the left and to
    the right that the other hasn't: texts that share a passage around the
    centre, but not with it, share one of the two new signatures."""
    left = c < len(a)
    for s, e in at:
        left &= (c < s) | (c >= e)
    k, c = k[left].view(np.uint64), c[left]
    others = np.nonzero(~ours)[0]
    p = np.searchsorted(others, c)
    keys = []
    sides = ((1, p - 1, p > 0), (2, p, p < len(others)))
    for side, i, ok in sides:
        near = a[others[i[ok]]]
        keys.append(mix(k[ok] * np.uint64(0x9E3779B97F4A7C15) + near + np.uint64(side)).view(np.int64))
    return np.concatenate(keys), np.concatenate([c[ok] for _, _, ok in sides])


def repeated_passages(docs: DataFrame, n_words: int = WORDS, hashes: int = HASHES) -> DataFrame:
    """One row per document: doc_id, copy_of (smallest doc_id of the same
    text), component_id (smallest doc_id linked by copies or passages),
    n_passages, n_repeated_words and passages (``start:end:doc_id`` of the
    words that repeat from a smaller doc_id), those of copy_of's text."""
    width = n_words - SHINGLE + 1
    ided = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    keyed = ided.select("doc_id", F.xxhash64("text").alias("t1"), F.md5("text").alias("t2"))
    classes = stored(keyed.where("doc_id IS NOT NULL AND t2 IS NOT NULL").groupBy("t1", "t2").agg(
        F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")), "passage-classes")
    # only texts that are not the smallest copy are looked up, so most rows meet no partner
    copies = stored(keyed.join(classes.where("rep < last").hint("merge"), ["t1", "t2"]).where("doc_id > rep").select(
        "doc_id", "rep").distinct(), "passage-copies")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = multipliers(hashes)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids, texts = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary()).to_pylist()
            for part in by_bytes(texts, BATCH_BYTES):
                h, starts = hashed([t or b"" for t in texts[part]])
                k, c = signature_rows(h, starts, mult, width)
                of = np.searchsorted(starts, c, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(ids[part][of]),
                                                  pa.array((c - starts[of]).astype(np.int32))], schema=_SIG)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a signature follow one another, smallest doc_id first: each
        is linked with the first one; only that one is remembered."""
        last = (None, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            k, doc, c = (x.to_numpy() for x in batch.columns)
            new = np.r_[k[0] != last[0], k[1:] != k[:-1]]
            first = np.r_[last[1], doc[new]][np.cumsum(new)]
            last = (k[-1], first[-1])
            later = doc != first
            yield pa.RecordBatch.from_arrays([pa.array(x[later]) for x in (k, doc, c, first)], schema=_LINK)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            rows = []
            docs, firsts = (batch.column(i).to_pylist() for i in (0, 2))
            texts, first_texts = (batch.column(i).cast(pa.binary()).to_pylist() for i in (1, 3))
            ends, cand = batch.column(4).offsets.to_numpy(), batch.column(4).values
            ks, cs = (cand.field(x).to_numpy() for x in ("k1", "c"))
            for part in by_bytes(texts, BATCH_BYTES):
                h, starts = hashed(texts[part])
                for i, s, e in zip(range(part.start, part.stop), starts, starts[1:]):
                    if last[0] != (firsts[i], first_texts[i]):
                        other = hashed([first_texts[i]])[0]
                        last = ((firsts[i], first_texts[i]), (other, np.sort(other)))
                    mine, (other, values) = h[s:e], last[1]
                    ours = among(mine, values)
                    got = shared(mine, other, ours, width)
                    rest = slice(ends[i], ends[i + 1])
                    k, c = further(mine, ours, got, ks[rest], cs[rest])
                    if got or len(k):
                        rows.append((docs[i], firsts[i], [[s, e + SHINGLE - 1] for s, e in got], k, c))
            yield emit(rows, _FOUND)

    sig = ided.mapInArrow(windows, "k1 bigint, doc_id bigint, c int")
    linked, texts = None, ided
    while True:  # each round without the first document of every signature, so it ends
        links = wide(sig, "k1").sortWithinPartitions("k1", "doc_id", "c").mapInArrow(
            link, "k1 bigint, doc_id bigint, c int, first bigint")
        pairs = links.join(copies.hint("merge"), "doc_id", "left_anti").groupBy("doc_id", "first").agg(
            F.collect_set(F.struct("k1", "c")).alias("rows"))  # at most those of one text
        pairs = stored(pairs, "passage-candidates")
        if linked is not None and pairs.isEmpty():
            break
        if linked is not None:  # only the texts that still have partners are moved again
            ids = pairs.select("doc_id").unionAll(pairs.select(F.col("first").alias("doc_id"))).distinct()
            texts = stored(texts.join(ids.hint("merge"), "doc_id"), "passage-texts")
        # both sides join the same rows by the same column, so that the texts are shuffled once
        mine, other = texts.alias("mine"), texts.alias("other")
        both = pairs.join(mine.hint("merge"), F.col("mine.doc_id") == pairs["doc_id"]).select(
            pairs["doc_id"], F.col("mine.text"), "first", "rows")
        both = both.join(other.hint("merge"), F.col("first") == F.col("other.doc_id")).select(
            both["doc_id"], both["text"], "first", F.col("other.text").alias("first_text"), "rows")
        found = stored(both.mapInArrow(verify, "doc_id bigint, first bigint, at array<array<bigint>>, k1 array<bigint>, c array<int>"),
                       "passage-links", batch_bytes=BATCH_BYTES)
        sig = found.select(F.inline(F.arrays_zip("k1", "c")), "doc_id").select("k1", "doc_id", "c")
        found = found.where(F.size("at") > 0).select("doc_id", "first", "at")
        linked = found if linked is None else linked.unionAll(found)
    edges = linked.select(F.col("doc_id").alias("a"), F.col("first").alias("b")).unionAll(
        copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    root = components(edges, name="passage-components").select(F.col("node").alias("doc_id"), "root")
    told = linked.select("doc_id", "first", F.explode("at").alias("p")).groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.struct(F.col("p")[0].alias("s"), F.col("p")[1].alias("e"), "first"))).alias("p"))
    # words covered by the union of the spans, sorted by their start
    covered = F.aggregate("p", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to")),
                          lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["to"]))).alias("n"),
                                                F.greatest(a["to"], x["e"]).alias("to")))["n"]
    told = told.select(F.col("doc_id").alias("copy_of"), F.size("p").cast("bigint").alias("n_passages"),
                       covered.alias("n_repeated_words"), F.array_join(F.transform("p", lambda x: F.concat_ws(
                           ":", x["s"], x["e"], x["first"])), ",").alias("passages"))
    res = ided.select("doc_id").join(copies, "doc_id", "left").withColumn("copy_of", F.coalesce("rep", "doc_id"))
    res = res.join(root, "doc_id", "left").join(told, "copy_of", "left")
    return res.select("doc_id", "copy_of", F.coalesce("root", "doc_id").alias("component_id"),
                      F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
                      F.coalesce("n_repeated_words", F.lit(0)).alias("n_repeated_words"),
                      F.coalesce("passages", F.lit("")).alias("passages"))
