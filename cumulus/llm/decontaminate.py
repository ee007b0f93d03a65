"""Benchmark decontamination by BM25 and block-max WAND.

The test items form the inverted index; every passage of every document is a
query. An item is an entry as a whole, and its question (all sentences but
the last, of eight words or more) is an entry of its own. Impacts are BM25 term
scores divided by the entry's own total, so a passage that holds all words of
an entry scores 1 against it and one threshold serves all; entries that can
pass the verification below it have the least score that this takes. The
entries are laid out in docid-aligned blocks.

A passage meets the index in two steps, both exact. First, an entry can only
reach the threshold with some of its strongest terms (what the weak ones weigh
together is well below it), so the postings of these, summed for all passages of a
text at once, tell which passages have to be asked at all (the strong terms
must hold what the weak ones can't make up for). These are answered
by WAND: terms are pivoted on their largest impacts, the maxima of the pivot's
block decide whether the block is skipped, and only what is left is scored.
Nothing below the threshold is ranked, so no top-k cuts the result. Postings
and block maxima are sparse, so an index is linear in its words.

Retrieved items are verified on the words: the share of the 5-word shingles of
the whole item, of its question (all sentences but the last) and of its answer
(the last sentence) that stand in the document. A document leaks an item if
0.8 of the whole, or of a question of eight words or more, is there. The score
told is the best passage's for the whole item.

Passages are windows of twice the longest item's words that start at each
multiple of that length, so any copy lies whole in one of them.

Defined results: null or word-less texts and items never match; items of
fewer than five words match as one shingle; items with equal texts each match;
rows that repeat a document or an item give the pair once; extra columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cumulus.llm.common import emit, stored

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
SCORE = 0.5
#: Share of shingles that must stand in the document.
OVERLAP = 0.8
SHINGLE = 5
MIN_QUESTION = 8
BLOCK = 8
#: Terms are weak, and left out of the first step, as long as they weigh less
#: than this part of an entry's threshold together.
WEAK = 0.4
#: Words of test items that one index holds; more items make more indexes,
#: each a pass over the documents, so that what a task holds is bounded.
INDEX_WORDS = 400_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_PAIR = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                   ("overlap", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
_PAIR_DDL = ("doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, "
             "answer_overlap double")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; an item of one
    sentence is all question."""
    parts = [w for w in map(tokens, _SENTENCE.split(text)) if w]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def shingles(words: list[str], width: int = SHINGLE) -> set[tuple]:
    k = min(width, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


def least_share(words: list[str], weight: dict[str, float]) -> float:
    """A lower bound of the weight of the words that stand in ``OVERLAP`` of
    the shingles: the missing ones leave out no more words than they have places."""
    k = min(SHINGLE, len(words))
    places = sorted(Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)).values(), reverse=True)
    missing = sum(places[: int(len(places) * (1 - OVERLAP) + 1e-9)])
    return 1 - sum(sorted(weight.values(), reverse=True)[:missing])


class Index:
    """Block-max index of one part of the items. ``df`` and the averages are
    those of all items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float):
        items = sorted(items, key=lambda x: (len(tokens(x[1])), x))  # alike lengths share a block: tight maxima
        self.item_ids = [i for i, _ in items]
        words = [tokens(t) for _, t in items]
        self.longest = max(map(len, words), default=0)
        parts = [question_answer(t) for _, t in items]
        self.whole = [shingles(w) for w in words]
        self.question = [shingles(q) for q, _ in parts]
        self.answer = [shingles(a) for _, a in parts]
        self.asks = [len(q) >= MIN_QUESTION for q, _ in parts]
        entries = [(ws, i) for i, ws in enumerate(words)]
        entries += [(q, i) for i, (q, a) in enumerate(parts) if a and self.asks[i]]
        entries.sort(key=lambda x: len(x[0]))
        #: Item number and item id of each entry.
        self.item = [i for _, i in entries]
        self.ids = [self.item_ids[i] for i in self.item]
        self.term: dict[str, int] = {}
        #: Impacts of each item's terms on the whole.
        self.impact: list[dict[int, float]] = [{} for _ in items]
        self.ease = []
        posts: list[tuple[list[int], list[float]]] = []
        must: list[list[tuple[int, float]]] = []
        self.need = np.zeros(len(entries))
        for at, (ws, i) in enumerate(entries):
            norm = K1 * (1 - B + B * len(ws) / max(mean_words, 1e-9))
            scores = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                      for w, tf in Counter(ws).items()}
            total = sum(scores.values())
            share = {w: s / total for w, s in scores.items()}
            for w, s in share.items():
                k = self.term.setdefault(w, len(posts))
                if k == len(posts):
                    posts.append(([], []))
                    must.append([])
                posts[k][0].append(at)
                posts[k][1].append(s)
                if len(ws) == len(words[i]):
                    self.impact[i][k] = s
            #: Part of the threshold that the entry must reach.
            self.ease.append(min(1.0, max(0.0, least_share(ws, share)) / SCORE))
            # its strongest terms, and how much of them a passage must hold
            rest, low = 1.0, SCORE * self.ease[at]
            for w, s in sorted(share.items(), key=lambda x: (-x[1], x[0])):
                if rest < WEAK * low:
                    break
                must[self.term[w]].append((at, s))
                rest -= s
            self.need[at] = low - max(rest, 0.0)
        self.block_ease = [min(self.ease[b : b + BLOCK]) for b in range(0, len(entries), BLOCK)]
        #: By term: entries, impacts, the largest impact, and that by block.
        self.lists = []
        for at, impacts in posts:
            maxima: dict[int, float] = {}
            for e, s in zip(at, impacts):
                maxima[e // BLOCK] = max(s, maxima.get(e // BLOCK, 0.0))
            self.lists.append((at, impacts, max(impacts), maxima))
        self.unknown = len(posts)
        #: The strongest terms' postings, one after the other; unknown words have none.
        self.size = np.array([len(m) for m in must] + [0])
        self.start = np.cumsum(self.size) - self.size
        self.entry = np.array([e for m in must for e, _ in m], dtype=np.int64)
        self.part = np.array([s for m in must for _, s in m])

    def asked(self, ids: np.ndarray) -> list[int]:
        """Numbers of a text's passages (of its term ids) that may reach the
        threshold of an entry."""
        at = np.nonzero(self.size[ids])[0]
        if not len(at):
            return []
        last = max(1, -(-(len(ids) - self.longest) // self.longest)) - 1
        number = at // self.longest  # a word is in the passage that starts before it, and in the one before that
        passage, term = np.concatenate([number, number - 1]), np.tile(ids[at], 2)
        inside = (passage >= 0) & (passage <= last)
        both = np.unique(passage[inside] * (self.unknown + 1) + term[inside])
        passage, term = np.divmod(both, self.unknown + 1)
        n = self.size[term]
        rows = np.repeat(self.start[term] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        entries = len(self.need)
        key, which = np.unique(np.repeat(passage, n) * entries + self.entry[rows], return_inverse=True)
        reached = np.bincount(which, weights=self.part[rows]) >= self.need[key % entries] - 1e-6
        return np.unique(key[reached] // entries).tolist()

    def retrieve(self, terms: np.ndarray, least: float) -> dict[int, float]:
        """Entries with a score of ``least`` (times their ease) or more for a
        passage of distinct known terms: position -> score."""
        found: dict[int, float] = {}
        lists = [[self.lists[t][0][0], 0, *self.lists[t]] for t in terms.tolist()]
        low = least * min(self.block_ease, default=1.0) - 1e-9
        while lists:
            lists.sort(key=lambda c: c[0])
            bound, held = 0.0, 0
            while held < len(lists) and bound < low:
                bound += lists[held][4]
                held += 1
            if bound < low:
                break
            pivot = lists[held - 1][0]
            while held < len(lists) and lists[held][0] == pivot:
                held += 1
            block = pivot // BLOCK
            if sum(c[5].get(block, 0.0) for c in lists[:held]) < least * self.block_ease[block] - 1e-9:
                to = (block + 1) * BLOCK  # no entry up to the next list's, or the block's end, can reach it
                if held < len(lists):
                    to = min(to, lists[held][0])
            elif lists[0][0] == pivot:
                score = sum(c[3][c[1]] for c in lists[:held])
                if score >= least * self.ease[pivot] - 1e-9:
                    found[pivot] = score
                to = pivot + 1
            else:
                to = pivot
            for c in lists[:held]:
                if c[0] < to:
                    c[1] = bisect_left(c[2], to, c[1])
                    c[0] = c[2][c[1]] if c[1] < len(c[2]) else -1
            lists = [c for c in lists if c[0] >= 0]
        return found

    def leaks(self, text: str | None) -> Iterator[tuple]:
        """Verified items of one text, each once: (item id, score, overlap of
        the whole, of the question, of the answer)."""
        words = tokens(text)
        if not words or not self.longest:
            return
        get, none = self.term.get, self.unknown
        ids = np.array([get(w, none) for w in words], dtype=np.int64)
        step = self.longest

        def passage(i: int) -> np.ndarray:
            w = ids[i * step : i * step + 2 * step]
            return np.unique(w[w != none])

        found = {self.item[e] for i in self.asked(ids) for e in self.retrieve(passage(i), SCORE)}
        if not found:
            return
        here = shingles(words)
        passages = [passage(i).tolist() for i in range(max(1, -(-(len(ids) - step) // step)))]
        for item in sorted(found):
            part = [self._share(x[item], here, words) for x in (self.whole, self.question, self.answer)]
            if part[0] >= OVERLAP or (self.asks[item] and part[1] >= OVERLAP):
                impact = self.impact[item].get
                yield self.item_ids[item], max(sum(impact(t, 0.0) for t in w) for w in passages), *part

    @staticmethod
    def _share(part: set[tuple], here: set[tuple], words: list[str]) -> float:
        if not part:
            return 0.0
        width = len(next(iter(part)))
        have = here if width == min(SHINGLE, len(words)) else shingles(words, width)
        return len(part & have) / len(part)


def indexes(items: DataFrame, index_words: int = INDEX_WORDS) -> Iterator[Index]:
    """The items' indexes, each of about ``index_words`` words at most, one
    after the other."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("n", pa.int64()), ("words", pa.list_(pa.string()))])
        for batch in batches:
            yield emit([(i, t, len(w), sorted(set(w))) for i, t in zip(*map(pa.Array.to_pylist, batch.columns))
                        if (w := tokens(t))], out)

    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    rows = stored(rows.mapInArrow(count, "item_id bigint, text string, n bigint, words array<string>"), "bench-items")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n:
        return
    parts = -(-total // index_words)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    each = rows.select("item_id", "text", "words", shard.alias("part"))
    df = rows.select(F.explode("words").alias("w")).groupBy("w").count()
    for part in range(parts):
        mine = each.where(F.col("part") == part)
        held = mine.select("item_id", "text").collect()
        if held:
            known = mine.select(F.explode("words").alias("w")).distinct().join(df, "w").collect()
            yield Index([(r[0], r[1]) for r in held], {r[0]: r[1] for r in known}, n, total / n)


def leaked_items(docs: DataFrame, items: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """One row for each document and item that it leaks."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], _PAIR_DDL)
    for index in indexes(items, index_words):
        held = docs.sparkSession.sparkContext.broadcast(index)  # bounded by index_words

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d, *x) for d, t in zip(*map(pa.Array.to_pylist, batch.columns)) for x in held.value.leaks(t)]
                if rows:
                    yield emit(rows, _PAIR)

        out = out.unionByName(texts.mapInArrow(run, _PAIR_DDL))
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in _PAIR.names[2:]])


def without_leaks(docs: DataFrame, items: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """The documents that leak no item; rows are only filtered, not moved."""
    for index in indexes(items, index_words):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [next(held.value.leaks(t), None) is None for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
