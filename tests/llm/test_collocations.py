"""Phrase mining against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from cumulus.llm import collocations as col

SCHEMA = "lang string, text string"
OPTIONS = dict(min_count=4)


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def expected(rows, min_count, percent=80, scale=2_000_000, top=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        around = Counter()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i:i + m]] = max(around[p[i:i + m]], a)
        rows_ = []
        for p, a in cands.items():
            if p in around and 100 * around[p] >= percent * a:
                continue
            score, _, l, r = min((scale * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        rows_.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(rows_[:top])]
    return sorted(out)


def run(spark, rows, extra=(), **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in extra:
        df = df.withColumn(c, F.lit(1))
    return sorted(map(tuple, col.best_collocations(df, **options).collect()))


def corpus(n, seed):
    rnd = random.Random(seed)
    words = ["a", "B", "ça", "the", "of", "x1", "ñ", " ", "q\x1f", "z-z", "Tea", "cup"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "!?"]
    out = []
    for _ in range(n):
        t = "".join(rnd.choice(words[:rnd.choice((3, 12))]) + rnd.choice(marks) for _ in range(rnd.randrange(60)))
        out.append((rnd.choice(["en", "en", "de", None, "und"]), t))
    return out + [("en", "Tea cup of the x1 B")] * 9


def test_equals_plain_counting_over_many_shards(spark):
    rows = corpus(150, 1)
    want = expected(rows, 4)
    assert len(want) > 100
    assert run(spark, rows, shard_words=50, **OPTIONS) == want
    assert run(spark, rows, extra=["p", "f", "n", "shard", "words", "id", "g1", "doc_id", "salt"], **OPTIONS) == want


def test_top_and_ties(spark):
    rows = [("en", f"k{i} v{i}") for i in range(30) for _ in range(4)]
    got = run(spark, rows, top=7, **OPTIONS)
    assert got == expected(rows, 4, top=7) and [r[2] for r in got] == sorted(f"k{i} v{i}" for i in range(30))[:7]


def test_empty_null_and_long_texts(spark):
    assert run(spark, [], **OPTIONS) == []
    assert run(spark, [("en", None), (None, ""), ("en", " .,\n"), ("en", "one two")], **OPTIONS) == []
    rows = [("en", "ab cd " * 50_000), ("en", "ab " * 100_000), (None, None)]
    assert run(spark, rows, shard_words=1000, **OPTIONS) == expected(rows, 4)


def test_index_intervals_stay_in_step():
    rnd = np.random.default_rng(3)
    for _ in range(20):
        text = np.append(rnd.integers(0, 5, rnd.integers(1, 200)), 0)
        index = col.Index(text, 4)
        count = Counter(tuple(text[i:i + k].tolist()) for k in (2, 3, 4) for i in range(len(text) - k + 1)
                        if 0 not in text[i:i + k])
        first, second, n = col.pairs(index)
        assert dict(zip(zip(first.tolist(), second.tolist()), n.tolist())) == {p: c for p, c in count.items() if len(p) == 2}
        every = np.sort(first * 5 + second)
        for words, n in col.longer(index, every):
            got = dict(zip(zip(*[w.tolist() for w in words]), n.tolist()))
            assert got == {p: c for p, c in count.items() if len(p) == len(words)}
        word, lo, n = index.words()
        parent, x, at, back, m = index.extend(lo, lo, n, left=True)
        first = [x, word[parent]]
        parent, y, back, at, m = index.extend(back, at, m, left=False)
        one = dict(zip(zip(first[0][parent].tolist(), first[1][parent].tolist(), y.tolist()), zip(at, back, m)))
        parent, y, back, at, m = index.extend(lo, lo, n, left=False)
        last = [word[parent], y]
        parent, x, at, back, m = index.extend(at, back, m, left=True)
        other = dict(zip(zip(x.tolist(), last[0][parent].tolist(), last[1][parent].tolist()), zip(at, back, m)))
        assert one == other


def test_scores_past_64_bits(spark):
    big = 9_000_000_000_000_000_000
    words = spark.createDataFrame([(1, "en", b"a", big), (2, "en", b"b", big)], "id bigint, lang string, word binary, f bigint")
    phrases = spark.createDataFrame([([1, 2], big)], "p array<bigint>, f bigint")
    assert col.scored(words, phrases).first()["score"] == 1_000_000
