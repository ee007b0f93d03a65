"""Training-data operators against brute force, reference libraries or SQL,
and their defined results on nulls, empty, long, tied and repeated input."""
import base64
import hashlib
import io
import itertools
import math
import random
import re
import time
import zipfile
from collections import Counter

import duckdb
import pandas as pd
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from cumulus.llm import (bytebpe, decontaminate, licenses, linedup, minmax, passages, quality, secrets, textsets,
                         toxicity, warczip)
from cumulus.llm.catalog import ORACLE, QUERIES

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def prose(r, n, words=400):
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Null, empty, blank, very long, tied and repeated rows."""
    r = random.Random(1)
    long = "\n".join(prose(r, 200) for _ in range(100))
    base = prose(r, 120)
    edit = base.split()
    edit[60] = "changed"
    return [(0, None, "en", "s", None), (1, "", None, None, 0), (2, " \t\n\r ", "xx", "s", 5), (3, long, "en", "s", 1),
            (4, base, "de", "s", 1), (5, " ".join(edit), "de", "s", 1), (6, base, "fr", "t", 1), (6, base, "fr", "t", 1),
            (None, base, "en", "s", 1), (7, "One two", "en", "s", 7), (8, "é漢\U0001F600 " * 30, "en", "s", 1),
            (9, "a" * 30000, "en", "s", 1)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DDL)


def table(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# --- near duplicates -------------------------------------------------------

def brute_components(rows, width, percent):
    sets = {}
    for d, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(textsets.ASCII_LOWER))
        k = min(width, len(ws))
        sets[d] = {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()
    root = {d: d for d in sets}
    for _ in sets:
        for a, b in itertools.combinations(sorted(sets), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo = min(root[a], root[b])
                root = {d: lo if x in (root[a], root[b]) else x for d, x in root.items()}
        break
    return {d: (len(sets[d]), root[d]) for d in sets}


@pytest.mark.parametrize("task_shingles", [minmax.TASK_SHINGLES, 300])
def test_minmax_against_brute_force(spark, task_shingles):
    r = random.Random(5)
    rows = []
    for g in range(4):
        base = prose(r, 90, 5000).split()
        for _ in range(14):
            t = list(base)
            for _ in range(r.randrange(0, 5)):
                t[r.randrange(len(t))] = f"x{r.randrange(9999)}"
            rows.append((len(rows) * 3, " ".join(t)))
    rows += [(len(rows) * 3 + i, prose(r, 60, 5000)) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minmax.near_duplicates(df, 3, 85, task_shingles=task_shingles).collect()
    want = brute_components(rows, 3, 85)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)


def test_minmax_defined_results(odd):
    got = sorted(minmax.near_duplicates(odd, 3, 85).collect(), key=lambda x: (x.doc_id is None, x.doc_id or 0))
    by = {x.doc_id: x for x in got}
    assert len(got) == 12 and by[0].n_shingles == by[1].n_shingles == by[2].n_shingles == 0
    assert by[6].component_id == 4 and by[5].component_id == 4 and by[7].n_shingles == 1
    assert by[None].component_id is None and by[None].kept


@pytest.mark.parametrize("task_shingles", [minmax.TASK_SHINGLES, 300])
def test_repeated_ids_keep_each_text_s_links(spark, task_shingles):
    """Rows are the nodes: groups of rows by brute force, texts under one id apart."""
    r = random.Random(31)
    base = [prose(r, 40) for _ in range(8)]
    rows = []
    for i in range(60):
        t = base[r.randrange(8)].split()
        if r.random() < 0.7:
            t[r.randrange(40)] = f"w{i}"
        rows.append((r.randrange(25), " ".join(t)))
    rows += rows[:5] + [(1, base[0]), (2, base[0] + " x"), (2, base[1] + " y"), (3, base[1])]
    sets = [{tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)} for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minmax.near_duplicates(df, 3, 85, task_shingles=task_shingles).collect()
    assert sorted((x.doc_id, x.component_id) for x in got) == sorted((d, least[find(i)]) for i, (d, _) in enumerate(rows))
    stay = minmax.without_near_duplicates(df, 3, 85).collect()
    by_text = {t: find(i) for i, (_, t) in enumerate(rows)}
    assert sorted(by_text[x.text] for x in stay) == sorted(least)
    assert all(x.doc_id == least[by_text[x.text]] and (x.doc_id, x.text) in rows for x in stay)


def test_min_max_bands_are_unbiased():
    r = random.Random(2)
    a = {f"t{i}" for i in range(400)}
    b = set(list(sorted(a))[:300]) | {f"u{i}" for i in range(100)}
    h = lambda s: __import__("numpy").unique(textsets.word_hashes(sorted(s)))
    m = minmax.multipliers(512)
    same = (minmax.min_max(h(a), m) == minmax.min_max(h(b), m)).mean()
    assert abs(same - len(a & b) / len(a | b)) < 0.06, r


# --- byte-level BPE --------------------------------------------------------

@pytest.fixture(scope="module")
def reference_bpe():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCAB, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_reference(reference_bpe, monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHE", 40)
    codec = bytebpe.Codec(bytebpe.build_model(bytebpe.read_ranks(VOCAB)), public_tokenizers.PATTERN)
    r = random.Random(9)
    pool = "abcé漢 \n\t12'sx\x1c\x85 \U0001F600"
    texts = ["", " ", "don't stop", "a" * 5000] + ["".join(r.choice(pool) for _ in range(r.randrange(80))) for _ in range(300)]
    for t in texts:
        ids = codec.encode(t)
        assert ids == reference_bpe.encode_ordinary(t) and codec.decode(ids) == t.encode()


def test_bpe_frame(odd, odd_rows, reference_bpe):
    got = bytebpe.encode(odd.withColumnRenamed("source", "ids"), VOCAB, public_tokenizers.PATTERN).collect()
    assert len(got) == len(odd_rows)
    want = sorted(hashlib.sha256(",".join(map(str, reference_bpe.encode_ordinary(t or ""))).encode()).hexdigest()
                  for _, t, *_ in odd_rows)
    assert sorted(x.ids_sha256 for x in got) == want
    assert sorted(x.decoded_sha256 for x in got) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in odd_rows)


# --- decontamination -------------------------------------------------------

def test_block_max_wand_retrieves_all():
    import numpy as np
    r = random.Random(3)
    items = [(i, prose(r, r.randrange(4, 40), 60)) for i in range(70)]
    ws = [decontaminate.tokens(t) for _, t in items]
    df = Counter(w for x in ws for w in set(x))
    index = decontaminate.Index(items, df, len(items), sum(map(len, ws)) / len(ws))
    text = dict(items)
    for _ in range(60):
        passage = set(prose(r, 30, 70).split())
        got = index.retrieve(np.array(sorted(index.term[w] for w in passage if w in index.term)), 0.4)
        want = {}
        mean = sum(map(len, ws)) / len(ws)
        for at, i in enumerate(index.ids):
            c = Counter(decontaminate.tokens(text[i]))
            n = sum(c.values())
            s = {w: math.log(1 + (70 - df[w] + .5) / (df[w] + .5)) * f * 2.2 / (f + 1.2 * (.25 + .75 * n / mean))
                 for w, f in c.items()}
            score = sum(s[w] for w in passage if w in s) / sum(s.values())
            if score >= 0.4:
                want[at] = score
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_passages_that_are_not_asked_hold_nothing():
    """Over whole texts, the passages asked give what asking every one gives."""
    import numpy as np
    r = random.Random(33)
    items = [(i, prose(r, r.randrange(6, 30), 90) + (". " + prose(r, r.randrange(2, 9), 90) if i % 2 else "")) for i in range(60)]
    ws = [decontaminate.tokens(t) for _, t in items]
    index = decontaminate.Index(items, Counter(w for x in ws for w in set(x)), 60, sum(map(len, ws)) / 60)
    step, hits, asked = index.longest, 0, 0
    for _ in range(80):
        t = prose(r, r.randrange(1, 200), 150).split()
        part = items[r.randrange(60)][1].split()
        at = r.randrange(len(t))
        t[at:at] = part[: r.randrange(1, len(part) + 1)]
        ids = np.array([index.term.get(w.strip("."), index.unknown) for w in t], dtype=np.int64)
        some = index.asked(ids)
        asked += len(some)
        for i in range(max(1, -(-(len(ids) - step) // step))):
            w = ids[i * step:i * step + 2 * step]
            got = index.retrieve(np.unique(w[w != index.unknown]), decontaminate.SCORE)
            assert not got or i in some
            hits += len(got)
    assert hits > 40 and asked > 0


def test_index_is_linear_in_its_words():
    import pickle
    r = random.Random(35)
    sizes = []
    for n in (400, 1600):
        items = [(i, " ".join(f"v{int(r.paretovariate(0.6)) % (n * 9)}" for _ in range(25))) for i in range(n)]
        ws = [decontaminate.tokens(t) for _, t in items]
        sizes.append(len(pickle.dumps(decontaminate.Index(items, Counter(w for x in ws for w in set(x)), n, 25))))
    assert sizes[1] < 5 * sizes[0]


def test_decontamination(spark, odd):
    r = random.Random(4)
    q = [(i, prose(r, 25, 3000) + f". answer {i} is here now.") for i in range(20)]
    q += [(20, None), (21, ""), (22, q[0][1])]
    docs = [(100 + i, prose(r, 300, 3000) + " " + q[i][1] + "\n" + prose(r, 50 * i, 3000)) for i in range(5)]
    docs += [(200 + i, prose(r, 200, 3000)) for i in range(20)]
    items = spark.createDataFrame(q, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = {(100 + i, i) for i in range(5)} | {(100, 22)}
    for size in (decontaminate.INDEX_WORDS, 100):
        assert {(x.doc_id, x.item_id) for x in decontaminate.leaked_items(df, items, size).collect()} == want
    left = decontaminate.without_leaks(df, items)
    assert left.columns == df.columns and {x.doc_id for x in left.collect()} == {200 + i for i in range(20)}
    assert decontaminate.leaked_items(odd, items).count() == 0
    assert decontaminate.without_leaks(odd, items.limit(0)).count() == 12


def test_question_alone_leaks(spark):
    r = random.Random(14)
    common = prose(r, 12, 40)
    ask = [f"{prose(r, 10, 40)}. rare{i}a rare{i}b rare{i}c rare{i}d rare{i}e rare{i}f rare{i}g rare{i}h rare{i}i rare{i}j."
           for i in range(30)]
    asked = [t.split(". ")[0] for t in ask]
    changed = asked[3].split()
    changed[-1] = "other"
    rows = [(i, prose(r, 80, 9000) + f" {asked[i]} " + prose(r, 90, 9000)) for i in range(3)]
    rows += [(3, prose(r, 90, 9000) + " " + " ".join(changed) + " " + prose(r, 30, 9000)), (4, prose(r, 200, 9000) + common)]
    items = spark.createDataFrame(list(enumerate(ask)), "item_id bigint, text string")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {(d, i) for d, t in rows for i, q in enumerate(asked)
            if (s := decontaminate.shingles(q.split())) and len(s & decontaminate.shingles(t.split())) >= 0.8 * len(s)}
    assert {(i, i) for i in range(4)} <= want
    got = decontaminate.leaked_items(docs, items).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    assert all(x.score < decontaminate.SCORE and x.question_overlap >= 0.8 for x in got)
    assert {x.doc_id for x in decontaminate.without_leaks(docs, items).collect()} == {4}


# --- substring dedup -------------------------------------------------------

def test_compact_windows_are_exact():
    import numpy as np
    r = np.random.default_rng(0)
    for n, width in ((30, 4), (80, 9), (12, 12), (5, 9)):
        v = r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
        want = []
        for c in range(n):
            a = b = c
            while a > 0 and v[a - 1] > v[c]:
                a -= 1
            while b < n - 1 and v[b + 1] > v[c]:
                b += 1
            if b - a + 1 >= width:
                want.append((a, c, b))
        assert passages.compact_windows(v, width) == want


def test_signatures_of_many_texts_are_those_of_each():
    """A batch of texts gives each text's own signatures, by brute force."""
    import numpy as np
    r = random.Random(26)
    texts = ["", "one two", prose(r, 40, 30), "a " * 60, prose(r, 90, 10**6), "\u00c9 \u00e0\x1cB\x85c A\x0bd " * 9, prose(r, 12, 10**6)]
    raw = [t.encode() for t in texts]
    h, starts = passages.hashed(raw)
    mult, width = minmax.multipliers(3), 9
    k, c = passages.signature_rows(h, starts, mult, width)
    assert len(starts) == len(texts) + 1 and passages.signature_rows(h[:0], np.array([0, 0]), mult, width)[0].size == 0
    of, reach, total = np.searchsorted(starts, c, "right") - 1, passages.REACH * width, 0
    for i, text in enumerate(texts):
        own = textsets.roll(textsets.word_hashes(textsets.words(text)), passages.SHINGLE)
        assert np.array_equal(own, h[starts[i] : starts[i + 1]])
        values = [textsets.mix(own * m) for m in mult]
        found = [[(max(a, x - reach), x, min(b, x + reach)) for a, x, b in passages.compact_windows(v, width)] for v in values]
        want = []
        for j, one in enumerate(found):
            for a, x, b in one:
                for a2, y, b2 in found[(j + 1) % 3]:
                    s, e = max(a, a2), min(b, b2)
                    if e - s >= width - 1 and s <= min(x, y) and max(x, y) <= e:
                        key = int(values[j][x]) * 0x9E3779B97F4A7C15 + int(values[(j + 1) % 3][y]) + j
                        want.append((int(textsets.mix(np.array([key % 2**64], dtype=np.uint64)).view(np.int64)[0]), x))
        assert sorted(zip(k[of == i].tolist(), (c[of == i] - starts[i]).tolist())) == sorted(want)
        total += len(want)
    assert total == len(k) > 0


def test_texts_reach_the_comparison_in_bounded_batches(spark, monkeypatch):
    """Memory of a task must not follow how long the compared texts are."""
    import pyarrow as pa
    from cumulus.llm import common
    asked = {}

    def noted(df, name, *parts, **more):
        asked[name] = more
        return common.stored(df, name, *parts, **more)

    monkeypatch.setattr(passages, "stored", noted)
    found_passages(spark, [(1, "a b"), (2, "a b")])
    most = asked["passage-links"]["batch_bytes"]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.nbytes], pa.int64())})

    wide = spark.range(0, 400, 1, 1).selectExpr("id", "repeat(cast(id as string), 20000) AS text")
    got = [x.n for x in common.stored(wide.mapInArrow(sizes, "n bigint"), "batches", batch_bytes=most).collect()]
    assert sum(got) > 8 * most and max(got) <= 2 * most
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_passages(spark, odd):
    r = random.Random(8)
    p, near = prose(r, 80, 9000), None
    near = p.split()
    near[40] = "other"
    rows = [(i, prose(r, 150, 9000)) for i in range(12)]
    rows += [(20, prose(r, 100, 9000) + " " + p + " " + prose(r, 60, 9000)), (21, p + " " + prose(r, 90, 9000)),
             (22, prose(r, 30, 9000) + " " + " ".join(near) + " " + prose(r, 70, 9000))]
    rows += [(30, rows[0][1]), (31, " ".join(rows[1][1].split()[:30]))]
    got = {x.doc_id: x for x in passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {d for d, x in got.items() if x.component_id != d} == {21, 22, 30}
    assert got[21].component_id == got[22].component_id == 20 and got[30].copy_of == 0
    assert got[21].passages == "0:80:20" and got[21].n_repeated_words == 80
    assert passages.repeated_passages(odd).count() == 12


def found_passages(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {x.doc_id: x for x in passages.repeated_passages(df).collect()}


def test_passage_held_twice(spark):
    r = random.Random(21)
    p = prose(r, 70, 10**7).split()
    short = " ".join(p[:20])
    rows = [(1, prose(r, 40, 10**7) + " " + " ".join(p) + " " + prose(r, 40, 10**7)),
            (2, " ".join([prose(r, 30, 10**7), *p, prose(r, 90, 10**7), *p, prose(r, 20, 10**7)])),
            (3, " ".join([prose(r, 30, 10**7), short, prose(r, 90, 10**7), *p]))]
    got = found_passages(spark, rows)
    assert got[2].passages == "30:100:1,190:260:1" and got[2].n_passages == 2 and got[2].n_repeated_words == 140
    assert "140:210:1" in got[3].passages.split(",") and got[3].n_repeated_words == 70


def test_exact_passage_beside_scattered_matches(spark):
    r = random.Random(22)
    rows = []
    for i in range(0, 120, 2):
        p, t = prose(r, 60, 10**7), prose(r, 60, 10**7).split()
        u = [w if k % 6 else f"y{r.randrange(10**7)}" for k, w in enumerate(t)]
        both = [[p, *t], [p, *u]] if i % 4 else [[*t, p], [*u, p]]
        rows += [(i + k, " ".join([prose(r, 60, 10**7), *x, prose(r, 60, 10**7)])) for k, x in enumerate(both)]
    got = found_passages(spark, rows)
    assert [i for i in range(0, 120, 2) if got[i + 1].component_id != i or got[i + 1].n_repeated_words < 60] == []


def test_dense_stretches_against_brute_force():
    import numpy as np
    r = random.Random(23)
    for _ in range(60):
        hit = np.array([i for i in range(60) if r.random() < 0.75] or [0])
        want = set()
        for i, a in enumerate(hit):
            for j, b in enumerate(hit):
                if b - a + 1 >= 9 and 5 * (j - i + 1) >= 4 * (b - a + 1):
                    want |= set(range(a, b + 1))
        assert {k for a, b in passages.dense(hit, 9) for k in range(a, b)} == want


def test_recall_of_edited_passages(spark):
    r = random.Random(24)
    rows = []
    for i in range(0, 400, 2):
        p = prose(r, 60, 10**7).split()
        q = list(p)
        for k in r.sample(range(60), 2):
            q[k] = f"x{r.randrange(10**7)}"
        rows += [(i + k, " ".join([prose(r, 100, 10**7), *x, prose(r, 90, 10**7)])) for k, x in enumerate((p, q))]
    got = found_passages(spark, rows)
    assert sum(got[i + 1].component_id == i for i in range(0, 400, 2)) >= 0.99 * 200


@pytest.mark.parametrize("phrase, holders", [(30, 1), (40, 1), (30, 20)])
def test_passage_with_a_phrase_of_smaller_documents(spark, phrase, holders):
    r = random.Random(25)
    rows, pairs = [], []
    for _ in range(40):
        p = prose(r, 55, 10**7).split()
        at = r.randrange(56 - phrase)
        texts = [p[at : at + phrase]] * holders + [p, p]
        rows += [(len(rows) + k, " ".join([prose(r, 60, 10**7), *x, prose(r, 60, 10**7)])) for k, x in enumerate(texts)]
        pairs.append((rows[-2][0], rows[-1][0]))
    got = found_passages(spark, rows)
    assert [(a, b) for a, b in pairs if got[b].passages != f"60:115:{a}"] == []
    assert {d for d, x in got.items() if x.component_id != d} == {b for _, b in pairs}


# --- line dedup, licences: SQL oracles on odd text -------------------------

@pytest.mark.parametrize("name", ["op6_line_dedup", "op7_license_dice"])
def test_sql_oracle_on_odd_lines(spark, tmp_path, name):
    r = random.Random(6)
    pool = ["alpha beta", "gamma", "", "  delta ", "delta", "Released under the MIT License.", "Licensed under CC BY 4.0."]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(12)))) for i in range(60)] + [(60, None)]
    sf = table(spark, tmp_path, documents=spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = QUERIES[name](spark, sf).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    want = con.sql(ORACLE[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda d: sorted(map(tuple, d[cols].astype(object).where(d[cols].notna(), None).astype(str).values.tolist()))
    assert key(got) == key(want)


def test_license_paragraphs(spark):
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
    isc = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
    rows = [(1, f"MIT License\n\nCopyright (c) 2020 Some One\n\n{mit}"), (2, f"Copyright 2020\n\n{isc}"), (3, mit.replace("\n", " ", 5))]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(x.doc_id, x.unit, x.unit_no, x.license) for x in got} >= {
        (1, "block", 2, "MIT"), (1, "block", 3, "MIT"), (2, "block", 1, "ISC"), (3, "line", 0, "MIT")}


def test_line_dedup_keeps_one_copy(odd):
    out = linedup.dedup_lines(odd)
    assert out.count() == 12 and out.columns[:5] != [] and set(out.columns) == {*odd.columns, "n_lines", "n_removed"}
    assert sum(x.n_removed for x in out.collect()) == 0


# --- quality ---------------------------------------------------------------

def brute_quality(t):
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    c = Counter(wins)
    cover = {i + k for i, w in enumerate(wins) if c[w] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(cover),
            len(ws) < 20 or 100 * len(cover) > 30 * len(ws))


def test_quality_measures(spark, odd_rows):
    r = random.Random(7)
    rows = odd_rows + [(100 + i, "\n".join(prose(r, r.randrange(15), 3) + "#|\x0b" for _ in range(9)), "en", "s", 1)
                       for i in range(60)]
    got = quality.quality(spark.createDataFrame(rows, DDL)).collect()
    f = lambda x: (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed)
    assert sorted((x.text or "", f(x)) for x in got) == sorted((t or "", brute_quality(t)) for _, t, *_ in rows)
    assert not any(x.kept and x.base_failed for x in got)


def char_classes(t):
    n = [0] * 7
    for c in t:
        n[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if c in " \t\n\x0b\x0c\r"
          else 4 if c in "#*$%&|<>" else 5 if c in "-.,;:!?'\"()" else 6] += 1
    return n


def common_words(t):
    return [re.split(r"[ \t-\r]+", t.lower()).count(w) for w in quality.VOCABULARY]


def plain_distance(p, q):
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda x, y: sum(i * math.log2(i / ((i + j) / 2)) for i, j in zip(x, y) if i)
    return math.sqrt(max(0.0, (kl(a, b) + kl(b, a)) / 2))


def test_verdict_against_brute_force(spark):
    r = random.Random(23)
    rows = []
    for i in range(160):
        lang = r.choice(["en", "en", "de", "fr", "xx", None])
        vocab = quality.COMMON.get(lang, ["lorem"]) + [f"Word{k}" for k in range(12)]
        if i % 9 == 0:
            vocab = [f"#{k}$%" for k in range(30)]
        if i % 11 == 0:
            vocab = quality.COMMON["es"]
        rows.append((i, " ".join(r.choice(vocab) for _ in range(r.randrange(10, 90))), lang, "s", 1))
    limits = dict(min_chars=60, min_common=10)
    refs = {}
    for _, t, lang, *_ in rows:
        if not brute_quality(t)[-1]:
            key = lang if lang in quality.COMMON else "other"
            old = refs.get(key, ([0] * 7, [0] * len(quality.VOCABULARY)))
            refs[key] = tuple([x + y for x, y in zip(a, b)] for a, b in zip(old, (char_classes(t), common_words(t))))
    every = [sum(x) for x in zip(*[c for c, _ in refs.values()])]
    least = sorted(sum(c) for c, _ in refs.values())[1]  # the smallest language falls back on all
    words = sorted(sum(w) for _, w in refs.values())[1]
    df = spark.createDataFrame(rows, DDL)
    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(quality.references, "__defaults__", (least, words))
        got = {x.doc_id: x for x in quality.quality(df, **limits).collect()}
    kinds = Counter()
    for i, t, lang, *_ in rows:
        c, w = refs[lang if lang in quality.COMMON else "other"]
        c = c if sum(c) >= least else every
        chars = plain_distance(char_classes(t), c) if len(t) >= 60 else None
        common = plain_distance(common_words(t), w) if sum(common_words(t)) >= 10 and sum(w) >= words else None
        for a, b in ((chars, got[i].char_distance), (common, got[i].word_distance)):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
        kept = not (brute_quality(t)[-1] or (chars or 0) > quality.MAX_CHAR_DISTANCE or (common or 0) > quality.MAX_WORD_DISTANCE)
        assert got[i].kept == kept
        kinds[kept, chars is None, common is None] += 1
    assert len(kinds) >= 5


def test_references_leave_junk_out(spark):
    r = random.Random(29)
    rows = [(i, prose(r, 200) + " the of and", "en", "s", 1) for i in range(60)]
    junk = " ".join(f"#{r.randrange(10**6)}$%&" for _ in range(80))
    got = {x.doc_id: x for x in quality.quality(spark.createDataFrame(
        rows + [(100, junk, "xx", "s", 1), (101, "#$ " * 4000, "zz", "s", 1), (102, rows[0][1], "zz", "s", 1)], DDL)).collect()}
    assert not got[100].kept and got[100].char_distance > quality.MAX_CHAR_DISTANCE  # judged by all languages together
    assert not got[101].kept and got[101].base_failed
    assert got[102].kept and all(got[i].kept for i in range(60))
    few = quality.quality(spark.createDataFrame([(100, junk, "xx", "s", 1)], DDL)).first()
    assert few.char_distance is None and few.word_distance is None and few.kept


def test_js_distance(spark):
    p, q = [3.0, 1.0, 0.0], [1.0, 1.0, 2.0]
    df = spark.createDataFrame([(p, q), (p, p), (p, [0.0] * 3)], "p array<double>, q array<double>")
    got = [x[0] for x in df.select(quality.js_distance(df.p, df.q)).collect()]
    a, b = [x / 4 for x in p], [x / 4 for x in q]
    kl = lambda x, y: sum(i * math.log2(i / ((i + j) / 2)) for i, j in zip(x, y) if i)
    assert abs(got[0] - math.sqrt((kl(a, b) + kl(b, a)) / 2)) < 1e-12 and got[1] == 0 and got[2] == 0


# --- secrets ---------------------------------------------------------------

def test_secrets():
    key = "Zq8fK2mV0xR7nT4bW9cL"
    text = f"é password = \"abc123\" secret=token:abcdef1 AKIA{'A' * 16} AKIAB {'0f' * 13} see {key} and words-in-a-slug-that-is-long"
    base = secrets.base_spans(text)
    assert [(k, text[s:e]) for s, k, e in base] == [
        (0, 'password = "abc123'), (1, "AKIA" + "A" * 16), (2, "0f" * 13)]
    assert [text[s:e] for s, _, e in secrets.entropy_spans(text, base)] == [key]


def test_entropy_windows_against_brute_force():
    r = random.Random(11)
    for _ in range(40):
        s = "".join(r.choice("aaabcdefgh0123456789XYZ") for _ in range(r.randrange(20, 90)))
        hit = set()
        for i in range(len(s) - 19):
            h = -sum(n / 20 * math.log2(n / 20) for n in Counter(s[i:i + 20]).values())
            if h >= 3.3 - 1e-9:
                hit |= set(range(i, i + 20))
        assert {i for a, b in secrets.high_entropy(s, 3.3) for i in range(a, b)} == hit


@pytest.mark.parametrize("form", ["example/{k}", "my_example_{k}", "/your-app/{k}", "{k}xxxx{k}", "{k}/placeholder",
                                  "EXAMPLE-{k}=", "{k}"])
def test_placeholder_hides_only_itself(form):
    key = "Zq8fK2mV0xR7nT4bW9cLd3Hs6Y"
    text = "see " + form.format(k=key) + " there"
    got = "".join(text[s:e] for s, _, e in secrets.entropy_spans(text, secrets.base_spans(text)))
    assert got.count(key) == form.count("{k}")
    for t in ("your_access_key_goes_in_here", "example-example-example-example", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"):
        assert secrets.entropy_spans(t, []) == []


def plain_base(text):
    """The contract's three kinds by plain search from left to right."""
    out = []
    kinds = [(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
             (r"(AKIA[A-Z0-9]+)", 20), (r"([0-9a-f]+)", 24)]
    for k, (pattern, least) in enumerate(kinds):
        at = 0
        while m := re.search(pattern, text[at:]):
            if len(m.group(1)) >= least:
                out.append((at + m.start(), k, at + m.end()))
            at += m.end()
    return sorted(out)


def test_base_spans_against_plain_search(spark):
    r = random.Random(19)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "apiKey", "=", ":", " ", '"', "'", "AKIA", "A1B2C3D4E5F6G7H8",
            "0123456789abcdef", "deadbeef", "abc", "é", "\n", "x.y", "/", "AKIAIOSFODNN7", "f" * 24, "token="]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(400)]
    assert sum(len(plain_base(t)) for t in texts) > 300
    kinds = ["assign", "access", "hex"]
    for row, t in zip(secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
                      .orderBy("doc_id").collect(), texts):
        base = plain_base(t)
        told = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        assert row.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        spans = row.spans.split(",") if row.spans else []
        assert [x for x in spans if not x.startswith("entropy")] == told
        order = [(int(x.split(":")[1]), [*kinds, "entropy"].index(x.split(":")[0])) for x in spans]
        assert order == sorted(order)


def test_allow_list_is_linear():
    for s in ("a" * 36 + "_1", "a-" * 22 + "a1", "a" * 30000 + "_1", "a-" * 15000 + "a1"):
        start = time.perf_counter()
        assert not secrets.allowed(s)
        assert time.perf_counter() - start < 1
    assert all(map(secrets.allowed, ("someCamelCaseIdentifier12", "path/to/Some_long-Name", "averylongsinglewordhere")))


def test_entropy_beside_base_spans():
    key, other = "Zq8fK2mV0xR7nT4bW9cL", "pQ3sY6uJ1hG5dE0zX8vN"
    text = f"path/{'0f' * 20}/{key} {other}-AKIA{'B' * 16}/{key}"
    base = secrets.base_spans(text)
    assert [(k, text[s:e]) for s, k, e in base] == [(2, "0f" * 20), (1, "AKIA" + "B" * 16)]
    assert [text[s:e] for s, _, e in secrets.entropy_spans(text, base)] == [key, other, key]


def test_secret_scan_frame(odd):
    assert {x.n_assign + x.n_access + x.n_entropy for x in secrets.scan(odd).collect()} == {0}


# --- WARC ------------------------------------------------------------------

@pytest.mark.parametrize("zip64", [False, True])
def test_zip_directory(zip64):
    sink = io.BytesIO()
    z = warczip.ZipWriter(sink, zip64)
    for name, data in ((warczip.DATA, b"abc" * 99), ("x/é", b"")):
        z.member(name, iter([data]), len(data), __import__("zlib").crc32(data))
    z.close()
    raw = sink.getvalue()
    got = warczip.directory(io.BytesIO(raw), len(raw))
    with zipfile.ZipFile(io.BytesIO(raw)) as f:
        assert f.testzip() is None and set(f.namelist()) == set(got)
        assert all(f.read(n) == raw[a : a + k] for n, (a, k) in got.items())


def test_warc_round_trip(spark):
    rows = [(5, "u", "same"), (3, "u", "same"), (3, "u", "same"), (9, None, None), (8, "x\r\ny", ""), (None, "z", "same"),
            (1, "q", "é" * 70000), (2, "q", "other")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS refers", "'k' AS sha")
    got = sorted((x.page_id if x.page_id is not None else -1, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to)
                 for x in warczip.round_trip(df).collect())
    d = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = [(-1, 4, d("same"), "revisit", 3), (1, 140000, d("é" * 70000), "response", None), (2, 5, d("other"), "response", None),
            (3, 4, d("same"), "response", None), (3, 4, d("same"), "response", None), (5, 4, d("same"), "revisit", 3),
            (8, 0, d(""), "response", None), (9, 0, d(""), "revisit", 8)]
    assert got == want
    assert warczip.round_trip(df.limit(0)).count() == 0


# --- toxicity --------------------------------------------------------------

def test_viterbi_is_the_best_path():
    words = ["idiot", "moron", "stupid", "the", "table", "loser"] * 5
    c = Counter()
    for w in words:
        w = f"^^{w}$"
        c.update(w[i:i + 3] for i in range(len(w) - 2))
    m = toxicity.CharModel(c)
    for token in ("1d10t", "s-t-u-p-1-d", "m0rrron", "t4bl3", "l0$er"):
        best = None
        for path in itertools.product(*toxicity.arcs(token)):
            s, h = 0.0, "^^"
            for written, cost in path:
                s += cost
                for x in written:
                    s += m(h, x)
                    h = h[1] + x
            s += m(h, "$")
            if best is None or s > best[0] + 1e-12:
                best = (s, "".join(w for w, _ in path))
        assert toxicity.viterbi(token, m) == best[1]
    assert toxicity.viterbi("1d10t", m) == "idiot"


def test_toxicity_learns_and_restores(spark, odd):
    r = random.Random(12)
    bad = ["idiot", "moron"]
    rows, labels = [], []
    for i in range(300):
        t = ["".join(r.choice("aeltrmnsu") for _ in range(r.randrange(2, 8))) for _ in range(30)]
        if i % 4 == 0:
            t[5] = r.choice(bad)
        rows.append((i, " ".join(t)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(1000, "some 1d10t here"), (1001, "a m-o-r-o-n"), (1002, "table lamp here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    got = {x.doc_id: x for x in toxicity.score(df, lab).collect()}
    assert all(got[i].predicted == t for i, t in labels)
    assert (got[1000].predicted, got[1001].predicted, got[1002].predicted) == (1, 1, 0)
    assert {x.score for x in toxicity.score(odd, lab.limit(0)).collect()} == {0.0}


def reader(words):
    c = Counter()
    for w in words:
        w = f"^^{w}$"
        c.update(w[i:i + 3] for i in range(len(w) - 2))
    return toxicity.Restorer(c)


@pytest.mark.parametrize("text, word", [
    ("an i  d  i  o  t there", "idiot"), ("an i.d-i.o-t, there", "idiot"), ("(\"1d10t\")", "idiot"), ("i\nd\ti o t", "idiot"),
    ("such a s_h-y", "shy"), ("s h y", "shy"), ("ÌDIÒT", "idiot"), ("iiiidiot", "idiot"), ("i. d. i. o. t.", "idiot")])
def test_spacing_of_any_kind_is_read(text, word):
    assert word in reader(["idiot", "shy", "there", "such", "an"] * 9)(text).split()


def test_restoring_is_linear_and_leaves_clean_text_alone():
    read = reader(["idiot", "table"])
    assert read("A table, is (clean) it's 3 tables: 12 don't!") == "a table is clean it s 3 tables 12 don t"
    for t in ("(" * 100_000, '("' * 50_000, "'" * 100_000 + "a", "a" * 100_000, "a." * 50_000, "a. " * 50_000, "a(" * 50_000,
              "((ab(\"" * 20_000):
        start = time.perf_counter()
        read(t)
        assert time.perf_counter() - start < 5, t[:8]


def test_repeated_ids_are_learnt_from_one_text(spark):
    r = random.Random(41)
    rows = [(i, " ".join(r.choice(["idiot", "moron"] if i % 2 else ["lamp", "table", "chair"]) for _ in range(9))) for i in range(60)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    twice = rows + [(i, "zzz " + t) for i, t in rows]  # sorts last, so it changes nothing
    make = lambda x: spark.createDataFrame(x, "doc_id bigint, text string")
    one = {x.doc_id: x.score for x in toxicity.score(make(rows), lab).collect()}
    two = toxicity.score(make(twice[::-1]), lab).collect()
    assert len(two) == 120 and {x.doc_id for x in two if abs(x.score - one[x.doc_id]) < 1e-9} == set(one)


# --- all: empty tables, clashing columns, pipeline -------------------------

def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], DDL + ", first bigint, k1 bigint, set_key string, kept boolean, _words string")
    sf = table(spark, tmp_path, documents=empty, benchmark=spark.createDataFrame([], "item_id bigint, text string"),
               labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"),
               pages=spark.createDataFrame([], "page_id bigint, url string, html string"))
    for name, q in QUERIES.items():
        assert q(spark, sf).count() == 0, name
    assert corpus_pipeline.run(spark, sf).count() == 0


def internal_names():
    """Every name that the subpackage or the pipeline gives a column, read from
    the sources."""
    import pathlib
    here = pathlib.Path(corpus_pipeline.__file__).parent
    found = set()
    for f in [here / "corpus_pipeline.py", *(here / "cumulus/llm").glob("*.py")]:
        found |= set(re.findall(r"""['"](_?[A-Za-z][A-Za-z0-9_]*)['"]""", f.read_text()))
    return sorted(n for n in found if n.lower() not in ("doc_id", "text", "lang", "source", "n_chars"))


def test_clashing_columns_and_pipeline(spark, tmp_path, odd):
    names, seen = [], set()
    for n in internal_names():  # column names are told apart without case
        if n.lower() not in seen:
            seen.add(n.lower())
            names.append(n)
    assert {"cut", "row", "kept", "language", "ref_chars", "node"} <= set(names)
    more = odd.select("*", *[F.lit(n).alias(n) for n in names])
    sf = table(spark, tmp_path, documents=more, benchmark=spark.createDataFrame([(1, "nothing of this is there at all")], "item_id bigint, text string"),
               labels=spark.createDataFrame([(4, 1, 1), (5, 1, 0)], "doc_id bigint, quality int, toxic int"),
               pages=spark.createDataFrame([(1, "u", "h")], "page_id bigint, url string, html string"))
    plain = table(spark, tmp_path / "plain", documents=odd, benchmark=spark.read.parquet(f"{sf}/benchmark.parquet"),
                  labels=spark.read.parquet(f"{sf}/labels.parquet"), pages=spark.read.parquet(f"{sf}/pages.parquet"))
    for name, q in QUERIES.items():
        assert sorted(map(str, q(spark, sf).collect())) == sorted(map(str, q(spark, plain).collect())), name
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.where(" OR ".join(f"`{n}` <> '{n}'" for n in names)).count() == 0, name
    assert sorted(x.doc_id for x in corpus_pipeline.run(spark, sf).collect() if x.doc_id is not None) == [3, 4]


def test_entry_has_all_and_pipeline_on_tables(spark, sf_small):
    import __spark_entry__ as E
    names = E.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    out = corpus_pipeline.run(spark, sf_small)
    n_in = spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert 0 < out.count() < n_in and isinstance(out.toPandas(), pd.DataFrame)
