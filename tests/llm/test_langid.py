"""Language spans against plain recomputation, and held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import langid
from cumulus.llm.catalog import QUERIES

SCHEMA = "doc_id bigint, lang string, text string"
EN, DE, EL = "the cat sat on the mat and that was the end of it", "der hund lief durch den wald und das war nicht gut", \
    "η γάτα και ο σκύλος είναι στο σπίτι"


def held(d):
    return zlib.crc32(str(d).encode()) % 4 == 2


def rows_of(n=60):
    return [(i, ("en", "de", "el")[i % 3], (EN, DE, EL)[i % 3]) for i in range(n)]


def run(spark, rows, extra=(), **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in extra:
        df = df.withColumn(c, F.lit("x"))
    return langid.identify(df, **options).collect()


def slow_path(score, switch):
    """Viterbi over all label sequences' prefixes, in plain Python."""
    n = score.shape[1]
    v, back = [0.0] * n, []
    for row in score.tolist():
        moved = max(v) - switch
        came = [i if v[i] >= moved else v.index(max(v)) for i in range(n)]
        v = [max(v[i], moved) + row[i] for i in range(n)]
        back.append(came)
    at = v.index(max(v))
    out = []
    for came in reversed(back):
        out.append(at)
        at = came[at]
    return out[::-1]


def test_viterbi_equals_brute_force():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 4):
        sizes = rnd.integers(0, 40, 12)
        score = rnd.normal(0, 3, (int(sizes.sum()), n))
        got, at = langid.viterbi(score, sizes, 4.0).tolist(), 0
        for s in sizes.tolist():
            assert got[at:at + s] == slow_path(score[at:at + s], 4.0)
            at += s


def test_words_are_runs_of_one_script():
    text = "Ab, ça1x Ωμέγαdoc 漢字かな😀हिन्दी".encode("utf-16", "surrogatepass").decode("utf-16")
    w = langid.words(text, 1 << 10)
    assert [text[a:b] for a, b in zip(w.start, w.end)] == ["Ab", "ça", "x", "Ωμέγα", "doc", "漢字", "かな", "हिन्दी"]
    assert w.letters.tolist() == [2, 2, 1, 5, 3, 2, 2, 3]
    again = langid.words("ab", 1 << 10)
    assert again.triples.tolist() == w.triples[:2].tolist() and again.closing[0] == w.closing[0]


def test_slices_leave_words_and_results_alone(spark):
    rows = rows_of()
    model, cells = langid.learn(spark.createDataFrame(rows, SCHEMA))
    texts = [EN + " " + DE, None, "", "12 !?", "x" * 300, " ".join([EN, EL] * 40), DE]
    assert langid.label(texts, model, cells, size=50) == langid.label(texts, model, cells)
    assert "".join(p for _, p in langid.slices(EN, 10)) == EN
    assert all(p[-1] == " " for _, p in list(langid.slices(EN, 10))[:-1])


def test_counts_equal_plain_counting(spark):
    rows = [(1, "en", "Aba ab"), (2, "en", None), (3, None, "zz"), (4, "de", "ÄB äb")]
    got = {(r[0], r[1]): r[2] for r in langid._counted(
        spark.createDataFrame(rows, SCHEMA).where("lang IS NOT NULL").select("lang", "text"), 1 << 12).collect()}

    def cell(a, b, c):
        return int(langid._cell(*[np.array([ord(x) if x else 0], dtype=np.uint32) for x in (a, b, c)], 1 << 12)[0])

    want = {}
    for lang, ws in (("en", ["aba", "ab"]), ("de", ["äb", "äb"])):
        for w in ws:
            chars = ["", "", *w]
            for t in [tuple(chars[i:i + 3]) for i in range(len(w))] + [(w[-2], w[-1], "")]:
                want[lang, cell(*t)] = want.get((lang, cell(*t)), 0) + 1
        want[lang, (1 << 12) + 1] = sum(map(len, ws))
    assert got == want


def test_mixed_text_has_spans_and_script_narrows(spark):
    rows = rows_of() + [(1000, None, f"{EN}. {DE}. {EL}"), (1001, None, "γάτα"), (1002, None, "漢字")]
    got = {r["doc_id"]: r for r in run(spark, rows)}
    spans = got[1000]["spans"]
    assert [s["lang"] for s in spans] == ["en", "de", "el"]
    assert [rows[60][2][s["start"]:s["end"]] for s in spans] == [EN, DE, EL]
    assert got[1000]["lang_pred"] == max((len([c for c in t if c.isalpha()]), k) for k, t in
                                         (("en", EN), ("de", DE), ("el", EL)))[1]
    assert (got[1001]["lang_pred"], got[1001]["score"]) == ("el", 1.0)
    assert got[1002]["lang_pred"] == "de"  # no language has the script: a tie, so the first
    for i, lang, _ in rows[:60]:
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["held_out"]) == (lang, 1.0, held(i))


def test_undefined_repeated_and_clashing_input(spark):
    odd = [(None, "en", EN), (70, "xx", None), (71, None, ""), (72, "en", "1 2 !"), (3, "en", EN), (3, "en", EN),
           (73, None, DE * 3000)]
    extra = ["held_out", "lang_pred", "score", "spans", "cell", "n", "cells", "start"]
    got = run(spark, rows_of() + odd, extra)
    assert len(got) == 67
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert (by[None][0]["held_out"], by[None][0]["lang_pred"]) == (False, "en")
    for d in (70, 71, 72):
        assert (by[d][0]["lang_pred"], by[d][0]["score"], by[d][0]["spans"]) == ("und", 0.0, [])
    assert len({tuple(r)[:4] for r in by[3] if r["lang_pred"] == "en"}) == 1
    assert by[73][0]["lang_pred"] == "de"
    assert run(spark, []) == []
    assert [r["lang_pred"] for r in run(spark, [(1, None, EN)])] == ["und"]


def test_model_has_a_fixed_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_CELLS", 1 << 12)
    model, cells = langid.learn(spark.createDataFrame(rows_of(), SCHEMA))
    assert cells == 1 << 10 and model.logs.shape == (3, 1 << 10)
    assert langid.label([EN, DE, EL], model, cells)[1][0] == "de"


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    out = QUERIES["op13_language_spans"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    right, n, low, high = out.where("held_out").agg(F.sum(F.expr("int(lang = lang_pred)")), F.count("*"),
                                                    F.min("score"), F.max("score")).first()
    assert n > 200 and right >= 0.99 * n and 0 <= low and high <= 1
