"""Language identification of mixed-language text.

A word is a run of letters of one script. Its script narrows the languages to
those written in it, and each of these scores the word by the letter triples
in it; a Viterbi pass over a text's words, with a penalty for each switch,
labels every word, and neighbouring words of one language make a span. The
language with most letters is the text's.

The triples of all learning documents are counted into a fixed number of
hashed cells a language. Cells halve while languages times cells would pass
``MODEL_CELLS``, so the model that travels to the tasks has a fixed bound.

Defined results: a null text, or one without letters, has no spans, language
``und`` and score 0, as has every text if nothing could be learned; the score
of another is the language's share of the text's letters. Ties go to the
language that sorts first. A word in a script that no language is written in
scores nothing in any, so its neighbours decide. A document with a null id isn't learned from and isn't held out; rows
are judged one by one, so repeated rows repeat their result. Long texts are
handled in slices of ``SLICE`` characters cut between words (inside a word
only if it is longer). Columns that are not asked for are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cumulus.llm.common import emit, stored

CELLS = 1 << 15
MODEL_CELLS = 1 << 25
#: Penalty of a switch in nats, and the share of a language's letters from
#: which a script counts as its own.
SWITCH = 10.0
OWN_SHARE = 0.01
#: Characters that are scored at once.
SLICE = 1 << 21
UNKNOWN = "und"

#: Code point ranges of scripts.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x300, 0x36F),
              (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS) + 1
_LAST = 0x32400
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class _Tables:
    """Script of each letter (0: not one; marks count with their script),
    whether it is a letter, and its lower case; made once a process."""
    made = None

    def __new__(cls):
        if cls.made is None:
            cls.made = t = super().__new__(cls)
            kinds = [unicodedata.category(chr(c)) for c in range(_LAST)]
            t.letter = np.array([k[0] == "L" for k in kinds])
            t.script = np.where(t.letter, OTHER, 0).astype(np.uint8)
            used = t.letter | np.array([k[0] == "M" for k in kinds])
            for number, ranges in enumerate(SCRIPTS.values(), 1):
                for lo, hi in ranges:
                    at = slice(lo, min(hi + 1, _LAST))
                    t.script[at] = np.where(used[at], number, 0)
            t.lower = np.arange(_LAST, dtype=np.uint32)
            for c in np.nonzero(t.letter)[0].tolist():
                low = chr(c).lower()
                if len(low) == 1:
                    t.lower[c] = ord(low)
        return cls.made


@dataclass
class Words:
    """Words of a slice: first position and end, script, number of letters,
    and the hashed triples (one a character) with each word's first and the
    triple that closes it."""
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    triples: np.ndarray
    first: np.ndarray
    closing: np.ndarray


def _cell(a: np.ndarray, b: np.ndarray, c: np.ndarray, cells: int) -> np.ndarray:
    x = ((a.astype(np.uint64) * _M1 + b) ^ (b.astype(np.uint64) << np.uint64(21))) * _M2 + c
    x = (x ^ (x >> np.uint64(29))) * _M3
    return (x >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)


def words(text: str, cells: int) -> Words:
    t = _Tables()
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.where(code < _LAST, code, 0)
    script = t.script[code]
    at = np.nonzero(script)[0]
    kind, char = script[at], t.lower[code[at]]
    begins = np.ones(len(at), dtype=bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (kind[1:] != kind[:-1])
    first = np.nonzero(begins)[0]
    last = np.append(first[1:], len(at))[: len(first)] - 1
    one, two = np.roll(char, 1), np.roll(char, 2)
    one[begins] = 0
    two[begins] = 0
    two[1:][begins[:-1]] = 0
    before = np.where(first < last, char[last - 1], 0).astype(np.uint32)
    letters = np.add.reduceat(t.letter[code[at]].astype(np.int64), first) if len(first) else first
    return Words(at[first], at[last] + 1, kind[first], letters, _cell(two, one, char, cells), first,
                 _cell(before, char[last], np.zeros(len(last), dtype=np.uint32), cells))


def slices(text: str, size: int = SLICE) -> Iterator[tuple[int, str]]:
    """(offset, slice), cut after a character that isn't a letter."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end > at and (text[end - 1].isalpha() or unicodedata.category(text[end - 1])[0] == "M"):
            end -= 1
        end = end if end > at else at + size
        yield at, text[at:end]
        at = end
    yield at, text[at:]


@dataclass
class Model:
    """languages, log probabilities of cells and own scripts by language."""
    languages: list[str]
    logs: np.ndarray
    own: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """Score of each word in each language; one that isn't written in the
        word's script is out, if another is."""
        out = np.empty((len(w.first), len(self.languages)))
        for i, log in enumerate(self.logs):
            out[:, i] = np.add.reduceat(log[w.triples], w.first) + log[w.closing] if len(w.first) else 0
        written = self.own[:, w.script].T
        out[~written] = -1e6
        out[~written.any(axis=1)] = 0
        return out


def viterbi(score: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word of several texts, whose words follow each
    other; texts step together, the longest last."""
    n = score.shape[1]
    order = np.argsort(-sizes, kind="stable")
    size, start = sizes[order], (np.cumsum(sizes) - sizes)[order]
    v = np.zeros((len(sizes), n))
    best = np.zeros(len(score), dtype=np.int32)
    stays = np.ones(score.shape, dtype=bool)
    active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
    for t, k in enumerate(active.tolist()):
        at, w = start[:k] + t, v[:k]
        top = w.argmax(axis=1)
        moved = w[np.arange(k), top][:, None] - switch
        stay = w >= moved
        best[at], stays[at] = top, stay
        v[:k] = np.where(stay, w, moved) + score[at]
    label = np.zeros(len(score), dtype=np.int32)
    now = v.argmax(axis=1).astype(np.int32)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = start[:k] + t
        label[at] = now[:k]
        now[:k] = np.where(stays[at, now[:k]], now[:k], best[at])
    return label


def _groups(texts: list[str | None], size: int) -> Iterator[list[int]]:
    """Numbers of the texts, by length, in groups of about ``size`` characters."""
    group, held = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i] or "")):
        if group and held + len(texts[i] or "") > size:
            yield group
            group, held = [], 0
        group.append(i)
        held += len(texts[i] or "") + 1
    if group:
        yield group


def label(texts: list[str | None], model: Model, cells: int, switch: float = SWITCH, size: int = SLICE
          ) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) of each text."""
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    if not model.languages:
        return out
    for group in _groups(texts, size):
        joined = "\n".join(texts[i] or "" for i in group)
        made = [(at, words(part, cells)) for at, part in slices(joined, size)]
        score = np.concatenate([model.scores(w) for _, w in made])
        begin = np.concatenate([w.start + at for at, w in made])
        end = np.concatenate([w.end + at for at, w in made])
        letters = np.concatenate([w.letters for _, w in made])
        offset = np.cumsum([0] + [len(texts[i] or "") + 1 for i in group])
        bound = np.searchsorted(begin, offset)
        labels = viterbi(score, np.diff(bound), switch)
        for j, i in enumerate(group):
            here = slice(bound[j], bound[j + 1])
            total = letters[here].sum()
            if not total:
                continue
            share = np.bincount(labels[here], weights=letters[here], minlength=len(model.languages))
            most = int(share.argmax())
            own = labels[here]
            cut = np.append(0, np.nonzero(own[1:] != own[:-1])[0] + 1)
            to = np.append(cut[1:], len(own)) - 1
            spans = list(zip((begin[here][cut] - offset[j]).tolist(), (end[here][to] - offset[j]).tolist(),
                             [model.languages[x] for x in own[cut]]))
            out[i] = model.languages[most], float(share[most] / total), spans
    return out


def _counted(docs: DataFrame, cells: int) -> DataFrame:
    """Occurrences (lang, cell, n) in ``docs`` (lang, text); the cells after
    the last are the scripts' letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                count = total.setdefault(lang, np.zeros(cells + OTHER + 1, dtype=np.int64))
                for group in _groups(texts, SLICE):
                    for _, part in slices("\n".join(texts[i] for i in group)):
                        w = words(part, cells)
                        count[:cells] += np.bincount(w.triples, minlength=cells) + np.bincount(w.closing, minlength=cells)
                        count[cells:] += np.bincount(w.script, weights=w.letters, minlength=OTHER + 1).astype(np.int64)
        for lang, count in total.items():
            at = np.nonzero(count)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(count[at], pa.int64())],
                names=["lang", "cell", "n"])

    rows = docs.where("text IS NOT NULL").select("lang", "text").mapInArrow(run, "lang string, cell bigint, n bigint")
    return rows.groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, cells: int = CELLS, own_share: float = OWN_SHARE) -> tuple[Model, int]:
    """The model of all rows of ``docs`` (lang, text) with a language, and its
    number of cells a language."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    n = known.agg(F.countDistinct("lang")).first()[0]
    while cells > 2 and n * cells > MODEL_CELLS:
        cells //= 2
    rows = stored(_counted(known, cells), "langid-counts").toArrow()  # at most MODEL_CELLS rows and the scripts'
    langs = rows["lang"].to_numpy()
    languages = sorted(set(langs.tolist()), key=str.encode)
    count = np.zeros((len(languages), cells + OTHER + 1))
    number = {x: i for i, x in enumerate(languages)}
    count[[number[x] for x in langs.tolist()], rows["cell"].to_numpy()] = rows["n"].to_numpy()
    part = count[:, :cells] + 0.5
    script = count[:, cells:]
    own = script > own_share * script.sum(axis=1, keepdims=True)
    return Model(languages, np.log(part / part.sum(axis=1, keepdims=True)).astype(np.float32), own), cells


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))])


def identify(docs: DataFrame, cells: int = CELLS, switch: float = SWITCH) -> DataFrame:
    """Learns from the documents that are not held out and labels all:
    doc_id, held_out, lang_pred, score and spans (start, end, lang; code
    points, ends exclusive)."""
    model, cells = learn(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()), cells)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, out, text = (c.to_pylist() for c in batch.columns)
            told = label(text, sent.value, cells, switch)
            yield emit([(d, h, lang, score, [dict(zip(("start", "end", "lang"), s)) for s in spans])
                        for d, h, (lang, score, spans) in zip(doc, out, told)], _OUT)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text") \
        .mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, "
                         "spans array<struct<start:bigint,end:bigint,lang:string>>")
