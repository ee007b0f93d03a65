"""Toxicity of deobfuscated text.

Noisy channel: a token that carries a substitution or a letter repeated three
times or more, and three or more letters that stand alone (parted by any white
space or marks), become a character lattice (a sign may stand for a letter, a
separator for nothing, a run for one or two letters). Viterbi decoding under a
character trigram model picks the likeliest word. The model's counts come from
the words of all documents. The restored text is then scored by character
n-grams and words learnt from labelled rows. Text is worked on by tokens, each
folded and restored once and kept, so the work on a text is linear.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows (smallest hash
of the id first), never on rows whose crc32 of the id is divisible by five:
features are weighted by their log-odds over the two labels, and a logistic
regression over a document's strongest weights gives the score.

Defined results: null text counts as empty; an empty text has a score; null
ids are scored and never learnt from; ids that repeat in the labels count as
toxic if any row says so, and of several texts under one id the one that
sorts first is learnt from; null labels are left out; without labels of both
kinds every score is 0; letters outside Latin pass through unchanged; extra
columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cumulus.llm.common import emit, stored

#: Labelled rows that the classifier is fitted on, and features it may have.
FIT_ROWS = 20_000
FEATURES = 4_000
MIN_TOXIC_DOCS = 4
#: Least toxic rows times log-odds of a feature; weaker ones are chance.
MIN_GAIN = 12.0
GRAMS = (3, 4, 5, 6)

#: Letters that a sign may stand for.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
_SIGN = re.escape("".join(SIGNS))
_MARK = re.compile("[̀-ͯ]")
#: Letters one by one within a token, any separators between them.
_SPACED = re.compile(r"(?<![^\W_])[a-z0-9@$!](?:[.\-_*]{1,2}[a-z0-9@$!]){2,}(?![^\W_])")
_ALONE = re.compile(r"[a-z0-9@$!][.\-_*]*")
#: Tokens of one letter, marked as they are read; three or more are one word.
_LONE = "\x00"
_LONES = re.compile(f"{_LONE}.(?: {_LONE}.){{2,}}")
#: Stretches that may be noisy, and what makes one so.
_STRETCH = re.compile(f"[a-z{_SIGN}'’-]+")
_CORE = re.compile(f"[a-z][{_SIGN}]+[a-z]|[{_SIGN}][a-z]{{2}}|[a-z]{{2}}[0-9@$|+]|([a-z])\\1\\1")
_LETTER = re.compile("[a-z]+")
_EDGES = re.compile(r"[^\W_]+")
#: Tokens and characters that a task holds at once, and the longest token that is kept.
_FLUSH, _HELD, _SHORT = 1 << 18, 1 << 26, 64


def folded(text: str | None) -> str:
    """Lower case without accents."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return _MARK.sub("", unicodedata.normalize("NFKD", text.lower()))


# --- character model -------------------------------------------------------

def char_counts(docs: DataFrame) -> DataFrame:
    """Counts of the trigrams of all words (a to z, bounded by ^ and $) in all
    documents: gram, n. At most 28^3 rows, pre-summed in each task."""
    schema = pa.schema([("gram", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter = Counter()

        def grams():
            out: Counter = Counter()
            for token, n in tokens.items():
                for w in _LETTER.findall(folded(token)):
                    w = f"^^{w}$"
                    for i in range(len(w) - 2):
                        out[w[i : i + 3]] += n
            tokens.clear()
            return emit(list(out.items()), schema)

        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens.update((text or "").lower().split())
                held += len(text or "")
                if len(tokens) > _FLUSH or held > _HELD:
                    yield grams()
                    held = 0
        yield grams()

    return docs.select("text").mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


class CharModel:
    """log P(c | two characters before), add-0.1 smoothed."""

    def __init__(self, counts: dict[str, int]):
        total: Counter = Counter()
        for g, n in counts.items():
            total[g[:2]] += n
        self.log = {g: math.log((n + 0.1) / (total[g[:2]] + 2.7)) for g, n in counts.items()}
        self.none = {h: math.log(0.1 / (n + 2.7)) for h, n in total.items()}

    def __call__(self, before: str, c: str) -> float:
        p = self.log.get(before + c)
        return p if p is not None else self.none.get(before, -5.0)


_SWAP, _DROP, _DOUBLE, _RAW = -1.0, -0.1, -1.5, -12.0


def arcs(token: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each stretch of the token, what may be written for it
    and at what cost."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c, k = token[i], i
        while k < len(token) and token[k] == c:
            k += 1
        run, i = k - i, k
        if "a" <= c <= "z":
            out.append([(c, 0.0), (c + c, _DOUBLE)] if run > 2 else [(c * run, 0.0)])
        elif c in SIGNS:
            options = [(x, _SWAP) for x in SIGNS[c]] + ([(x + x, _SWAP + _DOUBLE) for x in SIGNS[c]] if run > 1 else [])
            out.append(options + [("", _RAW if c.isdigit() else 2 * _SWAP)])
        else:
            out.append([("", _DROP)])  # separators
    return out


def viterbi(token: str, model: CharModel) -> str:
    """Likeliest reading of the token."""
    states: dict[str, tuple[float, tuple]] = {"^^": (0.0, ())}
    for options in arcs(token):
        new: dict[str, tuple[float, tuple]] = {}
        for before, (score, path) in states.items():
            for written, cost in options:
                s, h = score + cost, before
                for c in written:
                    s += model(h, c)
                    h = h[1] + c
                if h not in new or s > new[h][0]:
                    new[h] = (s, (path, written) if written else path)
        states = new
    score, path = max(((s + model(h, "$"), p) for h, (s, p) in states.items()), key=lambda x: x[0])
    parts = []
    while path:
        path, w = path
        parts.append(w)
    return "".join(reversed(parts))


class Restorer(dict):
    """Text to its restored words, blank-joined. Keeps what it made of short
    tokens, ``_FLUSH`` of them at most."""

    def __init__(self, counts: dict[str, int]):
        super().__init__()
        self.model = CharModel(counts)

    def __missing__(self, token: str) -> str:
        t = folded(token)
        if _ALONE.fullmatch(t):
            read = _LONE + t[0]
        else:
            read = _SPACED.sub(lambda m: viterbi(m.group(), self.model), t)
            if _CORE.search(read):
                read = _STRETCH.sub(self._stretch, read)
        if not read.startswith(_LONE):
            read = " ".join(_EDGES.findall(read))
        if len(token) <= _SHORT:
            if len(self) >= _FLUSH:
                self.clear()
            self[token] = read
        return read

    def _stretch(self, m: re.Match) -> str:
        """A stretch read from where the token, a quote or a bracket opens it;
        if that has nothing noisy, no later start has."""
        run, at = m.group(), m.start()
        if at and m.string[at - 1] != '"':
            at = next((i + 1 for i, c in enumerate(run) if c in "'("), len(run))
        else:
            at = 0
        return run[:at] + viterbi(run[at:], self.model) if _CORE.search(run, at) else run

    def __call__(self, text: str | None) -> str:
        out = " ".join(map(self.__getitem__, (text or "").lower().split()))
        if _LONE in out:
            out = _LONES.sub(lambda m: viterbi(m.group().replace(_LONE, ""), self.model), out).replace(_LONE, "")
        return out


# --- classifier ------------------------------------------------------------

def grams(word: str) -> set[str]:
    w = f" {word} "
    return {w[i : i + k] for k in GRAMS for i in range(len(w) - k + 1)} | {w}


def learn(docs: DataFrame, labels: DataFrame, restore, fit_rows: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Weights of the features and the coefficients over ``summary``."""
    spark = docs.sparkSession
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    sample = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "toxic-sample")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).repartition(16, "doc_id")

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(
                list(map(restore(), batch.column("text").to_pylist())), pa.string())], names=["toxic", "text"])

    rows = stored(texts.mapInArrow(restored, "toxic int, text string"), "toxic-rows")
    sizes = dict(rows.groupBy("toxic").count().collect())
    if not (sizes.get(0) and sizes.get(1)):
        return {}, np.zeros(4)
    counted = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for w in set(text.split()):
                    words.setdefault(w, [0, 0])[toxic != 1] += 1
        out: dict[str, list[int]] = {}
        for w, (a, b) in words.items():
            for g in grams(w):
                x = out.setdefault(g, [0, 0])
                x[0] += a
                x[1] += b
        yield emit([(g, a, b) for g, (a, b) in out.items()], counted)

    f = rows.mapInArrow(count, "feature string, toxic bigint, clean bigint").groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (sizes[1] + 1)) - F.log((F.col("b") + 0.5) / (sizes[0] + 1))
    best = f.where(F.col("a") >= MIN_TOXIC_DOCS).withColumn("w", odds).where((F.col("w") > 1.5) & (F.col("a") * F.col("w") >= MIN_GAIN)).orderBy(
        F.desc(F.col("a") * F.col("w")), "feature").limit(FEATURES).collect()
    weights = {r["feature"]: float(r["w"]) for r in best}
    if not weights:
        return {}, np.zeros(4)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = matcher(weights)
        for batch in batches:
            yield emit([(t, *summary(x, found)) for t, x in zip(
                batch.column("toxic").to_pylist(), batch.column("text").to_pylist())], pa.schema(
                [("toxic", pa.int64()), ("x0", pa.float64()), ("x1", pa.float64()), ("x2", pa.float64())]))

    x = rows.mapInArrow(features, "toxic bigint, x0 double, x1 double, x2 double").toPandas()  # at most fit_rows rows
    return weights, logistic(x[["x0", "x1", "x2"]].to_numpy(), (x["toxic"] == 1).to_numpy(float))


def matcher(weights: dict[str, float]):
    found = ahocorasick.Automaton()
    for i, (g, w) in enumerate(sorted(weights.items())):
        found.add_word(g, (i, w))
    if weights:
        found.make_automaton()
    return found


def summary(restored: str, found) -> tuple[float, float, float]:
    """The strongest weight, the mean of the five strongest, and their number
    on a log scale; distinct features only."""
    if not len(found):
        return 0.0, 0.0, 0.0
    got = sorted((w for _, w in {x for _, x in found.iter(f" {restored} ")}), reverse=True)
    return (got[0] if got else 0.0), sum(got[:5]) / 5, math.log1p(len(got))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Coefficients (intercept last, not penalised) by Newton's method with
    ridge penalty, halving a step that does not lower the loss."""
    a = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.r_[np.full(x.shape[1], ridge), 0.0]

    def loss(b: np.ndarray) -> float:
        z = a @ b
        return float(np.sum(np.logaddexp(0, z) - y * z) + penalty @ (b * b) / 2)

    b = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-6)
        step = np.linalg.solve(h, a.T @ (y - p) - penalty * b)
        now, scale = loss(b), 1.0
        while scale > 1e-6 and loss(b + scale * step) > now:
            scale /= 2
        b = b + scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    return b


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    counts = dict(char_counts(docs).collect())  # at most 28^3 rows
    state: dict = {}

    def restore():
        if "r" not in state:
            state["r"] = Restorer(counts)
        return state["r"]

    weights, b = learn(docs, labels, restore, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, read = matcher(weights), Restorer(counts)
        for batch in batches:
            rows = []
            for doc, held, text in zip(*map(pa.Array.to_pylist, batch.columns)):
                z = float(np.dot(b[:-1], summary(read(text), found)) + b[-1]) if weights else -40.0
                p = 1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) if weights else 0.0
                rows.append((doc, held, p, int(p >= 0.5)))
            yield emit(rows, _OUT)

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int")
