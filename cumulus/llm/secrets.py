"""Secret scans: three fixed patterns plus sliding-window Shannon entropy.

The base spans (assign, access, hex) are kept as they are. The entropy pass
adds spans over candidate strings, which are runs of key-like characters, or
what the base spans leave of them: each is classed by its characters (hex,
alphanumeric or base64), a window slides over it with incremental counts, and
windows whose entropy reaches the class's threshold merge into one span
``entropy``.
Allow-listed strings (identifiers, words, numbers, UUIDs, paths, sequences)
are not judged. A placeholder word hides itself alone: what stands on either
side of it is judged apart.

Defined results: null text counts as empty; offsets are code points, ends
exclusive; a run of any length is scanned in one pass; rows are judged alone;
extra columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cumulus.llm.common import emit

KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24}")

WINDOW = 20
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
_SEPARATORS = "+/_=-"
#: Least entropy in bits a character of a window, by character class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.7, "base64": 3.9}
#: Each string fits a pattern in one way only, so a failed match doesn't backtrack.
_ALLOWED = [re.compile(p) for p in (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
    r"[A-Z]?[a-z]*([-_/=+][A-Z]?[a-z]*)*",  # words, slugs, paths
    r"[A-Z]+([-_/=+][A-Z]+)*",
    r"[A-Z]?[a-z]{2,}([A-Z][a-z]{2,})*[0-9]{0,4}",  # camel case
    r"[0-9]+([-_/=+][0-9]+)*")]  # numbers, dates
_PLACEHOLDER = re.compile(r"example|placeholder|x{4,}|your[-_]", re.IGNORECASE)
_SEQUENCES = ("abcdefghijklmnopqrstuvwxyz" * 2, "0123456789" * 3, "0123456789abcdef" * 2)


def allowed(s: str) -> bool:
    low = s.lower()
    return any(p.fullmatch(s) for p in _ALLOWED) or any(low in q or low in q[::-1] for q in _SEQUENCES)


def char_class(s: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "alnum" if s.isalnum() else "base64"


_N_LOG = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def high_entropy(s: str, least: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans of the windows whose entropy is ``least`` bits or more.
    Counts are updated by one character in and one out."""
    count: dict[str, int] = {}
    total, out = 0.0, []
    log_width = math.log2(width)
    for i, c in enumerate(s):
        n = count.get(c, 0)
        total += _N_LOG[n + 1] - _N_LOG[n]
        count[c] = n + 1
        if i >= width:
            o = s[i - width]
            n = count[o]
            total += _N_LOG[n - 1] - _N_LOG[n]
            count[o] = n - 1
        if i >= width - 1 and log_width - total / width >= least - 1e-9:
            at = i - width + 1
            if out and at <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((at, i + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three patterns, sorted."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    at = 0
    while m := _LONG_HEX.search(text, at):  # a long run's first 24 characters start where the run starts
        end = _HEX.match(text, m.start()).end()
        out.append((m.start(), 2, end))
        at = end
    return sorted(out)


def parts(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the candidate strings: runs without the base spans.
    Separators next to a base span go too, unless that makes it too short."""
    held, first = sorted((s, e) for s, _, e in base), 0
    for m in _RUN.finditer(text):
        lo, hi = m.span()
        while first < len(held) and held[first][1] <= lo:
            first += 1
        at, k = lo, first
        while at < hi:
            while k < len(held) and held[k][1] <= at:
                k += 1
            s, e = held[k] if k < len(held) and held[k][0] < hi else (hi, hi)
            a, b = at, s
            while at > lo and a < b and text[a] in _SEPARATORS:
                a += 1
            while s < hi and a < b and text[b - 1] in _SEPARATORS:
                b -= 1
            if b - a >= WINDOW:
                yield a, b
            elif s - at >= WINDOW:
                yield at, s
            at = max(at, e)


def stretches(text: str, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """A candidate without its placeholder words and the separators next to
    them, as far as what is left is long enough."""
    at = lo
    for m in _PLACEHOLDER.finditer(text, lo, hi):
        end = m.start()
        while end > at and text[end - 1] in _SEPARATORS:
            end -= 1
        if end - at >= WINDOW:
            yield at, end
        at = m.end()
        while at < hi and text[at] in _SEPARATORS:
            at += 1
    if hi - at >= WINDOW:
        yield at, hi


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    for part in parts(text, base):
        for lo, hi in stretches(text, *part):
            s = text[lo:hi]
            if not allowed(s):
                out += [(lo + a, 3, lo + b) for a, b in high_entropy(s, THRESHOLDS[char_class(s)])]
    return out


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                  ("n_entropy", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan(docs: DataFrame) -> DataFrame:
    """Counts and spans of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(*map(pa.Array.to_pylist, batch.columns)):
                base = base_spans(text or "")
                more = entropy_spans(text or "", base)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc, *n, len(more), hashlib.sha256(_told(base).encode()).hexdigest(),
                             _told(sorted(base + more))))
            yield emit(rows, _OUT)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, "
             "base_sha256 string, spans string")
