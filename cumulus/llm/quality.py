"""Quality rules: text statistics and distribution divergence.

Besides word-count and repetition rules, each document's character-class and
common-word histograms are compared with its language's reference by
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1). The
references are the summed histograms of the language's documents that pass
the base rule; the languages are a fixed list, any other or null ``lang``
being one more, so the reference table has at most five rows. Both sides are
guarded: a document's histogram of fewer than the minimum of characters or
common words is not judged, nor is any by a reference of fewer than its own
minimum. A language whose characters are too few is judged by those of all
languages together, if these are enough.

Built-in column functions only; the measures are written once, so that the
references are sums over that table. Nothing is shuffled but these sums.

Defined results: null, empty or word-less text has zero words and fails the
base rule; ties don't arise; repeated rows repeat their result (and count
each in the references); all columns of the input stay, but those with the
name of a result are replaced; empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.llm.common import stored, unpacked, whole_row

#: Frequent function words of the four languages.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "ist", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "est", "pour"],
    "es": ["el", "y", "los", "del", "se", "las", "por", "con", "no", "su", "para", "al"],
}
VOCABULARY = [w for ws in COMMON.values() for w in ws]
SYMBOLS = "#*$%&|<>"
WS = r"[\x20\x09-\x0D]"
REPEAT_WORDS = 8
#: Largest distance that a kept document may have, and the smallest number of
#: characters or common words that a histogram is judged by.
MAX_CHAR_DISTANCE = 0.33
MAX_WORD_DISTANCE = 0.85
MIN_CHARS = 200
MIN_COMMON = 20
#: The smallest number of characters or common words of a reference.
MIN_REFERENCE_CHARS = 20_000
MIN_REFERENCE_COMMON = 1_000
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance",
           "base_failed", "kept")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column, width: int = REPEAT_WORDS) -> Column:
    """Words that lie in ``width``-word windows found twice or more in the
    text, the first one included."""
    def covered(win: Column) -> Column:
        at = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(at, lambda s: let(
            F.sort_array(F.filter(F.transform(s, lambda x, i: F.when(
                (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"])), lambda p: p.isNotNull())),
            lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(
                F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))), F.lit(0), lambda a, b: a + b)))

    def count(h: Column) -> Column:
        win = F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.xxhash64(F.slice(h, i, width)))
        return let(win, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w)))

    return F.when(F.size(words) < width, 0).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), count)).cast("bigint")


def _times(text: Column, part: str) -> Column:
    """How often ``part`` stands in ``text`` (JVM string replace, no regex)."""
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(float(len(part)))


def measured(docs: DataFrame, *carry: Column) -> DataFrame:
    """The columns ``carry`` beside the base measures and both histograms."""
    lang = F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise("other") if "lang" in docs.columns else F.lit("other")
    d = docs.select(*carry, F.coalesce("text", F.lit("")).alias("t"), lang.alias("language"))
    d = d.withColumns({
        "words": F.array_remove(F.split("t", WS + "+"), ""),
        "n": F.length("t"),
        "rest": F.regexp_replace("t", "[a-z]+", "")})
    d = d.withColumns({"dense": F.regexp_replace("rest", WS + "+", ""),
                       "hits": F.filter(F.split(F.lower("t"), WS + "+"), lambda w: w.isin(*VOCABULARY))})
    d = d.withColumn("told", F.concat(F.lit(" "), F.array_join("hits", "  "), F.lit(" ")))
    dense = F.col("dense")
    without = {k: F.length(dense) - F.length(F.regexp_replace(dense, f"[{c}]+", "")) for k, c in (
        ("upper", "A-Z"), ("digit", "0-9"), ("symbol", SYMBOLS), ("mark", "-.,;:!?'\"()"))}
    d = d.withColumns(without)
    space = F.length("rest") - F.length(dense)
    chars = [F.col("n") - F.length("rest"), F.col("upper"), F.col("digit"), space, F.col("symbol"), F.col("mark"),
             F.length(dense) - F.col("upper") - F.col("digit") - F.col("symbol") - F.col("mark")]
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumns({
        "n_words": F.size("words").cast("bigint"),
        "word_chars": (F.col("n") - space).cast("bigint"),
        "n_symbols": F.col("symbol").cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": repeat_words(F.col("words")),
        "chars": F.array(*[c.cast("double") for c in chars]),
        "common": F.array(*[_times(F.col("told"), f" {w} ") for w in VOCABULARY]),
        "n_chars": F.col("n"), "n_common": F.size("hits")})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return d.withColumn("base_failed", failed).select(
        *[c for c in d.columns if c == "row"], "language", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "chars", "common", "n_chars", "n_common")


def references(m: DataFrame, min_chars: int = MIN_REFERENCE_CHARS, min_common: int = MIN_REFERENCE_COMMON) -> DataFrame:
    """Summed histograms (ref_chars, ref_common) by language, at most five
    rows; null where a reference is too small to judge by."""
    def summed(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.when(~F.col("base_failed"), F.col(name)[i]).otherwise(0.0)) for i in range(size)])

    own = m.groupBy("language").agg(summed("chars", 7).alias("c"), summed("common", len(VOCABULARY)).alias("w"))
    every = F.array(*[F.sum(F.col("c")[i]).over(Window.partitionBy(F.lit(0))) for i in range(7)])  # of five rows
    return own.withColumn("all", every).select(
        "language",
        F.when(_total(F.col("c")) >= min_chars, F.col("c")).when(_total(F.col("all")) >= min_chars, F.col("all"))
        .alias("ref_chars"),
        F.when(_total(F.col("w")) >= min_common, F.col("w")).alias("ref_common"))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms; 0 if either is empty."""
    def half(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def whole(x: Column, y: Column) -> Column:
        return _total(F.zip_with(x, y, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))) / 2

    def scaled(h: Column, n: Column) -> Column:
        return F.transform(h, lambda x: x / n)

    d = let(_total(p), lambda n: let(_total(q), lambda k: whole(scaled(p, n), scaled(q, k))))
    return F.when((_total(p) > 0) & (_total(q) > 0), F.sqrt(F.greatest(d, F.lit(0.0)))).otherwise(0.0)


def judged(docs: DataFrame, carry: list[str] | None = None, max_char: float = MAX_CHAR_DISTANCE,
           max_word: float = MAX_WORD_DISTANCE, min_chars: int = MIN_CHARS, min_common: int = MIN_COMMON) -> DataFrame:
    """Each row's columns ``carry`` (all of them by default) as a struct
    ``row`` beside the results."""
    m = stored(measured(docs, whole_row(docs if carry is None else docs.select(*carry))), "quality-measures")
    d = m.join(F.broadcast(references(m)), "language").withColumns({
        "char_distance": F.when((F.col("n_chars") >= min_chars) & F.col("ref_chars").isNotNull(),
                                js_distance(F.col("chars"), F.col("ref_chars"))),
        "word_distance": F.when((F.col("n_common") >= min_common) & F.col("ref_common").isNotNull(),
                                js_distance(F.col("common"), F.col("ref_common")))})
    far = F.coalesce(F.col("char_distance") > max_char, F.lit(False)) | F.coalesce(
        F.col("word_distance") > max_word, F.lit(False))
    return d.withColumn("kept", ~F.col("base_failed") & ~far).select("row", *RESULTS)


def quality(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the results: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, char_distance, word_distance, base_failed and kept."""
    return unpacked(judged(docs, **limits), docs.columns, *RESULTS)
