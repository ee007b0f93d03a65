"""Scalar column helpers (section 2.9 functions), all built-in expressions so
they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Scoring bands of the snapshot tables, checked in order,
# first match wins (strictly greater than).
POINT_BANDS = [(20, "star"), (15, "good"), (10, "average")]
POINT_BAND_DEFAULT = "bad"
# Rating bands of the actor form of the snapshot.
RATING_BANDS = [(8, "star"), (7, "good"), (6, "average")]

# Referrer -> channel rules, first match wins; anything else
# keeps the raw referrer. The site's own domains map to 'On Site' after
# these (see ``referrer_rules``).
REFERRER_RULES = [
    ("%linkedin%", "Linkedin"),
    ("%t.co%", "Twitter"),
    ("%google%", "Google"),
    ("%lnkd%", "Linkedin"),
]
ON_SITE = "On Site"


def referrer_rules(site_domains=()) -> list[tuple[str, str]]:
    """The channel rules followed by one 'On Site' rule per own domain."""
    return REFERRER_RULES + [(f"%{d}%", ON_SITE) for d in site_domains]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value, bands: Sequence[tuple[float, str]] = POINT_BANDS,
         default: str = POINT_BAND_DEFAULT) -> Column:
    """Threshold banding, ``value > t`` checked top-down."""
    v = col_(value)
    expr = None
    for threshold, label in bands:
        expr = (F.when(v > threshold, label) if expr is None
                else expr.when(v > threshold, label))
    return expr.otherwise(default) if expr is not None else F.lit(default)


def classify_like(value, rules: Sequence[tuple[str, str]] = REFERRER_RULES,
                  default=None) -> Column:
    """LIKE-pattern classification, first matching rule wins; the
    default is the input itself."""
    v = col_(value)
    expr = None
    for pattern, label in rules:
        expr = (F.when(v.like(pattern), label) if expr is None
                else expr.when(v.like(pattern), label))
    fallback = v if default is None else F.lit(default)
    return expr.otherwise(fallback) if expr is not None else fallback


def changed(a, b) -> Column:
    """Null-safe inequality (a null transition counts as a change)."""
    return ~col_(a).eqNullSafe(col_(b))


def safe_ratio(num, den) -> Column:
    """Num / den as double, null when den is 0."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def contains_flag(text, needle: str) -> Column:
    """``POSITION(needle IN text) > 0`` with a null text read as false."""
    return F.coalesce(F.instr(col_(text), needle) > 0, F.lit(False))


def minutes_from_mmss(text) -> Column:
    """F8: 'mm:ss' -> minutes as double; malformed parts give null, a
    missing seconds part counts as 0."""
    t = col_(text)
    mins = F.split_part(t, F.lit(":"), F.lit(1)).try_cast("double")
    secs = F.split_part(t, F.lit(":"), F.lit(2))
    secs = F.when(secs == "", F.lit(0.0)).otherwise(secs.try_cast("double"))
    return mins + secs / 60.0


def json_object(**fields) -> Column:
    """JSON object text that keeps null fields (like a SQL builder)."""
    return F.to_json(F.struct(*[col_(v).alias(k) for k, v in fields.items()]),
                     {"ignoreNullFields": "false"})


def string_map(**fields) -> Column:
    """map<string,string> of named properties."""
    parts = []
    for k, v in fields.items():
        parts += [F.lit(k), col_(v).cast("string")]
    return F.create_map(*parts)


def join_ints(arr, sep: str = ",") -> Column:
    """Render an array of integers (or an integer field of structs via a
    lambda beforehand) as delimited text for flat reports."""
    return F.array_join(F.transform(col_(arr), lambda x: x.cast("string")), sep)


def join_dates(arr, sep: str = ",") -> Column:
    return F.array_join(F.transform(col_(arr), lambda x: F.date_format(x, "yyyy-MM-dd")), sep)


def cents(x) -> Column:
    """Money with two decimals as exact integer cents, so sums are exact
    and independent of the summation order."""
    return F.round(col_(x) * 100).cast("long")
