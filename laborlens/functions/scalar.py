"""Scalar column expressions: each returns a ``Column`` built from Spark
built-ins only, so it stays inside whole-stage codegen."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def range_midpoint(lo, hi) -> Column:
    """Mean of both ends, else the end present, else null."""
    lo, hi = _c(lo), _c(hi)
    return F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2).otherwise(F.coalesce(lo, hi))


def to_base_currency(amount, currency, rules=K.CURRENCY_RULES, unknown: str = "keep",
                     base: str = K.BASE_CURRENCY) -> Column:
    """Ordered substring rules on the upper-cased code; the first rule that
    matches gives the rate.  A missing code and the base currency itself count
    at rate 1.  ``unknown='keep'`` leaves other codes unconverted, ``'null'``
    nulls them."""
    amount = _c(amount)
    code = F.upper(F.coalesce(_c(currency).cast("string"), F.lit("NAN")))
    expr = None
    for subs, rate in rules:
        cond = reduce(lambda a, b: a | b, [code.contains(s) for s in subs])
        expr = F.when(cond, amount * F.lit(float(rate))) if expr is None else expr.when(cond, amount * F.lit(float(rate)))
    if unknown == "null":
        expr = expr.when(code.contains(base) | (code == "NAN"), amount)
    return expr.otherwise(amount if unknown == "keep" else F.lit(None).cast("double"))


def normalize_category(col, rules=K.CITY_RULES, default: str = K.CITY_DEFAULT) -> Column:
    """Lower-case, first rule family with a contained spelling wins;
    null or no match -> ``default``."""
    low = F.lower(_c(col))
    expr = None
    for label, spellings in rules:
        cond = reduce(lambda a, b: a | b, [low.contains(s) for s in spellings])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(_c(col).isNull(), F.lit(default)).otherwise(expr.otherwise(F.lit(default)))


def _map_lit(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def encode_ordinal(col, mapping: Mapping = K.EXPERIENCE_LEVELS, default: int = 0) -> Column:
    """C4: exact label -> ordinal; unknown or missing -> ``default``."""
    return F.coalesce(F.element_at(_map_lit(mapping), _c(col)), F.lit(default))


def decode_ordinal(col, mapping: Mapping = K.EXPERIENCE_LABELS) -> Column:
    """Ordinal -> label (null when not in the map)."""
    return F.element_at(_map_lit(mapping), _c(col).cast("int"))


def slug(col) -> Column:
    """Spaces -> '_', dots removed, lower case."""
    return F.lower(F.replace(F.replace(_c(col), F.lit(" "), F.lit("_")), F.lit("."), F.lit("")))


def title_case(col) -> Column:
    """Upper-case the first letter after every non-letter, lower the rest
    (str.title semantics; unlike initcap it restarts after '/', digits...)."""
    parts = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def title_label(col, prefix: str = "skill_") -> Column:
    """Display label from a slug: prefix removed, '_' -> ' ', title case."""
    return title_case(F.replace(F.replace(_c(col), F.lit(prefix), F.lit("")), F.lit("_"), F.lit(" ")))


def flag_regex(col, pattern: str = K.REMOTE_PATTERN) -> Column:
    """Case-insensitive (Unicode) regex flag; null text counts as ''."""
    return F.coalesce(_c(col), F.lit("")).rlike(f"(?iu){pattern}")


def band(col, cuts: Sequence[float], labels: Sequence[str], right_open: bool = True) -> Column:
    """C17: ordered threshold bands.  ``labels[i]`` for values below
    ``cuts[i]`` (first match), the last label otherwise.  Null -> null."""
    c = _c(col)
    expr = None
    for cut, lab in zip(cuts, labels):
        cond = (c < F.lit(cut)) if right_open else (c <= F.lit(cut))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(labels[len(cuts)])))


def truncate_label(col, width: int = 40) -> Column:
    """Longer than ``width`` -> first ``width-3`` chars + '...'."""
    c = _c(col)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width - 3), F.lit("..."))).otherwise(c)


def format_amount(col) -> Column:
    """Round half-even to a whole number, thousands separated by spaces."""
    return F.regexp_replace(F.format_number(F.bround(_c(col), 0), 0), ",", " ")


def lookup_default(col, mapping: Mapping[str, str], groups=(), default: str | None = None) -> Column:
    """Exact lookup, then group membership, then a default."""
    c = _c(col)
    expr = F.element_at(_map_lit(mapping), c) if mapping else F.lit(None).cast("string")
    grp = None
    for members, value in groups:
        cond = c.isin(list(members))
        grp = F.when(cond, F.lit(value)) if grp is None else grp.when(cond, F.lit(value))
    tail = F.lit(default) if grp is None else grp.otherwise(F.lit(default))
    return F.coalesce(expr, tail)


def join_labels(arr, prefix: str = "skill_", sep: str = ", ", sort: bool = False) -> Column:
    """Strip a prefix from every item and join to one text."""
    a = _c(arr)
    if sort:
        a = F.array_sort(a)
    return F.array_join(F.transform(a, lambda x: F.replace(x, F.lit(prefix), F.lit(""))), sep)


def pct(part, whole) -> Column:
    """Zero-safe percentage (null when the whole is 0 or null)."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100.0)


def pct_growth(value, base) -> Column:
    """Percent growth against a base; none when the base is <= 0."""
    b = _c(base)
    return F.when(b > 0, F.try_divide(_c(value) - b, b) * F.lit(100.0))


def fill_indicator(col) -> Column:
    """Missing indicator -> 0."""
    return F.coalesce(_c(col), F.lit(0))


def cap(col, lower, upper) -> Column:
    """Guarded clip: null stays null (least/greatest would turn it into a bound)."""
    c = _c(col)
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c, _c(lower)), _c(upper)))


def try_corr_t(r, n) -> Column:
    """t statistic of a correlation: r * sqrt((n-2)/(1-r^2))."""
    r, n = _c(r), _c(n)
    return r * F.sqrt(F.try_divide(n - 2, F.lit(1.0) - r * r))
