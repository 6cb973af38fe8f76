"""Column expressions of the ledger domain. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from finledger import schema as S


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- account codes ----------------------------------------------------------------------------


def digits(code: Column | str) -> Column:
    """Depth of an account: its number of digits (1, 3, 5, 7, 9)."""
    return F.length(F.replace(col(code), F.lit("."), F.lit("")))


def segments(code: Column | str) -> Column:
    """Depth of an account as a level: its number of dot-separated segments (1..5)."""
    return F.size(F.split(col(code), r"\."))


def parent_code(code: Column | str) -> Column:
    """Code without its last segment; a root is its own parent."""
    return F.regexp_replace(col(code), r"\.[^.]+$", "")


def prefix(code: Column | str, level: int) -> Column:
    """First ``level`` segments, NULL when the code is shallower. Level 1 always exists."""
    parts = F.split(col(code), r"\.")
    return F.when(F.size(parts) >= level, F.array_join(F.slice(parts, 1, level), "."))


def ancestors(code: Column | str) -> Column:
    """All proper prefixes of a code, root first; empty for a root."""
    parts = F.split(col(code), r"\.")
    return F.when(
        F.size(parts) > 1,
        F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), ".")),
    ).otherwise(F.array().cast("array<string>"))


# --- values -----------------------------------------------------------------------------------


def money(c: Column | str) -> Column:
    """Exact money as a double with two decimals, the form results are reported in."""
    return col(c).cast("decimal(28,2)").cast("double")


def rounded(c: Column | str, places: int = 6) -> Column:
    return F.round(col(c), places)


def ratio(numerator: Column | str, denominator: Column | str, guard: str = "positive") -> Column:
    """``numerator / denominator`` where the denominator is positive (or only non-zero), else NULL."""
    d = col(denominator)
    usable = d > 0 if guard == "positive" else d != 0
    return F.when(usable, col(numerator) / F.nullif(d, F.lit(0.0)))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def is_close(a: Column, b: Column, tolerance: float = 1.0, relative: float = 1e-5) -> Column:
    """``|a - b| <= tolerance + relative * |b|``."""
    return F.abs((a - b).cast("double")) <= F.lit(tolerance) + F.lit(relative) * F.abs(b.cast("double"))


def scaled_value(account: Column | str, scale: Column | str, value: Column | str) -> Column:
    """Value in currency units. Per-share accounts keep theirs; thousands are truncated before scaling.

    ``scale`` is upper case.
    """
    v = col(value)
    thousands = col(scale).like("%MIL%") & ~col(account).like("3.99%")
    return F.when(thousands, F.try_multiply(v.try_cast("bigint"), F.lit(1000)).cast(S.MONEY)).otherwise(v)


def statement_class(group: Column | str) -> Column:
    """Statement a reported group (trimmed, upper case) belongs to; the first matching pattern wins."""
    text = col(group)
    branches = [(text.like(pattern), label) for pattern, label in S.STATEMENT_CLASSES]
    chain = F.when(*branches[0])
    for condition, label in branches[1:]:
        chain = chain.when(condition, label)
    return chain.otherwise(S.UNKNOWN_CLASS)


def staged_number(text: Column | str, type_: str = S.MONEY) -> Column:
    """Number staged as text. ``'nan'`` and blanks are missing; anything unreadable becomes NULL."""
    t = F.trim(col(text))
    return F.when(~F.lower(t).isin("nan", ""), t).try_cast(type_)


def sector_label(sector: Column | str) -> Column:
    return F.coalesce(F.substring(col(sector), 1, 38), F.lit("Não Classificado"))


# --- scores -----------------------------------------------------------------------------------


def linear_note(value: Column | str, zero_at: float, ten_at: float) -> Column:
    """0..10 by linear interpolation, clamped; the direction follows from which end scores ten."""
    x = col(value)
    rising = ten_at > zero_at
    at_zero = x <= zero_at if rising else x >= zero_at
    at_ten = x >= ten_at if rising else x <= ten_at
    distance = (x - F.lit(zero_at)) if rising else (F.lit(zero_at) - x)
    span = round(abs(ten_at - zero_at), 10)
    return F.when(at_zero, 0.0).when(at_ten, 10.0).otherwise(F.round(distance * 10.0 / F.lit(span), 4))


def target_note(value: Column | str, target: float) -> Column:
    """10 at the target, falling linearly to 0 on both sides; negative values score 0."""
    x = col(value)
    slope = 10.0 / target
    height = F.lit(10.0) - F.abs(x - F.lit(target)) * F.lit(slope)
    return F.when(x < 0, 0.0).when(x.isNotNull(), F.round(F.greatest(F.lit(0.0), height), 4))


def mean_of_present(columns: list[str]) -> Column:
    """Mean of the non-NULL columns; NULL when none is present."""
    total = reduce(lambda a, b: a + b, [zero_if_null(c) for c in columns])
    present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    return F.when(present > 0, total / F.nullif(present, F.lit(0)))


def weighted_mean_of_present(weights: dict[str, float]) -> Column:
    """Weighted mean over the non-NULL columns, weights renormalised to those present."""
    total = reduce(lambda a, b: a + b, [zero_if_null(F.col(c) * F.lit(w)) for c, w in weights.items()])
    present = reduce(
        lambda a, b: a + b, [F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in weights.items()]
    )
    return F.when(present > 0, total / F.nullif(present, F.lit(0.0)))


def score_band(score: Column | str) -> Column:
    chain = F.when(col(score).isNull(), F.lit(None).cast("string"))
    for floor, label in S.SCORE_BANDS:
        chain = chain.when(col(score) >= floor, label)
    return chain.otherwise(S.LOWEST_BAND)


def working_capital_profile(cgl: Column | str, ncg: Column | str, st: Column | str) -> Column:
    """Profile by the signs of net working capital, its need and the treasury balance."""
    first, *rest = [
        (
            (F.sign(col(cgl)) == signs[0]) & (F.sign(col(ncg)) == signs[1]) & (F.sign(col(st)) == signs[2]),
            signs[3],
        )
        for signs in S.WORKING_CAPITAL_PROFILES
    ]
    chain = F.when(*first)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain.otherwise(S.UNDEFINED_PROFILE)
