"""Secret scan: patterns, and a sliding-window Shannon entropy over candidate strings, in DataFrame functions alone.

Base kinds are found by regular expressions; their places follow from the lengths of the pieces between the matches.
Candidate strings are runs of at least ``window`` letters, digits and ``+/_=-``. Over each candidate a window slides one
character a step: the counts of the characters that enter and leave change by one, and with them the sum of
``c * log2(c)`` that the entropy follows from. The limit depends on the character class of the candidate.

Allow-listed words that are a whole name in a path or an assignment part a candidate, and so do base spans on request;
what is left on either side is a candidate of its own. A candidate that the allow-list matches whole is left out: one without digits, an
identifier in UUID form. A placeholder or a run of an alphabet inside suppresses a high stretch only where less than two
windows of it are something else, and only when it is written in one case: longer text meets these by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN_LEAST = 6
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api"]

RUN = "[A-Za-z0-9+/_=-]"
WINDOW = 20
# Least entropy in bits of a window of 20 characters, by character class.
LIMITS = {"hex": 2.9, "alphanumeric": 3.6, "symbols": 3.7}
ALLOWED = (
    r"^[^0-9]*$|^[^A-Za-z]*$"
    r"|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
    r"|(?i)example|placeholder|changeme|xxxx|0{8}|deadbeef|01234567|abcdefgh"
)
SPAN = "struct<start: int, kind: int, end: int>"
HIT = "struct<start: int, end: int, hit: string>"


def _matches(text: Column, pattern: str) -> Column:
    """Places and texts of all matches: gaps and matches alternate, so a place is the length of all before it."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{HIT}>").alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["hit"]), F.lit(0))
        hit = F.struct(begin.alias("start"), end.alias("end"), part["hit"].alias("hit"))
        found = F.when(part["hit"].isNotNull(), F.concat(state["found"], F.array(hit))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(parts, start, step, lambda state: state["found"])


def _where(possible: Column, found: Column, kind: str) -> Column:
    """Look for matches only in texts that can hold one."""
    return F.when(possible, found).otherwise(F.array().cast(f"array<{kind}>"))


def _spans(hits: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind)).alias("kind")
    return F.transform(hits, lambda x: F.struct(x["start"].alias("start"), number, x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds. The tests before the patterns only rule out texts that cannot match."""
    lower = F.lower(text)
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | lower.contains(word)
    assigned = F.filter(
        _matches(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 1)) >= ASSIGN_LEAST
    )
    return F.concat(
        _where(named, _spans(assigned, "assign"), SPAN),
        _where(text.contains("AKIA"), _spans(_matches(text, ACCESS), "access"), SPAN),
        _where(text.rlike(HEX), _spans(_matches(text, HEX), "hex"), SPAN),
    )


def limit_of(run: Column) -> Column:
    """The least entropy for a candidate, by its character class."""
    return (
        F.when(run.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), LIMITS["hex"])
        .when(run.rlike("^[A-Za-z0-9]+$"), LIMITS["alphanumeric"])
        .otherwise(LIMITS["symbols"])
    )


def _slide(candidate: Column, window: int) -> Column:
    """(first, last): from the first to the end of the last window that reaches the limit; null where none does.

    State: how often each character is in the window, the sum of c * log2(c) over these counts, first, last.
    """

    def term(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count)).otherwise(0.0)

    def move(state: Column, at: Column) -> Column:
        enters = F.get(candidate["codes"], at)
        leaves = F.when(at >= window, F.get(candidate["codes"], at - window)).otherwise(F.lit(-1))
        came = F.get(state["counts"], enters)
        went = F.when(leaves >= 0, F.get(state["counts"], leaves)).otherwise(F.lit(0))
        change = term(came + 1) - term(came) + F.when(leaves >= 0, term(went - 1) - term(went)).otherwise(0.0)
        total = state["sum"] + F.when(enters == leaves, 0.0).otherwise(change)
        counts = F.transform(
            state["counts"], lambda c, code: c + (code == enters).cast("int") - (code == leaves).cast("int")
        )
        high = (at >= window - 1) & (F.log2(F.lit(float(window))) - total / window >= candidate["least"])
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(high & state["first"].isNull(), at - (window - 1)).otherwise(state["first"]).alias("first"),
            F.when(high, at + 1).otherwise(state["last"]).alias("last"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    places = F.sequence(F.lit(0), F.size(candidate["codes"]) - 1)
    return F.aggregate(places, start, move, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _words(run: Column, allowed: str) -> Column:
    """Matches of the allow-list: of the whole run, or of words in lower or upper case or with one capital in front."""
    return F.filter(
        _matches(run, allowed),
        lambda x: (F.length(x["hit"]) == F.length(run)) | x["hit"].isin(F.lower(x["hit"]), F.upper(x["hit"]), F.initcap(x["hit"])),
    )


def _apart(hit: Column, base: Column, run: str, allowed: str) -> Column:
    """Candidates in a run: what stands between base spans and allowed words that are names of their own (``/word/``)."""
    whole = hit["hit"]

    def is_name(word: Column) -> Column:
        before = F.when(word["start"] > 0, F.substring(whole, word["start"], 1)).otherwise("/")
        return before.isin("/", "=") & F.substring(whole, word["end"] + 1, 2).rlike("^s?(?:[/=]|$)")

    inside = F.filter(base, lambda b: (b["start"] < hit["end"]) & (hit["start"] < b["end"]))
    cuts = F.concat(
        F.transform(
            inside,
            lambda b: F.struct(
                F.greatest(b["start"] - hit["start"], F.lit(0)).alias("start"),
                (F.least(b["end"], hit["end"]) - hit["start"]).alias("end"),
            ),
        ),
        F.transform(
            F.filter(_words(whole, allowed), is_name), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"))
        ),
    )

    def blank(text: Column, cut: Column) -> Column:
        size = cut["end"] - cut["start"]
        return F.overlay(text, F.repeat(F.lit(" "), size), cut["start"] + 1, size)

    return F.transform(
        _matches(F.aggregate(cuts, whole, blank), run),
        lambda x: F.struct((hit["start"] + x["start"]).alias("start"), (hit["start"] + x["end"]).alias("end"), x["hit"].alias("hit")),
    )


def entropy_spans(text: Column, base: Column, window: int = WINDOW, allowed: str = ALLOWED) -> Column:
    """Spans of high entropy in candidate strings, apart from ``base`` spans, that the allow-list does not suppress.

    A span goes from the first to the last high window of a candidate.
    """
    run = f"{RUN}{{{window},}}+"
    hits = F.flatten(F.transform(_matches(text, run), lambda x: _apart(x, base, run, allowed)))
    candidates = F.transform(
        hits,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.transform(F.split(x["hit"], ""), F.ascii).alias("codes"),
            limit_of(x["hit"]).alias("least"),
            _words(x["hit"], allowed).alias("words"),
        ),
    )
    candidates = F.filter(
        candidates, lambda c: ~F.exists(c["words"], lambda w: w["end"] - w["start"] == F.size(c["codes"]))
    )
    walked = F.transform(
        candidates, lambda c: F.struct(c["start"].alias("start"), c["words"].alias("words"), _slide(c, window).alias("high"))
    )

    def real(w: Column) -> Column:
        """Holds no word, or two windows besides its words."""
        high = w["high"]
        words = F.filter(w["words"], lambda x: (x["start"] < high["last"]) & (high["first"] < x["end"]))
        inside = F.aggregate(
            words,
            F.lit(0),
            lambda total, x: total + F.least(x["end"], high["last"]) - F.greatest(x["start"], high["first"]),
        )
        return high["first"].isNotNull() & ((inside == 0) | (high["last"] - high["first"] - inside >= 2 * window))

    number = F.lit(KINDS.index("entropy")).alias("kind")
    found = F.transform(
        F.filter(walked, real),
        lambda w: F.struct(
            (w["start"] + w["high"]["first"]).alias("start"), number, (w["start"] + w["high"]["last"]).alias("end")
        ),
    )
    return _where(text.rlike(run), found, SPAN)


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    allowed: str = ALLOWED,
    part_at_base: bool = False,
) -> DataFrame:
    """Key, ``base`` and ``added`` spans (start, kind number, end; code points, end exclusive) of every row.

    Added spans do not overlap base ones: with ``part_at_base`` these part a candidate, as the query has it; without it a
    span of a candidate that overlaps one is left out whole. Null and empty texts have no spans; repeated rows stay; other columns are left
    behind.
    """
    whole = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("whole"))
    found = whole.select(key, "whole", base_spans(F.col("whole")).alias("base"))
    if part_at_base:
        return found.select(key, "base", entropy_spans(F.col("whole"), F.col("base"), window, allowed).alias("added"))
    none = F.array().cast(f"array<{SPAN}>")
    found = found.select(key, "base", entropy_spans(F.col("whole"), none, window, allowed).alias("high"))
    apart = F.filter(
        "high", lambda h: ~F.exists("base", lambda b: (b["start"] < h["end"]) & (h["start"] < b["end"]))
    )
    return found.select(key, "base", apart.alias("added"))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
