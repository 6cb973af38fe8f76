"""URL filter: rules, then words of the host and naive Bayes.

Concatenated host names are split into words by a unigram model, whose counts come from the words of all pages: the most
probable split is found by dynamic programming over the substrings that are known words. The words of host and path are
then scored by multinomial naive Bayes, trained on the urls that a rule decides. Urls are reduced to their kinds (host,
and path with digits as one sign) with counts first, so names are split once and a busy host is one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.session import materialise

# Fixed rules of the filter: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters of the longest label that DNS allows: no word of a host is longer.
LABEL = 63
# Letters whose words are looked up together, with as many more as a word may reach beyond them.
STRETCH = 64
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, SPLIT, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. The rules are a short list of the program."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, html: str, longest: int) -> DataFrame:
    """How often each word of letters stands in the text of all pages; words of up to ``longest`` letters."""
    text = F.lower(F.regexp_replace(html, "<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, "[^a-z]+")).alias("word"))
    return words.filter((F.length("word") > 0) & (F.length("word") <= longest)).groupBy("word").agg(F.count("*").alias("n"))


def best_split(label: str, known: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """Viterbi: the split of ``label`` of the least cost; a letter outside known words costs ``unknown``, and letters
    in a row outside known words are one word. Ties go to the longer last word."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for (start, end), cost in known.items():
        ending.setdefault(end, []).append((start, cost))
    best: list[tuple[float, int, bool]] = [(0.0, 0, True)]
    for end in range(1, len(label) + 1):
        options = [(best[start][0] + cost, start, True) for start, cost in ending.get(end, [])]
        options.append((best[end - 1][0] + unknown, end - 1, False))
        best.append(min(options))
    out: list[str] = []
    end, open_ = len(label), False
    while end:
        _, start, word = best[end]
        if not word and open_:
            out[-1] = label[start:end] + out[-1]
        else:
            out.append(label[start:end])
        end, open_ = start, not word
    return out[::-1]


def segmented(hosts: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """(host, words): the words of each distinct host; its labels and hyphenated parts are split one by one."""
    counts = materialise(counts, "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = hosts.select("host", F.posexplode(F.split("host", r"[.\-]")).alias("at", "label"))
    # A label goes by its digest, and its spots are looked up stretch by stretch: it may be as long as a text.
    labels = parts.select("label").filter(F.length("label") > 0).distinct().withColumn("id", F.md5("label"))

    @F.pandas_udf("array<string>")
    def stretches(names: pd.Series) -> pd.Series:
        return names.map(lambda n: [n[a : a + STRETCH + longest - 1] for a in range(0, len(n), STRETCH)])

    cut = labels.select("id", F.posexplode(stretches("label")).alias("part", "stretch"))
    before = F.col("part") * STRETCH - 1
    spots = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.least(F.lit(STRETCH), F.length("stretch"))),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), F.length("stretch") - i + 1)),
                lambda size: F.struct((before + i).alias("start"), (before + i + size).alias("end"), F.substring(F.col("stretch"), i, size).alias("word")),
            ),
        )
    )
    pieces = cut.select("id", F.inline(spots))
    cost = -F.log(F.col("n") / float(max(1, total)))
    known = pieces.join(counts, "word").groupBy("id").agg(F.collect_list(F.struct("start", "end", cost.alias("cost"))).alias("known"))
    unknown = log(max(2, total)) * 1.5

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for names, spans in batches:
            rows = []
            for name, span in zip(names, spans, strict=True):
                found = {} if span is None else {(x["start"], x["end"]): x["cost"] for x in span}
                rows.append(best_split(name, found, unknown))
            yield pd.Series(rows, dtype=object)

    words = labels.join(known, "id", "left").select("label", split("label", "known").alias("words"))
    joined = parts.join(words, "label", "left")
    order = F.array_sort(F.collect_list(F.struct("at", F.coalesce("words", F.array().cast("array<string>")).alias("words"))))
    return joined.groupBy("host").agg(F.flatten(F.transform(order, lambda x: x["words"])).alias("words"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    longest: int = LABEL,
) -> DataFrame:
    """Every row's key, host, path, rule, verdict and the naive Bayes ``score`` (log odds of block; over 0 blocks).

    Null urls and urls without ``://`` have an empty host and path; where a rule decides the score is still given. With
    urls of one verdict only to learn from, the words do not count and that verdict is the method's; with none, allow.
    Repeated rows stay and count; a null ``html`` has no words; other columns are left behind.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    base = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("ruled"), F.regexp_replace(F.lower("path"), "[0-9]+", "0").alias("shape"))
    kinds = base.groupBy("host", "shape").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    kinds = materialise(kinds, "kinds")
    words = materialise(segmented(kinds.select("host").distinct(), word_counts(pages, html, longest), longest), "hosts")
    tokens = F.concat(
        F.transform("words", lambda w: F.concat(F.lit("host:"), w)),
        F.transform(F.filter(F.split("shape", "[^a-z0-9]+"), lambda w: w != ""), lambda w: F.concat(F.lit("path:"), w)),
    )
    bags = kinds.join(words, "host").select("host", "shape", "allowed", "blocked", F.explode(tokens).alias("token"))
    bags = materialise(bags, "bags")
    seen = bags.groupBy("token").agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    seen = materialise(seen, "tokens")
    sums = seen.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("v")).first()
    urls = kinds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    allowed, blocked = urls.a or 0, urls.b or 0
    if allowed and blocked:
        prior, size = log(blocked / allowed), sums.v
        weight = F.log((F.col("b") + 1) / float(sums.b + size)) - F.log((F.col("a") + 1) / float(sums.a + size))
        weights = seen.select("token", weight.alias("w"))
        scores = bags.join(weights, "token").groupBy("host", "shape").agg(F.sum("w").alias("w"))
    else:
        prior = 1.0 if blocked else -1.0
        scores = kinds.select("host", "shape", F.lit(0.0).alias("w"))
    scored = base.join(materialise(scores, "scores"), ["host", "shape"], "left")
    score = F.lit(prior) + F.coalesce("w", F.lit(0.0))
    method = F.when(score > 0, "block").otherwise("allow")
    return scored.select(key, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), score.alias("score"))
