"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other. Small transducers read them. Negation
and reported speech rewrite insults and threats in their scope to weakened symbols; insult, threat and target match what
is left and meet in one score. All are composed into one transducer, whose table runs over many clauses at once. A
document is scored by its matched clauses: how much they weigh, how many there are, the strongest.

What counts as an insult is learned: words and word beginnings that labelled toxic documents hold far more often than
others, weighted by log odds, besides a short fixed list. The curve from clause features to the score is learned from
other rows than the lexicon.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.llm.common import labelled_sample
from finledger.session import materialise

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, WEAK, END = range(8)
SYMBOLS = 8
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;\n]")
ENDS = frozenset(".!?;\n")
# Words of a stretch: what a clause counts as; the grammar reads on from one stretch of a sentence to the next.
CLAUSE = 40
CHARS = 1 << 20
PREFIXES = (3, 4, 5, 6, 7)

# Fixed word lists, by symbol.
WORDS = {
    INSULT: "idiot moron stupid imbecile dumb loser scum trash pathetic worthless disgusting clown",
    THREAT: "kill hurt destroy beat stab shoot hang burn strangle murder",
    TARGET: "you your you're yourself u he she him her they them their vous tu toi ihr du dich usted tú",
    NEGATION: "not no never isn't aren't don't doesn't wasn't neither nor nicht kein keine ne pas nunca jamás",
    REPORT: "said says called wrote claimed quoted reported told according dit sagte dijo",
}


@dataclass
class Transducer:
    """For each state and symbol the next state, the symbol written and a weight; state 0 begins."""

    to: np.ndarray
    out: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, arcs: dict[tuple[int, int], tuple[int, int, float]], states: int) -> Transducer:
        """Arcs (state, symbol) to (state, symbol written, weight); all others stay in their state and copy."""
        to = np.repeat(np.arange(states)[:, None], SYMBOLS, axis=1)
        out = np.repeat(np.arange(SYMBOLS)[None, :], states, axis=0)
        weight = np.zeros((states, SYMBOLS))
        for (state, symbol), (after, written, value) in arcs.items():
            to[state, symbol], out[state, symbol], weight[state, symbol] = after, written, value
        to[:, END] = 0
        return cls(to, out, weight)

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one writes the other reads; weights add up."""
        n, m = len(self.to), len(other.to)
        mine, theirs = np.repeat(np.arange(n), m), np.tile(np.arange(m), n)
        read = self.out[mine]
        to = self.to[mine] * m + other.to[theirs[:, None], read]
        weight = self.weight[mine] + other.weight[theirs[:, None], read]
        return Transducer(to, other.out[theirs[:, None], read], weight)


def scoped(opener: int, length: int) -> Transducer:
    """For ``length`` words after ``opener`` insults and threats are weakened."""
    arcs = {}
    for state in range(length + 1):
        arcs[state, opener] = (length, opener, 0.0)
        for symbol in (OTHER, TARGET, INSULT, THREAT, WEAK, NEGATION, REPORT):
            if symbol != opener:
                written = WEAK if state and symbol in (INSULT, THREAT) else symbol
                arcs[state, symbol] = (max(0, state - 1), written, 0.0)
    return Transducer.of(arcs, length + 1)


def matcher(symbol: int, value: float, aimed: float) -> Transducer:
    """Every ``symbol`` weighs ``value``; the first that meets a target in its clause, in either order, adds ``aimed``.

    States: nothing yet, target seen, symbol seen, both seen.
    """
    arcs = {
        (0, symbol): (2, symbol, value),
        (0, TARGET): (1, TARGET, 0.0),
        (1, symbol): (3, symbol, value + aimed),
        (2, symbol): (2, symbol, value),
        (2, TARGET): (3, TARGET, aimed),
        (3, symbol): (3, symbol, value),
    }
    return Transducer.of(arcs, 4)


def grammar() -> Transducer:
    """Negation and reported speech before insult, weakened insult and threat with their targets."""
    parts = [
        scoped(NEGATION, 3),
        scoped(REPORT, 8),
        matcher(INSULT, 1.0, 0.5),
        matcher(WEAK, 0.2, 0.0),
        matcher(THREAT, 0.2, 1.5),
    ]
    return reduce(Transducer.then, parts)


def best_entry(word: str, lexicon: dict[str, float]) -> float:
    """The weight of a word: that of the word or of the heaviest of its beginnings (written with a star)."""
    found = lexicon.get(word, 0.0)
    for size in PREFIXES:
        if len(word) > size:
            found = max(found, lexicon.get(word[:size] + "*", 0.0))
    return found


FIXED = {word: symbol for symbol, words in WORDS.items() for word in words.split()}


def clause_features(texts: list[str], lexicon: dict[str, float], machine: Transducer) -> np.ndarray:
    """A row for each text: weight of all matched clauses, clauses, matched clauses, strongest clause, words.

    Clauses end at ``. ! ? ;`` or a line end; of a longer sentence every ``CLAUSE`` words count as one, and what was read
    in one still holds in the next.
    """
    out = np.zeros((len(texts), 5))
    start = 0
    while start < len(texts):
        end, chars, tokens, marks = start, 0, [], [0]
        while end < len(texts) and (end == start or chars + len(texts[end]) <= CHARS):
            chars += len(texts[end])
            tokens += TOKEN.findall(texts[end].lower())
            tokens.append("\n")
            marks.append(len(tokens))
            end += 1
        codes, distinct = pd.factorize(np.array(tokens, dtype=object))
        kinds, weights = np.zeros(len(distinct), dtype=np.int8), np.ones(len(distinct))
        for k, word in enumerate(distinct):
            symbol, learned = FIXED.get(word, OTHER), best_entry(word, lexicon)
            if word in ENDS:
                symbol = END
            elif learned > 0 and symbol == OTHER:
                symbol, weights[k] = INSULT, learned
            kinds[k] = symbol
        symbols, strength = kinds[codes], weights[codes]
        out[start:end] = _documents(symbols, strength, np.array(marks), machine)
        start = end
    return out


def _documents(symbols: np.ndarray, strength: np.ndarray, marks: np.ndarray, machine: Transducer) -> np.ndarray:
    n = len(marks) - 1
    doc = np.repeat(np.arange(n), np.diff(marks))
    word = symbols != END
    before = np.concatenate([[0], np.cumsum(word)])[:-1]
    ends = np.flatnonzero(~word)
    sentence = np.concatenate([[0], np.cumsum(~word)])[:-1]
    begin = np.concatenate([[0], before[ends]])[sentence]
    piece = (before - begin) // CLAUSE
    at = np.flatnonzero(word)
    out = np.zeros((n, 5))
    out[:, 4] = np.bincount(doc[at], minlength=n)
    if not len(at):
        return out
    new = np.concatenate([[True], (np.diff(sentence[at]) != 0) | (np.diff(piece[at]) != 0)])
    clause = np.cumsum(new) - 1
    owner = doc[at[new]]
    out[:, 1] = np.bincount(owner, minlength=n)
    begins = np.concatenate([[True], np.diff(sentence[at]) != 0])
    firsts, spoken = np.flatnonzero(begins), np.cumsum(begins) - 1
    sizes = np.diff(np.append(firsts, len(at)))
    live = np.unique(spoken[np.isin(symbols[at], (INSULT, THREAT))])
    if not len(live):
        return out
    # All sentences read their next word together; the longer ones go on alone.
    live = live[np.argsort(-sizes[live], kind="stable")]
    begin, left = firsts[live], sizes[live]
    state, gained = np.zeros(len(live), dtype=np.int64), np.zeros(len(at))
    for c in range(int(left[0])):
        m = int(np.searchsorted(-left, -c, "left"))
        place = begin[:m] + c
        read = symbols[at[place]]
        gained[place] = machine.weight[state[:m], read] * strength[at[place]]
        state[:m] = machine.to[state[:m], read]
    total = np.bincount(clause, weights=gained)
    out[:, 0] = np.bincount(owner, weights=total, minlength=n)
    out[:, 2] = np.bincount(owner, weights=total > 0.5, minlength=n)
    np.maximum.at(out[:, 3], owner, total)
    return out


def model_inputs(features: np.ndarray) -> np.ndarray:
    weight, clauses, matched, strongest, words = features.T
    return np.column_stack([
        np.log1p(weight),
        np.log1p(100 * weight / np.maximum(1, words)),
        np.minimum(weight / np.maximum(1, clauses), 5),
        matched / np.maximum(1, clauses),
        np.log1p(matched),
        np.minimum(strongest, 10),
        np.log1p(words),
    ])


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    threshold: float

    def score(self, features: np.ndarray) -> np.ndarray:
        strength = ((model_inputs(features) - self.mean) / self.scale) @ self.weights
        at_cut = log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(strength - self.cut + at_cut, -500, 500)))


def signature(text: str) -> int:
    """The smallest hash of three words in a row: the same for copies and, mostly, for near copies."""
    words = text.lower().split()
    if len(words) < 3:
        return zlib.crc32(text.encode("utf-8", "surrogatepass"))
    return min(zlib.crc32(" ".join(words[i : i + 3]).encode("utf-8", "surrogatepass")) for i in range(len(words) - 2))


def without_copies(sample: DataFrame) -> DataFrame:
    """One text for each signature and label: in copies every word would look like a mark of their label."""

    @F.pandas_udf("long")
    def signed(texts: pd.Series) -> pd.Series:
        return texts.map(signature)

    return sample.groupBy(signed("text").alias("_s"), "label").agg(F.min("text").alias("text")).select("text", "label")


def learn_lexicon(
    sample: DataFrame, most: int, least_docs: int, least_z: float, least_odds: float
) -> dict[str, float]:
    """Words and word beginnings with significant log odds for toxic documents, weighted 0.2 to 2.

    A beginning is left out where one longer entry stands in the same documents: it is no family of words then.
    Document counts are added up in the tasks and then by Spark; of the significant entries the ``most`` clearest are
    fetched.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = {w for w in TOKEN.findall(text.lower()) if len(w) > 2}
                stems = {w[:size] + "*" for w in words for size in PREFIXES if len(w) > size}
                (toxic if label else clean).update(words | stems)
        entries = list(toxic.keys() | clean.keys())
        if entries:
            yield pd.DataFrame({"entry": entries, "t": [toxic[e] for e in entries], "c": [clean[e] for e in entries]})

    sizes = sample.agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).first()
    toxic, clean = (sizes.t or 0) + 1.0, (sizes.c or 0) + 1.0
    counts = sample.mapInPandas(counted, "entry string, t long, c long").groupBy("entry")
    counts = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") >= least_docs)
    odds = F.log((F.col("t") + 0.5) / toxic) - F.log((F.col("c") + 2) / clean)
    z = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 2))
    clear = counts.withColumn("odds", odds).withColumn("z", z)
    clear = clear.filter((F.col("z") >= least_z) & (F.col("odds") >= least_odds))
    rows = clear.orderBy(F.desc("z"), "entry").limit(most).collect()
    longer = {(r.entry[:size], r.t, r.c) for r in rows for size in PREFIXES if len(r.entry.rstrip("*")) > size}
    return {
        r.entry: float(min(2.0, 0.2 + (r.odds - least_odds) / 2))
        for r in rows
        if not (r.entry.endswith("*") and (r.entry[:-1], r.t, r.c) in longer)
    }


def fit_curve(features: np.ndarray, labels: np.ndarray, lexicon: dict[str, float], threshold: float) -> ToxicityModel:
    """Logistic regression on clause features; the score passes ``threshold`` where the training F1 is best.

    With one label only every score is the same: above the threshold where all rows are toxic, else below.
    """
    x = model_inputs(features)
    width = x.shape[1]
    if len(np.unique(labels)) < 2:
        cut = -1.0 if len(labels) and labels[0] == 1 else 1.0
        return ToxicityModel(lexicon, np.zeros(width), np.ones(width), np.zeros(width), cut, threshold)
    mean, scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    x = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(width + 1), np.diag([1e-3] * width + [0.0])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge + 1e-9 * np.eye(width + 1)
        step = np.linalg.solve(hessian, x.T @ (labels - p) / len(x) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    strength = x[:, :-1] @ w[:-1]
    order = np.argsort(-strength, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    ranked = strength[order]
    f1[:-1][ranked[:-1] == ranked[1:]] = -1  # a cut does not part equal strengths
    best = int(f1.argmax())
    below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 1
    return ToxicityModel(lexicon, mean, scale, w[:-1], float((ranked[best] + below) / 2), threshold)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    label: str = "toxic",
    threshold: float = 0.7,
    sample_rows: int = 20_000,
    most_entries: int = 5_000,
    least_docs: int = 4,
    least_z: float = 3.5,
    least_odds: float = 2.0,
) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled training rows, copies counted once: two thirds for the lexicon, one third for the curve, by a
    hash of the text. Where that third holds one label only, the curve is fitted on all rows of the sample."""
    sample = materialise(without_copies(labelled_sample(docs, labels, label, training, sample_rows)), "toxic")
    part = F.pmod(F.xxhash64("text"), F.lit(3))
    lexicon = learn_lexicon(sample.filter(part != 0), most_entries, least_docs, least_z, least_odds)
    scored = sample.select(_features("text", lexicon).alias("f"), "label", (part == 0).alias("own"))
    rows = scored.filter("own").collect()
    if len({r["label"] for r in rows}) < 2:
        rows = scored.collect()
    features = np.array([r["f"] for r in rows], dtype=float).reshape(len(rows), 5)
    return fit_curve(features, np.array([r["label"] for r in rows]), lexicon, threshold)


def _features(text: str, lexicon: dict[str, float]) -> Column:
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = grammar()
        for texts in batches:
            yield pd.Series(list(clause_features([t or "" for t in texts], lexicon, machine)), dtype=object)

    return features(F.col(text))


def toxicity_score(model: ToxicityModel, text: str = "text") -> Column:
    """The score of a text, 0 to 1; null counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = grammar()
        for texts in batches:
            yield pd.Series(model.score(clause_features([t or "" for t in texts], model.lexicon, machine)))

    return score(F.col(text))


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score and prediction of every row: repeated rows are scored alike, null and empty texts as texts without
    clauses; other columns are left behind."""
    scored = docs.select(F.col(key), toxicity_score(model, text).alias("score"))
    return scored.select(key, "score", (F.col("score") >= model.threshold).cast("int").alias("predicted"))
