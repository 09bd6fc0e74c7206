"""Quality rules by weak supervision, in DataFrame functions only.

Every rule votes good (1), bad (0) or abstains (null) on a document from counts
over its whole text. Votes are tallied as a histogram over vote patterns (at
most 3 to the number of rules, whatever the corpus size); expectation-
maximisation on that histogram estimates how often good documents exist and how
often each rule is right on good and on bad ones, and a document is kept if its
posterior probability of being good reaches ``threshold``. No document is
judged by one rule alone, except the base conditions the caller asks for.

Defined results: a null text counts as empty; a document with no vote at all
has the prior as its posterior; an empty table gives no row; columns of the
input keep their names and values (of ``score``, ``__q`` and ``__q_posterior`` take the
place of columns of those names).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BOX, WHITE, boxed, let, materialize, strip, unboxed, words

SYMBOLS = "#*$%&|<>"
#: Upper-case letters of the Latin-1 range.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: Frequent function words of the languages the corpus is expected to hold.
FUNCTION_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "this", "was", "are",
    "der", "die", "das", "und", "ist", "von", "mit", "den", "ein", "eine", "zu", "im",
    "le", "la", "les", "des", "et", "est", "que", "pour", "dans", "un", "une", "de",
    "el", "los", "las", "y", "en", "del", "por", "con", "para", "una", "se", "no",
]


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeated(w: Column, window: int) -> Column:
    """Words of ``w`` that lie in a ``window``-word run found twice or more."""

    def runs(h: Column) -> Column:  # h: a hash for each word
        # hashes of the windows, in order of their place
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - window),
            lambda i: F.xxhash64(*[h[i + k] for k in range(window)]))

    def covered(r: Column) -> Column:
        pairs = F.sort_array(F.transform(r, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda s: F.filter(
            s, lambda e, k: ((k > 0) & (F.get(s, k - 1)["h"] == e["h"]))
            | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == e["h"]))))
        at = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(
                F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))),
            F.lit(0), lambda a, x: a + x))

    counted = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(
        runs(h), lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0))
        .otherwise(covered(r))))
    return F.when(F.size(w) <= window, F.lit(0)).otherwise(counted)


def features(text: Column, window: int = 8) -> Column:
    """A struct of counts over the whole text."""
    t = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated(w, window).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(FUNCTION_WORDS))).cast("long").alias("n_function"),
            F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x))).cast("long")
            .alias("n_stutter"))

    lines = F.filter(F.split(t, "\n"), lambda x: strip(x) != "")
    return F.struct(
        let(words(t), of).alias("w"),
        let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
        F.length(F.translate(t, WHITE, "")).cast("long").alias("word_chars"),
        _count(t, SYMBOLS).cast("long").alias("n_symbols"),
        _count(t, CAPITALS).cast("long").alias("n_capitals"))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds, else abstains."""
    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.bad, F.lit(0)).when(self.good, F.lit(1))


def default_rules() -> list[Rule]:
    """Rules on the counts of ``features``.

    Few function words may only mean a language that the list does not hold, so that rule
    votes bad only on a text that another rule finds bad; else it abstains.
    """
    c = F.col
    n, chars = c("__q.w.n_words"), c("__q.word_chars")
    rules = [
        Rule("symbols", 100 * c("__q.n_symbols") <= n, 10 * c("__q.n_symbols") > n),
        Rule("repeats", (c("__q.w.n_repeat_words") == 0) & (n >= 16),
             4 * c("__q.w.n_repeat_words") > n),
        Rule("stutter", (10 * c("__q.w.n_stutter") <= n) & (n >= 16), 4 * c("__q.w.n_stutter") > n),
        Rule("lines", (c("__q.l.n_dup_lines") == 0) & (c("__q.l.n_lines") > 1),
             (2 * c("__q.l.n_dup_lines") > c("__q.l.n_lines")) & (c("__q.l.n_lines") > 3)),
        Rule("word_length", (chars >= 2.5 * n) & (chars <= 9 * n), (chars < 2 * n) | (chars > 13 * n)),
        Rule("capitals", 100 * c("__q.n_capitals") <= 15 * chars, 10 * c("__q.n_capitals") > 4 * chars),
    ]
    other = reduce(or_, [r.bad for r in rules])
    return [*rules, Rule("function_words", 100 * c("__q.w.n_function") >= 4 * n,
                         (200 * c("__q.w.n_function") < n) & (n >= 30) & other)]


@dataclass(frozen=True)
class LabelModel:
    """The share of good documents; per rule its chance to vote good on good and on bad ones."""
    prior: float
    on_good: list[float]
    on_bad: list[float]

    def log_odds(self, votes: list) -> float:
        out = math.log(self.prior / (1 - self.prior))
        for v, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            if v is not None:
                out += math.log(g / b) if v else math.log((1 - g) / (1 - b))
        return out

    def posterior(self, votes: list[Column]) -> Column:
        """The posterior of being good, as a column."""
        out = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            out = out + (F.when(v == 1, F.lit(math.log(g / b)))
                         .when(v == 0, F.lit(math.log((1 - g) / (1 - b)))).otherwise(0.0))
        return 1 / (1 + F.exp(-out))


def starts(m: int) -> list[tuple[list[float], list[float], float]]:
    """Where the estimation starts: good documents trip few rules and bad ones more, to several
    degrees, or bad ones are those that trip one given rule."""
    plain = [([g] * m, [b] * m, share) for g, b, share in ((0.99, 0.7, 0.8), (0.9, 0.5, 0.8), (0.7, 0.4, 0.5))]
    return plain + [([0.98 if k == j else 0.9 for k in range(m)], [0.1 if k == j else 0.8 for k in range(m)], 0.8)
                    for j in range(m)]


def fit(patterns: list[tuple[tuple, int]], m: int, rounds: int = 500, good: float = 0.99,
        bad: float = 0.7, strength: float = 10) -> LabelModel:
    """Expectation-maximisation on a histogram of the vote patterns of ``m`` rules.

    Each rule's chances to vote good have a weak prior: ``strength`` votes of mean ``good``
    on good documents and ``bad`` on bad ones, and the share of good documents one vote
    of mean 0.8. The estimation climbs from every one of ``starts`` and the result of
    highest penalised likelihood counts (the first of equal ones). The good class is the
    one on which most rules vote good more often. The histogram has at most 3 to the
    number of rules rows, so this is driver work of a fixed size.
    """
    n = np.array([k for _, k in patterns], float)
    yes = np.array([[v == 1 for v in votes] for votes, _ in patterns], float).reshape(len(n), m)
    no = np.array([[v == 0 for v in votes] for votes, _ in patterns], float).reshape(len(n), m)
    found = []
    for on_good, on_bad, prior in starts(m):
        g, b = np.array(on_good), np.array(on_bad)
        for _ in range(rounds):
            as_good = math.log(prior) + yes @ np.log(g) + no @ np.log(1 - g)
            as_bad = math.log(1 - prior) + yes @ np.log(b) + no @ np.log(1 - b)
            either = np.logaddexp(as_good, as_bad)
            p = n * np.exp(as_good - either)
            new = ((yes.T @ p + strength * good) / ((yes + no).T @ p + strength),
                   (yes.T @ (n - p) + strength * bad) / ((yes + no).T @ (n - p) + strength),
                   (p.sum() + 0.8) / (n.sum() + 1))
            change = max(np.abs(new[0] - g).max(initial=0), np.abs(new[1] - b).max(initial=0), abs(new[2] - prior))
            g, b, prior = new
            if change < 1e-9:
                break
        penalty = strength * (good * np.log(g) + (1 - good) * np.log(1 - g)
                              + bad * np.log(b) + (1 - bad) * np.log(1 - b)).sum()
        found.append((float(n @ either + penalty), g, b, prior))
    top = max(f[0] for f in found)
    _, g, b, prior = next(f for f in found if f[0] >= top - 1e-6 * max(1.0, abs(top)))
    if 2 * int((g > b).sum()) < m:
        g, b, prior = b, g, 1 - prior
    return LabelModel(float(prior), g.tolist(), b.tolist())


def score(docs: DataFrame, text: str = "text", carry: list[str] | None = None,
          rules: list[Rule] | None = None) -> tuple[DataFrame, LabelModel]:
    """``docs`` (or its columns ``carry``) with ``__q`` (the counts) and ``__q_posterior``.

    The counts are written once to the shared scratch folder, since the vote
    histogram and the result both need them.
    """
    rules = rules or default_rules()
    carry = docs.columns if carry is None else carry
    counted = materialize(boxed(docs, carry, __q=features(docs[text])), "quality")
    votes = [r.vote() for r in rules]
    tally = counted.groupBy(*[v.alias(f"v{j}") for j, v in enumerate(votes)]).count()
    model = fit([(tuple(r[:-1]), r[-1]) for r in sorted(tally.collect(), key=str)], len(rules))
    return unboxed(counted, carry, __q=F.col("__q"), __q_posterior=model.posterior(votes)), model


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    """Too few words, or too many of them in repeated windows."""
    n = F.col("__q.w.n_words")
    return (n < min_words) | (100 * F.col("__q.w.n_repeat_words") > max_repeat_percent * n)


def keep(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass the base conditions and are probably good."""
    scored, _ = score(boxed(docs, docs.columns, body=docs[text]), "body", carry=[BOX])
    return unboxed(scored.where(~base_failed() & (F.col("__q_posterior") >= threshold)), docs.columns)
