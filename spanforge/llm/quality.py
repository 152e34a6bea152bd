"""Quality rules under weak supervision, in DataFrame functions only (operator 9).

Each rule looks at evidence of its own and votes good, votes bad or abstains (the grey
zone in between).  Expectation-maximisation over the votes of all documents estimates,
for good and for bad documents, how often each rule votes each way; the posterior
probability of good decides, instead of all rules having to pass.  A rule that hardly
ever votes bad keeps the rates it starts from (one part in a hundred of the documents
says so); a rule is held to call at most ``FALSE_ALARM`` of the good documents bad, so
a clear defect counts even if no other rule sees it.  The data enter EM as counts of
distinct vote patterns (at most 3^rules), so an iteration costs the same for any corpus.

Repeated 3-word windows are found inside the row: windows are hashed, sorted with
their position, and equal neighbours mark theirs as repeated, so no word leaves
its row and nothing is shuffled but the pattern counts.

Defined results: a null or empty text has no words, all counts 0, and fails the
base rules; repeated rows repeat; null doc_ids stay; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from spanforge.functions.arrays import pin

from .scratch import materialise

#: rule -> (votes good if, votes bad if), over the columns of ``features``; neither:
#: abstains
RULES = {
    "length": ("n_words >= 80", "n_words < 50"),
    "repeated_words": ("100 * n_repeat_words <= 30 * n_words", "100 * n_repeat_words > 45 * n_words"),
    "word_size": ("word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    "symbols": ("50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "duplicate_lines": ("20 * n_dup_lines <= n_lines", "n_lines >= 4 and 10 * n_dup_lines > 4 * n_lines"),
    "line_length": ("n_words >= 4 * n_lines", "n_words < 2 * n_lines"),
    "digits": ("10 * n_digits <= word_chars", "4 * n_digits > word_chars"),
    "distinct_words": ("n_distinct * n_distinct >= 4 * n_words", "n_distinct * n_distinct < 2 * n_words"),
}
#: votes of good and of bad documents that EM starts from: bad, abstains, good
START = ((0.001, 0.099, 0.9), (0.25, 0.15, 0.6))
FALSE_ALARM = 0.001
#: share of good documents, before their votes are known
GOOD = 0.9
_SPACE = r"[\\x20\\x09-\\x0D]"


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` -> counts of each row's whole text."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "t", pin(F.expr(f"filter(split(t, '{_SPACE}+'), w -> w != '')")).alias("ws"),
                 pin(F.expr(f"filter(split(t, '\\n'), l -> l rlike '[^{_SPACE[1:]}')")).alias("lines"))
    # windows by hash and position: equal ones are neighbours
    d = d.withColumn("win", pin(F.expr("""
        if(size(ws) < 3, cast(array() as array<struct<h: bigint, i: int>>),
           sort_array(transform(slice(ws, 3, greatest(size(ws) - 2, 0)),
                                (w, i) -> struct(xxhash64(ws[i], ws[i + 1], w) as h, i as i))))""")))
    d = d.withColumn("again", pin(F.expr("""
        sort_array(transform(filter(win, (x, k) -> (k > 0 and get(win, k - 1).h = x.h)
                                                   or coalesce(get(win, k + 1).h = x.h, false)), x -> x.i))""")))
    # a repeated window covers 3 words, fewer where the next one starts sooner
    return d.select(
        "doc_id", F.size("ws").cast("long").alias("n_words"),
        F.expr("cast(length(array_join(ws, '')) as bigint)").alias("word_chars"),
        F.expr("cast(regexp_count(t, '[#*$%&|<>]') as bigint)").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        F.expr("aggregate(transform(again, (p, k) -> least(3, coalesce(get(again, k + 1) - p, 3))), "
               "0L, (a, x) -> a + x)").alias("n_repeat_words"),
        F.expr("cast(size(lines) as bigint)").alias("n_lines"),
        F.expr("cast(regexp_count(t, '[0-9]') as bigint)").alias("n_digits"),
        F.expr("cast(size(array_distinct(ws)) as bigint)").alias("n_distinct"))


def _vote(good: str, bad: str) -> Column:
    return F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end")


class LabelModel:
    """EM over ``(votes, count)`` patterns: per class and rule how often it votes bad,
    abstains and votes good.  Votes are independent given the class, and nine of ten
    documents are good beforehand."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], rules: int, iterations: int = 50):
        total = sum(n for _, n in patterns)
        held = max(1.0, total / 100)
        self.rates = [[list(START[c]) for _ in range(rules)] for c in (0, 1)]
        for _ in range(iterations if patterns else 0):
            votes_of = [[[held * p for p in START[c]] for _ in range(rules)] for c in (0, 1)]
            for votes, n in patterns:
                p = self.posterior(votes)
                for j, v in enumerate(votes):
                    votes_of[0][j][v + 1] += n * p
                    votes_of[1][j][v + 1] += n * (1 - p)
            self.rates = [[_shares(v, FALSE_ALARM if c == 0 else 1.0) for v in votes_of[c]] for c in (0, 1)]

    def weight(self, rule: int, vote: int) -> float:
        """ln of how much likelier the vote is in a good document."""
        return math.log(self.rates[0][rule][vote + 1] / self.rates[1][rule][vote + 1])

    def prior(self) -> float:
        return math.log(GOOD / (1 - GOOD))

    def posterior(self, votes: tuple[int, ...]) -> float:
        """Probability that a document with these votes is good."""
        logit = self.prior() + sum(self.weight(j, v) for j, v in enumerate(votes))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, logit))))


def _shares(counts: list[float], most_bad: float) -> list[float]:
    """Shares of the three votes, that of bad being at most ``most_bad``."""
    total = sum(counts)
    bad = min(counts[0] / total, most_bad)
    rest = (1 - bad) / (counts[1] + counts[2])
    return [bad, counts[1] * rest, counts[2] * rest]


def judge(docs: DataFrame, rules: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``(doc_id, text)`` -> the counts, ``base_failed`` (the hard base rules),
    ``p_good`` (posterior of the label model) and ``kept``; a row per row."""
    rules = RULES if rules is None else rules
    votes = [f"v_{r}" for r in rules]
    table = materialise(features(docs).withColumns({v: _vote(*rules[r]) for v, r in zip(votes, rules)}), "quality")
    counted = table.groupBy(*votes).count().collect()          # at most 3^rules patterns
    model = LabelModel(sorted((tuple(r[:-1]), r["count"]) for r in counted), len(rules))
    logit = F.lit(model.prior())
    for j, v in enumerate(votes):
        by_vote = F.array(*[F.lit(model.weight(j, x)) for x in (-1, 0, 1)])
        logit = logit + F.get(by_vote, F.col(v) + 1)
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    judged = table.withColumns({"base_failed": failed, "p_good": 1 / (1 + F.exp(-logit))})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)).drop(*votes)
