"""Expectation-maximisation over counted vote patterns, as one fold in Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vote_pattern(rules: list[tuple[Column, Column]]) -> Column:
    """Votes as digits to base 3, from (votes no, votes yes) for each rule: 0 no, 1 abstains, 2 yes."""
    code = F.lit(0).cast("long")
    for k, (no, yes) in enumerate(rules):
        code = code + F.when(no, 0).when(yes, 2).otherwise(1) * F.lit(3**k)
    return code


def posteriors(
    patterns: DataFrame,
    n_rules: int,
    rounds: int = 30,
    prior: float = 0.8,
    votes_if_yes: tuple[float, float, float] = (0.02, 0.48, 0.5),
    votes_if_no: tuple[float, float, float] = (0.35, 0.6, 0.05),
    by: tuple[str, ...] = (),
) -> DataFrame:
    """From (pattern, n): pattern, posterior probability of yes, and the estimates (prior, yes, no) behind it; apart for each
    value of the columns ``by``, which come first.

    ``yes`` and ``no`` hold, for each rule, the probabilities that it votes no, abstains or votes yes on true and on
    false cases: its accuracy and its coverage, as a rule that finds defects abstains more often where there are none.
    They start from ``votes_if_yes`` and ``votes_if_no``, which also weigh as two cases of each kind in every estimate.
    All patterns fit one row (at most 3 ** n_rules), so the rounds are one fold over them there.
    """
    log_odds = (
        f"ln(e.prior / (1 - e.prior)) + aggregate(sequence(0, {n_rules - 1}), 0D,"
        " (s, j) -> s + ln(e.yes[3 * j + p.votes[j]] / e.no[3 * j + p.votes[j]]))"
    )
    weighed = f"transform(patterns, p -> named_struct('votes', p.votes, 'n', p.n, 'w', p.n / (1 + exp(-({log_odds})))))"

    def flat(start: tuple[float, ...]) -> str:
        return f"array({', '.join(f'{x}D' for x in start * n_rules)})"

    def rates(start: tuple[float, ...], weight: str) -> str:
        hits = f"aggregate(q, 2D * {flat(start)}[k], (s, p) -> s + if(p.votes[cast(k div 3 AS int)] = k % 3, {weight}, 0D))"
        return f"transform(sequence(0, {3 * n_rules - 1}), k -> {hits} / aggregate(q, 2D, (s, p) -> s + {weight}))"

    new_prior = "aggregate(q, 1D, (s, p) -> s + p.w) / aggregate(q, 2D, (s, p) -> s + p.n)"
    estimates = f"named_struct('prior', {new_prior}, 'yes', {rates(votes_if_yes, 'p.w')}, 'no', {rates(votes_if_no, '(p.n - p.w)')})"
    start = f"named_struct('prior', {prior}D, 'yes', {flat(votes_if_yes)}, 'no', {flat(votes_if_no)})"
    votes = F.array(*((F.expr(f"pattern div {3**k}") % 3).cast("int") for k in range(n_rules)))
    row = patterns.select(*by, "pattern", votes.alias("votes"), F.col("n").cast("double").alias("n")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pattern", "votes", "n"))).alias("patterns"))
    fitted = row.withColumn("e", F.expr(f"aggregate(sequence(1, {rounds}), {start}, (e, t) -> aggregate(array({weighed}), e, (old, q) -> {estimates}))"))
    scored = f"transform(patterns, p -> named_struct('pattern', p.pattern, 'posterior', 1 / (1 + exp(-({log_odds}))), 'prior', e.prior, 'yes', e.yes, 'no', e.no))"
    return fitted.select(*by, F.explode(F.expr(scored)).alias("p")).select(*by, "p.*")
