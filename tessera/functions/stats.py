"""Consensus, contamination and background statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.seq import RANKS
from tessera.params import Consensus


def consensus_start() -> Column:
    """The state of a consensus before any rank: no rank accepted, confidence 1.0."""
    return F.struct(*[F.lit(None).cast("string").alias(c) for c in RANKS], F.lit(1.0).alias("confidence"), F.lit(True).alias("going"), F.lit(0).alias("depth"))


def consensus_steps(k: int, p: Consensus = Consensus()) -> list[tuple[str, Column]]:
    """Columns, each built on those before, that take a cell's consensus (_s) down rank k.

    paths: array of (path, n), a cell's distinct paths and their counts.  Rank after rank,
    candidates are the values among reads that carry the accepted value of the rank before.
    Reads that conflict with an accepted rank weigh on all candidates alike, so that a
    candidate's log likelihood needs counts alone: of its own value, of null and of the rest
    among reads without conflict.  The best candidate's softmax share must reach
    min_confidence, and it must not be null; else the path ends there.  confidence is that
    of the last accepted rank.  What later columns use several times has a column of its own.
    """
    ln = {n: math.log(getattr(p, n)) for n in ("p_match", "p_none", "p_error")}
    codes, state = list(RANKS), F.col("_s")
    code = codes[k]
    own = F.filter("paths", lambda x: x["path"][codes[k - 1]] == state[codes[k - 1]]) if k else F.col("paths")
    fitting = F.filter("paths", lambda x: _all([x["path"][c].isNull() | (x["path"][c] == state[c]) for c in codes[:k]]))
    total, none, best = F.col("_total"), F.col("_none"), F.col("_best")

    def scored(v: Column) -> Column:
        mine = _sum(F.filter("_fitting", lambda x: x["v"] == v), lambda x: x["n"])
        value = mine * ln["p_match"] + none * ln["p_none"] + (total - mine - none) * ln["p_error"]
        empty = none * ln["p_match"] + (total - none) * ln["p_error"]
        return F.struct(F.when(v.isNull(), empty).otherwise(value).alias("ll"), v.alias("v"))

    share = F.try_divide(F.lit(1.0), F.aggregate("_ranked", F.lit(0.0), lambda t, x: t + F.exp(x["ll"] - best["ll"])))
    accepted = state["going"] & F.exists("_names", lambda v: v.isNotNull()) & (F.col("_share") >= p.min_confidence) & best["v"].isNotNull()
    ok = F.col("_ok")
    return [
        ("_names", F.array_distinct(F.transform(own, lambda x: x["path"][code]))),
        ("_fitting", F.transform(fitting, lambda x: F.struct(x["path"][code].alias("v"), x["n"].alias("n")))),
        ("_total", _sum(F.col("_fitting"), lambda x: x["n"])),
        ("_none", _sum(F.filter("_fitting", lambda x: x["v"].isNull()), lambda x: x["n"])),
        ("_ranked", F.transform("_names", scored)),
        ("_best", F.array_max("_ranked")),
        ("_share", share),
        ("_ok", F.coalesce(accepted, F.lit(False))),
        ("_s", F.struct(*[(F.when(ok, best["v"]) if c == code else state[c]).alias(c) for c in codes], F.when(ok, F.col("_share")).otherwise(state["confidence"]).alias("confidence"), ok.alias("going"), F.when(ok, k + 1).otherwise(state["depth"]).alias("depth"))),
    ]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def _sum(array: Column, value) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda t, x: t + value(x))


def contamination_mean(contam: Column, match: Column, noise: Column, p: Consensus = Consensus()) -> Column:
    """Mean of the Beta posterior of contamination."""
    return (F.lit(p.alpha) + contam) / (F.lit(p.alpha + p.beta) + contam + match + noise)


def noise_split(counts: Column, accepted: Column, reads: Column, p: Consensus = Consensus()) -> Column:
    """(match, noise, contam) from an array of (v, n) without nulls; reads: all reads, those without a value too.

    Values other than the accepted one are noise below min_noise_reads or below noise_ratio
    of all reads, contamination otherwise.
    """
    total = _sum(counts, lambda x: x["n"])
    other = F.filter(counts, lambda x: accepted.isNull() | (x["v"] != accepted))
    small = lambda x: (x["n"] < p.min_noise_reads) | (x["n"] / reads < p.noise_ratio)
    return F.struct(
        (total - _sum(other, lambda x: x["n"])).alias("match"),
        _sum(F.filter(other, small), lambda x: x["n"]).alias("noise"),
        _sum(F.filter(other, lambda x: ~small(x)), lambda x: x["n"]).alias("contam"),
    )


def poisson_tail(k: Column, rate: Column) -> Column:
    """P(X >= k) for k > 0 as 1 - sum; a rate so large that exp(-rate) is 0 gives 1."""
    terms = F.when(k > 1, F.sequence(F.lit(1), (k - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    first = F.exp(-rate)
    state = F.struct(first.alias("term"), first.alias("sum"))
    total = F.aggregate(terms, state, lambda s, m: F.struct((s["term"] * rate / m).alias("term"), (s["sum"] + s["term"] * rate / m).alias("sum")))["sum"]
    return F.when(rate <= 0, F.lit(0.0)).otherwise(F.lit(1.0) - total)


def sequence_consensus(counts: Column, p: Consensus = Consensus()) -> Column:
    """(v, confidence) of the best of an array of (v, n): one level, no nulls; v is null below min_confidence."""
    best = F.array_max(F.transform(counts, lambda x: F.struct(x["n"].alias("n"), x["v"].alias("v"))))
    step = math.log(p.p_match) - math.log(p.p_error)
    share = F.lit(1.0) / F.aggregate(counts, F.lit(0.0), lambda t, x: t + F.exp((x["n"] - best["n"]) * step))
    return F.struct(F.when(share >= p.min_confidence, best["v"]).alias("v"), share.alias("confidence"))
