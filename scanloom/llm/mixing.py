"""Mixing sources to target weights: balanced sampling by the cube method.

Every document of a source is drawn the same expected number of times, its source's target tokens over
its tokens at hand. The whole part of that number is certain; the fraction is an inclusion probability.
The cube method moves the vector of probabilities through the null space of the balancing constraints,
token total and document total, so that both stay as they were, until a probability reaches 0 or 1.

A source flies in blocks of bounded size, in parallel; the few documents each block leaves open fly on in
blocks of blocks, until one block is left per source, so the two constraints hold at every size. Inside
a block the documents that are longer than the rest are decided first, along directions in which all the
others balance them a little, in number too unless one is too long for that; the rest moves three at a
time, which two constraints always allow.
When ``LANDED`` documents of a source are open, the subset of them nearest to both totals is drawn.

Defined results: documents without tokens, with NULL source or of sources without a target are drawn 0
times; a target without documents is reported with share 0; a repeat cap of NULL is 1; an empty table
draws nothing; ties and repeated documents are units of their own; a source with several targets has the
largest.
"""

from __future__ import annotations

import random
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Documents of one block of the flight, about; a block is what a task holds.
BLOCK_DOCS = 20_000
#: Documents that a block leaves open, and that are landed together per source.
LANDED = 16
#: Documents so many times longer than the mean of the open ones are decided first.
LONG = 2
#: Share of its way to 0 or 1 that a long document must be able to go in one step with both totals kept.
BALANCED = 0.2
SEED = 7
_EPS = 1e-9


def _reach(p: np.ndarray, d: np.ndarray) -> float:
    """How far ``p`` can move along ``d`` before some value leaves 0..1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return float(np.where(d > 0, (1 - p) / d, np.where(d < 0, -p / d, np.inf)).min())


def _balancing(t: np.ndarray, p: np.ndarray, h: int, w: np.ndarray, way: float) -> np.ndarray:
    """The direction that moves h by ``way`` and the others, least weighted squares, so that totals stay.

    Both totals where that takes h a good part of its way, else the tokens alone: a document too long for
    the others to balance in number as well is the one case in which the number of documents is let go.
    """
    s0, s1, s2 = w.sum(), w @ t, w @ (t * t)
    det = s0 * s2 - s1 * s1
    if det > 1e-9 * s0 * s2:
        d = -w * ((s2 - s1 * t[h]) / det + (s0 * t[h] - s1) / det * t)
        d[h] = 1.0
        if _reach(p, d * way) >= BALANCED:
            return d * way
    d = -w * t * (t[h] / s2)
    d[h] = 1.0
    return d * way


def settle_long(tokens: list[float], probs: list[float], rng: random.Random) -> list[float]:
    """Decides the documents much longer than the rest, longest first; all other open ones balance them a little.

    A document is taken with its probability. One so long that the others can balance only its presence or
    only its absence gets that.
    """
    t, p = np.array(tokens), np.array(probs)
    for h in np.argsort(-t, kind="stable"):
        goal = None
        while _EPS < p[h] < 1 - _EPS:
            w = np.where((p > _EPS) & (p < 1 - _EPS), p * (1 - p), 0.0)
            w[h] = 0.0
            open_ = w > 0
            if goal is None:
                if open_.sum() < LANDED or t[h] <= LONG * t[open_].mean():
                    return p.tolist()
                lacks_in, lacks_out = (1 - p[h]) * t[h] - p[open_] @ t[open_], p[h] * t[h] - (1 - p[open_]) @ t[open_]
                if max(lacks_in, lacks_out) > 0:
                    goal = 1.0 if lacks_in < lacks_out else 0.0
                else:
                    goal = float(rng.random() < p[h])
            if not open_.any():
                p[h] = goal
                break
            d = _balancing(t, p, h, w, goal - p[h])
            q = p + min(_reach(p, d), 1.0) * d
            p = np.where(q < _EPS, 0.0, np.where(q > 1 - _EPS, 1.0, q))
    return p.tolist()


def flight(tokens: list[float], probs: list[float], rng: random.Random, leave: int = 0, count: bool = True) -> list[float]:
    """Moves the probabilities along null-space directions until few are strictly between 0 and 1.

    The sum of tokens times probabilities stays the same, and with ``count`` the sum of probabilities
    too. At most as many as there are constraints stay open; the flight ends early when only ``leave``
    are undecided.
    """
    need = 3 if count else 2
    p = list(probs)
    undecided = sum(_EPS < q < 1 - _EPS for q in p)
    open_, n, at = [], len(p), 0
    while undecided > leave:
        while len(open_) < need and at < n:
            if _EPS < p[at] < 1 - _EPS:
                open_.append(at)
            at += 1
        if len(open_) < need:
            return p
        t = [tokens[x] for x in open_]
        if count:
            u = (t[1] - t[2], t[2] - t[0], t[0] - t[1]) if any(x != t[0] for x in t) else (1.0, -1.0, 0.0)
        else:
            u = (t[1], -t[0])
        up = down = float("inf")
        for q, d in zip([p[x] for x in open_], u):
            if d > 0:
                up, down = min(up, (1 - q) / d), min(down, q / d)
            elif d < 0:
                up, down = min(up, -q / d), min(down, -(1 - q) / d)
        step = up if rng.random() * (up + down) < down else -down
        still = []
        for x, d in zip(open_, u):
            q = p[x] + step * d
            p[x] = 0.0 if q < _EPS else 1.0 if q > 1 - _EPS else q
            if 0.0 < p[x] < 1.0:
                still.append(x)
        undecided -= len(open_) - len(still)
        open_ = still
    return p


def landing(tokens: list[float], probs: list[float], rng: random.Random) -> list[float]:
    """Decides the few open ones: draws one of their subsets that miss both totals least.

    A document too many or too few, beyond the one that rounding allows, weighs as much as the tokens of a
    mean document; subsets that differ by under a token count as equal.
    """
    open_ = [i for i, q in enumerate(probs) if _EPS < q < 1 - _EPS]
    out = [float(round(q)) for q in probs]
    if not open_:
        return out
    t, q = np.array([tokens[i] for i in open_]), np.array([probs[i] for i in open_])
    subsets = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    extra = np.maximum(np.abs(subsets.sum(axis=1) - q.sum()) - (1 - _EPS), 0.0)
    missed = np.maximum(np.abs(subsets @ t - t @ q), 1.0) + np.ceil(extra) * max(t.mean(), 1.0)
    best = np.flatnonzero(missed <= missed.min() + _EPS)
    for i, x in zip(open_, subsets[best[rng.randrange(len(best))]]):
        out[i] = float(x)
    return out


def decided(tokens: list[float], probs: list[float], rng: random.Random, land: bool) -> list[float]:
    """The flight of a block: long documents, then the others in random order; all of them with ``land``.

    Those left open are thus of ordinary lengths, whose subsets come near any total.
    """
    p = settle_long(tokens, probs, rng)
    order = rng.sample(range(len(p)), len(p))
    q = flight([tokens[i] for i in order], [p[i] for i in order], rng, LANDED)
    if land:
        q = landing([tokens[i] for i in order], q, rng)
    for i, x in zip(order, q):
        p[i] = x
    return p


def clean_targets(targets: DataFrame) -> DataFrame:
    """One row per named source: its largest weight and cap; a NULL weight is 0, a NULL cap 1."""
    named = targets.where("source is not null").groupBy("source")
    return named.agg(F.coalesce(F.max(F.col("target_weight").cast("double")), F.lit(0.0)).alias("target_weight"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("max_repeats"))


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: source, target_weight, max_repeats, docs and tokens at hand, and rate.

    rate is the expected number of draws of each document: the total is the largest at which every
    target that has documents can be reached within its cap.
    """
    have = sizes.where("tokens > 0 and source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("have"))
    table = clean_targets(targets).join(have, "source", "left").na.fill(0, ["docs", "have"])
    reach = F.when((F.col("have") > 0) & (F.col("target_weight") > 0), F.col("max_repeats") * F.col("have") / F.col("target_weight"))
    total = table.agg(F.min(reach)).first()[0] or 0.0
    rate = F.when(F.col("have") > 0, F.least(F.lit(float(total)) * F.col("target_weight") / F.col("have"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return table.withColumn("rate", rate)


def drawn(sizes: DataFrame, targets: DataFrame, id_col: str = "doc_id", seed: int = SEED, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, source, tokens, copies) of every document; copies is how often the mixture holds it."""
    rates = stored(plan(sizes, targets), "rates")
    units = (
        sizes.join(rates.select("source", "rate"), "source", "left")
        .withColumn("rate", F.when(F.col("tokens") > 0, F.coalesce("rate", F.lit(0.0))).otherwise(0.0))
        .select(F.col(id_col).alias("id"), "source", "tokens", "rate")
        .withColumn("whole", F.floor(F.col("rate") + _EPS)).withColumn("prob", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    )
    units = stored(units, "units")
    id_type, tasks = dict(units.dtypes)["id"], int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out_schema = f"id {id_type}, source string, tokens bigint, prob double"

    def fly(level: int, land: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["tokens", "id"], ascending=[False, True], kind="stable")
            t, rng = rows["tokens"].astype(float).tolist(), random.Random(f"{seed}/{level}/{key}")
            rows["prob"] = decided(t, rows["prob"].tolist(), rng, land)
            return rows[["id", "source", "tokens", "prob"]]

        return run

    open_, chosen, level = units.where(f"prob > {_EPS}").select("id", "source", "tokens", "prob"), [], 0
    while True:
        counts = open_.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= block_docs:
            break
        block = F.pmod(F.xxhash64(F.lit(level), "id"), F.ceil(F.col("n") / block_docs))
        # as many tasks as the session has partitions: the rows are small, the flights are not
        spread = open_.join(counts, "source").withColumn("block", block).repartition(tasks, "source", "block")
        flown = stored(spread.groupBy("source", "block").applyInPandas(fly(level, False), out_schema), "flown")
        chosen.append(flown.where(f"prob >= {1 - _EPS}").select("id"))
        open_, level = flown.where(f"prob > {_EPS} and prob < {1 - _EPS}"), level + 1
    chosen.append(open_.repartition(tasks, "source").groupBy("source").applyInPandas(fly(level, True), out_schema).where("prob > 0.5").select("id"))
    return units.join(reduce(DataFrame.union, chosen).withColumn("extra", F.lit(1)), "id", "left").select(
        F.col("id").alias(id_col), "source", "tokens", (F.coalesce("whole", F.lit(0)) + F.coalesce("extra", F.lit(0))).cast("bigint").alias("copies")
    )


def shares(draws: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_weight, reached_share, drawn_tokens, drawn_docs, most_copies, token_residual, doc_residual) per target.

    The residuals are what was drawn less what the rates promise: tokens and documents that the landing left over.
    """
    got = draws.where("copies > 0").groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("drawn_tokens"), F.sum("copies").alias("drawn_docs"), F.max("copies").alias("most_copies")
    )
    total = got.agg(F.sum("drawn_tokens")).first()[0]
    table = plan(draws, targets).join(got, "source", "left").na.fill(0, ["drawn_tokens", "drawn_docs", "most_copies"])
    return table.select(
        "source", "target_weight", (F.col("drawn_tokens") / F.lit(float(total or 1))).alias("reached_share"), "drawn_tokens", "drawn_docs", "most_copies",
        (F.col("drawn_tokens") - F.col("rate") * F.col("have")).alias("token_residual"), (F.col("drawn_docs") - F.col("rate") * F.col("docs")).alias("doc_residual"),
    )
