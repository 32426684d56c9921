"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells source x language x topic are raked until their
marginals agree with the targets; each document is then kept with its cell's
calibrated probability, decided by a hash of its identifier and text. A cell's
probability is min(1, rate * share / weight); the rate is the one at which the
expected tokens are `keep` of all, so cells too small for their share are taken
whole and all others hold exactly their fitted proportions. Without `keep` the
tokens are BUDGET of all, or more where all cells can hold their proportions with
more (all tokens where the targets are the corpus's own).

A document's topic is its cluster by spherical k-means over hashed vectors of its words
of five bytes or more, fitted to all documents; without such a word it is -1. Its tokens
are its blank-separated words: weights are shares of words.
Default targets are the corpus marginals tempered by `temper`. Null sources and
languages are categories of their own; a null text has no tokens and a document
without tokens is never sampled (it cannot add to a weight) unless keep_empty.
Repeated rows share one decision. A very long text counts with all its words. Columns
of any name pass through, but those named as an added one are replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import settled
from kinfold.llm.textbytes import chunks, released, to_system, word_hashes, words

DIMS = ("source", "lang", "topic")
ADDED = ("_topic", "_tokens", "_prob", "_selected")
#: Up to this many cells are raked on the driver and sent whole; beyond, by
#: windows over the cell table.
DRIVER_CELLS = 50_000
ROUNDS, CLOSE = 200, 1e-10
#: The token budget, as a share of all, where no `keep` is given.
BUDGET = 0.6
#: Places and length of a word vector, and passes that move the centers.
WIDE, UNIT, TOPIC_ROUNDS, SEED = 64, 1000, 3, 7


def word_vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text its tokens, and a vector of whole numbers: its words of five bytes
    or more, hashed with a sign into WIDE places, scaled to length UNIT (zeros without
    such a word)."""
    tokens, out = np.zeros(len(texts), np.int64), np.zeros((len(texts), WIDE), np.int32)
    for a, b, raw, offsets in chunks(texts):
        starts, ends, first = words(raw, offsets)
        tokens[a:b] = np.diff(first)
        long = np.flatnonzero(ends - starts >= 5)
        h = word_hashes(raw, starts, ends, lower=True)[long]
        doc = np.searchsorted(first, long, "right") - 1
        cell = doc * WIDE + (h >> np.uint64(40)).astype(np.int64) % WIDE
        grid = np.bincount(cell, (h & np.uint64(1)) * 2.0 - 1.0, (b - a) * WIDE).reshape(b - a, WIDE)
        size = np.sqrt((grid * grid).sum(axis=1, keepdims=True))
        out[a:b] = np.rint(UNIT * grid / np.where(size > 0, size, 1))
    return tokens, out


def nearest(vectors: np.ndarray, centers: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The center of greatest cosine to each vector less the mean, the first of equals;
    -1 for a vector of zeros."""
    best = ((vectors - mean) @ centers.T).argmax(axis=1).astype(np.int32)
    best[~vectors.any(axis=1)] = -1
    return best


def fit_topics(texts: DataFrame, topics: int, rounds: int = TOPIC_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(centers, mean): spherical k-means over the word vectors of all texts, from
    seeded directions. A pass sums whole numbers, so the order of tasks makes no
    difference, and one row a topic reaches the driver."""
    centers, mean = np.random.default_rng(SEED).standard_normal((topics, WIDE)), np.zeros(WIDE)
    for k in range(rounds + 1):  # the first pass finds the mean

        def sums(batches: Iterator[pa.RecordBatch], centers=centers, mean=mean, one=k == 0) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((topics, WIDE), np.int64), np.zeros(topics, np.int64)
            for batch in batches:
                for j in range(0, batch.num_rows, 1024):
                    _, vectors = word_vectors(batch.column(0).slice(j, 1024))
                    own = nearest(vectors, centers, mean)
                    vectors, own = vectors[own >= 0], own[own >= 0] * (not one)
                    np.add.at(total, own, vectors)
                    count += np.bincount(own, minlength=topics)
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), *[pa.array(total[some, j]) for j in range(WIDE)]], ["topic", "n", *[f"x{j}" for j in range(WIDE)]])

        cols = [f"x{j}" for j in range(WIDE)]
        got = texts.mapInArrow(released(sums), "topic int, n long, " + ", ".join(f"{c} long" for c in cols)).groupBy("topic").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols]).collect()
        if not got:
            break
        if k == 0:
            mean = np.array([got[0][c] for c in cols], float) / got[0]["n"]
        for r in got if k else ():
            centers[r["topic"]] = np.array([r[c] for c in cols], float) / r["n"] - mean
        centers = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-9)
    return centers, mean


def described(docs: DataFrame, *, topics: int, text_col: str = "text") -> DataFrame:
    """docs with _topic and _tokens; all columns kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    centers, mean = fit_topics(docs.select(text.alias("text")), topics)

    @F.arrow_udf("struct<topic:int,tokens:long>")
    def describe(texts: pa.Array) -> pa.Array:
        parts = [word_vectors(texts.slice(k, 1024)) for k in range(0, len(texts), 1024)]
        topic = [nearest(vectors, centers, mean) for _, vectors in parts]
        tokens = np.concatenate([np.empty(0, np.int64), *[t for t, _ in parts]])
        out = pa.StructArray.from_arrays([pa.array(np.concatenate([np.empty(0, np.int32), *topic])), pa.array(tokens)], ["topic", "tokens"])
        del parts, topic
        to_system()
        return out

    got = docs.withColumn("_mix", describe(text))
    return got.withColumn("_topic", F.col("_mix.topic")).withColumn("_tokens", F.col("_mix.tokens")).drop("_mix")


def rake(weights: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray]) -> np.ndarray:
    """Fitted shares (sum 1) of cells whose categories are codes[d]."""
    fitted = weights / weights.sum()
    for _ in range(ROUNDS):
        off = 0.0
        for code, target in zip(codes, targets, strict=True):
            have = np.bincount(code, fitted, len(target))
            factor = np.where(have > 0, target / np.where(have > 0, have, 1), 0)
            off = max(off, np.abs(factor[have > 0] - 1).max(initial=0))
            fitted = fitted * factor[code]
        if off < CLOSE:
            break
    return fitted


def tempered(have: np.ndarray, temper: float) -> np.ndarray:
    t = np.where(have > 0, have, 0.0) ** temper * (have > 0)
    return t / t.sum()


def cell_probabilities(cells: DataFrame, *, temper: float, targets: dict[str, dict] | None, keep: float | None = None, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """cells: source, lang, topic, tokens. Adds share and prob."""
    cells = settled(cells.where("tokens > 0"), "cells")
    if cells.limit(driver_cells + 1).count() <= driver_cells:
        rows = cells.collect()
        if not rows:
            return cells.withColumn("share", F.lit(0.0)).withColumn("prob", F.lit(0.0))
        rows.sort(key=lambda r: tuple((x is not None, x) for x in (r["source"], r["lang"], r["topic"])))
        weight = np.array([r["tokens"] for r in rows], float)
        codes, goals = [], []
        for d in DIMS:
            names = sorted({r[d] for r in rows}, key=lambda x: (x is not None, x))
            at = {x: k for k, x in enumerate(names)}
            codes.append(np.array([at[r[d]] for r in rows]))
            if targets and d in targets:
                goal = np.array([max(0.0, targets[d].get(x, 0.0)) for x in names])
                goals.append(goal / goal.sum())
            else:
                goals.append(tempered(np.bincount(codes[-1], weight, len(names)), temper))
        share = rake(weight, codes, goals)
        some = share > 0
        order = np.argsort(weight[some] / share[some])  # cells in the order in which they are used up
        w, f = weight[some][order], share[some][order]
        used = np.concatenate(([0.0], np.cumsum(w)[:-1]))
        left = np.cumsum(f[::-1])[::-1]
        tokens = keep * weight.sum() if keep is not None else max(BUDGET * weight.sum(), (w / f).min(initial=np.inf))
        rates = (tokens - used) / left
        fits = rates * f <= w * (1 + 1e-12)
        rate = rates[fits.argmax()] if fits.any() else np.inf
        prob = np.where(some, np.minimum(1.0, rate * share / weight), 0.0)
        schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in cells.schema)}, share double, prob double"
        return cells.sparkSession.createDataFrame([(*r, float(s), float(p)) for r, s, p in zip(rows, share, prob, strict=True)], schema)
    total = cells.agg(F.sum("tokens")).first()[0]
    fitted = cells.withColumn("share", F.col("tokens") / F.lit(float(total)))
    for d in DIMS:  # the categories' goals, from each one's tokens
        if targets and d in targets:
            goal = F.lit(0.0)
            for x, t in targets[d].items():
                goal = F.when(F.col(d).eqNullSafe(F.lit(x)), F.lit(float(t))).otherwise(goal)
            per = cells.select(d).distinct().withColumn("g", goal)
        else:
            per = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("g")).withColumn("g", F.pow("g", F.lit(temper)))
        per = per.withColumn(f"goal_{d}", F.col("g") / F.lit(per.agg(F.sum("g")).first()[0])).select(F.col(d).alias(f"_{d}"), f"goal_{d}")
        fitted = fitted.join(per, F.col(d).eqNullSafe(F.col(f"_{d}"))).drop(f"_{d}")
    for _ in range(ROUNDS):
        off = F.lit(0.0)
        for d in DIMS:
            factor = F.col(f"goal_{d}") / F.sum("share").over(Window.partitionBy(d))
            fitted = fitted.withColumn("_f", factor).withColumn("share", F.col("share") * F.col("_f")).withColumn(f"_off_{d}", F.abs(F.col("_f") - 1)).drop("_f")
            off = F.greatest(off, F.max(f"_off_{d}"))
        fitted = settled(fitted, "raked")
        done = fitted.agg(off).first()[0] < CLOSE
        fitted = fitted.drop(*[f"_off_{d}" for d in DIMS])
        if done:
            break
    # The rate as above; the order of use is found by bisection over sums.
    exact, high = fitted.where("share > 0").agg(F.min(F.col("tokens") / F.col("share")), F.max(F.col("tokens") / F.col("share"))).first()
    low, wanted = 0.0, keep * total if keep is not None else max(BUDGET * total, exact)
    for _ in range(60):
        rate = (low + high) / 2
        got = fitted.agg(F.sum(F.least(F.col("tokens").cast("double"), F.lit(rate) * F.col("share")))).first()[0]
        low, high = (rate, high) if got < wanted else (low, rate)
    return fitted.withColumn("prob", F.least(F.lit(1.0), F.lit(high) * F.col("share") / F.col("tokens"))).select(*cells.columns, "share", "prob")


def mix_sources(docs: DataFrame, *, temper: float = 0.7, topics: int = 8, targets: dict[str, dict] | None = None, keep: float | None = None, seed: int = 7, keep_empty: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """All rows and columns of docs, and _topic, _tokens, _prob, _selected (columns of
    these names are replaced)."""
    # The rows travel whole in one column, so no name of theirs meets one of these.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id"))
    rows = described(rows, topics=topics)
    cells = rows.groupBy("source", "lang", F.col("_topic").alias("topic")).agg(F.sum("_tokens").alias("tokens"))
    known = cell_probabilities(cells, temper=temper, targets=targets, keep=keep, driver_cells=driver_cells)
    known = known.select(F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), F.col("prob").alias("_p"))
    few = known.limit(driver_cells + 1).count() <= driver_cells
    met = F.col("source").eqNullSafe(F.col("_s")) & F.col("lang").eqNullSafe(F.col("_l")) & (F.col("_topic") == F.col("_t"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    out = rows.join(F.broadcast(known) if few else known, met, "left")
    out = out.withColumn("_prob", F.when(F.col("_tokens") > 0, F.coalesce("_p", F.lit(0.0))).otherwise(F.lit(1.0 if keep_empty else 0.0)))
    own = [c for c in docs.columns if c not in ADDED]
    return out.withColumn("_selected", draw < F.col("_prob")).select(*[F.col("row")[c].alias(c) for c in own], *ADDED)
