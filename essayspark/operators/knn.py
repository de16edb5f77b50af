"""Exact k-nearest-neighbour search, voting and a one-pass grid search
(J6, ML5, ML6, ML15, O7).

Spark has no nearest-neighbour join.  Emitting every (query, training)
pair as a row would be quadratic in rows shuffled, so the search is a
block-nested-loop join:

* queries are hashed into ``BQ`` blocks and training rows into ``BT``
  blocks (block counts follow the data so a block stays near
  ``rows_per_block`` rows, however skewed the groups are);
* each query row is replicated to every training block and each training
  row to every query block; ``cogroup`` on (group, query block, training
  block) hands one bounded block pair to a task;
* the task computes the block's distance matrix with numpy and returns
  only the k nearest per query (candidates within a rounding margin of
  the k-th approximate distance are re-ranked by the exact
  sum of squares, so the result is exact);
* ``row_number() <= k`` over the <= BT x k candidates of each query
  picks the final neighbours (planned as a WindowGroupLimit).

Distance ties are broken by the training key, vote ties by the smallest
label (the classifier's rule).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 4096
# Values (rows x dimensions) a block's dense matrix may hold: 2^23 doubles
# = 64 MB per side, so wide vectors get proportionally fewer rows per block.
BLOCK_VALUES = 1 << 23
# Values of either side that the exact re-ranking of candidates copies at a time (8 MB).
SLICE_VALUES = 1 << 20
# Distances of a block pair that are held at a time (8 MB); their temporaries are as large.
PAIRS = 1 << 20


def rows_per_block_for(dim: int) -> int:
    """Rows per block for vectors of ``dim`` dimensions."""
    return max(16, min(ROWS_PER_BLOCK, BLOCK_VALUES // max(dim, 1)))


def _n_blocks(df: DataFrame, rows_per_block: int, group: str | None) -> int:
    """Blocks that bring the largest group's share of a block to ``rows_per_block``: rows are copied
    once per block of the other side, so their number follows the largest group, not the table."""
    n = df.count() if group is None else df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    return max(1, math.ceil(n / rows_per_block))


def _exact_sq(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Sum over dimensions, in dimension order, of (q - t)^2 (row-wise)."""
    acc = np.zeros(q.shape[0], dtype=np.float64)
    for d in range(q.shape[1]):
        diff = q[:, d] - t[:, d]
        acc += diff * diff
    return acc


def _matrix(pdf: pd.DataFrame, vec: str, sparse: tuple[str, str, str] | None) -> np.ndarray:
    """A block's dense matrix: the dense part, then (when ``sparse``) the
    (indices, values) part laid out over its width, built inside the task."""
    m = np.stack(pdf[vec].to_numpy()).astype(np.float64)
    if sparse is None:
        return m
    ic, vc, dc = sparse
    width = int(pdf[dc].iloc[0])  # one group per block pair: one width
    sp = np.zeros((len(pdf), width))
    lens = pdf[ic].map(len).to_numpy()
    if lens.sum():
        rows = np.repeat(np.arange(len(pdf)), lens)
        sp[rows, np.concatenate([np.asarray(x, dtype=np.int64) for x in pdf[ic]])] = \
            np.concatenate([np.asarray(x, dtype=np.float64) for x in pdf[vc]])
    return np.hstack([m, sp])


def _whole_counts(q: pd.DataFrame, t: pd.DataFrame, sparse: tuple[str, str, str]) -> tuple | None:
    """Both sides' sparse parts as float32 matrices with their sums of squares, if every dot product of them is exact in float32: whole numbers
    from 0 and, by Cauchy and Schwarz, products and their sums under 2^24."""
    ic, vc, dc = sparse
    out = []
    for pdf in (q, t):
        lens = pdf[ic].map(len).to_numpy()
        rows = np.repeat(np.arange(len(pdf)), lens)
        val = np.concatenate([np.asarray(x, np.float64) for x in pdf[vc]]) if lens.sum() else np.zeros(0)
        at = np.concatenate([np.asarray(x, np.int64) for x in pdf[ic]]) if lens.sum() else np.zeros(0, np.int64)
        if not ((val >= 0) & (val == np.floor(val))).all():
            return None
        m = np.zeros((len(pdf), int(pdf[dc].iloc[0])), np.float32)
        m[rows, at] = val
        out.append((m, np.bincount(rows, val * val, len(pdf))))
    (qm, qs), (tm, ts) = out
    return (qm, qs, tm, ts) if qs.max() * ts.max() < 2.0**48 and max(qs.max(), ts.max()) < 2.0**48 else None


def _block_topk(k: int, qkey: str, tkey: str, vec: str, label: str, keys: list[str],
                qfold: str | None, tfold: str | None, sparse: tuple[str, str, str] | None = None, every: bool = False):
    def fn(qp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        cols = keys + [qkey, tkey, "dist", label] + ["across"] * every
        if len(qp) == 0 or len(tp) == 0:
            # typed empty frame (a group present on one side only)
            empty = {c: qp[c].iloc[:0].reset_index(drop=True) for c in keys}
            empty[qkey] = qp[qkey].iloc[:0].reset_index(drop=True)
            empty[tkey] = tp[tkey].iloc[:0].reset_index(drop=True)
            empty["dist"] = pd.Series([], dtype="float64")
            empty[label] = tp[label].iloc[:0].reset_index(drop=True)
            empty["across"] = pd.Series([], dtype="bool")
            return pd.DataFrame(empty)[cols]
        # whole counts: their part of every distance comes out of one float32 product, exact
        whole = _whole_counts(qp, tp, sparse) if sparse else None
        Q = _matrix(qp, vec, None if whole else sparse)
        T = _matrix(tp, vec, None if whole else sparse)
        q_sq, t_sq = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", T, T)
        kk, t_keys = min(k, T.shape[0]), tp[tkey].to_numpy()
        found = []
        # queries take turns, so the distances to a whole block are held for a few of them only
        turn = max(1, PAIRS // T.shape[0])
        for at in range(0, Q.shape[0], turn):
            # fast approximate distances (BLAS), used only to find candidates
            scale = q_sq[at:at + turn, None] + t_sq[None, :]
            every_one = scale - 2.0 * (Q[at:at + turn] @ T.T)
            counted = None
            if whole:
                qm, qs, tm, ts = whole
                counted = (qm[at:at + turn] @ tm.T).astype(np.float64)
                counted *= -2.0
                counted += qs[at:at + turn, None]
                counted += ts
                every_one += counted
                scale += qs[at:at + turn, None] + ts
            margin = 1e-9 * (scale + 1.0)
            for across in (True, False) if every else (qfold is not None,):
                approx = every_one
                if across:
                    approx = np.where(qp[qfold].to_numpy()[at:at + turn, None] == tp[tfold].to_numpy()[None, :], np.inf, every_one)
                kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
                qi, ti = np.nonzero((approx <= kth[:, None] + margin) & np.isfinite(approx))
                # candidates are re-ranked in slices: many ties must not copy all their vectors at once
                step = max(1, SLICE_VALUES // Q.shape[1])
                exact = np.concatenate([_exact_sq(Q[at + qi[a:a + step]], T[ti[a:a + step]])
                                        for a in range(0, max(len(qi), 1), step)])
                if whole:
                    exact += counted[qi, ti]
                qi += at
                # keep the k smallest (exact distance, training key) per query
                order = np.lexsort((t_keys[ti], exact, qi))
                qi, ti, exact = qi[order], ti[order], exact[order]
                first = np.r_[0, np.flatnonzero(np.diff(qi)) + 1]
                pos = np.arange(len(qi)) - np.repeat(first, np.diff(np.r_[first, len(qi)]))
                keep = pos < k
                found.append((qi[keep], ti[keep], exact[keep], np.full(int(keep.sum()), across)))
        qi, ti, exact, across = (np.concatenate([f[i] for f in found]) for i in range(4))
        out = {c: qp[c].to_numpy()[qi] for c in keys}
        out[qkey] = qp[qkey].to_numpy()[qi]
        out[tkey] = t_keys[ti]
        out["dist"] = exact
        out[label] = tp[label].to_numpy()[ti]
        out["across"] = across
        return pd.DataFrame(out)[cols]

    return fn


def neighbours(queries: DataFrame, train: DataFrame, k: int, *, qkey: str, tkey: str,
               vec: str, label: str, group: str | None = None, fold: str | None = None,
               rows_per_block: int = ROWS_PER_BLOCK, sparse: tuple[str, str, str] | None = None, every: bool = False) -> DataFrame:
    """(group?, qkey, tkey, dist, label, rank) for the k nearest training
    rows of every query (squared Euclidean distance, no scaling).

    A null or NaN component counts as 0.
    ``group``: only rows of the same group are neighbours (per-set models).
    ``fold``: a training row in the query's own fold is never a neighbour
    (cross-validation with one ranking for all folds).
    ``sparse``: (indices, values, width) columns of a sparse part appended
    to ``vec``; rows travel sparse and each block is made dense in its task
    (with ``group``, so every block pair has one width).
    ``every``, with ``fold``: both rankings from one pass over the block pairs; a column ``across`` is true for the nearest rows of
    other folds and false for those of all rows."""
    keys = [group] if group else []
    bq, bt = _n_blocks(queries, rows_per_block, group), _n_blocks(train, rows_per_block, group)
    extra = list(sparse) if sparse else []
    qcols = keys + [qkey, vec] + extra + ([fold] if fold else [])
    tcols = keys + [tkey, vec, label] + extra + ([fold] if fold else [])
    def filled(c):
        # a missing component counts as 0, so no row loses its neighbours
        return F.transform(F.col(c), lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0))) if c == vec else F.col(c)

    # fresh aliases: both sides often come from the same DataFrame
    q = (queries.select(*[filled(c).alias(c) for c in qcols])
         .withColumn("__qb", F.pmod(F.xxhash64(F.col(qkey)), F.lit(bq)))
         .withColumn("__tb", F.explode(F.sequence(F.lit(0), F.lit(bt - 1)).cast("array<bigint>"))))
    t = (train.select(*[filled(c).alias(c) for c in tcols])
         .withColumn("__tb", F.pmod(F.xxhash64(F.col(tkey)), F.lit(bt)))
         .withColumn("__qb", F.explode(F.sequence(F.lit(0), F.lit(bq - 1)).cast("array<bigint>"))))
    if fold:
        t = t.withColumnRenamed(fold, "__tfold")
    gkeys = keys + ["__qb", "__tb"]
    fields = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
    tfields = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    schema = ", ".join([f"{c} {fields[c]}" for c in keys]
                       + [f"{qkey} {fields[qkey]}", f"{tkey} {tfields[tkey]}", "dist double",
                          f"{label} {tfields[label]}"] + ["across boolean"] * every)
    fn = _block_topk(k, qkey, tkey, vec, label, keys, fold, "__tfold" if fold else None, sparse, every)
    cand = q.groupBy(*gkeys).cogroup(t.groupBy(*gkeys)).applyInPandas(fn, schema)
    w = Window.partitionBy(qkey, *["across"] * every).orderBy("dist", tkey)
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def vote(nb: DataFrame, qkey: str, label: str, also: str | list[str] | None = None) -> DataFrame:
    """Majority label per query (and per ``also``, such as a k); ties -> smallest label."""
    keys = [qkey] + ([also] if isinstance(also, str) else list(also or []))
    counts = nb.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("__votes"))
    w = Window.partitionBy(*keys).orderBy(F.desc("__votes"), F.asc(label))
    return (counts.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1)
            .select(*keys, F.col(label).alias("pred")))


def predict(queries: DataFrame, train: DataFrame, k: int, *, qkey: str, tkey: str, vec: str,
            label: str, group: str | None = None, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """ML5: (qkey, pred) by uniform vote of the k nearest training rows."""
    nb = neighbours(queries, train, k, qkey=qkey, tkey=tkey, vec=vec, label=label, group=group,
                    rows_per_block=rows_per_block)
    return vote(nb, qkey, label)


def grid_search(train: DataFrame, ks: list[int], *, key: str, vec: str, label: str, fold: str,
                group: str | None = None, rows_per_block: int = ROWS_PER_BLOCK,
                sparse: tuple[str, str, str] | None = None, ranked: DataFrame | None = None) -> DataFrame:
    """ML6 + O7: (group?, k, mean_accuracy, is_best) over the folds.

    Each training row is ranked once against the rows of the other folds
    (of its own group), up to the largest k; every k of the grid then votes
    from the same ranking (a neighbour of rank r serves all k >= r).
    ``ranked``: that ranking with the queries' key as ``__qid``, if it is there already."""
    gcols = [group] if group else []
    extra = list(sparse) if sparse else []
    q = train.select(F.col(key).alias("__qid"), *gcols, vec, *extra, fold, F.col(label).alias("__true"))
    t = train.select(key, *gcols, vec, *extra, label, fold)
    nb = ranked if ranked is not None else neighbours(q.select("__qid", *gcols, vec, *extra, fold), t, max(ks), qkey="__qid", tkey=key, vec=vec,
                    label=label, fold=fold, group=group, rows_per_block=rows_per_block, sparse=sparse)
    grid = F.array(*[F.lit(k) for k in ks])
    per_k = nb.withColumn("k", F.explode(F.filter(grid, lambda g: g >= F.col("rank"))))
    pred = vote(per_k, "__qid", label, "k")
    scored = pred.join(q.select("__qid", *gcols, fold, "__true"), "__qid")
    per_fold = (scored.groupBy(*gcols, "k", fold)
                .agg(F.avg((F.col("pred") == F.col("__true")).cast("double")).alias("acc")))
    mean = per_fold.groupBy(*gcols, "k").agg(F.avg("acc").alias("mean_accuracy"))
    # |grid| rows per group: the ranking window covers a handful of rows.
    # Means equal up to summation order are ties (rounded to 12 decimals):
    # the smallest k among them wins, whatever order the sums ran in.
    w = (Window.partitionBy(*gcols) if gcols else Window).orderBy(F.desc(F.round("mean_accuracy", 12)),
                                                                  F.asc("k"))
    return mean.withColumn("is_best", F.row_number().over(w) == 1)


__all__ = ["neighbours", "vote", "predict", "grid_search"]
