"""Similarity fits between point pairs.

Pairs are rows with ``fx, fy, fz`` (from) and ``tx, ty, tz`` (to). A fit needs one aggregation:
means, variances and covariances are merged map-side by Spark's central-moment aggregates, which
stay accurate at UTM magnitudes. Only one row per group reaches the 3x3 decomposition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.scale import attach, checkpointed, line, ordered, smallest_sum

FROM = ("fx", "fy", "fz")
TO = ("tx", "ty", "tz")
FIT_DDL = "scale double, rotation array<double>, t struct<x: double, y: double, z: double>, " \
          "reason string, n bigint"


def pairs(df: DataFrame, source: str, target: str, *keep: str) -> DataFrame:
    """Flat pair columns from two point columns."""
    return df.select(*keep, *[F.col(source)[a].alias(c) for a, c in zip(L.AXES, FROM)],
                     *[F.col(target)[a].alias(c) for a, c in zip(L.AXES, TO)])


def pair_moments(prs: DataFrame, keys: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(c).alias(f"m_{c}") for c in FROM + TO]
    aggs += [F.covar_pop(t, f).alias(f"c_{t}{f}") for t in TO for f in FROM]
    aggs += [F.var_pop(c).alias(f"v_{c}") for c in FROM]
    return prs.groupBy(*keys).agg(*aggs)


def _solve(pdf, keys):
    """Scale, rotation and offset of many moment rows at once."""
    import numpy as np
    import pandas as pd

    cov = pdf[[f"c_{t}{f}" for t in TO for f in FROM]].to_numpy(float).reshape(-1, 3, 3)
    mf, mt = (pdf[[f"m_{c}" for c in cols]].to_numpy(float) for cols in (FROM, TO))
    u, d, vt = np.linalg.svd(cov)
    rank = (d > d[:, :1] * 3 * np.finfo(float).eps).sum(1)
    sign = np.ones_like(d)
    sign[np.linalg.det(cov) < 0, 2] = -1.0
    # a planar point set has no sign in its covariance; keep the rotation proper
    flat = rank == 2
    sign[flat, 2] = np.sign(np.linalg.det(u[flat]) * np.linalg.det(vt[flat]))
    rot = (u * sign[:, None, :]) @ vt
    with np.errstate(all="ignore"):
        scale = (d * sign).sum(1) / pdf[[f"v_{c}" for c in FROM]].sum(axis=1).to_numpy(float)
    t = mt - scale[:, None] * np.einsum("gij,gj->gi", rot, mf)
    bad = (rank < 2) | ~np.isfinite(scale)
    out = pdf[list(keys)].copy()
    out["scale"] = np.where(bad, np.nan, scale)
    out["rotation"] = [None if b else r.ravel().tolist() for b, r in zip(bad, rot)]
    out["t"] = [None if b else dict(zip(L.AXES, map(float, v))) for b, v in zip(bad, t)]
    out["reason"] = np.where(bad, "points are collinear", None)
    out["n"] = pdf["n"]
    out["scale"] = out["scale"].astype(object).where(~bad, None)
    return pd.DataFrame(out)


def solve_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    ddl = "".join(f"{k} {moments.schema[k].dataType.simpleString()}, " for k in keys) + FIT_DDL

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield _solve(pdf, keys)

    return moments.mapInPandas(run, ddl)


def similarity_fit(prs: DataFrame, keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """Least-squares ``to = scale * rotation * from + t`` per group; collinear groups get a
    ``reason`` and NULL parameters."""
    return solve_moments(pair_moments(prs, keys), keys)


def planar_fit(prs: DataFrame, keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """Rotation about the vertical axis from the x and z coordinates alone, in closed form, with
    its planar scale and offset: ``yaw_rotation, yaw_scale, yaw_t``; NULL for a single point."""
    return planar_solution(pair_moments(prs, keys), keys)


def planar_solution(m: DataFrame, keys: Sequence[str]) -> DataFrame:
    dots = F.col("c_txfx") + F.col("c_tzfz")
    crosses = F.col("c_tzfx") - F.col("c_txfz")
    size = F.sqrt(dots * dots + crosses * crosses)
    scaled = m.withColumn("_size", size).withColumns({
        "yaw_scale": F.try_divide("_size", F.col("v_fx") + F.col("v_fz")),
        "_cos": F.try_divide(dots, "_size"), "_sin": F.try_divide(crosses, "_size")})
    rx = F.col("_cos") * F.col("m_fx") - F.col("_sin") * F.col("m_fz")
    rz = F.col("_sin") * F.col("m_fx") + F.col("_cos") * F.col("m_fz")
    k = F.col("yaw_scale")
    return scaled.select(
        *keys, "n", L.embed_rotation(F.array("_cos", -F.col("_sin"), "_sin", "_cos"), "y")
        .alias("yaw_rotation"), "yaw_scale",
        L.vec(F.col("m_tx") - k * rx, F.col("m_ty") - k * F.col("m_fy"),
              F.col("m_tz") - k * rz).alias("yaw_t"))


def full_and_yaw_fit(prs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """3-D scale and offset together with the yaw-only rotation, from one set of moments."""
    moments = pair_moments(prs, keys)
    return solve_moments(moments, keys).join(planar_solution(moments, keys).drop("n"), list(keys))


def squared_error(scale="scale", rotation="rotation", t="t") -> Column:
    moved = L.similarity(L.vec(*FROM), scale, rotation, t)
    d = L.sub(moved, L.vec(*TO))
    return L.dot(d, d)


def alignment_residual(prs: DataFrame, fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``sqrt(sum of squared distances) / count`` after the fit."""
    rows = attach(prs, fits, keys).withColumn("_e", squared_error())
    return rows.groupBy(*keys).agg((F.sqrt(F.sum("_e")) / F.count(F.lit(1))).alias("residual"))


def scale_agreement(a, b) -> Column:
    """Smaller over larger magnitude of two scales; above 0.95 they agree."""
    a, b = F.abs(L._c(a)), F.abs(L._c(b))
    return F.try_divide(F.least(a, b), F.greatest(a, b))


# ------------------------------------------------------------------ random-subset fit

def _multipliers(count: int) -> list[int]:
    """``count`` odd multipliers for index permutations: consecutive primes above a million."""
    out, v = [], 1_000_003
    while len(out) < count:
        if all(v % p for p in range(3, int(v ** 0.5) + 1, 2)):
            out.append(v)
        v += 2
    return out


def ransac_fit(prs: DataFrame, order: str, keys: Sequence[str], sample_ratio: float,
               inlier_ratio: float, n_iter: int, group: str | None = None,
               seed: int = 0) -> DataFrame:
    """Best of ``n_iter`` fits on random subsets, scored by the sum of its smallest squared errors.

    Each trial permutes the dense index ``i`` to ``(a * i + b) mod n`` with ``a`` prime to ``n``
    and takes the first ``ceil(n * sample_ratio)``, so membership is decided row by row. With
    ``group`` the same index is taken in every group and errors are added over groups.
    """
    keys = list(keys)
    lane = [*keys, group] if group else keys
    rows = checkpointed(ordered(prs, line(lane, order), position="_i", size="_n"))
    primes = _multipliers(2 * n_iter)
    trials = []
    for k in range(n_iter):
        # of two different primes above a million, n smaller than their product keeps one coprime
        a = F.when(F.col("_n") % primes[2 * k] != 0, F.lit(primes[2 * k])) \
            .otherwise(F.lit(primes[2 * k + 1]))
        b = F.pmod(F.xxhash64(F.lit(seed), F.lit(k)), F.col("_n"))
        at = F.pmod(F.pmod(a, F.col("_n")) * F.col("_i") + b, F.col("_n"))
        trials.append(F.when(at < F.ceil(F.col("_n") * sample_ratio), F.lit(k)))
    picked = rows.withColumn("trial", F.explode(F.array_compact(F.array(*trials))))
    fits = similarity_fit(picked, [*keys, "trial"]).filter("reason IS NULL")
    per_key = fits.groupBy(*keys).agg(
        F.collect_list(F.struct("trial", "scale", "rotation", "t")).alias("_fits"),
        F.sum("n").alias("_size"))
    scored = attach(rows, per_key, keys).withColumn("_f", F.explode("_fits")) \
        .withColumn("_e", squared_error("_f.scale", "_f.rotation", "_f.t")) \
        .withColumn("trial", F.col("_f.trial"))
    if group:
        scored = scored.groupBy(*keys, "trial", "_i").agg(F.sum("_e").alias("_e"),
                                                          F.max("_n").alias("_n"))
    scored = scored.withColumn("_k", F.ceil(F.col("_n") * inlier_ratio))
    score = smallest_sum(scored, [*keys, "trial"], "_e", "_k", "score")
    best = score.groupBy(*keys).agg(F.min(F.struct("score", "trial")).alias("_b"))
    return best.select(*keys, F.col("_b.trial").alias("trial"), F.col("_b.score").alias("score")) \
        .join(fits, [*keys, "trial"])
