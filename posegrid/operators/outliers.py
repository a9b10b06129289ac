"""Pose and point outlier filters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.scale import attach, line, order_stats, ordered, stored

END_WEIGHT = 1e6
SEARCH_EPS = 1e-4
STOP_CHANGE = 1e-4
#: points tried within an interval in each round of a search
PROBES = 7
#: histogram cells per factor of two of squared distances
DISTANCE_CELLS = 256
#: chi-square with three degrees of freedom: median and upper 2.5 % point (fixed values)
CHI2_3_MEDIAN = 2.3659738843753377
CHI2_3_UPPER = 9.348403604496148


def center_outliers(poses: DataFrame, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Drop poses farther from the mean centre than mean + one standard deviation of that
    distance. ``poses`` has ``x, y, z``."""
    mean = poses.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    *[F.avg(a).alias(f"_m{a}") for a in L.AXES])
    far = attach(poses, mean, keys).withColumn(
        "_d", L.dist(L.vec(*L.AXES), L.vec("_mx", "_my", "_mz"))).select(*poses.columns, "_d")
    lim = far.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 (F.avg("_d") + F.stddev_pop("_d")).alias("_thr"))
    return attach(far, lim, keys).filter(F.col("_d") <= F.col("_thr")).select(*poses.columns)


def rotation_outliers(poses: DataFrame, thr_rad: float = 1.0, keys: Sequence[str] = ("scene_id",),
                      rotation: str = "rotation") -> DataFrame:
    """Keep poses whose down direction lies within ``thr_rad`` of the group's mean direction."""
    down = poses.withColumn("_down", L.down_direction(rotation))
    mean = down.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        L.vec(*[F.avg(F.col("_down")[a]) for a in L.AXES]).alias("_mean"))
    return attach(down, mean, keys).filter(F.acos(L.dot("_down", "_mean")) < thr_rad) \
        .select(*poses.columns)


def curve_parameter(points: DataFrame, order: str = "idx", mode: str = "centripetal",
                    keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """Curve parameter ``u`` in [0, 1] with dense position ``pos`` and size ``n``.

    ``uniform``, ``chordlength`` or ``centripetal`` spacing; a route of equal points gets 0.
    """
    power = {"uniform": None, "chordlength": 1.0, "centripetal": 0.5}
    if mode not in power:
        raise ValueError(f"unknown mode {mode!r}")
    ln = line(keys, order)
    if power[mode] is None:
        out = ordered(points, ln, position="pos", size="n")
        return out.withColumn("u", F.when(F.col("n") > 1, F.col("pos") / (F.col("n") - 1))
                              .otherwise(F.lit(0.0)))
    back = ordered(points, ln, position="pos", size="n", prev={f"_p{a}": a for a in L.AXES})
    seg = F.coalesce(F.pow(L.dist(L.vec(*L.AXES), L.vec("_px", "_py", "_pz")),
                           F.lit(power[mode])), F.lit(0.0))
    run = ordered(back.withColumn("_seg", seg), ln, running={"_run": "_seg"},
                  total={"_all": "_seg"})
    return run.withColumn("u", F.when(F.col("_all") > 0, F.col("_run") / F.col("_all"))
                          .otherwise(F.lit(0.0))).select(*points.columns, "pos", "n", "u")


# ------------------------------------------------------------------ parametric curve filter

def _basis(u: Column, degree: int) -> list[Column]:
    """Legendre polynomials of ``2u - 1``; they keep the normal equations well conditioned."""
    t = 2.0 * u - 1.0
    out = [F.lit(1.0), t]
    for k in range(1, degree):
        out.append(((2 * k + 1) * t * out[k] - k * out[k - 1]) / (k + 1))
    return out[:degree + 1]


def _fit_curve(rows: DataFrame, degree: int, keys: Sequence[str]) -> DataFrame:
    """Coefficients ``cx, cy, cz`` of every route from moment sums; the end points enter with a
    weight of a million."""
    m = degree + 1
    cols = [f"_b{k}" for k in range(m)]
    inner = (F.col("pos") > 0) & (F.col("pos") < F.col("n") - 1)
    based = rows.withColumns(dict(zip(cols, _basis(F.col("u"), degree))))
    aggs = [F.max("n").alias("n")]
    for i in range(m):
        for j in range(i, m):
            aggs.append(F.sum(F.when(inner, F.col(cols[i]) * F.col(cols[j]))).alias(f"g{i}_{j}"))
        for a in L.AXES:
            aggs.append(F.sum(F.when(inner, F.col(cols[i]) * F.col(a))).alias(f"r{a}{i}"))
    for a in L.AXES:
        aggs.append(F.max(F.when(F.col("pos") == 0, F.col(a))).alias(f"first_{a}"))
        aggs.append(F.max(F.when(F.col("pos") == F.col("n") - 1, F.col(a))).alias(f"last_{a}"))
    for end, at in (("first", F.col("pos") == 0), ("last", F.col("pos") == F.col("n") - 1)):
        aggs.append(F.max(F.when(at, F.col("u"))).alias(f"{end}_u"))
    moments = based.groupBy(*keys).agg(*aggs)
    keys = list(keys)
    ddl = "".join(f"{k} {moments.schema[k].dataType.simpleString()}, " for k in keys) + \
        "n bigint, cx array<double>, cy array<double>, cz array<double>"

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            g = len(pdf)
            gram = np.zeros((g, m + 2, m + 2))
            rhs = np.zeros((g, m + 2, 3))
            for i in range(m):
                for j in range(i, m):
                    v = pdf[f"g{i}_{j}"].fillna(0.0).to_numpy(float)
                    gram[:, i, j] = gram[:, j, i] = v
                for c, a in enumerate(L.AXES):
                    rhs[:, i, c] = pdf[f"r{a}{i}"].fillna(0.0).to_numpy(float)
            for e, end in enumerate(("first", "last")):
                t = 2.0 * pdf[f"{end}_u"].to_numpy(float) - 1.0
                gram[:, m + e, :m] = np.polynomial.legendre.legvander(t, degree)
                gram[:, :m, m + e] = gram[:, m + e, :m]
                gram[:, m + e, m + e] = -1.0 / END_WEIGHT ** 2
                for c, a in enumerate(L.AXES):
                    rhs[:, m + e, c] = pdf[f"{end}_{a}"].to_numpy(float)
            sol = np.stack([np.linalg.lstsq(gram[i], rhs[i], rcond=1e-13)[0][:m]
                            for i in range(g)])
            out = pdf[keys].copy()
            out["n"] = pdf["n"]
            for c, a in enumerate(L.AXES):
                out[f"c{a}"] = [s.tolist() for s in sol[:, :, c]]
            yield pd.DataFrame(out)

    return moments.mapInPandas(run, ddl)


def _curve_error(degree: int) -> Column:
    b = _basis(F.col("u"), degree)
    at = [sum((F.col(f"c{a}")[k] * b[k] for k in range(1, degree + 1)), F.col(f"c{a}")[0] * b[0])
          for a in L.AXES]
    return F.sqrt(sum((F.pow(F.col(a) - p, 2) for a, p in zip(L.AXES[1:], at[1:])),
                      F.pow(F.col("x") - at[0], 2)))


def _closest_parameter():
    """Curve point nearest to each row, between the parameters of its neighbours: in each round the interval
    shrinks to the neighbours of its best probe."""
    @F.pandas_udf("double")
    def search(u: pd.Series, lo: pd.Series, hi: pd.Series, x: pd.Series, y: pd.Series,
               z: pd.Series, cx: pd.Series, cy: pd.Series, cz: pd.Series) -> pd.Series:
        out = u.to_numpy(float).copy()
        a, b = lo.to_numpy(float).copy(), hi.to_numpy(float).copy()
        todo = np.flatnonzero(np.isfinite(a) & np.isfinite(b) & (np.abs(b - a) > 0))
        if not len(todo):
            return pd.Series(out)
        a, b = a[todo], b[todo]
        p = np.stack([s.to_numpy(float)[todo] for s in (x, y, z)])
        coef = [np.stack(s.to_numpy()[todo]).astype(float).T for s in (cx, cy, cz)]

        def gap(v):
            basis = np.polynomial.legendre.legvander(2.0 * v - 1.0, coef[0].shape[0] - 1).T
            return sum(((c * basis).sum(0) - q) ** 2 for c, q in zip(coef, p))

        share = np.arange(PROBES + 2) / (PROBES + 1)
        while np.abs(b - a).max() > SEARCH_EPS:
            tries = [a + (b - a) * f for f in share]
            best = np.argmin([gap(v) for v in tries[1:-1]], axis=0) + 1
            a, b = np.choose(best - 1, tries[:-2]), np.choose(best - 1, tries[2:])
        out[todo] = (a + b) / 2
        return pd.Series(out)

    return search


def curve_filter(points: DataFrame, degree: int = 5, max_iter: int = 10,
                 mode: str = "centripetal", num_sigma: float = 3.0, order: str = "idx",
                 keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """Keep points whose distance to a fitted parametric curve is below mean + ``num_sigma`` std.

    Each round fits the curve by moment sums, then moves every inner parameter to the nearest
    curve point between its old neighbours. Routes stop when the weighted error changes by less
    than 1e-4; the loop stops when all have. ``points`` has ``x, y, z``.
    """
    ks = list(keys)
    search = _closest_parameter()
    rows = stored(curve_parameter(points.select(*ks, order, *L.AXES), order, mode, keys))
    ln = line(keys, order)
    weight = F.when((F.col("pos") == 0) | (F.col("pos") == F.col("n") - 1), END_WEIGHT) \
        .otherwise(1.0)
    running, ended = None, []

    def errors(of: DataFrame) -> DataFrame:
        return attach(rows, of.withColumnRenamed("n", "_rows"), ks) \
            .withColumn("_e", _curve_error(degree)).select(*ks, order, "_e")

    for _ in range(max_iter):
        if running is not None:
            near = ordered(rows, ln, prev={"_lo": "u"}, following={"_hi": "u"})
            near = attach(near, running.select(*ks, "cx", "cy", "cz"), ks)
            moved = search("u", "_lo", "_hi", *L.AXES, "cx", "cy", "cz")
            rows = stored(near.withColumn("u", moved).select(*rows.columns))
        fits = stored(_fit_curve(rows, degree, keys))
        score = attach(rows, fits.withColumnRenamed("n", "_rows"), ks).groupBy(*ks) \
            .agg(F.sum(weight * _curve_error(degree)).alias("score"))
        now = fits.join(score, ks)
        if running is None:
            now = now.withColumn("done", F.lit(False))
        else:
            calm = (F.col("score") <= 0) | (F.try_divide("_old", "score") - 1 < STOP_CHANGE)
            now = now.join(running.select(*ks, F.col("score").alias("_old")), ks) \
                .withColumn("done", F.coalesce(calm, F.lit(True))).drop("_old")
        status = stored(now)
        # routes that have stopped leave the loop with their last curve
        ended.append(errors(status.filter("done")))
        running = status.filter("NOT done")
        if running.isEmpty():
            break
    else:
        ended.append(errors(running))
    err = ended[0]
    for e in ended[1:]:
        err = err.unionByName(e)
    err = stored(err)
    lim = err.groupBy(*ks).agg(F.count(F.lit(1)).alias("n"),
                               (F.avg("_e") + num_sigma * F.stddev_pop("_e")).alias("_thr"))
    kept = attach(err, lim, ks).filter(F.col("_e") < F.col("_thr")).select(*ks, order)
    return points.join(kept, [*ks, order], "left_semi")


def filter_poses(poses: DataFrame, degree: int = 5, max_iter: int = 10,
                 keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Centre, rotation and curve filters in turn, then new dense keys."""
    flat = poses.withColumns({a: F.col("center")[a] for a in L.AXES})
    clean = rotation_outliers(center_outliers(flat, keys), keys=keys)
    smooth = curve_filter(clean, degree, max_iter, order="pose_key", keys=keys)
    return ordered(smooth, line(keys, "pose_key"), position="new_key").drop("x", "y", "z")


# ------------------------------------------------------------------ robust covariance

def _distance2() -> Column:
    """Squared Mahalanobis distance from ``mx..`` and the covariance cells ``vxx..``."""
    v = lambda a, b: F.col(f"v{min(a, b)}{max(a, b)}")
    d = {a: F.col(a) - F.col(f"m{a}") for a in L.AXES}
    xx, yy, zz, xy, xz, yz = (v("x", "x"), v("y", "y"), v("z", "z"), v("x", "y"), v("x", "z"),
                              v("y", "z"))
    det = xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz) + xz * (xy * yz - yy * xz)
    num = (d["x"] * d["x"] * (yy * zz - yz * yz) + d["y"] * d["y"] * (xx * zz - xz * xz)
           + d["z"] * d["z"] * (xx * yy - xy * xy)
           + 2 * d["x"] * d["y"] * (xz * yz - xy * zz) + 2 * d["x"] * d["z"] * (xy * yz - xz * yy)
           + 2 * d["y"] * d["z"] * (xy * xz - xx * yz))
    return F.coalesce(F.try_divide(num, det), F.lit(0.0))


def _covariance(df: DataFrame, keys: Sequence[str], keep: Column) -> DataFrame:
    k = lambda c: F.when(keep, F.col(c))
    cells = [("x", "x"), ("y", "y"), ("z", "z"), ("x", "y"), ("x", "z"), ("y", "z")]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(k(a)).alias(f"m{a}") for a in L.AXES],
        *[F.covar_pop(k(a), k(b)).alias(f"v{a}{b}") for a, b in cells])


def robust_covariance_filter(points: DataFrame, contamination: float,
                             keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Drop the ``contamination`` share of points with the largest robust Mahalanobis distance.

    Minimum covariance determinant by concentration steps from the coordinate-wise median, then
    one reweighting. Each step is one exact rank selection and one covariance aggregate; steps go on
    until the half that is kept is the same again in every group (they never raise the determinant,
    and there are finitely many halves).
    """
    ks = list(keys)
    points = stored(points)
    # one row per group and rank: the places of the ranks are tables, read by the next pass over the points
    ranks = lambda df, value, wanted, mode="linear": order_stats(
        df, ks, value, wanted, mode, DISTANCE_CELLS, stored)
    start = None
    for a in L.AXES:
        med = ranks(points, a, {f"m{a}": 0.5})
        start = med if start is None else start.join(med.drop("n"), ks)
    start = stored(start)
    mad = attach(points, start, ks)
    spread = mad.groupBy(*ks).agg(*[F.avg(F.pow(F.col(a) - F.col(f"m{a}"), 2)).alias(f"v{a}{a}")
                                    for a in L.AXES])
    zero = {f"v{p}": F.lit(0.0) for p in ("xy", "xz", "yz")}
    params = stored(start.join(spread, ks).withColumns(zero))

    def scored(p: DataFrame) -> DataFrame:
        return attach(points, p, ks).withColumn("_d2", _distance2()) \
            .select(*points.columns, "_d2")

    half = lambda n: F.floor((n + 4) / 2) - 1
    moments = [f"m{a}" for a in L.AXES] + [f"v{p}" for p in ("xx", "yy", "zz", "xy", "xz", "yz")]
    while True:
        s = scored(params)
        cut = stored(ranks(s, "_d2", {"_cut": half}, "nearest"))
        now = stored(_covariance(attach(s, cut, ks).drop("n"), ks, F.col("_d2") <= F.col("_cut")))
        # sums in another order differ in the last digits, another half differs by more
        both = now.alias("now").join(params.alias("old"), ks)
        moved = F.greatest(*[F.abs(F.col(f"now.{c}") - F.col(f"old.{c}"))
                             - 1e-9 * F.greatest(F.abs(F.col(f"now.{c}")), F.lit(1.0)) for c in moments])
        settled = both.where(F.nanvl(moved, F.lit(0.0)) > 0).isEmpty()
        params = now
        if settled:
            break
    s = scored(params)
    med = stored(ranks(s, "_d2", {"_med": 0.5}))
    inlier = F.col("_d2") / (F.col("_med") / CHI2_3_MEDIAN) < CHI2_3_UPPER
    params = stored(_covariance(attach(s, med, ks).drop("n"), ks, inlier))
    s = scored(params)
    lim = stored(ranks(s, "_d2", {"_lim": 1.0 - contamination}))
    return attach(s, lim, ks).filter(F.col("_d2") <= F.col("_lim")).select(*points.columns)
