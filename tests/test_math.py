"""Identities of the column functions and fits."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from posegrid.functions import geo as G
from posegrid.functions import linalg as L
from posegrid.functions import names as N
from posegrid.operators import fit


def rot(axis, deg):
    axis = np.array(axis, float) / np.linalg.norm(axis)
    k = np.array([[0, -axis[2], axis[1]], [axis[2], 0, -axis[0]], [-axis[1], axis[0], 0]])
    a = math.radians(deg)
    return np.eye(3) + math.sin(a) * k + (1 - math.cos(a)) * k @ k


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-1, 1), st.floats(-1, 1), st.floats(0.1, 1),
                          st.floats(1, 179), st.floats(0.2, 9)), min_size=1, max_size=20))
def test_compose_and_decompose_are_inverse(spark, cases):
    rows = []
    for i, (x, y, z, a, s) in enumerate(cases):
        n = math.sqrt(x * x + y * y + z * z)
        rows.append((i, x / n, y / n, z / n, a, s))
    df = spark.createDataFrame(rows, "i int, x double, y double, z double, a double, s double")
    df = df.withColumn("m", L.compose("s", "a", L.vec("x", "y", "z"), L.vec(1, 2, 3)))
    for r in L.with_decomposition(df, "m", "d").collect():
        m = np.array(r.m).reshape(4, 4)
        assert np.allclose(m[:3, :3], r.s * rot((r.x, r.y, r.z), r.a), atol=1e-9)
        assert r.d.scale == pytest.approx(r.s) and r.d.angle_deg == pytest.approx(r.a, abs=1e-5)
        assert np.allclose([r.d.axis.x, r.d.axis.y, r.d.axis.z], [r.x, r.y, r.z], atol=1e-6)


def test_identity_has_no_axis(spark):
    df = spark.range(1).withColumn("m", L.to_mat4(2.0, L.identity3(), L.vec(0, 0, 0)))
    d = L.with_decomposition(df, "m", "d").first().d
    assert d.scale == pytest.approx(2) and d.angle_deg == 0 and d.axis is None


@pytest.mark.parametrize("axis,deg", [((0, 0, 1), 180), ((1, 1, 0), 180), ((0, 1, 0), 179.9999),
                                      ((1, 0, 0), 1e-5)])
def test_rotation_vector_at_the_edges(spark, axis, deg):
    r = rot(axis, deg)
    df = spark.createDataFrame([(r.ravel().tolist(),)], "r array<double>")
    v = L.with_rotation_vector(df, "r", "v").first().v
    back = np.array([v.x, v.y, v.z])
    angle = np.linalg.norm(back)
    assert angle == pytest.approx(math.radians(deg), abs=1e-6)
    assert np.allclose(rot(back, math.degrees(angle)), r, atol=1e-6)


def test_inverse_and_rebase(spark):
    df = spark.range(1).withColumn("m", L.compose(2.5, 40.0, L.vec(0, 0.6, 0.8), L.vec(3, -2, 5)))
    df = df.withColumn("i", L.mat4_inverse("m")).withColumn("p", L.matmul("m", "i", 4))
    assert np.allclose(np.array(df.first().p).reshape(4, 4), np.eye(4), atol=1e-12)


def test_slerp_stays_a_rotation_and_hits_its_ends(spark):
    a, b = rot((0, 1, 0), 10), rot((1, 2, 0), 120)
    df = spark.createDataFrame([(a.ravel().tolist(), b.ravel().tolist(), f / 10) for f in range(11)],
                               "a array<double>, b array<double>, f double")
    df = df.withColumns({"p": L.quaternion("a"), "q": L.quaternion("b")}) \
        .withColumn("s", L.slerp("p", "q", "f")).withColumn("r", L.quaternion_matrix("s"))
    for r in df.collect():
        m = np.array(r.r).reshape(3, 3)
        assert np.allclose(m @ m.T, np.eye(3), atol=1e-12)
        if r.f in (0, 1):
            assert np.allclose(m, a if r.f == 0 else b, atol=1e-9)


def test_viewer_angles_rebuild_the_rotation(spark):
    mirror = np.diag([1, -1, 1])
    rots = [rot((1, 2, 3), d) for d in range(-170, 171, 17)]
    df = spark.createDataFrame([(r.ravel().tolist(),) for r in rots], "r array<double>")
    for r in df.withColumn("a", G.viewer_angles("r")).collect():
        want = (mirror @ np.array(r.r).reshape(3, 3) @ mirror).T
        got = rot((0, 0, 1), math.degrees(r.a.gamma)) @ rot((1, 0, 0), math.degrees(r.a.alpha)) \
            @ rot((0, 1, 0), math.degrees(r.a.beta))
        assert np.allclose(got, want, atol=1e-9)


def test_utm_known_point_and_round_trip(spark):
    rows = [(120.8156, 23.5, 1.0), (-70.5, -33.4, 2.0), (5.0, 60.0, 0.0), (179.9, 10.0, 0.0)]
    df = spark.createDataFrame(rows, "lon double, lat double, alt double")
    df = df.withColumn("u", G.to_utm("lon", "lat", "alt")).withColumn(
        "g", G.from_utm("u.x", "u.y", "u.z", "u.zone", "u.south"))
    out = df.collect()
    assert [r.u.zone for r in out] == [51, 19, 32, 60]
    for r in out:
        assert r.g.lon == pytest.approx(r.lon, abs=2e-7) and r.g.lat == pytest.approx(r.lat, abs=2e-7)
    # on the central meridian the easting is the false easting
    mid = spark.range(1).select(G.to_utm(F.lit(123.0), F.lit(0.0), F.lit(0.0)).alias("u")).first().u
    assert mid.x == pytest.approx(500000) and mid.y == pytest.approx(0)


def test_rainbow_ends(spark):
    df = spark.range(5).withColumn("n", F.lit(5)).withColumn("c", N.rainbow("id", "n"))
    got = [tuple(r.c) for r in df.orderBy("id").collect()]
    assert got[0] == (255, 0, 0) and got[-1][2] == 255 and got[2][1] == 255


@settings(max_examples=4, deadline=None)
@given(st.floats(0.1, 20), st.floats(-179, 179), st.tuples(st.floats(-1, 1), st.floats(-1, 1),
                                                           st.floats(0.2, 1)))
def test_similarity_is_recovered_at_utm_magnitude(spark, scale, deg, axis):
    rng = np.random.default_rng(3)
    p = rng.normal(size=(60, 3)) * 10
    r, t = rot(axis, deg), np.array([276778.0, -15.0, 2602132.0])
    q = scale * p @ r.T + t
    df = spark.createDataFrame([("a", *map(float, u), *map(float, v)) for u, v in zip(p, q)],
                               "route_id string, fx double, fy double, fz double, tx double, "
                               "ty double, tz double")
    f = fit.similarity_fit(df).first()
    assert f.reason is None and f.scale == pytest.approx(scale, rel=1e-7)
    assert np.allclose(np.array(f.rotation).reshape(3, 3), r, atol=1e-7)
    assert np.allclose([f.t.x, f.t.y, f.t.z], t, atol=1e-4)


def test_collinear_points_are_reported(spark):
    df = spark.createDataFrame([("a", float(i), 0.0, 0.0, 2.0 * i, 0.0, 0.0) for i in range(9)],
                               "route_id string, fx double, fy double, fz double, tx double, "
                               "ty double, tz double")
    f = fit.similarity_fit(df).first()
    assert f.reason is not None and f.scale is None


def test_random_subset_fit_ignores_outliers(spark):
    rng = np.random.default_rng(5)
    p = rng.normal(size=(80, 3))
    r = rot((1, 0, 1), 50)
    q = 1.7 * p @ r.T + [1, 2, 3]
    q[::9] += 25
    df = spark.createDataFrame([("a", i, *map(float, u), *map(float, v))
                                for i, (u, v) in enumerate(zip(p, q))],
                               "route_id string, i long, fx double, fy double, fz double, "
                               "tx double, ty double, tz double")
    best = fit.ransac_fit(df, "i", ["route_id"], 0.05, 0.8, 25).first()
    assert best.scale == pytest.approx(1.7, rel=1e-6) and best.score < 1e-9
