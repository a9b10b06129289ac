"""Jobs checked against brute force on small fixtures."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.operators import anchor, fit, mesh, outliers, poses, resample, routegraph
from posegrid.plans import georeference, registry


def test_curve_filter_matches_direct_polynomial_fit(spark):
    rng = np.random.default_rng(1)
    s = np.linspace(0, 6, 120)
    p = np.stack([s, np.sin(s), 0.2 * s ** 2], 1) + rng.normal(size=(120, 3)) * 0.01
    p[40] += [0, 3, 0]
    p[77] += [0, 0, -4]
    df = spark.createDataFrame([("a", i, *map(float, v)) for i, v in enumerate(p)],
                               "route_id string, idx long, x double, y double, z double")
    kept = {r.idx for r in outliers.curve_filter(df, 5, 1).collect()}
    u = np.concatenate([[0], np.cumsum(np.linalg.norm(np.diff(p, axis=0), axis=1) ** 0.5)])
    u /= u[-1]
    w = np.ones(len(u))
    w[[0, -1]] = 1e6
    f = np.stack([np.polynomial.polynomial.polyval(u, np.polynomial.polynomial.polyfit(
        u, p[:, c], 5, w=w)) for c in range(3)], 1)
    e = np.linalg.norm(p - f, axis=1)
    assert kept == set(np.flatnonzero(e < e.mean() + 3 * e.std()))
    later = {r.idx for r in outliers.curve_filter(df, 5, 3).collect()}
    assert not {40, 77} & later


def test_robust_covariance_drops_the_requested_share(spark):
    rng = np.random.default_rng(2)
    p = rng.normal(size=(400, 3)) * [1, 2, 0.5]
    p[:12] += 40
    df = spark.createDataFrame([("a", i, *map(float, v)) for i, v in enumerate(p)],
                               "scene_id string, idx long, x double, y double, z double")
    kept = {r.idx for r in outliers.robust_covariance_filter(df, 0.05).collect()}
    assert len(kept) == 380 and not kept & set(range(12))


def _rig_reference(frames, n_cams):
    """Sequential repair of a list of frames (lists of centres or None), on one core."""
    good_c, cand, flag, idx = [], [], [], []
    flat = []
    for k, fr in enumerate(frames):
        pts = [p for p in fr if p is not None]
        if len(pts) <= n_cams // 2:
            continue
        pts = np.array(pts, float)
        flat += list(pts)
        best = None
        for bits in range(1, 2 ** (len(pts) - 1)):
            side = np.array([(bits >> j) & 1 for j in range(len(pts))], bool)
            a, b = pts[~side], pts[side]
            cost = ((a - a.mean(0)) ** 2).sum() + ((b - b.mean(0)) ** 2).sum()
            if best is None or cost < best[0] - 1e-12:
                best = (cost, a.mean(0), b.mean(0))
        idx.append(k)
        good_c.append(pts.mean(0))
        cand.append((best[1], best[2]))
    flat = np.array(flat)
    d = np.sort(np.linalg.norm(np.diff(flat, axis=0), axis=1))
    spacing = d[int(np.rint(0.3 * (len(d) - 1)))]
    flag = [np.linalg.norm(a - b) < 3 * spacing for a, b in cand]
    runs = [(k, list(g)) for k, g in itertools.groupby(range(len(flag)), lambda i: flag[i])]
    best = max((g for k, g in runs if k), key=len, default=None)
    out = [c if f else None for c, f in zip(good_c, flag)]
    if best is None:
        return dict(zip(idx, good_c)), flag, spacing

    def pick(i, one, two):
        anchor_at = one if two is None else 2.5 * one - 1.5 * two
        a, b = cand[i]
        return a if np.linalg.norm(a - anchor_at) <= np.linalg.norm(b - anchor_at) else b

    for i in range(best[0] - 1, -1, -1):
        if not flag[i]:
            out[i] = pick(i, out[i + 1], out[i + 2] if i + 2 < len(out) else None)
    for i in range(best[-1] + 1, len(out)):
        if not flag[i]:
            out[i] = pick(i, out[i - 1], out[i - 2] if i >= 2 else None)
    return dict(zip(idx, out)), flag, spacing


@pytest.mark.parametrize("seed", [0, 3])
def test_rig_center_matches_sequential_repair(spark, seed):
    rng = np.random.default_rng(seed)
    frames, rows = [], []
    for k in range(30):
        base = np.array([k * 0.5, 0, 0])
        fr = [base + rng.normal(size=3) * 0.2 for _ in range(6)]
        if rng.random() < 0.4:
            for j in rng.choice(6, 3, replace=False):
                fr[j] = fr[j] + rng.normal(size=3) * 6
        fr = [None if rng.random() < 0.05 else p for p in fr]
        frames.append(fr)
        rows += [("s", k * 6 + j, None if p is None else tuple(map(float, p)))
                 for j, p in enumerate(fr)]
    df = spark.createDataFrame(rows, "scene_id string, pos long, c struct<x:double,y:double,z:double>") \
        .withColumnRenamed("c", "center")
    got = {r.pos: r.center for r in poses.rig_center(df, 6).collect()}
    target, flag, spacing = _rig_reference(frames, 6)
    flags = dict(zip(target, flag))
    assert len(got) == len(rows)
    for k, fr in enumerate(frames):
        for j, p in enumerate(fr):
            want = p
            if p is not None and k in target and not flags[k] and \
                    np.linalg.norm(p - target[k]) > 3 * spacing:
                want = target[k]
            have = got[k * 6 + j]
            assert (have is None) == (want is None)
            if want is not None:
                assert np.allclose([have.x, have.y, have.z], want, atol=1e-9)


def test_route_tree_matches_plain_search(spark):
    rng = np.random.default_rng(4)
    visits = {r: sorted({int(v) for v in rng.integers(0, 40, 3)}) for r in range(30)}
    rows = [(f"r{r:02d}", str(n), int(n) % 4, r) for r, ns in visits.items() for n in ns]
    c = spark.createDataFrame(rows, "route_id string, node_id string, slice int, route_rank long")
    roots = spark.createDataFrame([("r00", "r00")], "root string, route_id string")
    got = {r.route_id: r for r in routegraph.route_tree(c, roots).collect()}
    order, parent = [0], {0: None}
    for r in order:
        for o in range(30):
            if o not in parent and set(visits[o]) & set(visits[r]):
                parent[o] = r
                order.append(o)
    assert set(got) == {f"r{r:02d}" for r in parent}
    for r, p in parent.items():
        row = got[f"r{r:02d}"]
        assert row.parent_id == (None if p is None else f"r{p:02d}")
        if p is not None:
            assert row.node_id == min(str(n) for n in set(visits[r]) & set(visits[p]))
    yaml = pytest.importorskip("yaml")
    lines = routegraph.tree_lines(routegraph.route_tree(c, roots)).orderBy("ord").collect()
    doc = yaml.safe_load("\n".join(x.value for x in lines))

    def flatten(node, above=None):
        for name, body in node.items():
            yield name, above
            for child in body["child_node"] or []:
                yield from flatten(child, name)

    assert dict(flatten(doc)) == {k: v.parent_id for k, v in got.items()}


def test_components_and_growth_on_a_box(spark):
    """Two separate unit cubes; growing from a top face stays on the top."""
    verts, faces = [], []
    quads = [((0, 1, 3, 2), (0, 0, -1)), ((4, 5, 7, 6), (0, 0, 1)), ((0, 1, 5, 4), (0, -1, 0)),
             ((2, 3, 7, 6), (0, 1, 0)), ((0, 2, 6, 4), (-1, 0, 0)), ((1, 3, 7, 5), (1, 0, 0))]
    for cube in range(2):
        pts = [(x + 5 * cube, y, z) for z in (0, 1) for y in (0, 1) for x in (0, 1)]
        for q, n in quads:
            base = len(verts)
            verts += [("m", base + i, *map(float, pts[v]), *map(float, n)) for i, v in enumerate(q)]
            faces += [(base, base + 1, base + 2), (base, base + 2, base + 3)]
    v = spark.createDataFrame(verts, "mesh_id string, vid long, x double, y double, z double, "
                                     "nx double, ny double, nz double")
    f = spark.createDataFrame([("m", i, *t) for i, t in enumerate(faces)],
                              "mesh_id string, fid long, v1 long, v2 long, v3 long")
    comp = {r.fid: r.component for r in mesh.face_components(f).collect()}
    assert all(comp[i] == i - i % 2 for i in comp)  # vertices are split per side
    seeds = spark.createDataFrame([("m", 0, 6), ("m", 1, 7), ("m", 2, 2)],
                                  "mesh_id string, seed_no int, fid long")
    seg = {r.fid: r.segment for r in mesh.grow_segments(f, v, seeds, 0.9).collect()}
    assert seg == {6: 0, 7: 0, 2: 2, 3: 2}
    floor = f.filter("fid IN (6, 7)")
    up = np.array(mesh.level_rotation(floor, v).first().matrix).reshape(4, 4)
    assert np.allclose(up, np.eye(4), atol=1e-9)


def test_growth_of_many_seeds_against_turns(spark):
    """Seeds on a strip of faces with normals that turn, in each other's way, against turn after turn."""
    rng = np.random.default_rng(21)
    n = 300
    angle = np.cumsum(rng.normal(0, 0.35, n + 2))
    verts = [("m", i, float(i), 0.0, 0.0, float(np.sin(a)), float(np.cos(a)), 0.0) for i, a in enumerate(angle)]
    v = spark.createDataFrame(verts, "mesh_id string, vid long, x double, y double, z double, nx double, ny double, nz double")
    f = spark.createDataFrame([("m", i, i, i + 1, i + 2) for i in range(n)], "mesh_id string, fid long, v1 long, v2 long, v3 long")
    picked = [int(i) for i in rng.permutation(n)[:60]]
    seeds = spark.createDataFrame([("m", k, i) for k, i in enumerate(picked)], "mesh_id string, seed_no int, fid long")
    normal = np.stack([np.sin(angle), np.cos(angle)], 1)
    face = np.stack([normal[i:i + 3].sum(0) / np.linalg.norm(normal[i:i + 3].sum(0)) for i in range(n)])
    want = {}
    for k, s in enumerate(picked):
        if s in want:
            continue
        open_, want[s] = [s], k
        while open_:
            i = open_.pop()
            for j in (i - 1, i + 1):
                if 0 <= j < n and j not in want and (normal[j:j + 3] @ face[s] > 0.6).all():
                    want[j] = k
                    open_.append(j)
    assert len(set(want.values())) > 15
    assert {r.fid: r.segment for r in mesh.grow_segments(f, v, seeds, 0.6).collect()} == want
    assert mesh.grow_segments(f, v, seeds.limit(0), 0.6).count() == 0


def test_a_large_triangle_has_few_cells(spark):
    rows = [("m", i, (0.0, 0.0, 0.0), x, x + s, y, y + s) for i, (x, y, s) in enumerate(
        [(-500.0, -500.0, 1000.0)] + [(k * 0.37, -k * 0.11, 0.001) for k in range(200)] + [(3.0, 4.0, 0.0)])]
    tri = spark.createDataFrame([(m, i, p, p, p, a0, a1, b0, b1) for m, i, p, a0, a1, b0, b1 in rows],
                                "mesh_id string, fid long, " + ", ".join(f"p{k} struct<x:double,y:double,z:double>" for k in range(3))
                                + ", a0 double, a1 double, b0 double, b1 double")
    per_face = mesh.triangle_cells(tri).groupBy("fid").count().collect()
    assert len(per_face) == 202 and max(r["count"] for r in per_face) <= 4


def test_components_of_a_long_chain(spark):
    nodes = spark.range(300).select(F.lit("m").alias("mesh_id"), F.col("id").alias("fid"))
    links = spark.range(1, 300).filter("id % 100 <> 0").select(
        F.lit("m").alias("mesh_id"), F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    got = {r.fid: r.component for r in mesh.components(nodes, links).collect()}
    assert got == {i: i // 100 * 100 for i in range(300)}


def test_ray_hits_match_brute_force(spark):
    rng = np.random.default_rng(7)
    tri = rng.uniform(-3, 3, size=(40, 3, 3))
    v = [("m", 3 * i + j, *map(float, tri[i, j])) for i in range(40) for j in range(3)]
    org = np.concatenate([rng.uniform(-2, 2, (50, 1)), np.full((50, 1), -6.0),
                          rng.uniform(-2, 2, (50, 1))], 1)
    vd = spark.createDataFrame(v, "mesh_id string, vid long, x double, y double, z double")
    fd = spark.createDataFrame([("m", i, 3 * i, 3 * i + 1, 3 * i + 2) for i in range(40)],
                               "mesh_id string, fid long, v1 long, v2 long, v3 long")
    rd = spark.createDataFrame([("m", i, tuple(map(float, o))) for i, o in enumerate(org)],
                               "mesh_id string, ray_id long, origin struct<x:double,y:double,z:double>")
    d = np.array([0.1, 1.0, 0.2])
    dd = spark.createDataFrame([("m", tuple(map(float, d)))],
                               "mesh_id string, direction struct<x:double,y:double,z:double>")
    got = {r.ray_id: r.t for r in mesh.ray_hits(rd, fd, vd, dd).collect()}
    d = d / np.linalg.norm(d)
    want = {}
    for i, o in enumerate(org):
        for t in tri:
            e1, e2 = t[1] - t[0], t[2] - t[0]
            m = np.array([-d, e1, e2]).T
            if abs(np.linalg.det(m)) < 1e-12:
                continue
            k, a, b = np.linalg.solve(m, o - t[0])
            if k >= 0 and a >= 0 and b >= 0 and a + b <= 1:
                want[i] = min(k, want.get(i, np.inf))
    assert set(got) == set(want)
    assert all(got[i] == pytest.approx(want[i]) for i in want)


def _helix(spark, n=80):
    """A helix, its track in geographic coordinates, and the similarity between them."""
    import math
    s = np.linspace(0, 4 * np.pi, n)
    own = np.stack([np.cos(s), -0.05 * s, np.sin(s)], 1)
    a, scale = math.radians(30), 8.0
    r = np.array([[math.cos(a), 0, -math.sin(a)], [0, 1, 0], [math.sin(a), 0, math.cos(a)]])
    world = scale * own @ r.T + [276800.0, -20.0, 2602100.0]
    rows = [("a", i, i * 1000 + 1_700_000_000_000, tuple(map(float, p)), tuple(map(float, w)))
            for i, (p, w) in enumerate(zip(own, world))]
    pt = "struct<x:double,y:double,z:double>"
    df = spark.createDataFrame(rows, f"route_id string, pose_key long, ms long, c {pt}, w {pt}")
    return df, scale


def test_georeference_recovers_a_known_track(spark):
    from posegrid.functions import geo as G
    df, scale = _helix(spark)
    u = G.sfm_to_utm("w")
    x, y, z = L.xyz(u)
    g = G.from_utm(x, y, z, F.lit(51), F.lit(False))
    fixes = df.withColumn("g", g).select("route_id", F.col("pose_key").alias("seq"), "ms", "g.lon", "g.lat",
                                         "g.elev", F.lit(1.6).alias("height"),
                                         (F.col("g.elev") - 1.6).alias("foot_elev"))
    frames = df.select("route_id", "pose_key", "ms", F.col("c").alias("center"),
                       L.identity3().alias("rotation"),
                       L.vec(F.col("c.x"), F.col("c.y") + 1.6 / scale, F.col("c.z")).alias("footprint"))
    out = georeference.georeference_route(frames, fixes, clean=False)
    j = out.join(fixes.select("route_id", F.col("seq").alias("pose_key"), F.col("lon").alias("l"),
                              F.col("lat").alias("p"), F.col("elev").alias("e")), ["route_id", "pose_key"])
    rows = j.collect()
    assert len(rows) == 80
    for r in rows:
        assert r.geo.lon == pytest.approx(r.l, abs=1e-7) and r.geo.lat == pytest.approx(r.p, abs=1e-7)
        assert r.geo.elev == pytest.approx(r.e, abs=1e-3) and r.height == pytest.approx(1.6, abs=1e-3)


def test_short_tracks(spark):
    rows = [("one", 0, 0, 1.0), ("two", 0, 0, 1.0), ("two", 1, 900, 10.0)]
    f = spark.createDataFrame(rows, "route_id string, seq long, ms long, lon double").withColumns({
        "lat": F.lit(1.0), "elev": F.lit(2.0), "height": F.lit(1.0)})
    got = anchor.long_enough(f).orderBy("seq").collect()
    assert len(got) == 10 and {r.route_id for r in got} == {"two"}
    assert [r.lon for r in got] == pytest.approx(list(range(1, 11)))


def test_fill_route_covers_every_frame(spark):
    r = L.rotation_y(F.radians(F.col("frame_idx") * 3.0))
    fr = spark.createDataFrame([("a", i, i * 0.5, float(i)) for i in (2, 3, 4, 7, 8)],
                               "route_id string, frame_idx long, timestamp double, x double")
    fr = fr.withColumns({"y": F.lit(0.0), "z": F.lit(1.0), "rotation": r})
    tot = spark.createDataFrame([("a", 11)], "route_id string, n_total long")
    got = resample.fill_route(fr, tot).orderBy("frame_idx").collect()
    assert [x.frame_idx for x in got] == list(range(11))
    assert [x.x for x in got] == pytest.approx([2, 2, 2, 3, 4, 5, 6, 7, 8, 8, 8])
    for x in got:
        m = np.array(x.rotation).reshape(3, 3)
        assert np.allclose(m @ m.T, np.eye(3), atol=1e-12)


def test_registry_rejects_unknown_names():
    assert registry.lookup("pairing", "window")
    with pytest.raises(ValueError):
        registry.lookup("pairing", "nope")
    with pytest.raises(ValueError):
        registry.lookup("nope", "window")


def test_alignment_recovers_a_known_move(spark):
    from posegrid.plans.alignment import align_sub_to_main
    rng = np.random.default_rng(9)
    rows = [("p", i, f"{i:05d}_1.jpg", tuple(map(float, rng.normal(size=3) * 5))) for i in range(40)]
    pt = "struct<x:double,y:double,z:double>"
    df = spark.createDataFrame(rows, f"scene_id string, view_key long, filename string, center {pt}")
    views = df.select("scene_id", "view_key", "filename")
    sub = df.select("scene_id", F.col("view_key").alias("pose_key"), "center").withColumn(
        "rotation", L.identity3())
    move = spark.range(1).select(F.lit("p").alias("scene_id"), L.compose(
        3.0, 25.0, L.vec(0, 0.6, 0.8), L.vec(4, 5, 6)).alias("matrix"))
    main = poses.transform_poses(sub, move)
    got = align_sub_to_main(views, main, views, sub).first()
    assert got.n == 78 and got.scale == pytest.approx(3.0)
    assert np.allclose(got.matrix, move.first().matrix, atol=1e-8)


def test_cascade_multiplies_along_the_tree(spark):
    parents = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "a")],
                                    "route_id string, parent_id string")
    tree = routegraph.tree_from_parents(parents)
    mats = {r: np.eye(4) + np.triu(np.full((4, 4), k / 10.0), 1) for k, r in enumerate("abcd", 1)}
    table = spark.createDataFrame([("a", r, m.ravel().tolist()) for r, m in mats.items()],
                                  "root string, route_id string, matrix array<double>")
    got = {r.route_id: np.array(r.matrix).reshape(4, 4) for r in routegraph.cascade(
        tree, table.filter("route_id <> 'a'"), table.filter("route_id = 'a'").drop("route_id")).collect()}
    a, b, c, d = (mats[r] for r in "abcd")
    for name, want in (("a", a), ("b", a @ b), ("c", a @ b @ c), ("d", a @ d)):
        assert np.allclose(got[name], want)
    failed = spark.createDataFrame([("a", "b")], "root string, route_id string")
    assert {r.route_id for r in routegraph.surviving(tree, failed).collect()} == {"a", "d"}


def test_ranks_beyond_twelve_digits(spark):
    from posegrid.operators import routegraph as RG
    big = 7 * 10**12
    rows = [("r", "n1", big + 3), ("a", "n1", big + 2), ("b", "n1", big + 1), ("a", "n2", big + 2), ("b", "n2", big + 1),
            ("c", "n2", 5)]
    crossings = spark.createDataFrame([(r, n, 0, k) for r, n, k in rows],
                                      "route_id string, node_id string, slice int, route_rank long")
    roots = spark.createDataFrame([("r", "r")], "root string, route_id string")
    tree = {r.route_id: (r.parent_id, r.depth, r.path) for r in RG.bfs_tree(crossings, roots).collect()}
    assert tree == {"r": (None, 0, [big + 3]), "a": ("r", 1, [big + 3, big + 2]), "b": ("r", 1, [big + 3, big + 1]),
                    "c": ("b", 2, [big + 3, big + 1, 5])}


def test_a_chain_is_walked_to_its_end(spark):
    from posegrid.operators import routegraph as RG
    n = 30
    parents = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(n)], "route_id string, parent_id string")
    tree = RG.tree_from_parents(parents)
    assert sorted((r.depth, r.enter, r["size"]) for r in tree.collect()) == [(i, i, n - i) for i in range(n)]


def test_numbers_of_a_random_forest(spark):
    from posegrid.operators import trees
    rng = np.random.default_rng(12)
    parent = {i: (None if i % 40 == 0 else int(rng.integers(i // 40 * 40, i))) for i in range(200)}
    parent |= {500: 501, 501: 502, 502: 500, 503: 500, 600: 999, 601: 600}  # a cycle, what hangs on it, and orphans
    rows = [(str(k), None if p is None else str(p), (k * 7) % 211) for k, p in parent.items()]
    nodes = spark.createDataFrame(rows, "route_id string, parent_id string, route_rank long").repartition(4)
    kids, want = {}, {}
    for k in sorted(range(200), key=lambda i: (i * 7) % 211):
        kids.setdefault(parent[k], []).append(k)

    def walk(node, root, depth, enter):
        size = 1
        for child in kids.get(node, []):
            size += walk(child, root, depth + 1, enter + size)
        want[str(node)] = (str(root), depth, enter, size)
        return size

    for top in kids[None]:
        walk(top, top, 0, 0)
    tree = trees.number_tree(nodes, "route_rank").cache()
    assert {r.route_id: (r.root, r.depth, r.enter, r["size"]) for r in tree.collect()} == want
    by_hash = trees.number_tree(nodes).collect()
    assert {(r.route_id, r.root, r.depth, r["size"]) for r in by_hash} == {(k, w[0], w[1], w[3]) for k, w in want.items()}
    spans = {r.route_id: (r.root, r.enter, r.enter + r["size"]) for r in by_hash}
    for k, p in parent.items():
        if p is not None and str(k) in spans:
            root, begin, end = spans[str(p)]
            assert spans[str(k)][0] == root and begin < spans[str(k)][1] and spans[str(k)][2] <= end
    starts = spark.createDataFrame([(want[str(i)][0], str(i)) for i in (3, 41, 43, 43, 80, 199)], "root string, route_id string")

    def inside(i):
        while i is not None:
            if i in (3, 41, 43, 80, 199):
                return True
            i = parent[i]
        return False

    assert sorted(r.route_id for r in trees.below(tree, starts).collect()) == sorted(str(i) for i in range(200) if inside(i))
    assert trees.number_tree(nodes.limit(0)).count() == 0


def test_tracks_over_a_zone_border_and_the_equator(spark):
    from posegrid.operators import anchor as A
    fixes = [("zone", i, 120.0 + (i - 2) * 1e-4, 30.0) for i in range(5)] + [("equator", i, 10.0, (i - 2) * 1e-4) for i in range(5)]
    track = spark.createDataFrame([(r, i, i * 1000, x, y, 0.0) for r, i, x, y in fixes],
                                  "route_id string, seq long, ms long, lon double, lat double, elev double")
    for r in A.track_steps(track).collect():
        if r.seq:
            assert (9.5 < r.step < 9.8) if r.route_id == "zone" else (11.0 < r.step < 11.1)


def test_tied_knots_give_a_point_that_was_there(spark):
    from posegrid.operators import resample as RS
    knots = spark.createDataFrame([("r", 0.0, 1.0, 9.0), ("r", 0.0, 5.0, 2.0)], "route_id string, t double, x double, y double")
    at = spark.createDataFrame([("r", 0.0)], "route_id string, t double")
    r = RS.interpolate(at, knots, "t", ["x", "y"]).first()
    assert (r.x, r.y) in {(1.0, 9.0), (5.0, 2.0)}


def test_ring_pairs_of_a_frame_that_lacks_cameras(spark):
    from posegrid.operators import pairs as PR
    views = spark.createDataFrame([("s", i, i) for i in range(7)], "scene_id string, pos long, id_view long")
    got = {(r.view_a, r.view_b) for r in PR.rig_ring_pairs(views, 4).collect()}
    assert got == {(3, 0), (0, 1), (1, 2), (2, 3), (6, 4), (4, 5), (5, 6)}


def test_clusters_of_each_mesh(spark, monkeypatch):
    from posegrid.operators import mesh as ME
    rng = np.random.default_rng(4)
    rows = []
    for m, spots in (("a", [(0, 0, 0), (50, 0, 0), (0, 0, 50)]), ("b", [(7, 7, 7), (90, 0, 7)])):
        for s in spots:
            rows += [(m, len(rows) + i, *map(float, p)) for i, p in enumerate(rng.normal(s, 0.5, (40, 3)))]
    v = spark.createDataFrame(rows, "mesh_id string, vid long, x double, y double, z double")
    monkeypatch.setattr(ME, "curvature_features", lambda d: d.withColumns(
        {"theta": F.lit(0.0), "phi": F.lit(0.0), "is_flat": F.lit(True)}))
    labelled, centres = ME.cluster_flat_vertices(v, 6)
    points = {(r.mesh_id, r.vid): np.array(r._f) for r in labelled.collect()}
    own = {}
    for r in centres.collect():
        own.setdefault(r.mesh_id, []).append((r.cluster, np.array(r.centre)))
    of = {(r.mesh_id, r.vid): r.cluster for r in labelled.collect()}
    for (m, vid), p in points.items():
        assert of[m, vid] == min(own[m], key=lambda c: ((c[1] - p) ** 2).sum())[0]
    for m, cs in own.items():
        for c, centre in cs:
            held = [p for k, p in points.items() if k[0] == m and of[k] == c]
            assert not held or np.allclose(np.mean(held, 0), centre, atol=1e-4)
    seeds = ME.cluster_seed_vertices(labelled, centres).collect()
    assert {r.mesh_id for r in seeds} == {"a", "b"}


def test_robust_covariance_ends_and_keeps_the_half_of_numpy(spark):
    """Concentration steps by numpy give the same points; a group with NaN (which never settled) ends too."""
    rng = np.random.default_rng(5)
    rows, want = [], set()
    for g in range(3):
        p = rng.normal(size=(301, 3)) * [1, 3, 0.2 + g] + rng.exponential(2, size=(301, 1)) * g
        rows += [(f"g{g}", i, *map(float, v)) for i, v in enumerate(p)]
        m = np.median(p, 0)
        v, last = np.diag(((p - m) ** 2).mean(0)), None
        dist = lambda m, v: np.einsum("ij,jk,ik->i", p - m, np.linalg.inv(v), p - m)
        while True:
            d = dist(m, v)
            keep = d <= np.sort(d)[(len(p) + 4) // 2 - 1]
            if last is not None and (keep == last).all():
                break
            last, m, v = keep, p[keep].mean(0), np.cov(p[keep].T, bias=True)
        d = dist(m, v)
        keep = d / (np.median(d) / outliers.CHI2_3_MEDIAN) < outliers.CHI2_3_UPPER
        d = dist(p[keep].mean(0), np.cov(p[keep].T, bias=True))
        want |= {(f"g{g}", int(i)) for i in np.flatnonzero(d <= np.quantile(d, 0.95))}
    rows += [("nan", i, float("nan"), float(i), 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "scene_id string, idx long, x double, y double, z double")
    got = outliers.robust_covariance_filter(df, 0.05)
    assert {(r.scene_id, r.idx) for r in got.where("scene_id <> 'nan'").collect()} == want


def test_curves_that_are_settled_leave_the_rounds(spark, monkeypatch):
    """A route has the same result alone as among others; tables of the rounds get smaller as routes stop."""
    t = np.linspace(0, 1, 40)
    rng = np.random.default_rng(3)
    routes = {"line": np.stack([t, 2 * t, -t], 1), "arc": np.stack([np.cos(3 * t), np.sin(3 * t), t * t], 1),
              "rough": np.stack([9 * t, np.sin(20 * t), t], 1) + rng.normal(scale=0.3, size=(40, 3)),
              "one": np.ones((1, 3))}
    rows = [(k, i, *map(float, v)) for k, p in routes.items() for i, v in enumerate(p)]
    df = spark.createDataFrame(rows, "route_id string, idx long, x double, y double, z double")
    sizes, keep = [], outliers.stored

    def noted(x):
        out = keep(x)
        if "pos" in out.columns:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(outliers, "stored", noted)
    got = {(r.route_id, r.idx) for r in outliers.curve_filter(df, 5, 6).collect()}
    assert sizes[0] == len(rows) and sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    alone = {(r.route_id, r.idx) for k in routes for r in outliers.curve_filter(df.where(F.col("route_id") == k), 5, 6).collect()}
    assert got == alone
