"""Mesh and point-cloud tables.

``vertices``: ``mesh_id, vid, x, y, z, nx, ny, nz, red, green, blue``; ``faces``: ``mesh_id, fid,
v1, v2, v3``. Adjacency is kept as face-edge incidence; a fan of faces around one edge or vertex
never turns into all its pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.scale import attach, checkpointed, order_stats

M = "mesh_id"


# ------------------------------------------------------------------ vertex attributes

def is_flat(red="red", green="green", blue="blue") -> Column:
    """Flat vertices are painted with red as the largest channel."""
    r, g, b = L._c(red), L._c(green), L._c(blue)
    return (r > g) & (r > b)


def azimuth(nx="nx", ny="ny", nz="nz") -> Column:
    n = L.unit(L.vec(nx, ny, nz))
    return F.atan2(n["y"], n["x"])


def curvature_features(vertices: DataFrame) -> DataFrame:
    """Flat flag and clustering features; ``theta`` is a constant -1."""
    return vertices.withColumns({"is_flat": is_flat(), "theta": F.lit(-1.0), "phi": azimuth()})


def transform_vertices(vertices: DataFrame, transforms: DataFrame) -> DataFrame:
    """Rotate, scale and move all vertices of each mesh by its 4x4 ``matrix``."""
    moved = attach(vertices, transforms.select(M, "matrix"), M).withColumn(
        "_p", L.mat4_apply("matrix", L.vec("x", "y", "z")))
    return moved.withColumns({a: F.col("_p")[a] for a in L.AXES}).drop("_p", "matrix")


def mirror_xy(vertices: DataFrame) -> DataFrame:
    """Mirror x and y for the viewer."""
    return vertices.withColumns({"x": -F.col("x"), "y": -F.col("y")})


# ------------------------------------------------------------------ faces and corners

def corners(faces: DataFrame) -> DataFrame:
    """One row per face corner: ``mesh_id, fid, corner, vid``."""
    return faces.select(M, "fid", F.posexplode(F.array("v1", "v2", "v3")).alias("corner", "vid"))


def corner_values(faces: DataFrame, vertices: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Corners with vertex columns. A vertex shared by very many faces is salted."""
    return attach(corners(faces), vertices.select(M, "vid", *columns), [M, "vid"])


def face_normals(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Unit normals of the three corners ``n1..n3`` and their normalised sum ``normal``."""
    c = corner_values(faces, vertices, ["nx", "ny", "nz"]).withColumn(
        "_n", L.unit(L.vec("nx", "ny", "nz")))
    one = c.groupBy(M, "fid").agg(*[F.max(F.when(F.col("corner") == i, F.col("_n"))).alias(
        f"n{i + 1}") for i in range(3)])
    return one.withColumn("normal", L.unit(L.add(L.add("n1", "n2"), "n3")))


def face_boxes(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """Extent of every face."""
    c = corner_values(faces, vertices, list(L.AXES))
    aggs = [f(a).alias(f"{n}_{a}") for a in L.AXES for f, n in ((F.min, "min"), (F.max, "max"))]
    return c.groupBy(M, "fid").agg(*aggs)


def bounding_box(faces: DataFrame, vertices: DataFrame, buffer: float,
                 keys: Sequence[str] = (M,)) -> DataFrame:
    """Box around all corners of a face set, widened by ``buffer`` of its extent in total."""
    extra = [k for k in keys if k != M]
    rows = face_boxes(faces, vertices)
    if extra:
        rows = rows.join(faces.select(M, "fid", *extra), [M, "fid"])
    box = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), *[
        f(f"{n}_{a}").alias(f"{n}_{a}") for a in L.AXES
        for f, n in ((F.min, "min"), (F.max, "max"))])
    wide = {}
    for a in L.AXES:
        pad = (F.col(f"max_{a}") - F.col(f"min_{a}")) * buffer / 2
        wide[f"min_{a}"] = F.col(f"min_{a}") - pad
        wide[f"max_{a}"] = F.col(f"max_{a}") + pad
    return box.withColumns(wide)


def extents(vertices: DataFrame) -> DataFrame:
    """Extent per axis, diagonal and vertical start of each mesh."""
    box = vertices.groupBy(M).agg(*[(F.max(a) - F.min(a)).alias(f"d{a}") for a in L.AXES],
                                  F.min("y").alias("min_y"), F.count(F.lit(1)).alias("n"))
    return box.withColumn("diagonal", L.norm(L.vec("dx", "dy", "dz")))


# ------------------------------------------------------------------ filters

def drop_sparse_vertices(vertices: DataFrame, faces: DataFrame, quantile: float, tolerance: float
                         ) -> tuple[DataFrame, DataFrame]:
    """Remove vertices below ``quantile * tolerance`` of the density, and faces that use them."""
    lim = order_stats(vertices, M, "density", {"_q": quantile}, mode="linear")
    kept = attach(vertices, lim, M).filter(F.col("density") >= F.col("_q") * tolerance) \
        .select(*vertices.columns)
    c = attach(corners(faces), kept.select(M, "vid", F.lit(1).alias("_in")), [M, "vid"],
                      how="inner")
    whole = c.groupBy(M, "fid").agg(F.count(F.lit(1)).alias("_k")).filter("_k = 3")
    return kept, faces.join(whole, [M, "fid"], "left_semi")


def cut_floor(faces: DataFrame, vertices: DataFrame, ratio: float) -> DataFrame:
    """Drop faces with a corner below ``min_y + ratio * dy``."""
    lim = extents(vertices).select(M, (F.col("min_y") + ratio * F.col("dy")).alias("_cut"), "n")
    boxes = attach(face_boxes(faces, vertices), lim, M)
    return faces.join(boxes.filter(F.col("min_y") >= F.col("_cut")), [M, "fid"], "left_semi")


def faces_in_box(faces: DataFrame, vertices: DataFrame, boxes: DataFrame) -> DataFrame:
    """Faces whose corners all lie strictly inside their mesh's box (one box per mesh)."""
    b = face_boxes(faces, vertices)
    lim = boxes.select(M, *[F.col(f"{n}_{a}").alias(f"_{n}_{a}") for a in L.AXES
                            for n in ("min", "max")])
    cond = F.lit(True)
    for a in L.AXES:
        cond = cond & (F.col(f"min_{a}") > F.col(f"_min_{a}")) & \
            (F.col(f"max_{a}") < F.col(f"_max_{a}"))
    return faces.join(attach(b, lim, M).filter(cond), [M, "fid"], "left_semi")


def vertex_flat_faces(vertices: DataFrame, faces: DataFrame, wanted: DataFrame | None = None
                      ) -> DataFrame:
    """First face (smallest id) around each vertex whose three corners are all flat."""
    c = corner_values(faces, vertices.withColumn("_flat", is_flat()), ["_flat"])
    flat = c.groupBy(M, "fid").agg(F.bool_and("_flat").alias("_all")).filter("_all")
    on = corners(faces.join(flat, [M, "fid"], "left_semi"))
    if wanted is not None:
        on = on.join(wanted.select(M, "vid"), [M, "vid"], "left_semi")
    return on.groupBy(M, "vid").agg(F.min("fid").alias("fid"))


# ------------------------------------------------------------------ adjacency

def face_edges(faces: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Incidence of faces and undirected edges: ``mesh_id, *also, fid, ea, eb`` with ``ea <= eb``."""
    e = lambda p, q: F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b"))
    return faces.select(M, *also, "fid", F.explode(F.array(e("v1", "v2"), e("v2", "v3"), e("v1", "v3")))
                        .alias("_e")).select(M, *also, "fid", F.col("_e.a").alias("ea"),
                                             F.col("_e.b").alias("eb"))


def neighbour_counts(faces: DataFrame) -> DataFrame:
    """Neighbours of each face over shared edges, counted once per shared edge."""
    inc = face_edges(faces)
    per_edge = inc.groupBy(M, "ea", "eb").agg(F.count(F.lit(1)).alias("n_faces"))
    return attach(inc, per_edge, [M, "ea", "eb"]).groupBy(M, "fid").agg(
        F.sum(F.col("n_faces") - 1).alias("n_neighbours"))


def neighbours_of(faces: DataFrame, wanted: DataFrame) -> DataFrame:
    """Neighbouring faces of the wanted ones: ``mesh_id, fid, nbr, ea, eb``."""
    inc = face_edges(faces)
    mine = inc.join(wanted.select(M, "fid").distinct(), [M, "fid"], "left_semi")
    other = inc.select(M, "ea", "eb", F.col("fid").alias("nbr"))
    return mine.join(other, [M, "ea", "eb"]).filter("fid <> nbr")


def face_links(faces: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Links ``u > v`` that connect the faces of each edge to its smallest face; linear in size and
    with the same components as full adjacency. Columns of ``also`` keep several face sets apart."""
    keys = [M, *also]
    inc = face_edges(faces, also)
    low = inc.groupBy(*keys, "ea", "eb").agg(F.min("fid").alias("v"), F.count(F.lit(1)).alias("n"))
    return attach(inc, low, [*keys, "ea", "eb"]).filter("fid > v").select(
        *keys, F.col("fid").alias("u"), "v").distinct()


def components(nodes: DataFrame, links: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Smallest node id of each node's component: ``mesh_id, *also, fid, component``.

    Alternating star contraction: every node links its larger neighbours to the smallest node it
    knows, then itself and its smaller neighbours. Neighbour minima are map-side aggregates; the
    link list never grows and settles in a logarithmic number of rounds; the loop ends when a round
    changes nothing.
    """
    keys = [M, *also]

    def star(sym: DataFrame) -> tuple[DataFrame, DataFrame]:
        low = sym.groupBy(*keys, "u").agg(F.min("v").alias("_m"), F.count(F.lit(1)).alias("n")) \
            .withColumn("_m", F.least("_m", "u"))
        return attach(sym, low, [*keys, "u"]), low

    cur = checkpointed(links.select(*keys, "u", "v"))
    mark = None
    while True:
        both = cur.unionByName(cur.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = star(both)
        large = large.filter("v > u").select(*keys, F.col("v").alias("u"), F.col("_m").alias("v")) \
            .filter("u <> v").distinct()
        small, low = star(large)
        small = small.filter("v <> _m").select(*keys, F.col("v").alias("u"), F.col("_m").alias("v")) \
            .unionByName(low.select(*keys, "u", F.col("_m").alias("v"))) \
            .filter("u <> v").distinct()
        cur = checkpointed(small)
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))) \
            .first()
        if now == mark:
            break
        mark = now
    label = cur.groupBy(*keys, "u").agg(F.min("v").alias("_c")).withColumnRenamed("u", "fid")
    return nodes.select(*keys, "fid").join(label, [*keys, "fid"], "left").select(
        *keys, "fid", F.coalesce("_c", "fid").alias("component"))


def face_components(faces: DataFrame) -> DataFrame:
    return components(faces, face_links(faces))


def drop_small_components(faces: DataFrame, min_faces: int = 500) -> DataFrame:
    """Faces in connected pieces of at least ``min_faces`` faces."""
    comp = checkpointed(face_components(faces))
    sizes = comp.groupBy(M, "component").agg(F.count(F.lit(1)).alias("n"))
    big = attach(comp, sizes, [M, "component"]).filter(F.col("n") >= min_faces)
    return faces.join(big, [M, "fid"], "left_semi")


# ------------------------------------------------------------------ normals, segments

def mean_aligned_normal(normals: DataFrame, sigma: float, axis: tuple[float, float, float] = (0, 1, 0)
                        ) -> DataFrame:
    """Mean of the face normals whose component along ``axis`` lies within ``sigma`` standard
    deviations, and its dot product with the axis."""
    ax = L.vec(*axis)
    comp = normals.withColumn("_a", L.dot("normal", ax))
    lim = comp.groupBy(M).agg(F.count(F.lit(1)).alias("n"), F.avg("_a").alias("_mean"),
                              F.stddev_pop("_a").alias("_std"))
    inlier = attach(comp, lim, M).filter(F.abs(F.col("_a") - F.col("_mean")) <
                                         sigma * F.col("_std"))
    sums = inlier.groupBy(M).agg(L.vec(*[F.sum(F.col("normal")[a]) for a in L.AXES]).alias("_s"))
    return sums.select(M, L.unit("_s").alias("mean_normal")).withColumn(
        "axis_dot", L.dot("mean_normal", ax))


def segment_summary(faces: DataFrame, vertices: DataFrame, segments: DataFrame, seeds: DataFrame,
                    buffer: float, min_size: int) -> DataFrame:
    """Size, box and seed normal of segments with more than ``min_size`` faces.
    ``segments``: ``mesh_id, fid, segment``; ``seeds``: ``mesh_id, segment, normal``."""
    tagged = faces.join(segments, [M, "fid"])
    box = bounding_box(tagged, vertices, buffer, (M, "segment")).filter(F.col("size") > min_size)
    return box.join(seeds.withColumnRenamed("normal", "normal_seed"), [M, "segment"])


def size_class(size, medium: int, big: int) -> Column:
    size = L._c(size)
    return F.when(size > big, "big").when(size > medium, "medium").otherwise("small")


def aligned_segments(summary: DataFrame, threshold: float,
                     axis: tuple[float, float, float] = (0, 1, 0)) -> DataFrame:
    """Segments whose seed normal points against ``axis`` (floors, not ceilings)."""
    return summary.filter(-L.dot("normal_seed", L.vec(*axis)) > threshold)


def _reached(member: DataFrame, faces: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rows of ``member`` (``mesh_id, seed_no, fid``) that are connected to their own seed face by members."""
    keys = [M, "seed_no"]
    links = face_links(faces.join(member, [M, "fid"]), ["seed_no"])
    comp = checkpointed(components(member, links, ["seed_no"]))
    home = comp.join(seeds.select(*keys, "fid"), [*keys, "fid"], "left_semi").select(*keys, "component")
    return comp.join(home, [*keys, "component"], "left_semi").select(*keys, "fid")


def grow_segments(faces: DataFrame, vertices: DataFrame, seeds: DataFrame, threshold: float
                  ) -> DataFrame:
    """Planar segments grown from seed faces: ``mesh_id, fid, segment``.

    A face belongs to a seed when it is connected to it through faces whose three corner normals
    all have a dot product above ``threshold`` with the seed's normal. Seeds take turns in order;
    a face stays with the first seed that reaches it, and a seed already taken is skipped.
    ``seeds``: ``mesh_id, seed_no, fid``, one face per number.

    All seeds grow at once, over (seed, face) rows, as if there were no others. A seed whose faces no
    earlier seed reached as well is settled; its faces leave the others, whose rest grows anew from the
    seed. So the rounds follow the longest chain of seeds that are in each other's way, not their number.
    """
    normals = face_normals(faces, vertices)
    start = seeds.join(normals.select(M, "fid", "normal"), [M, "fid"])
    start = checkpointed(start.select(M, "seed_no", "fid", F.col("normal").alias("_n")))
    passes = F.col("fid") == F.col("_seed")
    near = F.lit(True)
    for i in (1, 2, 3):
        near = near & (L.dot(f"n{i}", "_n") > threshold)
    tested = attach(normals.drop("normal"), start.withColumnRenamed("fid", "_seed"), M).filter(passes | near)
    open_ = checkpointed(_reached(checkpointed(tested.select(M, "seed_no", "fid")), faces, start))
    done = open_.limit(0)
    while True:
        first = open_.groupBy(M, "fid").agg(F.min("seed_no").alias("_first"))
        waiting = checkpointed(attach(open_, first, [M, "fid"]).filter("seed_no > _first").select(M, "seed_no").distinct())
        settled = checkpointed(open_.join(waiting, [M, "seed_no"], "left_anti"))
        done = done.unionByName(settled)
        rest = checkpointed(open_.join(waiting, [M, "seed_no"], "left_semi").join(settled, [M, "fid"], "left_anti"))
        if rest.isEmpty():
            return done.select(M, "fid", F.col("seed_no").alias("segment"))
        open_ = checkpointed(_reached(rest, faces, start))


FEATURES = ("theta", "phi", "x", "y", "z")
#: k-means ends when no centre moves farther than this
SETTLED = 1e-6


def cluster_flat_vertices(vertices: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """k-means of each mesh's flat vertices on (theta, phi, x, y, z): labelled vertices and centres.

    Lloyd's rounds for all meshes at once, from the ``k`` vertices that come first by one hash each
    (fewer where a mesh has fewer places), until the centres stand still. A round is one join with a
    row of centres per mesh and one partial aggregation. ``mesh_id, cluster`` is unique in the centres.
    """
    flat = curvature_features(vertices).filter("is_flat").withColumn(
        "_f", F.array(*[F.col(c).cast("double") for c in FEATURES]))
    first = flat.groupBy(M).agg(*[F.min_by("_f", F.struct(F.xxhash64("vid", F.lit(i)), "vid")).alias(f"s{i}")
                                  for i in range(k)])
    centres = checkpointed(first.select(M, F.array_sort(F.array_distinct(
        F.array(*[f"s{i}" for i in range(k)]))).alias("centres")))

    def nearest(rows: DataFrame, table: DataFrame) -> DataFrame:
        away = F.transform("centres", lambda c: F.aggregate(
            F.zip_with(c, F.col("_f"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
        return attach(rows, table, M).withColumn("_away", away).withColumn(
            "cluster", (F.array_position("_away", F.array_min("_away")) - 1).cast("int")).drop("_away")

    while True:
        means = nearest(flat, centres).groupBy(M, "cluster").agg(
            F.array(*[F.avg(F.col("_f")[i]) for i in range(len(FEATURES))]).alias("mean"))
        by_mesh = means.groupBy(M).agg(F.map_from_entries(F.collect_list(F.struct("cluster", "mean"))).alias("means"))
        moved = checkpointed(attach(centres, by_mesh, M).withColumn("now", F.transform(
            "centres", lambda c, i: F.coalesce(F.try_element_at("means", i), c))).drop("means"))
        step = F.array_max(F.transform(F.arrays_zip("centres", "now"), lambda z: F.array_max(
            F.zip_with(z["centres"], z["now"], lambda a, b: F.abs(a - b)))))
        going = not moved.where(step > SETTLED).isEmpty()
        centres = moved.select(M, F.col("now").alias("centres"))
        if not going:
            break
    labelled = nearest(flat, centres).drop("centres")
    return labelled, centres.select(M, F.posexplode("centres").alias("cluster", "centre"))


def cluster_seed_vertices(labelled: DataFrame, centres: DataFrame) -> DataFrame:
    """Vertex nearest to its cluster's centre: ``mesh_id, cluster, vid``."""
    c = attach(labelled, centres, [M, "cluster"])
    d = sum((F.pow(F.col("_f")[i] - F.col("centre")[i], 2) for i in range(1, len(FEATURES))),
            F.pow(F.col("_f")[0] - F.col("centre")[0], 2))
    return c.withColumn("_d", d).groupBy(M, "cluster").agg(
        F.min(F.struct("_d", "vid")).alias("_m")).select(M, "cluster", F.col("_m.vid").alias("vid"))


def level_rotation(faces: DataFrame, vertices: DataFrame) -> DataFrame:
    """4x4 that turns the best-fit plane of the given floor faces onto the xz plane.

    The plane normal is the smallest principal axis of the corner coordinates (one covariance
    aggregate per mesh), taken upwards.
    """
    import numpy as np
    import pandas as pd

    used = corners(faces).select(M, "vid").distinct()
    pts = vertices.join(used, [M, "vid"], "left_semi")
    cells = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    cov = pts.groupBy(M).agg(*[F.covar_pop(a, b).alias(f"v{a}{b}") for a, b in cells])

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                v = np.array([[r.vxx, r.vxy, r.vxz], [r.vxy, r.vyy, r.vyz], [r.vxz, r.vyz, r.vzz]])
                normal = np.linalg.eigh(v)[1][:, 0]
                normal = normal if normal[1] >= 0 else -normal
                axis = np.cross(normal, [0.0, 1.0, 0.0])
                s, c = np.linalg.norm(axis), normal[1]
                k = axis / s if s > 1e-12 else np.zeros(3)
                w = np.array([[0, -k[2], k[1]], [k[2], 0, -k[0]], [-k[1], k[0], 0]])
                rot = np.eye(3) + s * w + (1 - c) * (w @ w)
                full = np.eye(4)
                full[:3, :3] = rot
                out.append(full.ravel().tolist())
            if out:
                yield pd.DataFrame({M: pdf[M], "matrix": out})

    key = vertices.schema[M].dataType.simpleString()
    return cov.mapInPandas(solve, f"{M} {key}, matrix array<double>")


# ------------------------------------------------------------------ rays

#: levels of the grid below that of a mesh's largest triangle; smaller triangles live on the lowest
LEVELS = 20


def flat_triangles(faces: DataFrame, vertices: DataFrame, directions: DataFrame) -> DataFrame:
    """Triangles with corners ``p0..p2`` and their box ``a0..b1`` on the plane across their mesh's direction."""
    tri = attach(corner_values(faces, vertices, list(L.AXES)), directions, M).withColumn("_p", L.vec("x", "y", "z"))
    tri = tri.withColumns({"_a": L.dot("_p", "_u"), "_b": L.dot("_p", "_v")})
    at = lambda i: F.max(F.when(F.col("corner") == i, F.col("_p"))).alias(f"p{i}")
    return tri.groupBy(M, "fid").agg(at(0), at(1), at(2), F.min("_a").alias("a0"), F.max("_a").alias("a1"),
                                     F.min("_b").alias("b0"), F.max("_b").alias("b1"))


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def triangle_cells(tri: DataFrame) -> DataFrame:
    """Cells that a triangle's box touches, on the level whose cells (2^level wide) are as wide as the box: at most
    two a side, so a triangle has at most four rows, however large it is."""
    size = F.greatest(F.col("a1") - F.col("a0"), F.col("b1") - F.col("b0"))
    own = F.when(size > 0, F.ceil(F.log2(size))).cast("int")
    top = tri.groupBy(M).agg(F.max(own).alias("_top"))
    placed = attach(tri, top, M).withColumn(
        "level", F.coalesce(F.greatest(own, F.col("_top") - LEVELS), F.lit(0)))
    for axis in ("a", "b"):
        placed = placed.withColumn(f"c{axis}", F.explode(F.sequence(
            _cell(F.col(f"{axis}0"), F.col("level")), _cell(F.col(f"{axis}1"), F.col("level")))))
    return placed.select(M, "level", "ca", "cb", "fid", "p0", "p1", "p2")


def ray_hits(rays: DataFrame, faces: DataFrame, vertices: DataFrame,
             directions: DataFrame) -> DataFrame:
    """First hit of each ray with its mesh, all rays of a mesh sharing one direction.

    ``rays``: ``mesh_id, ray_id, origin``; ``directions``: ``mesh_id, direction``. Rays become
    points and triangles become boxes on the plane across the direction, in a grid of several levels:
    a triangle lives on the level of its size, a ray asks one cell of each level that its mesh uses, so
    candidates come from an equi-join on cells. Result: ``mesh_id, ray_id, t, hit``.
    """
    d = directions.withColumn("_d", L.unit("direction"))
    helper = F.when(F.abs(F.col("_d")["x"]) < 0.9, L.vec(1, 0, 0)).otherwise(L.vec(0, 1, 0))
    d = d.withColumn("_u", L.unit(L.cross("_d", helper))).withColumn("_v", L.cross("_d", "_u"))
    cells = triangle_cells(flat_triangles(faces, vertices, d))
    # a mesh has at most LEVELS + 1 of them
    used = cells.groupBy(M).agg(F.collect_set("level").alias("_levels"))
    r = attach(attach(rays, d, M), used, M).withColumns({"_a": L.dot("origin", "_u"), "_b": L.dot("origin", "_v")})
    asked = r.select(M, "ray_id", "origin", "_d", "_a", "_b", F.explode("_levels").alias("level")).withColumns({
        "ca": _cell(F.col("_a"), F.col("level")), "cb": _cell(F.col("_b"), F.col("level"))})
    pair = attach(asked.drop("_a", "_b"), cells, [M, "level", "ca", "cb"])
    pair = pair.withColumns({"_e1": L.sub("p1", "p0"), "_e2": L.sub("p2", "p0"),
                             "_s": L.sub("origin", "p0")}) \
        .withColumn("_h", L.cross("_d", "_e2")).withColumn("_q", L.cross("_s", "_e1")) \
        .withColumn("_det", L.dot("_e1", "_h")).filter(F.abs("_det") > 1e-15)
    pair = pair.withColumns({"_bu": F.try_divide(L.dot("_s", "_h"), "_det"),
                             "_bv": F.try_divide(L.dot("_d", "_q"), "_det"),
                             "_t": F.try_divide(L.dot("_e2", "_q"), "_det")})
    eps = 1e-9
    hit = pair.filter((F.col("_bu") >= -eps) & (F.col("_bv") >= -eps)
                      & (F.col("_bu") + F.col("_bv") <= 1 + eps) & (F.col("_t") >= 0))
    first = hit.groupBy(M, "ray_id").agg(F.min_by(F.struct("origin", "_d", F.col("_t").alias("t")), "_t").alias("_f"))
    return first.select(M, "ray_id", F.col("_f.t").alias("t"),
                        L.add("_f.origin", L.times("_f._d", F.col("_f.t"))).alias("hit"))
