"""Sources and sinks: what is written reads back, and goldens when a folder of them is given."""

import json
import os
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.operators import frames as FR
from posegrid.operators import poses as P
from posegrid.operators import routegraph as RG
from posegrid.sources import documents as D
from posegrid.sources import ply, sinks

POINT = "struct<x:double,y:double,z:double>"


def whole(path: Path, doc: str) -> str:
    parts = sorted((path / f"doc_id={doc}").glob("part-*"))
    return "".join(p.read_text() for p in parts)


def scene(n=7, footprint=True):
    return {"sfm_data_version": "0.3", "root_path": "/img", "views": [
        {"key": i, "value": {"polymorphic_id": 1073741824, "ptr_wrapper": {"id": 2147483649 + i, "data": {
            "local_path": "", "filename": f"{i:05d}_77.jpg", "width": 8, "height": 4, "id_view": i,
            "id_intrinsic": 0, "id_pose": i}}}} for i in range(n)], "intrinsics": [],
        "extrinsics": [{"key": i, "value": {
            "rotation": [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]],
            "center": [i * 0.5, 1.0, 2.0], **({"footprint": [i * 0.5, 3.0, 2.0]} if footprint else {})}}
            for i in range(n)],
        "structure": [{"key": 4, "value": {"X": [1.0, 2.0, 3.0]}}], "control_points": []}


def test_scene_round_trip(spark, tmp_path):
    for s, fp in (("one", True), ("two", False)):
        (tmp_path / "in" / s).mkdir(parents=True)
        (tmp_path / "in" / s / "scene.json").write_text(json.dumps(scene(footprint=fp), indent=2))
    docs = D.read_scenes(spark, str(tmp_path / "in" / "*" / "scene.json"))
    views, poses = D.scene_views(docs), D.scene_poses(docs)
    assert views.count() == 14 and poses.filter("footprint IS NULL").count() == 7
    assert D.scene_points(docs).count() == 2 and D.view_ids(docs).filter("id_view = pos").count() == 14
    head = docs.select("scene_id", "sfm_data_version", "root_path")
    lines = sinks.scene_lines(head, views, poses, points=D.scene_points(docs))
    sinks.text_documents(lines, str(tmp_path / "out"))
    for s, fp in (("one", True), ("two", False)):
        got, want = json.loads(whole(tmp_path / "out", s)), scene(footprint=fp)
        assert got == want


def test_route_round_trip(spark, tmp_path):
    pose = {"position": [1.0, 2.0, 3.0], "rotation": [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]}
    frames = [{"dir": "d", "slice": 0, "frame_idx": i, "timestamp": i / 10, "filenames": [f"{i:05d}.jpg"],
               "lense_positions": [[1.0, 2.0, 3.0] if i else None], "lense_rotations": [pose["rotation"]],
               "lense_footprints": [None], **(pose if i else {"position": None, "rotation": None}),
               "footprint": None} for i in range(5)]
    doc = {"is_scene": True, "video": "v.mp4", "slice_beg_timestamp": 0.0, "slice_end_timestamp": 0.5,
           "last_overwritten": "x", "frames": frames}
    (tmp_path / "data_a_000").mkdir()
    (tmp_path / "data_a_000" / "routes.json").write_text(json.dumps(doc))
    docs = D.read_routes(spark, str(tmp_path / "data_*" / "routes.json"))
    fr = D.route_frames(docs)
    assert fr.count() == 5 and fr.filter("position IS NULL").count() == 1
    assert D.route_lenses(docs).filter("center IS NOT NULL").count() == 4
    lines = sinks.route_lines(D.route_headers(docs), fr)
    sinks.text_documents(lines, str(tmp_path / "out"))
    got = json.loads(whole(tmp_path / "out", "data_a_000"))
    assert [f["position"] for f in got["frames"]] == [f["position"] for f in frames]
    assert got["video"] == "v.mp4" and got["frames"][2]["rotation"] == pose["rotation"]
    pts = sinks.route_points(fr)
    assert pts.count() == 4
    sinks.text_documents(ply.ply_lines(pts), str(tmp_path / "ply"))
    text = whole(tmp_path / "ply", "data_a_000").splitlines()
    assert text[0] == "ply" and "element vertex 4" in text and text[-1].split()[:3] == ["1.0", "2.0", "3.0"]


def test_track_formats(spark, tmp_path):
    one = {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[121.0, 23.0, 5.0], [121.1, 23.1, 6.0]]},
           "properties": {"AbsoluteUtcMilliSec": [1000, 2000]}}
    two = {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [
        [121.0, 23.0, 5.0, 1000.0, 1.5, 0.1, 0.2, 0.3]]}, "properties": {}}
    for s, d in (("plain", one), ("full", two)):
        (tmp_path / s).mkdir()
        (tmp_path / s / "track.geojson").write_text(json.dumps(d))
    t = D.track_points(D.read_tracks(spark, str(tmp_path / "*" / "track.geojson"))).orderBy("route_id", "seq")
    rows = [(r.route_id, r.seq, r.ms, r.height, r.gamma) for r in t.collect()]
    assert rows == [("full", 0, 1000, 1.5, 0.3), ("plain", 0, 1000, 1.8, None), ("plain", 1, 2000, 1.8, None)]
    entries = t.filter("route_id = 'full'").select("route_id", "seq", F.array(
        "lon", "lat", "elev", F.col("ms").cast("double"), "height", "alpha", "beta", "gamma").alias("entry"))
    sinks.text_documents(sinks.geojson_lines(entries), str(tmp_path / "out"))
    assert json.loads(whole(tmp_path / "out", "full")) == two


def test_marker_and_log_documents(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "r1_source_marker.json").write_text(json.dumps([
        {"name": "node_4", "begin": 2000}, {"name": "start_end", "begin": 1000, "end": 9000},
        {"name": "mask_1", "begin": 3000}, {"name": "node_7", "begin": 8500}]))
    m = D.read_markers(spark, str(tmp_path / "m" / "*.json"))
    assert m.count() == 3
    assert {(r.node_id, r.slice) for r in RG.node_slices(m, 3).collect()} == {("4", 0), ("7", 2)}
    assert {(r.node_id, r.node_s, r.ss, r.to) for r in FR.marker_times(m).collect()} == {
        ("4", 2.0, 1.0, 9.0), ("7", 8.5, 1.0, 9.0)}
    log = spark.createDataFrame([("s", 0, np.diag([2.0, 2, 2, 1]).ravel().tolist(), "t0", "a")],
                                "scene_id string, seq int, matrix array<double>, ts string, note string")
    more = spark.createDataFrame([("s", np.diag([3.0, 3, 3, 1]).ravel().tolist(), "t1", "b")],
                                 "scene_id string, matrix array<double>, ts string, note string")
    log = RG.append_transform(log, more)
    lines = sinks.transform_log_lines(log, RG.concatenated(log))
    sinks.text_documents(lines, str(tmp_path / "out"))
    doc = json.loads(whole(tmp_path / "out", "s"))
    assert doc["concatenated"][0][0] == 6 and [x["note"] for x in doc["list"]] == ["a", "b"]


@pytest.mark.parametrize("fmt", ["ascii", "binary_little_endian", "binary_big_endian"])
def test_ply_reading(spark, tmp_path, fmt):
    order = ">" if "big" in fmt else "<"
    v = np.zeros(5, dtype=[("x", order + "f4"), ("y", order + "f4"), ("z", order + "f8"), ("red", "u1"),
                           ("green", "u1"), ("blue", "u1")])
    v["x"], v["z"], v["red"] = range(5), 2.5, 200
    f = np.zeros(2, dtype=[("n", "u1"), ("i", order + "i4", (3,)), ("m", "u1"), ("t", order + "f4", (6,))])
    f["n"], f["m"], f["i"], f["t"] = 3, 6, [[0, 1, 2], [2, 3, 4]], 0.5
    head = (f"ply\nformat {fmt} 1.0\ncomment made for a test\nelement vertex 5\nproperty float x\n"
            "property float y\nproperty double z\nproperty uchar red\nproperty uchar green\n"
            "property uchar blue\nelement face 2\nproperty list uchar int vertex_indices\n"
            "property list uchar float texcoord\nend_header\n").encode()
    if fmt == "ascii":
        body = "".join(" ".join(map(str, r.tolist())) + "\n" for r in v)
        body += "".join(f"3 {a} {b} {c} 6 " + " ".join(["0.5"] * 6) + "\n" for a, b, c in f["i"])
        body = body.encode()
    else:
        body = v.tobytes() + f.tobytes()
    (tmp_path / "cube.ply").write_bytes(head + body)
    vs = ply.read_vertices(spark, str(tmp_path)).orderBy("vid").collect()
    fs = ply.read_faces(spark, str(tmp_path)).orderBy("fid").collect()
    assert [(r.mesh_id, r.vid, r.x, r.z, r.red, r.nx) for r in vs] == [
        ("cube", i, float(i), 2.5, 200, None) for i in range(5)]
    assert [(r.v1, r.v2, r.v3, r.uv) for r in fs] == [(0, 1, 2, [0.5] * 6), (2, 3, 4, [0.5] * 6)]


def test_ply_writing(spark, tmp_path):
    v = spark.range(50).select(F.lit("m").alias("mesh_id"), F.col("id").alias("vid"), *[
        (F.col("id") * k / 4).alias(a) for k, a in enumerate("xyz")], *[
        (F.col("id") % 7).cast("int").alias(c) for c in ("red", "green", "blue")])
    f = spark.range(20).select(F.lit("m").alias("mesh_id"), F.col("id").alias("fid"), *[
        (F.col("id") + k).alias(f"v{k + 1}") for k in range(3)])
    ply.write_ply_binary(str(tmp_path / "bin"), v, f)
    ply.write_ply(str(tmp_path / "txt"), v, f)
    (tmp_path / "again").mkdir()
    pieces = sorted((tmp_path / "bin" / "mesh_id=m").glob("part-*"))
    (tmp_path / "again" / "b.ply").write_bytes(b"".join(p.read_bytes() for p in pieces))
    (tmp_path / "again" / "t.ply").write_text(whole(tmp_path / "txt", "m"))
    got = ply.read_vertices(spark, str(tmp_path / "again")).groupBy("mesh_id").agg(
        F.count("*").alias("n"), F.sum("z").alias("z"), F.sum("red").alias("r")).collect()
    want = v.agg(F.sum("z"), F.sum("red")).first()
    assert len(got) == 2 and all((r.n, r.z, r.r) == (50, want[0], want[1]) for r in got)
    assert ply.read_faces(spark, str(tmp_path / "again")).filter("v3 = fid + 2").count() == 40


def test_trajectory_and_pair_documents(spark, tmp_path):
    c = spark.createDataFrame([(1, "stationary", 50.0), (2, "moving", 9.0)],
                              "capture_id long, movement_type string, duration_ms double")
    sinks.text_documents(sinks.trajectory_lines(FR.stationary_trajectory(c)), str(tmp_path / "t"))
    assert json.loads(whole(tmp_path / "t", "1")) == [[0.0] * 7 + [1.0], [50.0] + [0.0] * 6 + [1.0]]
    lines = spark.createDataFrame([("s", "3 9"), ("s", "1 2"), ("s", "1 10")], "scene_id string, value string")
    sinks.text_documents(sinks.pair_list_documents(lines), str(tmp_path / "p"))
    assert whole(tmp_path / "p", "s").split("\n")[:3] == ["1 2", "1 10", "3 9"]


def test_hashed_names_and_listing(spark, tmp_path):
    for n, b in (("00001_1.jpg", b"a"), ("00002_1.jpg", b"b"), ("note.txt", b"c")):
        (tmp_path / n).write_bytes(b)
    assert FR.manifest(D.list_images(spark, str(tmp_path))).agg(F.sum("key_idx")).first()[0] == 3
    names = {r.hashed_filename for r in D.hashed_images(spark, str(tmp_path)).collect()}
    assert len(names) == 2 and all(n.startswith("0000") and n.endswith(".jpg") and len(n) > 70 for n in names)


# ------------------------------------------------------------------ goldens

GOLDEN = os.environ.get("POSEGRID_GOLDEN_DIR")
golden = pytest.mark.skipif(not GOLDEN, reason="POSEGRID_GOLDEN_DIR is not set")


def _json_files():
    for p in Path(GOLDEN).rglob("*.json"):
        try:
            yield p, json.loads(p.read_text())
        except (ValueError, UnicodeDecodeError):
            continue


@golden
def test_golden_step_anchor_transform_and_product(spark):
    """Folders holding a scene, its transform log and the moved scene."""
    scenes, logs = {}, {}
    for p, doc in _json_files():
        if isinstance(doc, dict) and doc.get("extrinsics") and "footprint" in doc["extrinsics"][0]["value"]:
            scenes.setdefault(p.parent, []).append(p)
        elif isinstance(doc, dict) and "concatenated" in doc and "list" in doc:
            logs[p.parent] = p
    assert scenes
    for folder, files in scenes.items():
        files = sorted(files, key=lambda p: len(p.name))
        before = D.scene_poses(D.read_scenes(spark, str(files[0])))
        anchored = P.step_anchor(before.drop("footprint")).select("pose_key", F.col("footprint").alias("got"))
        gap = before.join(anchored, "pose_key").agg(F.max(L.dist("got", "footprint"))).first()[0]
        assert gap < 1e-9
        log = D.read_transform_logs(spark, str(logs[folder]))
        product = RG.concatenated(D.transform_entries(log))
        want = D.stored_products(log).first().matrix
        assert np.allclose(product.first().matrix, want, atol=1e-12)
        if len(files) > 1:
            moved = P.transform_poses(before, D.stored_products(log))
            after = D.scene_poses(D.read_scenes(spark, str(files[1]))).select(
                "pose_key", F.col("center").alias("c"), F.col("rotation").alias("r"),
                F.col("footprint").alias("f"))
            worst = moved.join(after, "pose_key").agg(
                F.max(L.dist("center", "c")), F.max(L.dist("footprint", "f")),
                *[F.max(F.abs(F.col("rotation")[i] - F.col("r")[i])) for i in range(9)]).first()
            assert max(worst) < 1e-9


@golden
def test_golden_route_tree(spark):
    yaml = pytest.importorskip("yaml")
    folders = {p.parent for p in Path(GOLDEN).rglob("*_source_marker.json")}
    trees = [t for p in Path(GOLDEN).rglob("*.yaml") if "parent_to_own_slice" in p.read_text()
             for t in [yaml.safe_load(p.read_text())]
             if len(t) == 1 and "child_node" in next(iter(t.values()))]
    assert folders and trees
    for folder in folders:
        m = D.read_markers(spark, str(folder / "*_source_marker.json"))
        c = RG.node_slices(m, 15)
        names = sorted(p.name.removesuffix("_source_marker.json") for p in folder.glob("*_source_marker.json"))
        # files sort with their suffix
        order = sorted(names, key=lambda n: n + "_source_marker.json")
        ranks = spark.createDataFrame(list(zip(order, range(len(order)))), "route_id string, route_rank long")
        c = c.join(ranks, "route_id")
        assert RG.edge_totals(c).agg(F.sum("n_edges")).first()[0] == 302
        assert RG.root_routes(c).count() == 4
        for tree in trees:
            want = {}

            def walk(node, above=None):
                for name, body in node.items():
                    name = name.split("/")[-1]
                    want[name] = (above, *[None if s is None else int(s) for s in body["parent_to_own_slice"]])
                    for child in body["child_node"] or []:
                        walk(child, name)

            walk(tree)
            top = next(n for n, v in want.items() if v[0] is None)
            roots = spark.createDataFrame([(top, top)], "root string, route_id string")
            got = {r.route_id: (r.parent_id, r.parent_slice, r.own_slice)
                   for r in RG.route_tree(c, roots).collect()}
            assert got == want


def test_polygons_become_fans(spark, tmp_path):
    import struct

    from posegrid.sources import ply

    head = "ply\nformat {} 1.0\nelement vertex 5\nproperty float x\nproperty float y\nproperty float z\n" \
           "element face 3\nproperty list uchar int vertex_indices\nproperty list uchar float texcoord\nend_header\n"
    faces = [[0, 1, 2, 3], [1, 2, 4], [0, 1, 2, 3, 4]]
    uv = [[i / 8 for i in range(2 * len(f))] for f in faces]
    text = head.format("ascii") + "0 0 0\n" * 5 + "".join(
        " ".join(map(str, [len(f), *f, len(t), *t])) + "\n" for f, t in zip(faces, uv))
    (tmp_path / "a.ply").write_text(text)
    raw = head.format("binary_little_endian").encode() + struct.pack("<15f", *range(15))
    for f, t in zip(faces, uv):
        raw += struct.pack(f"<B{len(f)}iB{len(t)}f", len(f), *f, len(t), *t)
    (tmp_path / "b.ply").write_bytes(raw)
    got = {}
    for r in ply.read_faces(spark, str(tmp_path)).collect():
        got.setdefault(r.mesh_id, {})[r.fid] = ((r.v1, r.v2, r.v3), r.uv)
    want = [(f, t, i) for f, t in zip(faces, uv) for i in range(1, len(f) - 1)]
    for mesh in ("a", "b"):
        assert [got[mesh][k][0] for k in range(6)] == [(f[0], f[i], f[i + 1]) for f, _, i in want]
        assert [got[mesh][k][1] for k in range(6)] == [
            [*t[:2], *t[2 * i:2 * i + 2], *t[2 * i + 2:2 * i + 4]] for _, t, i in want]
    assert ply.read_vertices(spark, str(tmp_path)).count() == 10


def _uneven_ply(fmt, folder, name):
    """A PLY with an element before the vertices, and polygons of 0 to 6 corners in runs and alone."""
    import struct

    rng = np.random.default_rng(6)
    sizes = [3] * 150 + [int(n) for n in rng.integers(0, 7, 60)] + [4] * 90 + [3] * 40 + [300]
    faces = [[int(v) for v in rng.integers(0, 400, n)] for n in sizes]
    points = np.round(rng.normal(size=(400, 3)), 3).astype("f4")
    end = ">" if "big" in fmt else "<"
    head = (f"ply\nformat {fmt} 1.0\nelement camera 3\nproperty list uchar short tags\nproperty int no\nelement vertex 400\n"
            "property float x\nproperty float y\nproperty float z\nelement face 341\nproperty uchar flag\n"
            "property list ushort int vertex_indices\nend_header\n").encode()
    tags = [[7], [], [1, 2, 3]]
    if fmt == "ascii":
        lines = [" ".join(map(str, [len(t), *t, i])) for i, t in enumerate(tags)]
        lines += [" ".join(map(str, p)) for p in points] + [" ".join(map(str, [1, len(f), *f])) for f in faces]
        body = "\n".join(lines).encode()  # no line end at the end
    else:
        body = b"".join(struct.pack(f"{end}B{len(t)}hi", len(t), *t, i) for i, t in enumerate(tags))
        body += points.astype(end + "f4").tobytes()
        body += b"".join(struct.pack(f"{end}BH{len(f)}i", 1, len(f), *f) for f in faces)
    (folder / name).write_bytes(head + body)
    return points, [(f[0], f[i], f[i + 1]) for f in faces for i in range(1, len(f) - 1)]


@pytest.mark.parametrize("fmt", ["ascii", "binary_little_endian", "binary_big_endian"])
def test_a_file_is_read_in_ranges(spark, tmp_path, fmt):
    points, triangles = _uneven_ply(fmt, tmp_path, "with space é.ply")
    for piece, buffer in ((1 << 20, 1 << 20), (900, 64), (2000, 5000)):
        vs = ply.read_vertices(spark, str(tmp_path), piece, buffer)
        fs = ply.read_faces(spark, str(tmp_path), piece, buffer)
        if piece == 900:
            tasks = fs.select(F.spark_partition_id().alias("p")).distinct().count()
            assert tasks > 3 and vs.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        got = {r.vid: (r.x, r.y, r.z) for r in vs.collect()}
        assert np.allclose([got[i] for i in range(400)], points, atol=1e-6) and len(got) == 400
        found = {r.fid: (r.mesh_id, r.v1, r.v2, r.v3) for r in fs.collect()}
        assert [found[i] for i in range(len(triangles))] == [("with space é", *t) for t in triangles]
        assert len(found) == len(triangles)


def test_a_cut_file_is_an_error(spark, tmp_path):
    _uneven_ply("binary_little_endian", tmp_path, "a.ply")
    raw = (tmp_path / "a.ply").read_bytes()
    (tmp_path / "a.ply").write_bytes(raw[:-7])
    for piece in (1 << 20, 900):
        with pytest.raises(Exception, match="are declared"):
            ply.read_faces(spark, str(tmp_path), piece, 512).count()


def test_a_failed_write_leaves_the_old_document(spark, tmp_path):
    """A task fails on purpose after others have written: nothing of the job is left, the mesh is as it was."""
    v = spark.range(0, 3000, numPartitions=6).select(
        F.lit("m/1").alias("mesh_id"), F.col("id").alias("vid"),
        *[(F.col("id") * k).cast("double").alias(a) for k, a in enumerate("xyz", 1)])
    ply.write_ply_binary(str(tmp_path), v)
    whole_before = {p.name: p.read_bytes() for p in (tmp_path / "mesh_id=m%2F1").glob("part-*")}
    assert len(b"".join(whole_before[n] for n in sorted(whole_before)).split(b"end_header\n", 1)[1]) == 3000 * 24

    @F.udf("double")
    def broken(x):
        if x == 2999.0:
            raise RuntimeError("lost on purpose")
        return x + 1

    with pytest.raises(Exception, match="lost on purpose"):
        ply.write_ply_binary(str(tmp_path), v.withColumn("x", broken("x")))
    assert {p.name: p.read_bytes() for p in (tmp_path / "mesh_id=m%2F1").glob("part-*")} == whole_before
    assert [p.name for p in tmp_path.iterdir()] == ["mesh_id=m%2F1"]
    ply.write_ply_binary(str(tmp_path), v.limit(5))  # replaced as a whole
    left = b"".join(p.read_bytes() for p in sorted((tmp_path / "mesh_id=m%2F1").glob("part-*")))
    assert b"element vertex 5\n" in left and len(left.split(b"end_header\n", 1)[1]) == 5 * 24


def test_pieces_that_no_task_names_are_not_committed(tmp_path):
    """A repeated task leaves files of its first attempt; only those of its message become the document."""
    from posegrid.sources.pieces import PieceWriter, Written

    writer = PieceWriter(str(tmp_path), "doc_id", True)
    for attempt, data in ((1, b"stale"), (2, b"good")):
        folder = tmp_path / writer.job / str(attempt)
        folder.mkdir(parents=True)
        (folder / "00000000.bin").write_bytes(data)
    writer.commit([None, Written(0, [("d", str(tmp_path / writer.job / "2" / "00000000.bin"))])])
    assert [p.name for p in tmp_path.iterdir()] == ["doc_id=d"]
    assert (tmp_path / "doc_id=d" / "part-00000.bin").read_bytes() == b"good"


def test_bundles_of_small_documents(spark, tmp_path):
    """Files follow the size of the data, not the number of documents; ids, order and separators stay."""
    from posegrid.sources import mixed

    n = 500
    rows = [(f"r{i}" if i else None if k else 'a"b\n', k, f"n{i}\x1e{k}", i, None) for i in range(n) for k in (2, 0, 1)]
    m = spark.createDataFrame(rows, "route_id string, pos long, name string, begin_ms long, end_ms long")
    sinks.json_sequences(sinks.marker_lines(m), str(tmp_path / "out" / "0"))
    files = list((tmp_path / "out" / "0").rglob("part-*"))
    assert len(files) <= 8 and not list((tmp_path / "out").rglob("doc_id=*"))
    docs = mixed.read_sequences(spark, str(tmp_path / "out"))
    assert docs.count() == n + 1 and docs.where("kind = 'markers'").count() == n + 1
    got = {tuple(r) for r in mixed.markers(docs).collect()}
    # elements without a document id belong to no document
    assert got == {(f"r{i}", k, f"n{i}\x1e{k}", i, None) for i in range(1, n) for k in range(3)} | {('a"b\n', 0, "n0\x1e0", 0, None)}
    assert mixed.scenes(docs).count() == 0
    # splits of a file share no document
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        again = mixed.read_sequences(spark, str(tmp_path / "out"))
        assert again.count() == n + 1 and {tuple(r) for r in mixed.markers(again).collect()} == got
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_field_is_converted_once_and_no_field_copied_to_tell_its_kind(spark, tmp_path):
    """Filters that Spark infers for an explode converted a document's arrays two times more."""
    from posegrid.sources import mixed

    texts = {"scene": json.dumps(scene()), "bare": '{"views": 3}', "null": '{"views": null, "structure": []}',
             "named": '{"views": {"a": 1}}', "empty": '{"geometry": {"coordinates": []}}', "far": '{"geometry": "x"}',
             "log": '{"concatenated": [[1.0]]}', "other": '{"a": [1]}', "none": "{"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0").write_text("".join(
        f'{sinks.RECORD}{json.dumps({"doc_id": k})}\n{v}\n' for k, v in texts.items()))
    docs = mixed.read_sequences(spark, str(tmp_path / "in"))
    assert {r.doc_id: r.kind for r in docs.collect()} == {
        "scene": "scene", "bare": "scene", "null": "scene", "named": "scene", "empty": "track", "far": "track", "log": "log",
        "other": None, "none": None}
    real = docs.where("doc_id IN ('scene', 'null')")
    views, tracks = mixed.scenes(real), mixed.tracks(docs.where("doc_id = 'empty'"))
    assert (D.scene_views(views).count(), D.scene_points(views).count(), D.scene_poses(views).count()) == (7, 1, 7)
    assert D.track_points(tracks).count() == 0
    every = mixed.scenes(docs)
    for rows, field in ((D.scene_views(every), "views"), (D.view_ids(every), "views"), (D.scene_poses(every), "extrinsics"),
                        (D.scene_points(every), "structure"), (D.scene_intrinsics(every), "intrinsics"),
                        (D.route_frames(mixed.routes(docs)), "frames"), (D.route_lenses(mixed.routes(docs)), "frames"),
                        (D.track_points(mixed.tracks(docs)), "geometry"),
                        (D.transform_entries(mixed.transform_logs(docs)), "list")):
        plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
        found = [line for line in plan if re.search(rf"(?<!try_)variant_get\(doc#\d+, \$\.{field},", line)]
        assert len(found) == 1 and "Project" in found[0], field


def test_times_of_a_track_stay_with_their_points(spark):
    """Every point carried the list of all times of its track."""
    point, s = [1.0, 2.0, 3.0], "route_id string, geometry struct<coordinates: array<array<double>>>, properties struct<AbsoluteUtcMilliSec: array<bigint>>"
    rows = [("a", ([point] * 3,), ([7, 8],)), ("b", ([point] * 2,), ([7, None, 9],)), ("c", ([point] * 2,), (None,)),
            ("d", ([[*point, 4.0, 1.5]] * 2,), ([7],)), ("e", ([],), ([7],)), ("f", (None,), ([7],)), ("g", None, None)]
    tracks = D.track_points(spark.createDataFrame(rows, s))
    assert sorted((r.route_id, r.seq, r.ms) for r in tracks.where("route_id <> 'c' AND ms IS NOT NULL").collect()) == [
        ("a", 0, 7), ("a", 1, 8), ("b", 0, 7), ("d", 0, 4), ("d", 1, 4)]
    assert sorted((r.route_id, r.seq) for r in tracks.where("ms IS NULL").collect()) == [("b", 1), ("c", 0), ("c", 1)]
    plan = tracks._jdf.queryExecution().executedPlan().toString()
    kept = re.search(r"posexplode\(.*?\), \[(.*?)\], true", plan).group(1)
    assert "properties" not in kept and "_t#" not in kept


def test_products_of_long_logs_are_looped(spark):
    """Written out, the 4x4 product of two columns is longer than what the JVM compiles (8,000 bytes)."""
    rng = np.random.default_rng(3)
    m = rng.normal(size=(6, 2, 16))
    m[5, 1, 7] = np.nan
    rows = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(m)] + [(6, None, m[0, 0].tolist())]
    df = spark.createDataFrame(rows, "i int, a array<double>, b array<double>")
    got = df.select("i", L.matmul("a", "b", 4).alias("w"), L.matmul_loop("a", "b").alias("l")).orderBy("i").collect()
    for r in got[:6]:
        assert np.array_equal(r.w, r.l, equal_nan=True)
        assert np.allclose(r.l, (m[r.i, 0].reshape(4, 4) @ m[r.i, 1].reshape(4, 4)).ravel(), equal_nan=True)
    assert got[6].w == got[6].l == [None] * 16
    log = spark.createDataFrame([("s", i, a.tolist()) for i, (a, _) in enumerate(m[:3])],
                                "scene_id string, seq long, matrix array<double>")
    product = RG.concatenated(log).first().matrix
    x, y, z = (a.reshape(4, 4) for a in m[:3, 0])
    assert np.allclose(product, (z @ (y @ x)).ravel())
