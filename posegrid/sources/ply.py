"""PLY files: ASCII and binary ingest of many files, ASCII and binary output.

A file is read in byte ranges (``PIECE``), each by a task of its own. Where the ranges begin follows from the header
for records of one size; for lists of differing lengths and for ASCII a first pass, one task per file, streams over
the file and notes offsets, record numbers and triangle numbers. No task holds more than a range and a buffer.
Files smaller than a range are read by Spark itself, so these may be in any store it knows; ranges are read
through Arrow's file systems.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrid import schemas as S
from posegrid.sources.pieces import save_pieces, store_of
from posegrid.sources.sinks import text_documents

BYTE_ORDER = {"ascii": "", "binary_little_endian": "<", "binary_big_endian": ">"}
CHUNK = 100_000
#: bytes of a file that one task reads, and that the first pass has in hand
PIECE, BUFFER = 32 << 20, 4 << 20
POINT_COLUMNS = ["x", "y", "z", "nx", "ny", "nz", "red", "green", "blue"]
#: bytes of a file: (offset, length) to what is there
Read = Callable[[int, int], bytes]
#: begin, end, first record, records, first triangle
Mark = tuple[int, int, int, int, int]


def _header(read: Read):
    """Format, element list and data offset of a PLY file."""
    raw, size = b"", 1 << 14
    while True:
        raw = read(0, size)
        end = raw.find(b"end_header")
        if end >= 0 and (b"\n" in raw[end:] or len(raw) < size):
            break
        if len(raw) < size:
            raise ValueError("not a PLY file")
        size *= 4
    end = raw.find(b"\n", end) + 1 or len(raw)
    lines = [ln.split() for ln in raw[:end].decode("ascii").splitlines()]
    if not lines or lines[0] != ["ply"]:
        raise ValueError("not a PLY file")
    fmt, elements = None, []
    for ln in lines:
        if ln[:1] == ["format"]:
            fmt = ln[1]
        elif ln[:1] == ["element"]:
            elements.append((ln[1], int(ln[2]), []))
        elif ln[:1] == ["property"]:
            elements[-1][2].append(ln[1:])
    if fmt not in BYTE_ORDER:
        raise ValueError(f"unknown PLY format {fmt!r}")
    return fmt, elements, end


def _scalar(type_name: str, order: str):
    import numpy as np
    return np.dtype(order + S.PLY_TYPES[type_name])


def _is_list(prop: list) -> bool:
    return prop[0] == "list"


def _plain(props: list, order: str):
    """Record type of an element without lists."""
    import numpy as np
    return np.dtype([(p[1], _scalar(p[0], order or "<")) for p in props])


def _walk(raw: bytes, at: int, count: int, props: list, order: str) -> tuple[list[list], int]:
    """Records of a binary element with lists, one list of property values each, and the offset after it."""
    import numpy as np

    types = [(_scalar(p[1], order), _scalar(p[2], order)) if _is_list(p) else (None, _scalar(p[0], order))
             for p in props]
    rows = []
    for _ in range(count):
        row = []
        for counter, item in types:
            n = 1
            if counter is not None:
                n = int(np.frombuffer(raw, counter, 1, at)[0])
                at += counter.itemsize
            values = np.frombuffer(raw, item, n, at)
            at += n * item.itemsize
            row.append(values if counter is not None else values[0])
        rows.append(row)
    return rows, at


def _even(raw: bytes, at: int, count: int, props: list, order: str):
    """The same for the common case that every record has lists as long as the first one's: one typed array,
    or None if a record differs."""
    import numpy as np

    if not count:
        return None
    (first,), _ = _walk(raw, at, 1, props, order)
    fields = []
    for i, (p, v) in enumerate(zip(props, first)):
        if _is_list(p):
            fields += [(f"n{i}", _scalar(p[1], order)), (f"p{i}", _scalar(p[2], order), (len(v),))]
        else:
            fields.append((f"p{i}", _scalar(p[0], order)))
    kind = np.dtype(fields)
    if at + count * kind.itemsize > len(raw):
        return None
    rows = np.frombuffer(raw, kind, count, at)
    lists = [i for i, p in enumerate(props) if _is_list(p)]
    return rows if all((rows[f"n{i}"] == len(first[i])).all() for i in lists) else None


def _ascii_row(cells: list[bytes], props: list) -> list:
    import numpy as np

    row, at = [], 0
    for p in props:
        n = 1
        if _is_list(p):
            n, at = int(cells[at]), at + 1
        values = np.array(cells[at:at + n], dtype=float)
        if len(values) < n:
            raise ValueError("a record ends within a list")
        row.append(values if _is_list(p) else values[0])
        at += n
    return row


# ------------------------------------------------------------------ where records lie

def _corner_place(props: list) -> int | None:
    return next((i for i, p in enumerate(props) if _is_list(p) and p[3].startswith("vertex_ind")), None)


def _plain_marks(at: int, count: int, width: int, piece: int) -> Iterator[Mark]:
    """Ranges of records of one size."""
    step = max(1, piece // max(1, width))
    for first in range(0, count, step):
        n = min(step, count - first)
        yield at + first * width, at + (first + n) * width, first, n, first


def _list_marks(read: Read, at: int, count: int, props: list, order: str, piece: int, buffer: int) -> Iterator[Mark]:
    """Ranges of binary records with lists, by a walk over their counters. Runs of records whose lists are as long as
    the first one's are taken at once."""
    import numpy as np

    types = [(_scalar(p[1], order), _scalar(p[2], order).itemsize) if _is_list(p) else (None, _scalar(p[0], order).itemsize)
             for p in props]
    corners = _corner_place(props)
    held, base, pos, done = b"", at, 0, 0
    begin = (at, 0, 0)
    triangles = 0

    def shape() -> tuple[int, list[tuple[int, int]], int] | None:
        """Bytes of the record at ``pos``, its counters (offset, bytes) and its triangles; None if more is needed."""
        here, counters, fans = pos, [], 0
        for i, (counter, width) in enumerate(types):
            n = 1
            if counter is not None:
                if here + counter.itemsize > len(held):
                    return None
                n = int(np.frombuffer(held, counter, 1, here)[0])
                counters.append((here - pos, counter.itemsize))
                here += counter.itemsize
                if i == corners:
                    fans = max(0, n - 2)
            here += n * width
        return (here - pos, counters, fans) if here <= len(held) else None

    while done < count:
        found = shape()
        if found is None:
            more = read(base + len(held), buffer)
            if not more:
                raise ValueError(f"{count} records are declared, {done} are there")
            held, base, pos = held[pos:] + more, base + pos, 0
            continue
        width, counters, fans = found
        n = max(1, min((len(held) - pos) // max(1, width), count - done, max(1, buffer // max(1, width))))
        rows = np.frombuffer(held, np.uint8, n * width, pos).reshape(n, width)
        alike = np.ones(n, bool)
        for offset, size in counters:
            alike &= (rows[:, offset:offset + size] == rows[0, offset:offset + size]).all(axis=1)
        run = n if alike.all() else int(np.argmin(alike))
        pos, done, triangles = pos + run * width, done + run, triangles + run * fans
        if base + pos - begin[0] >= piece or done == count:
            yield begin[0], base + pos, begin[1], done - begin[1], begin[2]
            begin = (base + pos, done, triangles)


def _line_marks(read: Read, at: int, count: int, props: list, piece: int, buffer: int) -> Iterator[Mark]:
    """Ranges of ASCII records, one per line."""
    import numpy as np

    corners = _corner_place(props)
    held, base, done, triangles = b"", at, 0, 0
    begin = (at, 0, 0)
    while done < count:
        more = read(base + len(held), buffer)
        held += more
        cut = held.rfind(b"\n") + 1 if more else len(held)
        if not more and not held:
            raise ValueError(f"{count} records are declared, {done} are there")
        if not cut:
            continue
        lines = held[:cut]
        ends = np.flatnonzero(np.frombuffer(lines, np.uint8) == 10) + 1
        if not lines.endswith(b"\n"):
            ends = np.append(ends, len(lines))
        n = min(len(ends), count - done)
        cut = int(ends[n - 1])
        lines = lines[:cut]
        if corners is not None:
            rows = lines.splitlines()
            if corners == 0:
                triangles += sum(max(0, int(row.split(None, 1)[0]) - 2) for row in rows)
            else:
                triangles += sum(max(0, len(_ascii_row(row.split(), props)[corners]) - 2) for row in rows)
        held, base, done = held[cut:], base + cut, done + n
        if base - begin[0] >= piece or done == count:
            yield begin[0], base, begin[1], done - begin[1], begin[2]
            begin = (base, done, triangles)


def _marks(read: Read, want: str, piece: int, buffer: int) -> tuple[str, list, Iterator[Mark]] | None:
    """Format, properties and ranges of one element; None if the file lacks it."""
    fmt, elements, at = _header(read)
    order = BYTE_ORDER[fmt]
    for name, count, props in elements:
        if fmt == "ascii":
            marks = _line_marks(read, at, count, props, piece, buffer)
        elif any(map(_is_list, props)):
            marks = _list_marks(read, at, count, props, order, piece, buffer)
        else:
            marks = _plain_marks(at, count, _plain(props, order).itemsize, piece)
        if name == want:
            return fmt, props, marks
        for _, at, *_ in marks:  # on to its end
            pass
    return None


def _records(raw: bytes, fmt: str, props: list, count: int, want: str):
    """Vertices or triangles of a range as a structured array."""
    import numpy as np

    order = BYTE_ORDER[fmt]
    if fmt == "ascii":
        rows = [_ascii_row(ln.split(), props) for ln in raw.splitlines()[:count]]
        if len(rows) < count:
            raise ValueError(f"{count} records are declared, {len(rows)} are there")
        columns = [[r[i] for r in rows] if _is_list(p) else np.array([r[i] for r in rows], float)
                   for i, p in enumerate(props)]
    elif not any(map(_is_list, props)):
        rows = np.frombuffer(raw, _plain(props, order), count)
        columns = [rows[p[1]] for p in props]
    else:
        rows = _even(raw, 0, count, props, order)
        if rows is not None:
            columns = [rows[f"p{i}"] for i in range(len(props))]
        else:
            found, _ = _walk(raw, 0, count, props, order)
            columns = [[r[i] for r in found] if _is_list(p) else np.array([r[i] for r in found]) for i, p in enumerate(props)]
    if want != "face":
        out = np.empty(count, [(p[1], "f8") for p in props if not _is_list(p)])
        for p, c in zip(props, columns):
            if not _is_list(p):
                out[p[1]] = c
        return out
    textures = next((c for p, c in zip(props, columns) if _is_list(p) and p[3].startswith("tex")), None)
    return _triangles(columns[_corner_place(props)], textures)


def _triangles(corners, textures):
    """Polygons as fans of triangles about their first corner; a polygon of fewer than three corners has none.
    Texture coordinates (two per corner) follow their corners."""
    import numpy as np

    names = [("v1", "i8"), ("v2", "i8"), ("v3", "i8")] + [(f"uv{i}", "f8") for i in range(6)] * (textures is not None)
    sizes = np.array([len(c) for c in corners]) if len(corners) else np.empty(0, int)
    out = np.empty(int(np.maximum(sizes - 2, 0).sum()), names)
    if len(out) == len(sizes) and (sizes == 3).all() and len(out):
        flat = np.asarray(corners, "i8").reshape(-1, 3)
        out["v1"], out["v2"], out["v3"] = flat.T
        if textures is None:
            return out
        if all(len(t) == 6 for t in textures):
            for i, column in enumerate(np.asarray(textures, float).reshape(-1, 6).T):
                out[f"uv{i}"] = column
            return out
    at = 0
    for k, polygon in enumerate(corners):
        for i in range(1, len(polygon) - 1):
            out["v1"][at], out["v2"][at], out["v3"][at] = polygon[0], polygon[i], polygon[i + 1]
            if textures is not None:
                own = np.asarray(textures[k], float)
                full = len(own) == 2 * len(polygon)
                for j, corner in enumerate((0, i, i + 1)):
                    out[f"uv{2 * j}"][at] = own[2 * corner] if full else np.nan
                    out[f"uv{2 * j + 1}"][at] = own[2 * corner + 1] if full else np.nan
            at += 1
    return out


def _scan(spark: SparkSession, path: str, want: str, schema, shape, piece: int, buffer: int) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ply") \
        .option("recursiveFileLookup", True).load(path) \
        .withColumn("mesh_id", F.regexp_extract("path", r"([^/]+)\.ply$", 1))

    def rows(mesh_id: str, raw: bytes, fmt: str, props: list, mark: Mark):
        rec = _records(raw, fmt, props, mark[3], want)
        for lo in range(0, len(rec), CHUNK):
            yield shape(mesh_id, mark[4 if want == "face" else 2] + lo, rec[lo:lo + CHUNK])

    def whole(batches: Iterator) -> Iterator:
        for pdf in batches:
            for mesh_id, raw in zip(pdf["mesh_id"], pdf["content"]):
                raw = bytes(raw)
                found = _marks(lambda at, n: raw[at:at + n], want, piece, buffer)  # noqa: B023
                for mark in found[2] if found else ():
                    yield from rows(mesh_id, raw[mark[0]:mark[1]], *found[:2], mark)

    def index(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for name, mesh_id in zip(pdf["path"], pdf["mesh_id"]):
                with store_of(name) as f:
                    found = _marks(lambda at, n: f.read_at(min(n, max(0, f.size() - at)), at), want, piece, buffer)  # noqa: B023
                    for mark in found[2] if found else ():
                        yield pd.DataFrame([(name, mesh_id, found[0], json.dumps(found[1]), *mark)])

    def ranged(batches: Iterator) -> Iterator:
        for pdf in batches:
            for name, mesh_id, fmt, props, *mark in pdf.itertuples(index=False, name=None):
                with store_of(name) as f:
                    raw = f.read_at(mark[1] - mark[0], mark[0])
                yield from rows(mesh_id, raw, fmt, json.loads(props), mark)

    small = files.where(F.col("length") <= piece).select("mesh_id", "content").mapInPandas(whole, schema)
    large = files.where(F.col("length") > piece).select("path", "mesh_id", "length")
    size = large.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    if not size:
        return small
    marks = large.drop("length").mapInPandas(
        index, "path string, mesh_id string, fmt string, props string, begin long, end long, first long, n long, triangle long")
    # ranges are a few bytes each, so they are dealt by number and not by size
    return small.unionByName(marks.repartition(min(100_000, size // piece + 1)).mapInPandas(ranged, schema))


def read_vertices(spark: SparkSession, path: str, piece: int = PIECE, buffer: int = BUFFER) -> DataFrame:
    """Vertices of all PLY files below ``path``; a range of ``piece`` bytes is the unit of work."""
    def shape(mesh_id, lo, rec):
        import numpy as np
        import pandas as pd
        n = len(rec)
        out = {"mesh_id": mesh_id, "vid": np.arange(lo, lo + n, dtype="int64")}
        for c in POINT_COLUMNS:
            kind = "Int32" if c in ("red", "green", "blue") else "float64"
            out[c] = pd.Series(rec[c].astype("f8") if c in rec.dtype.names else [None] * n) \
                .astype(kind)
        return pd.DataFrame(out)
    return _scan(spark, path, "vertex", S.PLY_VERTICES, shape, piece, buffer)


def read_faces(spark: SparkSession, path: str, piece: int = PIECE, buffer: int = BUFFER) -> DataFrame:
    """Triangles of all PLY files, with texture coordinates where a file has them; polygons of more corners
    become fans of triangles, numbered in order."""
    def shape(mesh_id, lo, rec):
        import numpy as np
        import pandas as pd
        n = len(rec)
        uv = [f"uv{i}" for i in range(6)]
        has = all(c in rec.dtype.names for c in uv)
        tex = np.stack([rec[c].astype("f8") for c in uv], 1).tolist() if has else [None] * n
        return pd.DataFrame({"mesh_id": mesh_id, "fid": np.arange(lo, lo + n, dtype="int64"),
                             **{c: rec[c].astype("int64") for c in ("v1", "v2", "v3")},
                             "uv": tex})
    return _scan(spark, path, "face", S.PLY_FACES, shape, piece, buffer)


# ------------------------------------------------------------------ output

def _counts(vertices: DataFrame, faces: DataFrame | None) -> DataFrame:
    n = vertices.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("nv"))
    if faces is None:
        return n.withColumn("nf", F.lit(None).cast("bigint"))
    f = faces.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("nf"))
    return n.join(f, "mesh_id", "left").withColumn("nf", F.coalesce("nf", F.lit(0)))


def _header_text(fmt: str, columns: list[tuple[str, str]]):
    props = "".join(f"property {t} {c}\n" for c, t in columns)
    face = F.when(F.col("nf").isNotNull(), F.concat(
        F.lit("element face "), F.col("nf").cast("string"),
        F.lit("\nproperty list uchar int vertex_indices\n"))).otherwise(F.lit(""))
    return F.concat(F.lit(f"ply\nformat {fmt} 1.0\nelement vertex "), F.col("nv").cast("string"),
                    F.lit("\n" + props), face, F.lit("end_header"))


def _columns(vertices: DataFrame) -> list[tuple[str, str]]:
    return [(c, "uchar" if c in ("red", "green", "blue") else "double")
            for c in POINT_COLUMNS if c in vertices.columns]


def ply_lines(vertices: DataFrame, faces: DataFrame | None = None) -> DataFrame:
    """ASCII PLY as document lines ``doc_id, section, ord, value``."""
    cols = _columns(vertices)
    head = _counts(vertices, faces).select(
        F.col("mesh_id").alias("doc_id"), F.lit(0).alias("section"),
        F.lit(0).cast("bigint").alias("ord"), _header_text("ascii", cols).alias("value"))
    body = vertices.select(
        F.col("mesh_id").alias("doc_id"), F.lit(1).alias("section"),
        F.col("vid").cast("bigint").alias("ord"),
        F.concat_ws(" ", *[F.col(c).cast("string") for c, _ in cols]).alias("value"))
    out = head.unionByName(body)
    if faces is not None:
        out = out.unionByName(faces.select(
            F.col("mesh_id").alias("doc_id"), F.lit(2).alias("section"),
            F.col("fid").cast("bigint").alias("ord"),
            F.concat_ws(" ", F.lit("3"), *[F.col(c).cast("string") for c in ("v1", "v2", "v3")])
            .alias("value")))
    return out


def write_ply(path: str, vertices: DataFrame, faces: DataFrame | None = None) -> None:
    """One folder per mesh; its part files in name order are the ASCII PLY."""
    text_documents(ply_lines(vertices, faces), path)


def _binary_rows(vertices: DataFrame, faces: DataFrame | None, order: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``document, data``: headers and records as bytes, in the order that ``order`` gives the rows."""
    cols = _columns(vertices)
    head = _counts(vertices, faces).select(
        "mesh_id", F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("ord"),
        _header_text("binary_little_endian", cols).alias("head"))
    rows = head.unionByName(vertices.select(
        "mesh_id", F.lit(1).alias("section"), F.col("vid").cast("bigint").alias("ord"),
        *[F.col(c).cast("double") for c, _ in cols]), allowMissingColumns=True)
    if faces is not None:
        rows = rows.unionByName(faces.select(
            "mesh_id", F.lit(2).alias("section"), F.col("fid").cast("bigint").alias("ord"),
            *[F.col(c).cast("bigint") for c in ("v1", "v2", "v3")]), allowMissingColumns=True)
    names = [c for c, _ in cols]
    vt = [(c, "u1" if t == "uchar" else "<f8") for c, t in cols]
    ft = [("n", "u1"), ("v1", "<i4"), ("v2", "<i4"), ("v3", "<i4")]

    def packed(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            out = []
            for mesh_id, part in pdf.groupby("mesh_id", sort=False):
                for section, chunk in part.groupby("section", sort=True):
                    if section == 0:
                        out.append((str(mesh_id), "".join(h + "\n" for h in chunk["head"]).encode()))
                        continue
                    rec = np.zeros(len(chunk), dtype=vt if section == 1 else ft)
                    for c in names if section == 1 else ("v1", "v2", "v3"):
                        rec[c] = chunk[c].to_numpy()
                    if section == 2:
                        rec["n"] = 3
                    out.append((str(mesh_id), rec.tobytes()))
            yield pd.DataFrame(out, columns=["document", "data"])

    return order(rows).sortWithinPartitions("mesh_id", "section", "ord").mapInPandas(packed, "document string, data binary")


def write_ply_binary(path: str, vertices: DataFrame, faces: DataFrame | None = None) -> None:
    """Little-endian PLY in pieces: ``mesh_id=<id>/part-<n>.bin`` in name order.

    Records are range-partitioned by mesh and row, and each task writes its own pieces, so a large
    mesh is never held by one task. Pieces appear when all tasks have ended well; a mesh that is there
    already is replaced then.
    """
    save_pieces(_binary_rows(vertices, faces, lambda rows: rows.repartitionByRange("mesh_id", "section", "ord")),
                path, "mesh_id")


def write_ply_files(path: str, vertices: DataFrame, faces: DataFrame | None = None) -> None:
    """Little-endian PLY, one file ``<id>.ply`` per mesh, for many meshes that a task each can write.

    A mesh's rows go to one task, which sorts (and spills) them and streams them into the file."""
    save_pieces(_binary_rows(vertices, faces, lambda rows: rows.repartition("mesh_id")), path, "mesh_id", ".ply")
