"""Explicit schemas of every document and table as DDL text; nothing is inferred."""

from __future__ import annotations


def _struct(text: str) -> str:
    return " ".join(text.split())


# --- documents -----------------------------------------------------------------------------

SCENE_DOCUMENT = _struct("""
    sfm_data_version string, root_path string,
    views array<struct<key: bigint, value: struct<polymorphic_id: bigint, ptr_wrapper: struct<
        id: bigint, data: struct<local_path: string, filename: string, width: int, height: int,
        id_view: bigint, id_intrinsic: bigint, id_pose: bigint>>>>>,
    intrinsics array<struct<key: bigint, value: struct<polymorphic_id: bigint,
        polymorphic_name: string, ptr_wrapper: struct<id: bigint, data: struct<
        value0: struct<width: int, height: int>>>>>>,
    extrinsics array<struct<key: bigint, value: struct<rotation: array<array<double>>,
        center: array<double>, footprint: array<double>>>>,
    structure array<struct<key: bigint, value: struct<X: array<double>>>>
""")

ROUTE_DOCUMENT = _struct("""
    is_scene boolean, video string, last_overwritten string,
    slice_beg_timestamp double, slice_end_timestamp double,
    frames array<struct<dir: string, slice: int, frame_idx: bigint, timestamp: double,
        filenames: array<string>, lense_positions: array<array<double>>,
        lense_rotations: array<array<array<double>>>, lense_footprints: array<array<double>>,
        position: array<double>, rotation: array<array<double>>, footprint: array<double>>>,
    dir string, position array<double>, rotation array<array<double>>
""")

TRACK_DOCUMENT = _struct("""
    type string, geometry struct<type: string, coordinates: array<array<double>>>,
    properties struct<AbsoluteUtcMilliSec: array<bigint>, RelativeMilliSec: array<bigint>,
        video: string>
""")

MARKER_ENTRY = "struct<name: string, begin: bigint, `end`: bigint>"

TRANSFORM_LOG = _struct("""
    concatenated array<array<double>>,
    list array<struct<matrix: array<array<double>>, timestamp: string, note: string>>
""")

TRAJECTORY_COLUMNS = ("t_ms", "x", "y", "z", "qx", "qy", "qz", "qw")

# --- flat tables ---------------------------------------------------------------------------

POINT = "struct<x: double, y: double, z: double>"

VIEWS = _struct("scene_id string, view_key bigint, pos int, filename string, width int, height int, "
                "id_view bigint, id_intrinsic bigint, id_pose bigint")
POSES = _struct(f"scene_id string, pose_key bigint, rotation array<double>, center {POINT}, "
                f"footprint {POINT}")
ROUTE_TREE = _struct("root string, route_id string, parent_id string, depth int, path string, "
                     "parent_slice int, own_slice int")
PLY_VERTICES = _struct("mesh_id string, vid bigint, x double, y double, z double, nx double, "
                       "ny double, nz double, red int, green int, blue int")
PLY_FACES = _struct("mesh_id string, fid bigint, v1 bigint, v2 bigint, v3 bigint, "
                    "uv array<double>")

#: PLY scalar type names and their numpy codes (fixed values of the file format)
PLY_TYPES = {
    "int8": "i1", "char": "i1", "uint8": "u1", "uchar": "u1",
    "int16": "i2", "short": "i2", "uint16": "u2", "ushort": "u2",
    "int32": "i4", "int": "i4", "uint32": "u4", "uint": "u4",
    "float32": "f4", "float": "f4", "float64": "f8", "double": "f8",
}
