"""File names, times, colours and small keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posegrid.functions.linalg import _c

LOG_ZONE = "Asia/Taipei"
LOG_FORMAT = "yyyy-MM-dd-HH-mm-ss"


def stem(filename) -> Column:
    """File name up to its first dot."""
    return F.substring_index(_c(filename), ".", 1)


def name_field(filename, i: int) -> Column:
    """``i``-th underscore-separated field of the stem."""
    return F.split(stem(filename), "_").getItem(i)


def frame_index(filename) -> Column:
    return name_field(filename, 0).cast("bigint")


def camera_index(filename) -> Column:
    return name_field(filename, 1).cast("int")


def is_mask(filename) -> Column:
    return _c(filename).contains("_mask")


def shared_prefix(low, high) -> Column:
    """Length of the common beginning of two names; of a group's first and last name in order, it is what
    all names of the group begin with."""
    low, high = _c(low), _c(high)
    least = F.least(F.length(low), F.length(high))
    return F.when(least > 0, F.size(F.filter(
        F.sequence(F.lit(1), least), lambda i: F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i)))
    ).otherwise(0)


def frame_seconds(idx, fps, ss) -> Column:
    return _c(idx) / _c(fps) + _c(ss)



def log_time(ts) -> Column:
    return F.date_format(F.from_utc_timestamp(_c(ts), LOG_ZONE), LOG_FORMAT)


def rainbow(i, n) -> Column:
    """``struct<red, green, blue>`` of stop ``i`` of ``n``: hue from 0 to 2/3 at full saturation."""
    i, n = _c(i), _c(n)
    third, two_thirds, sixth = 1.0 / 3.0, 2.0 / 3.0, 1.0 / 6.0
    hue = F.when(n > 1, two_thirds * i / (n - 1)).otherwise(F.lit(0.0))

    def channel(h: Column) -> Column:
        h = F.when(h < 0, h + 1).otherwise(h)
        v = (F.when(h < sixth, h * 6.0).when(h < 0.5, F.lit(1.0))
             .when(h < two_thirds, (two_thirds - h) * 6.0).otherwise(F.lit(0.0)))
        return F.floor(255 * v).cast("int")

    return F.struct(channel(hue + third).alias("red"), channel(hue).alias("green"),
                    channel(hue - third).alias("blue"))


def repository_base(path) -> Column:
    return F.regexp_replace(_c(path), "/", "_")


def repository_folder(base, tag) -> Column:
    return F.concat_ws("_", _c(base), _c(tag))


def slice_label(slice_no) -> Column:
    """Three-digit slice label."""
    s = _c(slice_no).cast("string")
    return F.when(F.length(s) < 3, F.lpad(s, 3, "0")).otherwise(s)


def hashed_name(filename, content) -> Column:
    """File name with a content hash before its extension."""
    f = _c(filename)
    return F.concat(F.regexp_replace(f, r"\.[^.]*$", ""), F.lit("_"), F.sha2(_c(content), 256),
                    F.regexp_extract(f, r"(\.[^.]*)$", 1))
