"""Building blocks that keep a single large group from becoming a single large task.

Every operator that needs an order, a per-group statistic or an exact order statistic goes
through this module, so that a route, scene or mesh holding a third of all rows is still spread
over many tasks:

* ``ordered``      ordered window results computed per *block* of the order column, stitched
                   together by one small row per block;
* ``bracket``      last knot before / first knot after each target (as-of matching, interpolation);
* ``attach``       join of one-row-per-key statistics back to the rows;
* ``order_stats``  exact nearest-rank or linear percentiles by histogram cells;
* ``smallest_sum`` exact sum of the k smallest values per key;
* ``checkpointed`` lineage cut in the shared checkpoint folder;
* ``stored``       the same as a table, for loops over many rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posegrid.functions.names import shared_prefix

#: rows per ordered block when the order column is a unique integer
BLOCK = 1 << 20
#: histogram cells per factor of two in ``order_stats``
CELLS_PER_OCTAVE = 1 << 16


# ------------------------------------------------------------------ lineage

def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and drop its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder. Unlike a checkpoint it is computed once, readers take the columns they
    need, and its size is known to joins, so that a small one is broadcast before the other side is shuffled."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which checkpoints use too; a plain local session without one gets its own."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="posegrid-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


# ------------------------------------------------------------------ ordered blocks

@dataclass(frozen=True)
class Line:
    """Rows of each ``keys`` group ordered by ``order`` and cut into blocks.

    The block number is ``floor(order[0] / width)``. For a unique integer order column a block
    therefore never holds more than ``width`` rows; for times, ``width`` bounds a block by the
    sampling rate of the sensor. ``blocks`` replaces that rule with explicit, order-preserving
    block expressions (for instance a prefix of a file name).
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    width: float = BLOCK
    blocks: tuple[Column, ...] | None = None
    #: column that orders block summaries where ``order`` has several columns; must decide between
    #: the rows whose values are carried
    carry_by: str | None = None

    def block_columns(self) -> list[Column]:
        if self.blocks is not None:
            return list(self.blocks)
        return [F.floor(F.col(self.order[0]) / F.lit(self.width))]


def line(keys: Sequence[str] | str, order: Sequence[str] | str, width: float = BLOCK,
         blocks: Sequence[Column] | None = None, carry_by: str | None = None) -> Line:
    as_tuple = lambda v: (v,) if isinstance(v, str) else tuple(v)
    return Line(as_tuple(keys), as_tuple(order), width, None if blocks is None else tuple(blocks),
                carry_by)


def ordered(df: DataFrame, ln: Line, *,
            position: str | None = None,
            size: str | None = None,
            prev: Mapping[str, str] | None = None,
            following: Mapping[str, str] | None = None,
            running: Mapping[str, str] | None = None,
            total: Mapping[str, str] | None = None,
            seen: Mapping[str, str] | None = None,
            ahead: Mapping[str, str] | None = None) -> DataFrame:
    """Ordered window columns over arbitrarily large groups.

    ``position``/``size``: 0-based dense position and group size. ``prev``/``following``: value one
    row back / on. ``running``/``total``: cumulative and overall sum. ``seen``/``ahead``: last
    non-null value at or before, first non-null value at or after the row. Mappings are
    ``{output column: input column}``.

    Windows run per (keys, block). What a block needs from its neighbours comes from one
    pre-aggregated row per block, so the only per-group task handles block rows, not data rows.
    Rows with a NULL key are a group, rows with a NULL order come first in theirs, as in plain
    windows.
    """
    prev, following, running = dict(prev or {}), dict(following or {}), dict(running or {})
    total, seen, ahead = dict(total or {}), dict(seen or {}), dict(ahead or {})
    keys, order = list(ln.keys), list(ln.order)
    names = [f"_b{i}" for i in range(len(ln.block_columns()))]
    # structs equal each other where their fields are NULL, so no row is lost in the join
    base = df.withColumn("_part", F.struct(F.struct(*keys).alias("keys"), *[
        c.alias(n) for n, c in zip(names, ln.block_columns())]))
    part = ["_part"]

    up = Window.partitionBy(*part).orderBy(*[F.col(c).asc() for c in order])
    down = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    to_here = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    inner: dict[str, Column] = {}
    if position or prev or following:
        inner["_rn"] = F.row_number().over(up)
    for out, src in prev.items():
        inner[f"_in_{out}"] = F.lag(src).over(up)
    if following:
        inner["_last"] = F.lead(F.lit(1)).over(up).isNull()
    for out, src in following.items():
        inner[f"_in_{out}"] = F.lead(src).over(up)
    for out, src in running.items():
        inner[f"_in_{out}"] = F.sum(src).over(to_here)
    for out, src in seen.items():
        inner[f"_in_{out}"] = F.last(src, ignorenulls=True).over(to_here)
    for out, src in ahead.items():
        inner[f"_in_{out}"] = F.last(src, ignorenulls=True).over(from_here)
    rows = base.withColumns(inner) if inner else base

    by = F.struct(ln.carry_by) if ln.carry_by else F.struct(*order)
    aggs: list[Column] = []
    if position or size:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    for out, src in prev.items():
        aggs.append(F.max_by(src, by).alias(f"_s_{out}"))
    for out, src in following.items():
        aggs.append(F.min_by(src, by).alias(f"_s_{out}"))
    for out, src in {**running, **total}.items():
        aggs.append(F.sum(src).alias(f"_s_{out}"))
    for out, src in seen.items():
        aggs.append(F.max_by(src, F.when(F.col(src).isNotNull(), by)).alias(f"_s_{out}"))
    for out, src in ahead.items():
        aggs.append(F.min_by(src, F.when(F.col(src).isNotNull(), by)).alias(f"_s_{out}"))
    summary = base.groupBy(*part).agg(*aggs)

    whole = Window.partitionBy("_part.keys")
    across = whole.orderBy(*[f"_part.{n}" for n in names])
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = whole.orderBy(*[F.col(f"_part.{n}").desc() for n in names]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry: dict[str, Column] = {}
    if position:
        carry["_c_pos"] = F.coalesce(F.sum("_n").over(before), F.lit(0))
    if size:
        carry["_c_size"] = F.sum("_n").over(whole)
    for out in prev:
        carry[f"_c_{out}"] = F.lag(f"_s_{out}").over(across)
    for out in following:
        carry[f"_c_{out}"] = F.lead(f"_s_{out}").over(across)
    for out in running:
        carry[f"_c_{out}"] = F.sum(f"_s_{out}").over(before)
    for out in total:
        carry[f"_c_{out}"] = F.sum(f"_s_{out}").over(whole)
    for out in seen:
        carry[f"_c_{out}"] = F.last(f"_s_{out}", ignorenulls=True).over(before)
    for out in ahead:
        carry[f"_c_{out}"] = F.last(f"_s_{out}", ignorenulls=True).over(after)
    stitched = summary.withColumns(carry).select(*part, *carry.keys())
    joined = rows.join(stitched, part)

    result: dict[str, Column] = {}
    if position:
        result[position] = F.col("_c_pos") + F.col("_rn") - 1
    if size:
        result[size] = F.col("_c_size")
    for out in prev:
        result[out] = F.when(F.col("_rn") == 1, F.col(f"_c_{out}")).otherwise(F.col(f"_in_{out}"))
    for out in following:
        result[out] = F.when(F.col("_last"), F.col(f"_c_{out}")).otherwise(F.col(f"_in_{out}"))
    for out in running:
        result[out] = F.coalesce(F.col(f"_c_{out}"), F.lit(0)) + F.col(f"_in_{out}")
    for out in total:
        result[out] = F.col(f"_c_{out}")
    for out in [*seen, *ahead]:
        result[out] = F.coalesce(F.col(f"_in_{out}"), F.col(f"_c_{out}"))
    done = joined.withColumns(result)
    extra = [c for c in result if c not in df.columns]
    return done.select(*df.columns, *extra)


def bracket(targets: DataFrame, knots: DataFrame, keys: Sequence[str], time: str,
            payload: Sequence[str], width: float) -> DataFrame:
    """For each target row the last knot at or before it (``prev_*``) and the first knot strictly
    after it (``next_*``).

    Knots must have one row per (keys, time) and non-null payload. Both sides are merged on one
    time line, so no target/knot pairs are formed.
    """
    cols = [time, *[c for c in payload if c != time]]
    k = knots.select(*keys, F.col(time), F.lit(0).alias("_kind"),
                     *[F.col(c).alias(f"_k_{c}") for c in cols])
    merged = targets.withColumn("_kind", F.lit(1)).unionByName(k, allowMissingColumns=True)
    out = ordered(merged, line(keys, (time, "_kind"), width, carry_by=time),
                  seen={f"prev_{c}": f"_k_{c}" for c in cols},
                  ahead={f"next_{c}": f"_k_{c}" for c in cols})
    return out.filter("_kind = 1").drop("_kind", *[f"_k_{c}" for c in cols])


def name_blocks(df: DataFrame, keys: Sequence[str], name: str, digits: int = 3) -> DataFrame:
    """``df`` with ``_block``: the ``digits`` characters of a name after what all names of its group share,
    so that names with a long common beginning still fall into many blocks, in name order."""
    ends = df.groupBy(*keys).agg(F.min(name).alias("_low"), F.max(name).alias("_high"))
    shared = ends.select(*keys, shared_prefix("_low", "_high").alias("_shared"))
    at = F.coalesce("_shared", F.lit(0)) + 1
    return attach(df, shared, keys, "left").withColumn(
        "_block", F.substring(F.col(name), at, F.lit(digits))).select(*df.columns, "_block")


# ------------------------------------------------------------------ statistics back to rows

def attach(fact: DataFrame, stats: DataFrame, keys: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Join per-key ``stats`` (one row per key) to ``fact``.

    A plain equi-join: adaptive execution broadcasts a small side and splits the partitions of hot
    keys, from the sizes that the shuffle has measured.
    """
    return fact.join(stats, [keys] if isinstance(keys, str) else list(keys), how)


# ------------------------------------------------------------------ exact order statistics

def value_cell(v: Column, per_octave: int = CELLS_PER_OCTAVE) -> Column:
    """Integer that never decreases as ``v`` grows; one octave has ``per_octave`` cells."""
    mag = F.floor(F.log2(F.abs(v)) * per_octave) + F.lit(1200 * per_octave)
    return F.when(v == 0, F.lit(0)).when(v > 0, mag).otherwise(-mag).cast("bigint")


def order_stats(df: DataFrame, keys: Sequence[str] | str, value: str,
                wanted: Mapping[str, float | Callable[[Column], Column]],
                mode: str = "nearest", per_octave: int = CELLS_PER_OCTAVE,
                keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Exact percentiles per key: one row per key with ``n`` and one column per wanted fraction.

    ``nearest`` takes the row at ``rint(q * (n - 1))`` (half to even); ``linear`` interpolates. A
    callable maps the row count of a key to a 0-based rank instead. A histogram over value cells locates the cell of each rank; only rows of those cells are
    ordered. Equal values are merged before the shuffle, so ties cost nothing. Fewer cells ``per_octave`` make a
    smaller histogram and more rows in the cells of the ranks; ``keep`` (``stored``) materialises these cells, one
    row per key and rank, so that a small number of them is broadcast.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    slim = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v")) \
        .withColumn("_cell", F.coalesce(value_cell(F.col("_v"), per_octave), F.lit(0).cast("bigint")))
    # a cell that can't be NULL needs no filter in the join below, which would spell out the value several times
    hist = slim.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_cell")
    hist = hist.withColumns({
        "_before": F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)),
        "_total": F.sum("_n").over(Window.partitionBy(*keys))})
    ranks = []
    for name, q in wanted.items():
        at = q(F.col("_total")) if callable(q) else F.lit(float(q)) * (F.col("_total") - 1)
        if mode == "nearest":
            ranks.append((name, F.rint(at).cast("bigint"), F.lit(1.0)))
        else:
            frac = at - F.floor(at)
            ranks.append((f"{name}_lo", F.floor(at), 1.0 - frac))
            ranks.append((f"{name}_hi", F.ceil(at), frac))
    wants = F.array(*[F.struct(F.lit(n).alias("what"), r.cast("bigint").alias("rank"),
                               wt.alias("share")) for n, r, wt in ranks])
    targets = hist.withColumn("_w", F.explode(wants)) \
        .filter((F.col("_w.rank") >= F.col("_before")) &
                (F.col("_w.rank") < F.col("_before") + F.col("_n"))) \
        .select(*keys, "_cell", F.col("_total").alias("n"), F.col("_w.what").alias("_what"),
                F.col("_w.share").alias("_share"),
                (F.col("_w.rank") - F.col("_before")).alias("_k"))
    targets = keep(targets)
    cells = targets.select(*keys, "_cell").distinct()
    values = slim.join(cells, [*keys, "_cell"], "left_semi") \
        .groupBy(*keys, "_cell", "_v").agg(F.count(F.lit(1)).alias("_m"))
    wc = Window.partitionBy(*keys, "_cell").orderBy("_v")
    values = values.withColumn("_upto", F.sum("_m").over(
        wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    picked = targets.join(values, [*keys, "_cell"]) \
        .filter((F.col("_k") < F.col("_upto")) & (F.col("_k") >= F.col("_upto") - F.col("_m")))
    outs = [F.sum(F.when(F.col("_what").isin(name, f"{name}_lo", f"{name}_hi"),
                         F.col("_v") * F.col("_share"))).alias(name) for name in wanted]
    return picked.groupBy(*keys).agg(F.max("n").alias("n"), *outs)


def smallest_sum(df: DataFrame, keys: Sequence[str], value: str, k: str, out: str) -> DataFrame:
    """Exact sum of the ``k`` smallest values per key (``k`` is a column, constant per key)."""
    keys = list(keys)
    slim = df.select(*keys, F.col(value).alias("_v"), F.col(k).alias("_k")) \
        .withColumn("_cell", value_cell(F.col("_v")))
    hist = slim.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_s"),
                                            F.max("_k").alias("_k"))
    w = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    full = hist.filter(F.col("_before") + F.col("_n") <= F.col("_k")) \
        .groupBy(*keys).agg(F.sum("_s").alias("_full"))
    edge = hist.filter((F.col("_before") < F.col("_k")) &
                       (F.col("_before") + F.col("_n") > F.col("_k"))) \
        .select(*keys, "_cell", (F.col("_k") - F.col("_before")).alias("_need"))
    vals = slim.join(edge, [*keys, "_cell"]).groupBy(*keys, "_cell", "_v") \
        .agg(F.count(F.lit(1)).alias("_m"), F.max("_need").alias("_need"))
    we = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, -1)
    part = vals.withColumn("_done", F.coalesce(F.sum("_m").over(we), F.lit(0))) \
        .groupBy(*keys).agg(F.sum(F.col("_v") * F.greatest(
            F.lit(0), F.least(F.col("_m"), F.col("_need") - F.col("_done")))).alias("_part"))
    every = hist.select(*keys).distinct()
    return every.join(full, keys, "left").join(part, keys, "left").select(
        *keys, (F.coalesce("_full", F.lit(0.0)) + F.coalesce("_part", F.lit(0.0))).alias(out))


# ------------------------------------------------------------------ finite-state scan

def _composed_prefixes(steps: np.ndarray) -> np.ndarray:
    """Row i: the table of all steps up to i, by doubling (log rounds of whole-array operations)."""
    done, reach = steps.copy(), 1
    while reach < len(done):
        done = np.concatenate((done[:reach], np.take_along_axis(done[reach:], done[:-reach], 1)))
        reach *= 2
    return done


def state_scan(df: DataFrame, keys: Sequence[str], pos: str, steps: Sequence[str], start: str,
               out: str, width: int = 1 << 16) -> DataFrame:
    """State after each row of an ordered chain with a handful of states.

    ``steps[s]`` is the state a row moves to from state ``s``; ``start`` (constant per key) is the
    state before the first row. Step tables compose associatively, so each block is reduced to one
    composed table, blocks are chained per key on those few rows, and each block is then replayed
    from its own entry state. ``keys`` and ``pos`` must be unique; ``pos`` is an integer.
    """
    import pandas as pd

    keys, steps = list(keys), list(steps)
    n_states = len(steps)
    slim = df.select(*keys, F.col(pos).alias("_p"), F.col(start).cast("int").alias("_start"),
                     *[F.col(s).cast("int").alias(f"_t{i}") for i, s in enumerate(steps)]) \
        .withColumn("_blk", F.floor(F.col("_p") / F.lit(width)))
    tables = [f"_t{i}" for i in range(n_states)]
    key_ddl = ", ".join(f"{k} {slim.schema[k].dataType.simpleString()}" for k in keys)

    def reduce_block(pdf: pd.DataFrame) -> pd.DataFrame:
        # neighbouring step tables are composed pairwise until one is left
        pdf = pdf.sort_values("_p")
        steps_of = pdf[tables].to_numpy()
        while len(steps_of) > 1:
            odd = steps_of[len(steps_of) // 2 * 2:]
            steps_of = np.concatenate((np.take_along_axis(
                steps_of[1::2], steps_of[:len(steps_of) // 2 * 2:2], 1), odd))
        return pdf.iloc[:1][[*keys, "_blk", "_start"]].assign(
            **{t: steps_of[0, i] for i, t in enumerate(tables)})

    def chain_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        upto = _composed_prefixes(pdf[tables].to_numpy())
        start = int(pdf["_start"].iloc[0])
        return pdf[[*keys, "_blk"]].assign(_entry=np.concatenate(([start], upto[:-1, start])))

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_p")
        upto = _composed_prefixes(pdf[tables].to_numpy())
        return pdf[[*keys, "_p"]].assign(_state=upto[:, int(pdf["_entry"].iloc[0])])

    table_ddl = ", ".join(f"{t} int" for t in tables)
    composed = slim.groupBy(*keys, "_blk").applyInPandas(
        reduce_block, f"{key_ddl}, _blk bigint, _start int, {table_ddl}")
    entries = composed.groupBy(*keys).applyInPandas(chain_blocks,
                                                    f"{key_ddl}, _blk bigint, _entry int")
    states = slim.join(entries, [*keys, "_blk"]).groupBy(*keys, "_blk").applyInPandas(
        replay, f"{key_ddl}, _p bigint, _state int")
    return df.join(states.withColumnsRenamed({"_p": pos, "_state": out}), [*keys, pos])
