"""Operator 3: near duplicates by SimHash fingerprints and vantage-point trees.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 1 bit of one of their halves. So
each half has a vantage-point tree: an inner node holds a vantage code and a radius; codes within the radius
of the vantage live inside, the others outside. A code lives in one leaf, its home. Besides it visits every
leaf that could be home to a code within the search distance: the triangle bound prunes a side when the
code's distance to the vantage lies farther from the radius than that. Visiting is needed one way only
(what lives outside visits inside), which finds each pair once in a tree.

The trees are built on the driver from a bounded sample of codes (the ``SAMPLE`` smallest hashes) and shape
only how the work is dealt: every code is routed, whatever the sample. A leaf is a shard, one group of a
shuffle. Shards far over their expected size (many codes close together) are split into blocks of homes
that all visitors pass, and within a task a large shard is searched by a tree of its own. A shard returns
not all its links but a lightest spanning forest of them, so a dense group gives fewer rows than it has
codes. Distinct codes are compared, never rows; copies share a code.

For documents with five-word shingle similarity of at least 0.8 (``near_copies``) fingerprints miss too much.
That join is exact: the shingles of a text are put in one order that all texts share (rare ones
first, as a table of fixed size counts them over all texts; then by hash), and two sets this similar share a shingle of the first fifth of each. Texts that meet in
such a shingle are candidates; sizes and places rule out some, the exact similarity of the two whole texts
decides the others. Classes need not every pair of a dense group: at first the links of fingerprints, found in the
trees as above, and each text's neighbours under the shingles are confirmed, then every pair of texts that meet and are of different classes. A pair that
could be similar goes unread only when links join it already.

Results for odd inputs: a null, empty or blank text has the fingerprint zero, and all such texts are linked; a
text with fewer words than a shingle is one shingle; texts of any length are hashed whole; repeated rows
share a class; an empty table gives an empty table; a null id is in the class of its text and names it only
if no other id does; columns called like the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posegrid.llm.common import cut, shards_for, without, written
from posegrid.llm.components import components

SEED = 42
MAX_BITS = 3
#: codes on the driver that shape the trees, and homes expected in a shard
SAMPLE = 32_768
PER_SHARD = 4096
#: times the expected homes from which a shard is split into blocks, and homes compared without a local tree
SPLIT_FROM = 8
BRUTE = 4096
#: counters that order the shingles of a corpus of any size, how many are added at once, and into how many parts tasks
#: are dealt to add them; the order decides how many candidates there are, not which pairs are linked
COUNTERS = 1 << 22
PIECE = 1 << 16
PARTS = 64
_SLICE = 1 << 15


# ------------------------------------------------------------------ fingerprints

def shingle_hashes(words: Sequence[bytes], width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of all runs of ``width`` words, joined by spaces; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    text = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(text, seed)], np.uint64)
    begin = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[b:e - 1], seed) for b, e in zip(begin, begin[width:])), np.uint64,
                       len(words) - width + 1)


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bits are those set in over half of ``hashes``."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _SLICE):
        part = np.ascontiguousarray(hashes[i:i + _SLICE], "<u8").view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return sum(1 << int(k) for k in np.nonzero(2 * counts > len(hashes))[0])


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(text: Column, width: int = 3) -> Column:
    """The 64-bit fingerprint of a text column, as a signed long."""
    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            codes = [majority_bits(shingle_hashes(words_of(t.as_py()), width)) for t in batch]
            yield pa.array(np.array(codes, np.uint64).view(np.int64))

    return prints(F.coalesce(text, F.lit("")))


# ------------------------------------------------------------------ vantage-point trees

@dataclass
class Tree:
    """Arrays over nodes; ``inside``/``outside`` are nodes, or leaves as -1 - leaf."""

    vantage: np.ndarray
    radius: np.ndarray
    inside: np.ndarray
    outside: np.ndarray
    leaves: int


def build_tree(codes: np.ndarray, leaves: int, reach: int) -> Tree:
    """A tree of about ``leaves`` leaves that deals ``codes`` (uint32) evenly.

    Of a few vantages the one is taken whose larger side, with the codes that would visit, is smallest.
    """
    nodes: list[list[int]] = []
    count = 0
    least = max(2, len(codes) // max(1, leaves))

    def grow(part: np.ndarray, depth: int) -> int:
        nonlocal count
        best = None
        if len(part) > least and depth < 48:
            for k in range(5):
                v = part[(k * 7919 + depth * 104729) % len(part)]
                sizes = np.cumsum(np.bincount(np.bitwise_count(part ^ v), minlength=33 + reach))
                for mu in range(32):
                    inner = int(sizes[mu])
                    if 0 < inner < len(part):
                        cost = max(int(sizes[mu + reach]), len(part) - inner) + int(sizes[mu + reach]) - inner
                        if best is None or cost < best[0]:
                            best = (cost, int(v), mu)
        if best is None or best[0] >= 2 * len(part):
            count += 1
            return -count
        node = len(nodes)
        nodes.append([best[1], best[2], 0, 0])
        near = np.bitwise_count(part ^ np.uint32(best[1])) <= best[2]
        nodes[node][2] = grow(part[near], depth + 1)
        nodes[node][3] = grow(part[~near], depth + 1)
        return node

    grow(codes, 0)
    table = np.array(nodes, np.int64).reshape(-1, 4)
    return Tree(table[:, 0].astype(np.uint32), table[:, 1], table[:, 2], table[:, 3], max(1, count))


def route(codes: np.ndarray, tree: Tree, reach: int, homes: np.ndarray | None = None
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, whether at home) of every leaf in which a code lives or which it visits.

    ``homes`` marks the rows that live somewhere; the others only visit, on both sides.
    """
    rows = np.arange(len(codes))
    living = rows if homes is None else rows[homes]
    guests = rows[:0] if homes is None else rows[~homes]
    out: list[tuple[np.ndarray, int, bool]] = []
    stack = [(0 if len(tree.vantage) else -1, living, guests)]
    while stack:
        node, living, guests = stack.pop()
        if not len(living) + len(guests):
            continue
        if node < 0:
            out += [(living, -1 - node, True), (guests, -1 - node, False)]
            continue
        far = np.bitwise_count(codes[living] ^ tree.vantage[node]).astype(np.int64) - tree.radius[node]
        away = np.bitwise_count(codes[guests] ^ tree.vantage[node]).astype(np.int64) - tree.radius[node]
        visitors = living[(far > 0) & (far <= reach)]
        stack.append((int(tree.inside[node]), living[far <= 0],
                      np.concatenate((guests[away <= reach], visitors))))
        stack.append((int(tree.outside[node]), living[far > 0], guests[away > -reach]))
    return (np.concatenate([r for r, _, _ in out]) if out else rows[:0],
            np.concatenate([np.full(len(r), leaf) for r, leaf, _ in out]) if out else rows[:0],
            np.concatenate([np.full(len(r), h) for r, _, h in out]) if out else np.empty(0, bool))


class Forest:
    """The lightest spanning forest of the links met so far and the ``near`` lightest links of each row; holds
    at most ``1 + near`` links a row, and those of the last blocks."""

    def __init__(self, size: int, near: int = 0, most: int = 1 << 20):
        self.size, self.near, self.most = size, near, most
        self.links = [np.empty((0, 3), np.int64)]
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> None:
        self.links.append(np.stack((a, b, weight), axis=1).astype(np.int64))
        self.waiting += len(a)
        if self.waiting > self.most:
            self.reduce()

    def reduce(self) -> np.ndarray:
        """Boruvka's rounds: every component takes its lightest link out (ties by the link's place)."""
        links = np.concatenate(self.links)
        links = links[np.lexsort((links[:, 1], links[:, 0], links[:, 2]))]
        label, kept = np.arange(self.size), []
        open_ = links
        while len(open_):
            x, y = label[open_[:, 0]], label[open_[:, 1]]
            apart = x != y
            open_, x, y = open_[apart], x[apart], y[apart]
            first = np.full(self.size, len(open_))
            np.minimum.at(first, x, np.arange(len(open_)))
            np.minimum.at(first, y, np.arange(len(open_)))
            picked = np.unique(first[first < len(open_)])
            kept.append(open_[picked])
            up = np.arange(self.size)
            for i, j in zip(x[picked].tolist(), y[picked].tolist()):
                while up[i] != i:
                    up[i] = i = up[up[i]]
                while up[j] != j:
                    up[j] = j = up[up[j]]
                up[max(i, j)] = min(i, j)
            while (up != up[up]).any():
                up = up[up]
            label = up[label]
        if self.near and len(links):
            # the links of a row in order of weight, whichever of their ends it is
            row = np.concatenate((links[:, 0], links[:, 1]))
            order = np.lexsort((np.tile(np.arange(len(links)), 2), row))
            begin = np.searchsorted(row[order], row[order], side="left")
            kept.append(links[order[np.arange(len(order)) - begin < self.near] % len(links)])
        out = np.unique(np.concatenate(kept), axis=0) if kept else np.empty((0, 3), np.int64)
        self.links, self.waiting = [out], 0
        return out


#: of pairs of rows: the weight of their link, and whether they are linked
Weigh = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def link_shard(codes: np.ndarray, homes: np.ndarray, half: int, max_bits: int, weigh: Weigh | None,
               forest: Forest, rows: np.ndarray | None = None) -> None:
    """Add to ``forest`` all linked pairs of a shard of which at least one lives there."""
    rows = np.arange(len(codes)) if rows is None else rows
    living = rows[homes[rows]]
    if len(living) > BRUTE:
        halves = (codes[rows] >> np.uint64(32 * half)).astype(np.uint32)
        own = halves[homes[rows]]
        tree = build_tree(own[:: max(1, len(own) // SAMPLE)], shards_for(len(living), BRUTE // 2), _reach(max_bits))
        if tree.leaves > 1:
            at, leaf, home = route(halves, tree, _reach(max_bits), homes[rows])
            order = np.argsort(leaf, kind="stable")
            for part in np.split(order, np.nonzero(np.diff(leaf[order]))[0] + 1):
                inner = np.zeros(len(codes), bool)
                inner[rows[at[part][home[part]]]] = True
                _all_pairs(codes, rows[at[part]], inner, max_bits, weigh, forest)
            return
    _all_pairs(codes, rows, homes, max_bits, weigh, forest)


def _all_pairs(codes, rows, homes, max_bits, weigh, forest) -> None:
    living = rows[homes[rows]]
    for i in range(0, len(living), 512):
        block = living[i:i + 512]
        bits = np.bitwise_count(codes[block][:, None] ^ codes[rows][None, :])
        a, b = np.nonzero(bits <= max_bits)
        weight = bits[a, b]
        a, b = block[a], rows[b]
        # two that both live here meet twice
        once = (a < b) | ~homes[b]
        a, b, weight = a[once], b[once], weight[once]
        for k in range(0, len(a), 1 << 18):
            x, y, w = (v[k:k + (1 << 18)] for v in (a, b, weight))
            if weigh is not None:
                w, good = weigh(x, y)
                x, y, w = x[good], y[good], w[good]
            forest.add(x, y, w)


def _reach(max_bits: int) -> int:
    """Bits in which the nearer half of two linked codes can differ."""
    return max_bits // 2


# ------------------------------------------------------------------ links of all codes

def forest_edges(codes: DataFrame, max_bits: int = MAX_BITS, sign_limit: int | None = None,
                 near: int = 0, per_shard: int | None = None) -> DataFrame:
    """``a, b``: links between rows of ``codes`` whose components are those of all links. Of the links of a
    shard those with the least differing bits are taken, and the ``near`` lightest of each row besides.

    ``codes``: key long (distinct), codes array<long> (a pair is linked if any of its codes are) and signs
    binary (compared if ``sign_limit`` is set: at most that many bits may differ).
    """
    reach = _reach(max_bits)
    per_shard = per_shard or PER_SHARD
    size = codes.count()
    views = codes.select(F.size("codes").alias("n")).agg(F.max("n")).first()[0] or 0
    sample = np.array([r[0] for r in codes.orderBy(F.xxhash64("key", F.lit(3)), "key").limit(SAMPLE)
                       .select("codes").collect()], np.int64).view(np.uint64).reshape(-1, views) if views else None
    leaves = min(shards_for(size, per_shard), max(1, SAMPLE // 8))
    trees = [build_tree((sample[:, v] >> np.uint64(32 * h)).astype(np.uint32), leaves, reach)
             for v in range(views) for h in (0, 1)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.ascontiguousarray(batch["codes"].flatten().to_numpy(zero_copy_only=False)).view(
                np.uint64).reshape(batch.num_rows, -1)
            for t, tree in enumerate(trees):
                full = own[:, t // 2]
                at, leaf, home = route((full >> np.uint64(32 * (t % 2))).astype(np.uint32), tree, reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.int64(t) << 32) + leaf, pa.int64()), batch["key"].take(pa.array(at)),
                     pa.array(full[at].view(np.int64)), pa.array(home), batch["signs"].take(pa.array(at))],
                    names=["shard", "key", "code", "home", "signs"])

    dealt = codes.select("key", "codes", "signs").mapInArrow(
        deal, "shard long, key long, code long, home boolean, signs binary")
    # crowded shards: homes in blocks, everybody else passes all of them, a home those before its own
    # (at most one row per leaf, as a table of known size)
    most = SPLIT_FROM * per_shard
    crowded = written(dealt.where("home").groupBy("shard").agg(F.count(F.lit(1)).alias("homes"))
                      .where(F.col("homes") > most)
                      .select("shard", F.ceil(F.col("homes") / most).cast("int").alias("blocks")))
    own_block = F.when(F.col("home"), F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).otherwise(F.col("blocks") - 1)
    spread = (dealt.join(crowded, "shard", "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own_block)
              .select("shard", "key", "code", "signs", "home", "own", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("block"))
              .select("shard", "block", "key", "code", "signs", (F.col("home") & (F.col("block") == F.col("own"))).alias("home")))

    def search(shard: pa.Table) -> pa.Table:
        full = shard["code"].to_numpy().view(np.uint64)
        homes = shard["home"].to_numpy(zero_copy_only=False).astype(bool)
        key = shard["key"].to_numpy()
        weigh = None
        if sign_limit is not None:
            signs = np.frombuffer(b"".join(shard["signs"].to_pylist()), "<u8").reshape(len(full), -1)

            def weigh(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                apart = np.bitwise_count(signs[a] ^ signs[b]).sum(1, dtype=np.int64)
                return apart, apart <= sign_limit

        forest = Forest(len(full), near)
        link_shard(full, homes, (shard["shard"][0].as_py() >> 32) % 2, max_bits, weigh, forest)
        links = forest.reduce()
        return pa.table({"a": pa.array(key[links[:, 0]], pa.int64()), "b": pa.array(key[links[:, 1]], pa.int64())})

    return spread.groupBy("shard", "block").applyInArrow(search, "a long, b long").where("a <> b")


def _classes(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """key, root (the smallest key of its component) and component_id (the smallest id of its component).

    ``reps``: key, first (the smallest id of the key)."""
    rooted = reps.join(components(edges).withColumnRenamed("node", "key"), "key", "left").select(
        "key", "first", F.coalesce("root", "key").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("key", "root").join(least, "root").select("key", "root", "component_id")


def cluster(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3,
            max_bits: int = MAX_BITS) -> DataFrame:
    """id, fingerprint (16 hexadecimal digits) and component_id (smallest id reachable by links)."""
    prints = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text), width).alias("key")))
    reps = cut(prints.groupBy("key").agg(F.min("doc_id").alias("first")))
    edges = forest_edges(reps.select("key", F.array("key").alias("codes"), F.lit(None).cast("binary").alias("signs")), max_bits)
    classes = _classes(reps, edges)
    return prints.join(classes, "key").select(
        "doc_id", F.lpad(F.lower(F.hex("key")), 16, "0").alias("fingerprint"), "component_id")


# ------------------------------------------------------------------ near copies

def shingle_set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), width))


def first_shingles(own: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The beginning of a set of shingles (sorted) in the common order, by ``counts`` and then by hash: any two
    sets of this similarity share a member of their beginnings."""
    own = own[np.argsort(counts[own % np.uint64(len(counts))], kind="stable")]
    return own[:len(own) - math.ceil(similarity * len(own) - 1e-9) + 1]


def shingle_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How common the shingles of each counter are among ``texts`` (t), as steps of a logarithm.

    Every task counts the shingles of all its texts in one table of ``COUNTERS`` numbers; pieces of the tables are
    added in two rounds, so that nothing grows with the corpus but the number of pieces.
    """
    pieces = COUNTERS // PIECE
    schema = "piece int, part int, counts binary"

    def packed(piece: int, part: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([part], pa.int32()),
             pa.array([pa.compress(counts.tobytes(), codec="zstd", asbytes=True)], pa.binary())],
            names=["piece", "part", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task has fewer texts than these numbers can count; sums over tasks are long
        sums, met = np.zeros(COUNTERS, np.int32), set()
        for batch in batches:
            for key, t in zip(batch["key"].to_pylist(), batch["t"]):
                if key not in met:  # copies within a task
                    met.add(key)
                    np.add.at(sums, shingle_set(t.as_py(), width) % np.uint64(COUNTERS), 1)
        if met:
            part = min(met) % PARTS
            for piece, counts in enumerate(sums.reshape(pieces, PIECE)):
                yield packed(piece, part, counts.astype(np.int64))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch["piece"].to_pylist(), batch["counts"]):
                more = np.frombuffer(pa.decompress(counts.as_py(), PIECE * 8, codec="zstd"), np.int64)
                sums[piece] = sums[piece] + more if piece in sums else more
        for piece, counts in sums.items():
            yield packed(piece, 0, counts)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add(batches):
            counts = np.frombuffer(pa.decompress(batch["counts"][0].as_py(), PIECE * 8, codec="zstd"), np.int64)
            scale = np.minimum(np.log2(counts + 1.0) * 2048, 65535).astype(np.uint16)
            yield packed(batch["piece"][0].as_py(), 0, scale)

    found = (texts.select("key", "t").mapInArrow(count, schema)
             .repartition("piece", "part").mapInArrow(add, schema)
             .repartition("piece").mapInArrow(steps, schema).collect())
    out = np.zeros(COUNTERS, np.uint16)
    for piece, _, counts in found:
        out[piece * PIECE:(piece + 1) * PIECE] = np.frombuffer(pa.decompress(bytes(counts), PIECE * 2, codec="zstd"), np.uint16)
    return out


def postings(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """``shingle, key, at, size`` of the first shingles of each text (``key, t``) that others have too, with the
    neighbour under that shingle (``key2, at2, size2``; null for the first). ``at`` is the shingle's place."""
    counts = shingle_counts(texts, width)
    names = ["shingle", "key", "at", "size"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # copies within a task
        for batch in batches:
            keys, firsts, sizes = [], [], []
            for key, t in zip(batch["key"].to_pylist(), batch["t"]):
                if key in met:
                    continue
                met.add(key)
                own = shingle_set(t.as_py(), width)
                # all texts without words meet in one row
                keys.append(key)
                firsts.append(first_shingles(own, counts, similarity) if len(own) else np.zeros(1, np.uint64))
                sizes.append(len(own))
            if keys:
                n = [len(f) for f in firsts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), n)),
                     pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in n])),
                     pa.array(np.repeat(np.array(sizes, np.int32), n))], names=names)

    # some orders of the texts, so that a text of a dense group has different neighbours
    group = Window.partitionBy("shingle").orderBy(F.xxhash64("key", F.pmod("shingle", F.lit(4))), "key")
    found = (texts.select("key", "t").mapInArrow(rows, "shingle long, key long, at int, size int")
             .withColumn("last", F.lag("key").over(group))
             .where(F.col("last").isNull() | (F.col("last") != F.col("key"))).drop("last"))
    found = found.select(*names, *[F.lag(c).over(group).alias(c + "2") for c in names[1:]],
                         F.lead("key").over(group).alias("next"))
    return written(found.where(F.col("key2").isNotNull() | F.col("next").isNotNull()).drop("next"))


def _possible(similarity: float) -> Column:
    """Whether sizes and places of a shared shingle leave room for the similarity."""
    small, large = F.least("size", "size2"), F.greatest("size", "size2")
    after = F.least(F.col("size") - F.col("at"), F.col("size2") - F.col("at2"))
    shared = F.least("at", "at2") + after
    return ((small >= similarity * large - 1e-6)
            & (shared >= similarity / (1 + similarity) * (small + large) - 1e-6))


def _pairs(rows: DataFrame, similarity: float, every: float = 1.0) -> DataFrame:
    """Pairs that the shingles counted in ``rows``, the ``every``-th part of all that they share, do not rule out.

    Of two beginnings in one order, that which ends first holds all shared shingles up to its end, so the
    shared shingles are those of the beginnings and at most the rest of one text.
    """
    pairs = (rows.where(_possible(similarity)).where("key <> key2")
             .select(F.greatest("key", "key2").alias("a"), F.least("key", "key2").alias("b"),
                     F.least("size", "size2").alias("small"), F.greatest("size", "size2").alias("large"))
             .groupBy("a", "b").agg(F.min("small").alias("small"), F.min("large").alias("large"), F.count(F.lit(1)).alias("n")))
    return pairs.where(F.col("n") >= _needed(F.col("small"), F.col("large"), similarity) * every).select("a", "b")


def _needed(small: Column, large: Column, similarity: float) -> Column:
    """How many shingles the beginnings of two sets of these sizes share at least if the sets are similar."""
    rest = F.ceil(similarity * large - 1e-9) - 1
    return similarity / (1 + similarity) * (small + large) - 1e-6 - rest


def ranked(rooted: DataFrame) -> DataFrame:
    """``rooted`` (shingle, key, at, size, root) with ``rank``: how many shingles of the text more classes share."""
    crowd = rooted.select("shingle", "root").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("crowd"))
    place = Window.partitionBy("key").orderBy(F.desc("crowd"), "shingle")
    return written(rooted.join(crowd, "shingle").withColumn("rank", F.row_number().over(place) - 1).drop("crowd"))


def meeting(rows: DataFrame, similarity: float) -> DataFrame:
    """``shingle, root, root2`` (root < root2): classes of ``rows`` (as ``ranked``) that may hold two similar texts.

    Two similar texts share a number of shingles that their sizes tell. The least crowded of these comes after all
    others in the ranks of both, so they are left out where the rank is too low, which is where most texts meet.
    """
    classes = rows.groupBy("shingle", "root").agg(
        F.min("size").alias("low"), F.max("size").alias("high"), F.max("rank").alias("rank"))
    other = classes.select("shingle", *[F.col(c).alias(c + "2") for c in ("root", "low", "high", "rank")])
    rest = F.ceil(similarity * F.greatest("high", "high2") - 1e-9) - 1
    least = similarity / (1 + similarity) * (F.col("low") + F.col("low2")) - 1e-6 - rest
    return (classes.join(other, "shingle").where("root < root2").where(F.least("rank", "rank2") + 1 >= least)
            .select("shingle", "root", "root2"))


def _across(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs of different classes of ``rows`` (as ``ranked``) that the shingles of their beginnings do not rule out."""
    other = rows.select("shingle", *[F.col(c).alias(c + "2") for c in ("root", "key", "at", "size", "rank")])
    small, large = F.least("size", "size2"), F.greatest("size", "size2")
    pairs = (meeting(rows, similarity).join(rows, ["shingle", "root"]).join(other, ["shingle", "root2"])
             .where(_possible(similarity) & (F.least("rank", "rank2") + 1 >= _needed(small, large, similarity)))
             .select(F.greatest("key", "key2").alias("a"), F.least("key", "key2").alias("b"),
                     small.alias("small"), large.alias("large")).distinct())
    # all that the beginnings share, also under shingles at which the pair was left out
    begin = written(rows.groupBy("key").agg(F.collect_list("shingle").alias("s")))
    of = lambda end: begin.select(F.col("key").alias(end), F.col("s").alias(f"s{end}"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(of("b"), "b").join(of("a"), "a")
            .where(shared >= _needed(F.col("small"), F.col("large"), similarity)).select("a", "b"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5,
                similarity: float = 0.8) -> DataFrame:
    """key (xxhash64 of the text), root (smallest key) and component_id (smallest id) of its copies and near
    copies."""
    full = F.coalesce(F.col(text), F.lit(""))
    reps = written(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(full).alias("key"))
                   .groupBy("key").agg(F.min("doc_id").alias("first")))
    texts = docs.select(F.xxhash64(full).alias("key"), full.alias("t"))
    met = postings(texts, width, similarity)

    def decided(edges: DataFrame) -> DataFrame:
        """``edges`` with whether the exact similarity links them."""
        ends = edges.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        # other texts stay out of the shuffle while the ends are few; pairs are compared as sets of hashes, row by
        # row, so that no task holds a batch of pairs of texts
        whole = texts.join(ends, "key", "left_semi").groupBy("key").agg(F.min("t").alias("t"))
        whole = written(whole.select("key", shingles_of(F.col("t"), width).alias("s")))
        of = lambda end: whole.select(F.col("key").alias(end), F.col("s").alias(f"s{end}"))
        return written(edges.join(of("b"), "b").join(of("a"), "a").select(
            "a", "b", (set_similarity(F.col("sa"), F.col("sb")) >= similarity).alias("linked")))

    # texts that fingerprints link and neighbours under shingles first, which joins most of a dense group; the pairs
    # below are all that are left, so which of them are tried here decides no result
    first = fingerprint_links(texts).union(_pairs(met.where("key2 is not null"), similarity, 1 / 8)).distinct()
    done = decided(written(first))
    roots = cut(components(done.where("linked").select("a", "b"))).withColumnRenamed("node", "key")
    rooted = met.select("shingle", "key", "at", "size").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    # then every pair of different classes that meet, found by the classes, so that none pairs its own members
    open_ = (rooted.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"))
             .where("x <> y").select("shingle"))
    pairs = _across(ranked(rooted.join(open_, "shingle")), similarity)
    pairs = written(pairs.join(done.select("a", "b"), ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        done = done.union(decided(pairs))
    return _classes(reps, done.where("linked").select("a", "b"))


def fingerprint_links(texts: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b`` (a > b): links of distinct ``texts`` (key, t) by fingerprints, as ``cluster`` finds them in the
    vantage-point trees; texts of one fingerprint are linked to the one with the smallest key."""
    prints = written(texts.select("key", fingerprint(F.col("t")).alias("code")).distinct())
    reps = cut(prints.groupBy("code").agg(F.min("key").alias("rep")))
    edges = forest_edges(reps.select(F.col("code").alias("key"), F.array("code").alias("codes"),
                                     F.lit(None).cast("binary").alias("signs")), max_bits)
    rep = lambda end: reps.select(F.col("code").alias(end), F.col("rep").alias(f"r{end}"))
    apart = edges.join(rep("a"), "a").join(rep("b"), "b").select("ra", "rb")
    same = prints.join(reps, "code").where("key <> rep").select("key", "rep")
    return apart.union(same).select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))


def shingles_of(text: Column, width: int) -> Column:
    """The set of shingle hashes of a text column, as an array of longs."""
    @F.arrow_udf("array<long>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own = [shingle_set(t.as_py(), width).view(np.int64) for t in batch]
            ends = np.cumsum([0] + [len(s) for s in own]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *own])))

    return sets(text)


def set_similarity(a: Column, b: Column) -> Column:
    """Shared part of two sets; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - both
    return F.when(whole == 0, 1.0).otherwise(both / F.greatest(whole, F.lit(1)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class of near copies of ``docs``: the one with the smallest id.

    Of several rows with that id in a class any one stays; a class without ids keeps one row.
    """
    classes = written(near_copies(docs, id_col, text, **options)).withColumnRenamed("key", "__key")
    kept = without(docs, "__key", "__root", "__n", "__i", "__k")
    rows = kept.withColumn("__key", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    # ids and hashes only: the row of each class that stays, and how many rows look like it
    look = (rows.select(F.col(id_col).alias("__id"), "__key")
            .join(classes.select("__key", F.col("root").alias("__root")), "__key")
            .groupBy("__root", "__id", "__key").agg(F.count(F.lit(1)).alias("__n")))
    chosen = look.groupBy("__root").agg(F.min(F.struct(
        F.col("__id").isNull().alias("none"), "__id", "__key", "__n")).alias("s")).select(
            "__root", F.col("s.__id").alias("__i"), F.col("s.__key").alias("__k"), F.col("s.__n").alias("__n"))
    chosen = written(chosen)
    rows = rows.join(chosen.hint("merge"), (F.col("__key") == F.col("__k")) & F.col(id_col).eqNullSafe(F.col("__i")))
    original = [F.col(f"`{c}`") for c in kept.columns]
    single = rows.where(F.col("__n") == 1).select(*original)
    return single.union(rows.where(F.col("__n") > 1).dropDuplicates(["__root"]).select(*original))
