"""Operator 10: packing of documents into sequences of a fixed number of tokens.

Documents are dealt into random groups of bounded expected size (a hash, one shuffle of the texts). Each
group is packed by itself: whole pieces of a full sequence are cut off first, the remainders go by
first-fit decreasing into bins. A tournament tree over the bins' free space finds the first bin that
takes a remainder in log(bins) steps. The emptiest bins are then cut up to fill the gaps of the fullest, and
the last bin of a group is split into sequences whose lengths are powers of two, so nothing is padded.

Tokens are those of the byte-level BPE of ``tokenizers``; the ids come from the same vocabulary given as
ranks, which a test holds against the library's own. A text is split at the added tokens of the JSON, which
have their own ids.

Results for odd inputs: a null or empty text is a document of the end token alone; rows with a null or
repeated id are documents of their own; an empty table gives an empty table; columns beside id and text
are not read. A document of any length is cut into as many pieces as it needs.
"""

from __future__ import annotations

import base64
import json
import re
import struct
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import shards_for

SEQUENCE = 2048
END_ID = 1
GROUP_ROWS = 1024
RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
#: a space before white space or at the end of the text
SPACE_RUN = re.compile(r" (?:\s|\Z)")

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.binary())])


# ------------------------------------------------------------------ tokens

class WordIds(dict):
    """Bytes of the ids of words that follow a space; a word is encoded when it is first met.

    Holds ``most`` words (25 MB); later ones are encoded each time, so memory is bounded and results don't change. The
    table stays in a worker that goes on to other work.
    """

    def __init__(self, path: str, most: int = 170_000):
        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})
        self.most = most
        self.added = added_ids()
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def whole(self, text: str) -> bytes:
        return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encoding.encode_ordinary(" " + word)).tobytes()
        if len(self) < self.most:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """The ids of a text. A space before a visible character always begins a token, so the words
        between single spaces have the ids that they have in the text; a space before white space or at
        the end may belong to a longer run, and then the text is encoded in one go."""
        if SPACE_RUN.search(text):
            return self.whole(text)
        first, *words = text.split(" ")
        return (self.whole(first) if first else b"") + b"".join(map(self.__getitem__, words))

    def of_document(self, text: str) -> bytes:
        """The ids of a text whose added tokens are tokens."""
        if not any(a in text for a in self.added):
            return self.of(text)
        parts = self.at_added.split(text)
        return b"".join(struct.pack("<I", self.added[p]) if i % 2 else self.of(p)
                        for i, p in enumerate(parts) if p)


def added_ids() -> dict[str, int]:
    """The added tokens of the JSON and their ids; none of them may take in what stands around it."""
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    return {t["content"]: t["id"] for t in tokens}


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker process: the words met in one task serve the next."""
    return WordIds(path)


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path(RANKS)


def token_ids(texts: Sequence[str | None], path: str, end_id: int | None = END_ID) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text, followed by ``end_id``.

    With ``end_id`` the texts are documents, as the library encodes them by default. Without it they are plain
    strings, in which nothing is a token of its own (the library's ``encode_special_tokens``).
    """
    words = word_ids(path)
    if end_id is None:
        return [words.of(t) if t else b"" for t in texts]
    last = struct.pack("<I", end_id)
    return [(words.of_document(t) if t else b"") + last for t in texts]


# ------------------------------------------------------------------ packing one group

class Tournament:
    """Free space of bins as leaves of a complete binary tree; an inner node holds its subtree's largest."""

    def __init__(self, bins: int, capacity: int):
        self.first = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.first)

    def take(self, length: int) -> int:
        """The first bin with ``length`` free; its free space shrinks by that."""
        best, at = self.best, 1
        while at < self.first:
            at *= 2
            if best[at] < length:
                at += 1
        best[at] -= length
        chosen = at - self.first
        at //= 2
        while at:
            best[at] = max(best[2 * at], best[2 * at + 1])
            at //= 2
        return chosen


def first_fit_decreasing(lengths: Sequence[int], capacity: int) -> list[int]:
    """The bin of each item, items taken longest first (ties in the order given)."""
    tree = Tournament(len(lengths), capacity)
    bins = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        bins[i] = tree.take(lengths[i])
    return bins


def powers(length: int, capacity: int) -> list[int]:
    """Lengths that sum to ``length``: full sequences, then falling powers of two."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(lengths: Sequence[int], capacity: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) for documents of these token counts, without padding."""
    sequences: list[list[tuple[int, int, int]]] = []
    rests: list[tuple[int, int, int]] = []
    for i, n in enumerate(lengths):
        whole = n - n % capacity
        sequences += [[(i, s, capacity)] for s in range(0, whole, capacity)]
        if n > whole:
            rests.append((i, whole, n - whole))
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for piece, b in zip(rests, first_fit_decreasing([r[2] for r in rests], capacity)):
        bins.setdefault(b, []).append(piece)
    held = {b: sum(p[2] for p in pieces) for b, pieces in bins.items()}
    # the emptiest bins give their tokens to the gaps of the fullest ones
    order = sorted(bins, key=lambda b: (-held[b], b))
    full, giver = 0, len(order) - 1
    while full < giver:
        target, need = bins[order[full]], capacity - held[order[full]]
        while need and full < giver:
            doc, start, length = bins[order[giver]].pop()
            moved = min(need, length)
            if moved < length:  # cut at the end of what stays
                bins[order[giver]].append((doc, start, length - moved))
            target.append((doc, start + length - moved, moved))
            need -= moved
            if not bins[order[giver]]:
                giver -= 1
        if need:
            break
        sequences.append(target)
        full += 1
    last = bins[order[full]] if full == giver else []
    # the last bin: sequences of power-of-two lengths
    waiting = list(last)
    for size in powers(sum(p[2] for p in last), capacity):
        row: list[tuple[int, int, int]] = []
        while size:
            doc, start, length = waiting.pop(0)
            used = min(size, length)
            row.append((doc, start, used))
            if used < length:
                waiting.insert(0, (doc, start + used, length - used))
            size -= used
        sequences.append(row)
    return sequences


# ------------------------------------------------------------------ all documents

def pack_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranks: str | None = None,
                   capacity: int = SEQUENCE, end_id: int = END_ID,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece of ``docs``: its place in the document (``start``, ``length``, ``doc_tokens``), its
    place in a sequence (``sequence_id``, ``offset``) and its ids, little-endian unsigned 32-bit.

    The groups are a hash of the row's position in the input's files and of its id, so rows that repeat
    one id or one text are dealt out like any others. ``sequence_id`` is the group's number times 2^32
    plus the sequence's number in the group.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = ranks or default_ranks()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    groups = shards_for(docs.select(id_col).count(), group_rows)
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id"),
                                          F.lit(groups)).cast("long"))

    def one_group(rows: pa.Table) -> pa.Table:
        # the order of a group's rows depends on the shuffle; the packing must not
        group = sorted(zip(rows["doc_id"].to_pylist(), (t or "" for t in rows["text"].to_pylist())),
                       key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        ids = token_ids([t for _, t in group], path, end_id)
        base = rows["grp"][0].as_py() << 32
        out: list[tuple] = []
        for number, sequence in enumerate(pack([len(x) // 4 for x in ids], capacity)):
            offset = 0
            for doc, start, length in sequence:
                out.append((group[doc][0], start, length, len(ids[doc]) // 4, base + number, offset,
                            ids[doc][4 * start:4 * (start + length)]))
                offset += length
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PIECES)], schema=PIECES)

    schema = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
              "ids binary")
    return dealt.groupBy("grp").applyInArrow(one_group, schema)
