"""Operator 6: SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (one space before it, every space begins a word) and cut into words: a run of spaces and
what follows up to the next space. No piece crosses such a border, so the best segmentation of a text
is that of its words. The distinct words of a block of texts are sorted, which is the depth-first order of
their trie; each word keeps the forward scores of the prefix that it shares with the word before, and only
its own nodes of the trie are scored. Encoded words are kept for later blocks in a table of bounded size.

The score of a segmentation is the sum of the log-probabilities of its pieces. The given model was made
by merging (BPE): its scores are ranks, and its library segments by merge order. Here the piece of rank r
gets the probability 1/r, normalised (Zipf's law). So ids differ from the library's in some words; both use
the same pieces, and both decode to the same text. A character without a piece is written as its UTF-8
bytes, as is U+2581, which the library would turn into a space: decoding gives every text back exactly.

Results for odd inputs: a null text has null ids, an empty text none; long texts are encoded whole; repeated
rows give repeated results; an empty table gives an empty table; a column called like the result is replaced.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import without

MODEL = "piece_bpe_32k.model"
MARK = "▁"
WORD = re.compile(" +[^ ]*")
#: characters of text whose words are held at once, and words kept from block to block
BLOCK_CHARS = 1_000_000
KEPT_WORDS = 150_000
#: texts decoded at once
DECODED_ROWS = 256


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


class Pieces:
    """Pieces and scores of a model file, and the encoder over them. Inside, a space stands for the mark."""

    def __init__(self, path: str, most: int = KEPT_WORDS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.byte = [0] * 256
        self.text: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                piece = piece.replace(MARK, " ")
                if " " in piece.lstrip(" "):
                    raise ValueError(f"piece {i} crosses a word border")
                self.score[piece] = model.get_score(i)
                self.number[piece] = i
                self.text.append(piece.encode())
        # from ranks to log-probabilities; runs of marks have no rank in the file and come last
        total = sum(1 / r for r in range(1, len(self.score) + 1))
        ranked = sorted(self.score, key=lambda p: (-self.score[p], self.number[p]))
        self.score = {p: -math.log(r * total) for r, p in enumerate(ranked, 1)}
        #: below every piece, so bytes are used only where no piece fits
        self.fallback = min(self.score.values()) - 10
        if any(c not in self.score for p in self.score for c in p):
            raise ValueError("a piece has a character that is no piece")
        self.ids = [struct.pack("=i", i) for i in range(len(self.text))]
        #: score and id of all pieces; minus infinity for what a piece only ends with
        self.endings: dict[str, tuple[float, bytes]] = {
            p[i:]: (-math.inf, b"") for p in self.score for i in range(len(p))}
        self.endings |= {p: (x, self.ids[self.number[p]]) for p, x in self.score.items()}
        self.most = most
        self.words: dict[str, bytes] = {}

    def forward(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Words in sorted order, each with its ids. ``best``, ``begin`` and ``piece`` are the path from the trie's root
        to the current node: the forward score of the first j characters, where the last piece before j begins, and
        its ids. A word's ids are put together once, from its end back."""
        endings, infinity = self.endings.get, -math.inf
        best, begin, piece, before = [0.0], [0], [b""], ""
        for word in words:
            shared = 0
            if word.startswith(before):
                shared = len(before)
            else:
                for a, b in zip(before, word):
                    if a != b:
                        break
                    shared += 1
                del best[shared + 1:], begin[shared + 1:], piece[shared + 1:]
            for j in range(shared + 1, len(word) + 1):
                top, start, last = infinity, j - 1, b""
                i = j - 1
                while i >= 0:
                    hit = endings(word[i:j])
                    if hit is None:  # no piece ends so, nor with anything longer
                        break
                    score = best[i] + hit[0]
                    if score >= top:
                        top, start, last = score, i, hit[1]
                    i -= 1
                if top == infinity:
                    top = best[j - 1] + self.fallback
                    start, last = j - 1, b"".join(
                        self.ids[self.byte[x]] for x in word[j - 1].encode("utf-8", "surrogatepass"))
                best.append(top)
                begin.append(start)
                piece.append(last)
            before = word
            parts, j = [], len(word)
            while j:
                parts.append(piece[j])
                j = begin[j]
            yield word, b"".join(reversed(parts))

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Native 32-bit ids of each text."""
        cut = [None if t is None else WORD.findall(" " + t) if t else [] for t in texts]
        known = self.words
        fresh = sorted({w for ws in cut if ws for w in ws if w not in known})
        new = dict(self.forward(fresh))
        known.update(new)
        out = [None if ws is None else b"".join(map(known.__getitem__, ws)) for ws in cut]
        for w in fresh[max(0, len(fresh) + self.most - len(known)):]:
            del known[w]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join(map(self.text.__getitem__, ids))
        return raw.decode("utf-8", "replace")[1:] if raw.startswith(b" ") else raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One per worker process."""
    return Pieces(path)


def _blocks(texts: pa.Array, most: int) -> Iterator[list[str | None]]:
    block: list[str | None] = []
    size = 0
    for t in texts:
        block.append(t.as_py())
        size += len(block[-1] or "")
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def encoded(text: Column, model: str | None = None) -> Column:
    """Array of piece ids of a text column."""
    path = model or default_model()

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = pieces(path)
        for batch in batches:
            # a result for each block: what is held does not grow with the batch
            for block in _blocks(batch, BLOCK_CHARS):
                ids = tool.encode(block)
                gone = [x is None for x in ids]
                ends = np.cumsum([0] + [len(x or b"") // 4 for x in ids])
                yield pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32(), mask=np.array([*gone, False]) if any(gone) else None),
                    pa.array(np.frombuffer(b"".join(x for x in ids if x), np.int32)))

    return encode(text)


def decoded(ids: Column, model: str | None = None) -> Column:
    """Text of an array of piece ids."""
    path = model or default_model()

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = pieces(path)
        for batch in batches:
            # one text's ids are Python numbers at a time, and a few texts are held
            for at in range(0, len(batch), DECODED_ROWS):
                part = batch.slice(at, DECODED_ROWS)
                ends, values = part.offsets.to_pylist(), part.values.to_numpy(zero_copy_only=False)
                yield pa.array([tool.decode(values[b:e].tolist()) if there else None for b, e, there in zip(
                    ends, ends[1:], part.is_valid().to_pylist())], pa.string())

    return decode(ids)


def encode(docs: DataFrame, text: str = "text", out: str = "ids", model: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text`` in ``out``."""
    return without(docs, out).withColumn(out, encoded(F.col(text), model))


def decode(docs: DataFrame, ids: str = "ids", out: str = "decoded", model: str | None = None) -> DataFrame:
    """``docs`` with the text of ``ids`` in ``out``."""
    return without(docs, out).withColumn(out, decoded(F.col(ids), model))
