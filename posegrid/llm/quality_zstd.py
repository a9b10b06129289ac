"""Operator 7: quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled texts. A text is cut into
chunks of fixed size (all of it, so a long text is judged like a short one) and every chunk is compressed
three times: with either dictionary and with none. Two normalised sizes become a calibrated score by a
logistic fit: the difference of the two dictionary sizes over the plain size, and the size with the good
dictionary over the length, which tells texts that compress well under any dictionary, such as one word
said a hundred times. Sizes of a few dozen bytes say little, so both are drawn towards the mean of the
labelled texts by the weight n / (n + ``SHRINK``) of a text of n bytes.

The fit uses a bounded sample: of each class the ``sample`` labelled rows with the smallest hashes whose
texts have at most ``longest`` characters. The calibration is fitted on texts that the dictionaries in
use have not seen (two halves, each scored with the dictionaries of the other). Scoring is one map over
all whole texts; the model (two dictionaries and seven numbers) has a fixed size.

Results for odd inputs: a null or empty text has the weight 0 and so the score of a mean text (the
calibration's constant); repeated rows give repeated results; repeated or
contradicting labels of one document count by their smallest value; null labels and labels of unknown
documents do not count; without labelled rows of both classes nothing can be learned: ``fit`` raises
``ValueError``, the query and the stage give every text the score one half and reject none; an empty
table of documents gives an empty table; a column called like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import without

SAMPLE = 3000
LONGEST = 20_000
CHUNK = 512
DICTIONARY = 32_768
LEVEL = 3
SHRINK = 256


@dataclass(frozen=True)
class Model:
    """Dictionaries, chunk size and calibration; a few tens of kilobytes."""

    good: bytes
    bad: bytes
    mean: tuple[float, float]
    weights: tuple[float, float, float]
    chunk: int = CHUNK
    level: int = LEVEL


class Sizes:
    """Compressed sizes of texts under a pair of dictionaries."""

    def __init__(self, good: bytes, bad: bytes, chunk: int, level: int):
        self.chunk = chunk
        self.tools = [self._tool(d, level) for d in (good, bad, b"")]

    @staticmethod
    def _tool(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
        plain = {"level": level, "write_content_size": False, "write_checksum": False,
                 "write_dict_id": False}
        if not dictionary:
            return zstandard.ZstdCompressor(**plain)
        prepared = zstandard.ZstdCompressionDict(dictionary)
        prepared.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=prepared, **plain)

    def features(self, text: str | None) -> tuple[float, float, float]:
        """The two normalised sizes and the weight of the text."""
        if not text:
            return 0.0, 0.0, 0.0
        raw = text.encode("utf-8", "surrogatepass")
        parts = [raw[i:i + self.chunk] for i in range(0, len(raw), self.chunk)]
        good, bad, plain = (sum([len(t.compress(p)) for p in parts]) for t in self.tools)
        return (bad - good) / plain, good / len(raw), len(raw) / (len(raw) + SHRINK)


def _dictionaries(by_class: dict[int, list[str]], chunk: int, size: int) -> tuple[bytes, bytes]:
    """The good and the bad dictionary. Lines that texts of both classes have tell nothing and are left out;
    else the dictionary of the shorter texts would know them better."""
    lines = {k: {x for t in texts for x in t.split("\n")} for k, texts in by_class.items()}
    shared = lines[1] & lines[0]
    own = {k: ["\n".join(x for x in t.split("\n") if x not in shared) for t in texts]
           for k, texts in by_class.items()}
    return _dictionary(own[1], chunk, size), _dictionary(own[0], chunk, size)


def _dictionary(texts: Sequence[str], chunk: int, size: int) -> bytes:
    parts = [raw[i:i + chunk] for raw in (t.encode("utf-8", "surrogatepass") for t in texts)
             for i in range(0, len(raw), chunk)]
    parts = [p for p in parts if len(p) >= 8]
    # the trainer needs several samples of some size; few labelled texts give a smaller dictionary
    size = min(size, max(256, sum(map(len, parts)) // 8))
    if len(parts) < 16 or sum(map(len, parts)) < 4096:
        return b""
    try:
        return zstandard.train_dictionary(size, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # the texts have nothing in common that is worth an entry
        return b""


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float, float]:
    """Weights of two features and the constant, by Newton steps on the ridge-penalised likelihood."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(3)
    penalty = np.diag([ridge, ridge, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    slope = w[:2] / scale
    return float(slope[0]), float(slope[1]), float(w[2] - slope @ mean)


def fit_rows(texts: Sequence[str], quality: Sequence[int], chunk: int = CHUNK,
             size: int = DICTIONARY, level: int = LEVEL) -> Model:
    """The model of a bounded list of labelled texts."""
    by_class = {k: [t for t, q in zip(texts, quality) if q == k] for k in (1, 0)}
    if not by_class[1] or not by_class[0]:
        raise ValueError("the fit needs labelled texts of both classes")
    halves = [{k: v[h::2] for k, v in by_class.items()} for h in (0, 1)]
    x, y = [], []
    for learn, judge in (halves, halves[::-1]):
        sizes = Sizes(*_dictionaries(learn, chunk, size), chunk, level)
        for k, rows in judge.items():
            x += [sizes.features(t) for t in rows]
            y += [k] * len(rows)
    good, bad = _dictionaries(by_class, chunk, size)
    x = np.array(x, float)
    mean = x[:, :2].mean(0)
    weights = _logistic((x[:, :2] - mean) * x[:, 2:], np.array(y, float))
    return Model(good, bad, (float(mean[0]), float(mean[1])), weights, chunk, level)


#: the score of every text where nothing can be learned: one half
FLAT = Model(b"", b"", (0.0, 0.0), (0.0, 0.0, 0.0))


def _labelled(docs: DataFrame, labels: DataFrame, usable: Column | None, sample: int, longest: int) -> list[tuple[int, int, str]]:
    """Hash, quality and text of at most ``sample`` rows of each class, each of at most ``longest`` characters."""
    marks = (labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id")
             .agg(F.min("quality").alias("quality")))
    if usable is not None:
        marks = marks.where(usable)
    texts = (docs.where((F.length("text") > 0) & (F.length("text") <= longest))
             .select("doc_id", "text", F.xxhash64("text", F.lit(7)).alias("h")))
    # the choice shuffles ids and hashes only; copies of a text count once, with their smallest label
    marked = texts.select("doc_id", "h").join(marks, "doc_id").groupBy("h").agg(F.min("quality").alias("quality"))
    chosen = [(r["h"], k) for k in (1, 0) for r in
              marked.where(F.col("quality") == k).orderBy("h").limit(sample).select("h").collect()]
    if not chosen:
        return []
    # at most twice ``sample`` rows of two numbers
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "h long, quality int"))
    picked = texts.select("h", "text").join(wanted, "h").groupBy("h", "quality").agg(F.min("text").alias("text"))
    return sorted((r["h"], r["quality"], r["text"]) for r in picked.collect())


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE,
        longest: int = LONGEST, **options) -> Model:
    """Fit on the labelled rows of ``docs`` (doc_id, text) for which ``usable`` holds.

    At most ``sample`` rows of each class reach the driver, each of at most ``longest`` characters. Without texts of
    both classes there is no fit, which is an error here.
    """
    rows = _labelled(docs, labels, usable, sample, longest)
    return fit_rows([t for _, _, t in rows], [q for _, q, _ in rows], **options)


def fit_if_possible(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE,
                    longest: int = LONGEST, **options) -> Model:
    """As ``fit``, but ``FLAT`` where one class has no labelled text: nothing is known then that would reject any."""
    rows = _labelled(docs, labels, usable, sample, longest)
    if {q for _, q, _ in rows} != {0, 1}:
        return FLAT
    return fit_rows([t for _, _, t in rows], [q for _, q, _ in rows], **options)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: from 0 to 1, higher for texts that resemble the good ones."""
    sizes_of = (model.good, model.bad, model.chunk, model.level)
    mean, slope, constant = np.array(model.mean), np.array(model.weights[:2]), model.weights[2]

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = Sizes(*sizes_of)
        for texts in batches:
            x = np.array([sizes.features(t) for t in texts], float).reshape(-1, 3)
            at = (x[:, :2] - mean) @ slope * x[:, 2] + constant
            yield pd.Series(1 / (1 + np.exp(-np.clip(at, -35, 35))))

    return without(docs, out).withColumn(out, scores(F.col(text)))


def fold(doc_id: Column | str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")),
                  F.lit(folds))


def keep_good(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
              threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with the columns of ``docs``."""
    model = fit_if_possible(docs, labels, usable, **options)
    return (score(docs, model, out="__score").where(F.col("__score") >= threshold)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
