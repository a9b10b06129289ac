"""Operator 1: quality rules with risk-controlled thresholds.

Each rule rejects a document whose measure reaches a cutoff from a fixed grid. Labelled documents that pass
the base rules are the holdout: for every stratum (language), rule and cutoff the good ones that it would
reject are counted. A cutoff is valid if an exact binomial test at the corrected level refutes that it
rejects more than the rule's share of the allowed risk among good documents. The allowed risk of a stratum
is split evenly over the rules (a document is rejected by any of them); the error level is split over all
rules and strata (Bonferroni), and the cutoffs of one rule are tested from the loosest to the strictest,
ending at the first that fails (fixed sequence), so that with probability 1 - ``delta`` no stratum loses
more than ``risk`` of its good documents. Of the valid cutoffs the one is taken that is worth most: bad
documents caught less ``price`` for each good one lost, and of equals the loosest. A stratum with too few
labels has no valid cutoff; there the method keeps everything.

All is DataFrame functions. Measures of whole texts are made within the row and written once, as a table of
a few numbers per document; the labels meet that table, never the texts. Counts are taken per grid cell with
partial aggregation; what is joined back is one row per stratum.

Results for odd inputs: a null or empty text has no words and fails the base rules; a null stratum is one of
its own; labels that are null, repeated or contradict each other count once by their smallest value; with
no labels only the base rules act; a document with a null id is judged like any other, by thresholds from
the others; repeated rows give repeated results; an empty table gives an empty table; only the columns named
are read.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posegrid.llm.common import WORD_SPACE, cut, written

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent

RISK = 0.05
DELTA = 0.05
PRICE = 5.0
#: measure of each rule and its cutoffs; a document is rejected from the cutoff on
GRID: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3),
    "duplicate_line_share": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8),
    "repeated_word_share": (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45),
    "capital_pair_share": (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6),
    "exclamation_share": (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8),
    "word_length": (8.0, 9.0, 10.0, 11.0, 12.0, 14.0, 17.0, 20.0, 30.0),
}
WORD_BREAK = r"[\x20\x09-\x0D]+"


# ------------------------------------------------------------------ measures

def count_char(text: Column, char: str) -> Column:
    """Occurrences of one ASCII character; searching bytes is far cheaper than translating characters."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


def covered_words(windows: Column) -> Column:
    """Words within 3-word windows that occur twice, from the sorted (hash, position) pairs of all windows."""
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    starts = F.sort_array(F.transform(
        F.filter(windows, lambda w, j: same(w, F.get(windows, j - 1)) | same(w, F.get(windows, j + 1))),
        lambda w: w["i"]))
    # a window adds the words after the end of the one before
    return F.aggregate(
        starts, F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("at"), (s["n"] + F.least(F.lit(3), i - s["at"])).alias("n")),
        lambda s: s["n"])


def measures(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
             stratum: str = "lang") -> DataFrame:
    """Counts of every whole text and the measures of the rules.

    Each step is a projection of its own: an array that a later one refers to more than once is then a
    column, made once, and not an expression that is evaluated at each reference.
    """
    t = F.col("t")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"),
                       F.coalesce(text, F.lit("")).alias("t"))
    line = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")
    rows = rows.select(
        "doc_id", "stratum", words_of(t).alias("w"), line.alias("lines"),
        (F.length(t) - sum((count_char(t, c) for c in WORD_SPACE), F.lit(0))).cast("long").alias("word_chars"),
        sum((count_char(t, c) for c in SYMBOLS), F.lit(0)).cast("long").alias("n_symbols"),
        count_char(t, "!").cast("long").alias("n_exclamations"),
        F.regexp_count(t, F.lit(r"\p{Lu}\p{Lu}")).cast("long").alias("n_capital_pairs"))
    w = F.col("w")
    hashes = F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    rows = rows.select("*", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.size(w).cast("long").alias("n_words"), hashes.alias("h")).drop("w", "lines")
    # most texts repeat no window: they need no sorting
    twice = F.size(F.array_distinct("h")) < F.size("h")
    rows = rows.withColumn("windows", F.when(twice, F.sort_array(F.transform(
        "h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("h")
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered_words(F.col("windows")), F.lit(0)).cast("long"))
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return rows.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < LEAST_WORDS)
         | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("duplicate_line_share"),
        share("n_repeat_words", "n_words").alias("repeated_word_share"),
        share("n_capital_pairs", "word_chars").alias("capital_pair_share"),
        share("n_exclamations", "n_words").alias("exclamation_share"),
        share("word_chars", "n_words").alias("word_length"))


# ------------------------------------------------------------------ thresholds

def most_rejected(n: Column, share: float, level: Column) -> Column:
    """Largest k for which P(X <= k) <= ``level`` with X binomial of ``n`` and ``share``; -1 if none.

    The exact tail is summed term by term, each from the one before in logarithms. Beyond ``n * share`` the
    tail is over one half, so the sum ends there.
    """
    odds = log(share / (1 - share))
    start = F.struct((n * log(1 - share)).alias("term"), F.lit(0.0).alias("tail"), F.lit(-1).cast("long").alias("k"))

    def step(s: Column, i: Column) -> Column:
        tail = s["tail"] + F.exp(s["term"])
        return F.struct((s["term"] + F.log((n - i) / (i + 1)) + odds).alias("term"), tail.alias("tail"),
                        F.when(tail <= level, i).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * share)), start, step, lambda s: s["k"])


def thresholds(measured: DataFrame, labels: DataFrame, grid: dict[str, tuple[float, ...]] = GRID,
               risk: float = RISK, delta: float = DELTA, price: float = PRICE) -> DataFrame:
    """stratum, cutoffs (a map from rule to its chosen cutoff; rules without a valid one are absent)."""
    marks = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = measured.where(~F.col("base_failed")).join(marks, "doc_id")
    # the grid cell of each measure: how many cutoffs it reaches
    cells = F.array(*[F.struct(
        F.lit(rule).alias("rule"),
        sum(((F.col(rule) >= c).cast("int") for c in cuts), F.lit(0)).alias("cell"))
        for rule, cuts in grid.items()])
    counts = (held.select("stratum", "quality", F.explode(cells).alias("c"))
              .groupBy("stratum", "c.rule", "c.cell")
              .agg(F.sum(F.col("quality")).alias("good"), F.sum(1 - F.col("quality")).alias("bad")))
    counts = cut(counts)  # a few rows per stratum, used three times
    strata = counts.agg(F.count_distinct(F.coalesce(F.concat(F.lit("="), "stratum"), F.lit("")))).first()[0]
    # a row for every cutoff of the grid, and the counts of the cells at or above it
    all_cells = F.explode(F.filter(F.create_map(*[x for r, c in grid.items() for x in (
        F.lit(r), F.sequence(F.lit(0), F.lit(len(c))))])[F.col("rule")], lambda i: i >= 0)).alias("cell")
    ladder = (counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"))
              .select("stratum", "rule", "n", all_cells))
    above = Window.partitionBy("stratum", "rule").orderBy(F.col("cell").desc())
    ladder = (ladder.join(counts.withColumn("at", F.coalesce("stratum", F.lit(""))).withColumn("no", F.col("stratum").isNull())
                          .drop("stratum"),
                          [F.coalesce(ladder["stratum"], F.lit("")) == F.col("at"),
                           ladder["stratum"].isNull() == F.col("no"),
                           ladder["rule"] == counts["rule"], ladder["cell"] == counts["cell"]], "left")
              .select("stratum", ladder["rule"], ladder["cell"], "n",
                      F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
              .withColumn("lost", F.sum("good").over(above)).withColumn("caught", F.sum("bad").over(above))
              .where(F.col("cell") > 0))
    sizes = (counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n")).groupBy("stratum")
             .agg(F.max("n").alias("size"))
             .withColumn("most", most_rejected(F.col("size"), risk / len(grid),
                                               F.lit(delta / (len(grid) * max(1, strata))))))
    sizes = sizes.select(F.coalesce("stratum", F.lit("")).alias("at"), F.col("stratum").isNull().alias("no"), "most")
    cutoff = F.create_map(*[x for r, c in grid.items() for x in (
        F.lit(r), F.array(*[F.lit(v) for v in c]))])[F.col("rule")]
    # lost grows from the loosest cutoff to the strictest, so the fixed sequence ends where it passes ``most``
    valid = (ladder.join(sizes, [F.coalesce("stratum", F.lit("")) == F.col("at"), F.col("stratum").isNull() == F.col("no")])
             .where(F.col("lost") <= F.col("most"))
             .withColumn("worth", F.col("caught") - price * F.col("lost")).where(F.col("worth") > 0))
    best = valid.groupBy("stratum", "rule").agg(
        F.max_by(F.element_at(cutoff, F.col("cell")), F.struct("worth", "cell")).alias("cutoff"))
    return best.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          stratum: str = "lang", grid: dict[str, tuple[float, ...]] = GRID, **options) -> DataFrame:
    """One row per document: its counts, measures, ``base_failed``, ``failed`` (names of the rules whose
    cutoffs it reaches) and ``kept``."""
    measured = written(measures(docs, id_col, text, stratum))
    chosen = thresholds(measured, labels, grid, **options).select(
        F.coalesce("stratum", F.lit("")).alias("at"), F.col("stratum").isNull().alias("no"), "cutoffs")
    judged = measured.join(chosen, [F.coalesce("stratum", F.lit("")) == F.col("at"),
                                    F.col("stratum").isNull() == F.col("no")], "left")
    failed = F.filter(F.array(*[F.when(F.col(r) >= F.try_element_at("cutoffs", F.lit(r)), F.lit(r))
                                for r in grid]), lambda r: r.isNotNull())
    return (judged.withColumn("failed", failed).drop("cutoffs", "at", "no")
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))
