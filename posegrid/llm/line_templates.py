"""Operator 9: line dedup by a log-template tree.

A line is parsed at fixed depth: by its number of tokens, then by its first ``depth`` tokens. Tokens with a
digit are variable fields from the start. What follows the leading tokens is divided into at most ``fields``
runs of tokens of equal count (single tokens in short lines). Each leaf has one template: in every field the
value that most texts have there; a line with at least ``similarity`` of its fields equal to the template
belongs to it, and the fields in which its lines differ are variable. A line that fits no template stands
for itself, as do lines no longer than ``depth``.

A template recurs if at least ``min_texts`` lines of different texts belong to it. Equal texts count once. A
text of whose characters or lines more than ``copy_share`` recur is a near copy of others and no evidence for
boilerplate: its lines stay unless they recur in enough other texts. Lines of recurring templates are
dropped wherever they stand; what remains keeps its order, and blank lines stay.

All is DataFrame functions. Texts are read twice (to hash their lines, and to drop some) and shuffled once,
to meet the list of their own dropped lines; all counting is on rows of hashes, with partial aggregation, so
a line in a third of all documents is one row of each map task. Joins on lines are ones that Spark splits
where a line is hot.

Results for odd inputs: a null text stays null, an empty one empty; a text can end up empty; rows with null
or repeated ids are treated alike, since only texts count; repeated rows give repeated results; an empty
table gives an empty table; columns called like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import WORD_SPACE, without, written

DEPTH = 3
FIELDS = 8
SIMILARITY = 0.5
MIN_TEXTS = 4
COPY_SHARE = 0.4
VARIABLE = "<*>"


def tokens_of(line: Column) -> Column:
    """Tokens of a line; those with a digit are masked."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(
        line, r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", VARIABLE)).otherwise(line)
    return F.split(F.btrim(masked, F.lit(WORD_SPACE)), r"[\x20\x09-\x0D]+")


def visible(line: Column) -> Column:
    return F.btrim(line, F.lit(WORD_SPACE)) != ""


def hashed_lines(docs: DataFrame, text: str = "text", depth: int = DEPTH, fields: int = FIELDS) -> DataFrame:
    """Hashes of the distinct lines of each text: text_key, line, leaf and one number per field (f0, f1, ...),
    with the characters of the line and the characters and lines of the text."""
    all_lines = F.filter(F.array_distinct(F.split(text, "\n")), visible)
    rows = docs.where(F.length(text) > 0).select(
        F.xxhash64(text).alias("text_key"), F.length(text).alias("text_chars"), all_lines.alias("all_lines"))
    rows = rows.select("text_key", "text_chars", F.size("all_lines").alias("text_lines"),
                       F.explode("all_lines").alias("l"))
    lines = rows.select("text_key", "text_chars", "text_lines", F.length("l").alias("chars"),
                        tokens_of(F.col("l")).alias("t"))
    n = F.size("t")
    rest = n - depth

    def field(j: int) -> Column:
        begin = F.floor(j * rest / fields).cast("int")
        end = F.floor((j + 1) * rest / fields).cast("int")
        return F.when((rest > 0) & (end > begin), F.hash(F.slice("t", begin + depth + 1, end - begin)))

    return lines.select("text_key", "text_chars", "text_lines", "chars", F.xxhash64("t").alias("line"),
                        F.xxhash64(n, F.slice("t", 1, depth)).alias("leaf"),
                        *[field(j).alias(f"f{j}") for j in range(fields)])


def templates(lines: DataFrame, fields: int, min_texts: int, similarity: float) -> DataFrame:
    """``line, template`` of the lines whose template stands in at least ``min_texts`` texts.

    ``lines``: line, texts (in which it stands), leaf and fields of each distinct line. A template is called by
    its leaf, a line that fits none by itself.
    """
    several = (lines.groupBy("leaf").agg(F.sum("texts").alias("n"), F.count(F.lit(1)).alias("kinds"))
               .where((F.col("kinds") > 1) & (F.col("n") >= min_texts)).select("leaf"))
    # leaves in which generalising can matter: several lines, together often enough
    open_lines = written(lines.join(several, "leaf").select(
        "leaf", "line", "texts", F.array(*[f"f{j}" for j in range(fields)]).alias("fields")))
    votes = (open_lines.select("leaf", "texts", F.posexplode("fields").alias("j", "value"))
             .where(F.col("value").isNotNull()).groupBy("leaf", "j", "value").agg(F.sum("texts").alias("votes")))
    usual = (votes.groupBy("leaf", "j").agg(F.max_by("value", F.struct("votes", "value")).alias("value"))
             .groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("j", "value"))).alias("usual")))
    equal = F.size(F.filter("fields", lambda v, j: F.coalesce(F.try_element_at("usual", j) == v, F.lit(False))))
    filled = F.size(F.filter("fields", lambda v: v.isNotNull()))
    fitting = written(open_lines.join(usual, "leaf").where((equal >= similarity * filled) & (filled > 0))
                      .select("leaf", "line", "texts"))
    often = fitting.groupBy("leaf").agg(F.sum("texts").alias("n")).where(F.col("n") >= min_texts).select("leaf")
    alone = (lines.where(F.col("texts") >= min_texts).select("line")
             .join(fitting.select("line"), "line", "left_anti").select("line", F.col("line").alias("template")))
    return fitting.join(often, "leaf").select("line", F.col("leaf").alias("template")).union(alone)


def dropped_lines(docs: DataFrame, text: str = "text", depth: int = DEPTH, fields: int = FIELDS,
                  similarity: float = SIMILARITY, min_texts: int = MIN_TEXTS,
                  copy_share: float = COPY_SHARE) -> DataFrame:
    """text_key and the hashes (``dropped``) of the lines that the text loses."""
    names = [f"f{j}" for j in range(fields)]
    seen = written(hashed_lines(docs, text, depth, fields).groupBy("line", "text_key").agg(
        *[F.min(c).alias(c) for c in ("text_chars", "text_lines", "chars", "leaf", *names)]))
    lines = written(seen.groupBy("line").agg(
        F.count(F.lit(1)).alias("texts"), *[F.min(c).alias(c) for c in ("leaf", *names)]))
    # all that follows is on the few lines that recur at all
    hits = written(seen.select("line", "text_key", "text_chars", "text_lines", "chars")
                   .join(templates(lines, fields, min_texts, similarity), "line"))
    copies = (hits.groupBy("text_key").agg(
        F.min("text_chars").alias("text_chars"), F.min("text_lines").alias("text_lines"),
        F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("lines"))
        .where((F.col("chars") > copy_share * F.col("text_chars"))
               | (F.col("lines") > copy_share * F.col("text_lines"))).select("text_key"))
    # a table of known size: its join broadcasts it while it is small, and splits hot templates when not
    final = written(hits.join(copies, "text_key", "left_anti").groupBy("template")
                    .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_texts).select("template"))
    return hits.join(final, "template").groupBy("text_key").agg(F.collect_set("line").alias("dropped"))


def drop_templates(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the lines of recurring templates, with n_lines (visible ones) and n_dropped."""
    lost = written(dropped_lines(docs, text, **options))
    kept = without(docs, "n_lines", "n_dropped", "__key")
    rows = (kept.withColumn("__key", F.xxhash64(text))
            # one plan at every size: the lists grow with the texts
            .join(lost.withColumnRenamed("text_key", "__key").withColumnRenamed("dropped", "__dropped").hint("merge"),
                  "__key", "left"))
    lines = F.split(F.col(text), "\n")
    stays = F.filter(lines, lambda x: ~visible(x) | ~F.array_contains(
        F.col("__dropped"), F.xxhash64(tokens_of(x))))
    count = lambda a: F.size(F.filter(a, visible)).cast("long")
    rows = rows.withColumn("__stays", F.when(F.col("__dropped").isNotNull(), stays))
    total = F.coalesce(F.when(F.length(text) > 0, count(lines)), F.lit(0).cast("long"))
    changed = F.when(F.col("__stays").isNull(), F.col(text)).otherwise(F.array_join("__stays", "\n"))
    return rows.select(
        *[changed.alias(c) if c == text else F.col(f"`{c}`") for c in kept.columns], total.alias("n_lines"),
        F.when(F.col("__stays").isNull(), F.lit(0).cast("long")).otherwise(total - count(F.col("__stays")))
        .alias("n_dropped"))
