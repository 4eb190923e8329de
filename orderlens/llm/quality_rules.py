"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document gets base counts and a few ratios. Instead of one fixed cutoff per ratio,
every (lang, source) group gets its own from a mergeable quantile sketch: values fall into
logarithmic buckets (relative width ``GAMMA``), the sketch of a group is its bucket
counts, and two sketches merge by adding counts. A group's upper fence is
``q75 + reach * max(q75 - q25, slack)``; small groups are drawn towards the fence of the
merged sketch of all documents by weight ``n / (n + PRIOR_ROWS)``. Documents are then
joined with their group's fences and filtered.

A hot source costs one partial bucket count per task, and a fence table has one row per
group, so no group of documents is ever gathered.

Defined cases: a null text has no words and fails the base rule, as an empty one does;
null lang or source form groups of their own; repeated rows count and are judged
separately; an empty table gives an empty result; other columns are carried only by
``filter_documents``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderlens.llm.common import append_columns, count_bytes, in_repeated_window, row_sums, slices, split_words, text_bytes, texts_of

SYMBOLS = b"#*$%&|<>"
GAMMA = 1.02
PRIOR_ROWS = 200
MIN_WORDS = 50
#: Ratio -> (reach of the fence in quartile distances, least quartile distance).
RULES = {
    "symbol_ratio": (4.0, 0.03),
    "dup_line_ratio": (4.0, 0.12),
    "repeat_ratio": (4.0, 0.08),
    "upper_ratio": (4.0, 0.06),
    "bang_ratio": (4.0, 0.03),
    "word_length": (4.0, 0.75),
}
STATS = T.StructType([T.StructField(x, T.LongType()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                     + [T.StructField(x, T.DoubleType()) for x in RULES])
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_BANG = np.arange(256) == 33


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    r"""Per text: its \n-split lines with a word, and how many of them equal an earlier one."""
    lines = pc.split_pattern(texts, "\n")
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    coded = lines.flatten().dictionary_encode()
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)), 0).to_numpy(zero_copy_only=False)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keep = worded[code] if len(worded) else np.zeros(0, bool)
    doc, code = doc[keep], code[keep]
    n_lines = np.bincount(doc, minlength=len(texts))
    distinct = np.unique(doc * (len(worded) + 1) + code) // (len(worded) + 1)
    return n_lines, n_lines - np.bincount(distinct, minlength=len(texts))


def text_stats(texts: pa.Array) -> pa.StructArray:
    """The counts and ratios of ``STATS`` for each text."""
    offsets, codes, words = split_words(texts)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.diff(offsets)
    word_chars = row_sums(chars[codes] if len(codes) else codes, offsets)
    raw, ends = text_bytes(texts)
    n_symbols, upper, bang = (count_bytes(raw, ends, table) for table in (_SYMBOL, _UPPER, _BANG))
    n_lines, dup = duplicate_lines(texts)
    repeat = row_sums(in_repeated_window(codes, offsets, len(words)).astype(np.int64), offsets)
    per_word = np.maximum(n_words, 1)
    values = [n_words, word_chars, n_symbols, dup, repeat, n_symbols / per_word, dup / np.maximum(n_lines, 1), repeat / per_word,
              upper / np.maximum(word_chars, 1), bang / per_word, word_chars / per_word]
    return pa.StructArray.from_arrays([pa.array(v.astype(np.float64 if f.dataType == T.DoubleType() else np.int64))
                                       for v, f in zip(values, STATS)], names=STATS.names)


def with_stats(docs: DataFrame, name: str = "__stats") -> DataFrame:
    """``docs`` with a struct column of its text's statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield append_columns(part, **{name: text_stats(texts_of(part))})
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, STATS)]))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def sketches(rows: DataFrame) -> DataFrame:
    """Quantile sketch of each ratio in each (lang, source): bucket counts.

    ``rows`` has lang, source and stats. Base-failed documents are left out, as they have
    their verdict already. Merging sketches is summing ``rows`` over the merged groups.
    """
    value = F.col("value")
    bucket = F.when(value <= 1e-6, F.lit(None)).otherwise(F.ceil(F.log(value) / F.lit(math.log(GAMMA)))).cast("int")
    pairs = F.explode(F.array(*[F.struct(F.lit(x).alias("rule"), F.col("stats")[x].alias("value")) for x in RULES]))
    return (rows.where(~base_failed(F.col("stats"))).select("lang", "source", pairs.alias("pair"))
            .select("lang", "source", "pair.rule", "pair.value")
            .groupBy("lang", "source", "rule", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows")))


def quantile(sketch: DataFrame, group: list[str], points: dict[str, float]) -> DataFrame:
    """Quantiles of merged sketches: per group the upper end of the bucket that holds each point, and the rows."""
    merged = sketch.groupBy(*group, "bucket").agg(F.sum("rows").alias("rows"))
    w = Window.partitionBy(*group)
    upto = F.sum("rows").over(w.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    value = F.coalesce(F.pow(F.lit(GAMMA), F.col("bucket")), F.lit(0.0))
    found = merged.select(*group, value.alias("value"), upto.alias("upto"), F.sum("rows").over(w).alias("n"))
    return found.groupBy(*group).agg(F.max("n").alias("n"), *[
        F.min(F.when(F.col("upto") >= F.lit(p) * F.col("n"), F.col("value"))).alias(name) for name, p in points.items()])


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): a fence per rule, drawn towards that of all documents."""
    reach = F.create_map(*[F.lit(y) for k, v in RULES.items() for y in (k, v[0])])
    slack = F.create_map(*[F.lit(y) for k, v in RULES.items() for y in (k, v[1])])
    points = {"q25": 0.25, "q75": 0.75}
    fence = F.col("q75") + reach[F.col("rule")] * F.greatest(F.col("q75") - F.col("q25"), slack[F.col("rule")])
    own = quantile(sketch, ["lang", "source", "rule"], points).select("lang", "source", "rule", "n", fence.alias("own"))
    every = quantile(sketch, ["rule"], points).select("rule", fence.alias("every"))  # a row per rule
    weight = F.col("n") / (F.col("n") + F.lit(PRIOR_ROWS))
    return (own.join(F.broadcast(every), "rule")
            .withColumn("fence", weight * F.col("own") + (1 - weight) * F.col("every"))
            .groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == x, F.col("fence"))).alias(x) for x in RULES]))


def judged(rows: DataFrame, limits: DataFrame, stats: str) -> DataFrame:
    """``rows`` (lang, source and the struct ``stats``) with ``__failed`` and ``__kept``."""
    names = {x: f"__fence_{x}" for x in RULES}
    limits = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *[F.col(x).alias(y) for x, y in names.items()])
    s = F.col(stats)
    passes = F.lit(True)
    for rule, fence in names.items():
        passes = passes & (s[rule] <= F.col(fence))
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    return (joined.withColumn("__failed", base_failed(s))
            .withColumn("__kept", ~F.col("__failed") & F.coalesce(passes, F.lit(True)))
            .drop("__lang", "__source", *names.values()))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, base counts and ratios, base_failed, kept for every document."""
    from orderlens.sources.files import materialize
    rows = materialize(with_stats(docs.select("doc_id", "lang", "source", "text"), "stats").drop("text"), "rule-stats")
    limits = materialize(fences(sketches(rows)), "rule-fences")
    return (judged(rows, limits, "stats")
            .select("doc_id", "lang", "source", "stats.*", F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept")))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    Statistics are computed once for the fences and once more on the way to the filter, so
    that texts need no shuffle.
    """
    from orderlens.sources.files import materialize
    rows = with_stats(docs.select("lang", "source", "text"), "stats").drop("text")
    limits = materialize(fences(sketches(rows)), "rule-fences")
    return judged(with_stats(docs), limits, "__stats").where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlens.llm.common import documents
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *RULES)
