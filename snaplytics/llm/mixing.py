"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word budget (its target). Whole epochs of the source come first:
every document as often as the target holds the source's size. What is left is filled
by weighted sampling without replacement: a document's key is an exponential variate
divided by its quality weight (``-ln(u) / w``, ``u`` from a hash of the document, so
reruns agree), documents are taken in ascending key order, and the prefix sum of their
sizes is cut at the rest of the budget. The document at the cut is taken when more
than half of it lies inside.

At scale no source is sorted as a whole. Keys are binned on a log scale (about a
hundredth of a unit wide, so a bin holds at most 0.3 % of a source whatever its
weights); sizes are summed per (source, bin) with map-side combining, the bin that
crosses the budget is found on those sums, and only that bin's rows are ordered. The
outcome is one cut key per source, which is joined to the documents; that table is
broadcast only when its measured size is small. The source table (one row per source)
is ordered in one task to rank sources and to reshare excess budget.

Cases: null or empty text has size 0 and takes 0 words; a null source is a source of
its own, ranked last; rows with equal non-null ``doc_id`` share one key and are taken
or left together, a null ``doc_id`` is replaced by the text for the key; an empty table
gives an empty result; columns of the input are kept as they are (working columns get
names the input does not use).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, count_words, staged, table, unclash

WEIGHTS = (5, 2, 1)     # by rank of the source in code-point order, repeating
SHARE = 1.5             # all targets together, as a share of all sizes
MAX_EPOCHS = 2          # a target stops at this many times its source's size
BINS_PER_UNIT = 128     # resolution of the log-scale key bins


def quality_weight(text: Column, size: Column) -> Column:
    """1, halved for fewer than 50 words and halved for an odd mean word length."""
    per_word = F.length(F.coalesce(text, F.lit(""))) / F.greatest(size, F.lit(1))
    return (F.when(size < 50, 0.5).otherwise(1.0)
            * F.when(per_word.between(3, 12), 1.0).otherwise(0.5))


def sampling_columns(docs: DataFrame, n: dict[str, str], weight: Column | None = None) -> DataFrame:
    """Add size, draw (the hash behind the key), key and bin."""
    size = F.col(n["size"])
    docs = docs.withColumn(n["size"], count_words(F.col("text")))
    seed = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("?"), F.coalesce(F.col("text"), F.lit(""))))
    docs = docs.withColumn(n["draw"], F.md5(seed.cast("binary")))
    w = weight if weight is not None else quality_weight(F.col("text"), size)
    u = (F.conv(F.substring(n["draw"], 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    docs = docs.withColumn(n["key"], -F.ln(u) / w)
    return docs.withColumn(n["bin"], F.floor(F.ln(n["key"]) * BINS_PER_UNIT).cast("long"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> plus target: weight shares of the budget, capped, the
    excess reshared by weight (water level found on the sources sorted by cap / weight)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * max_epochs)
    s = s.withColumn("level", F.col("cap") / F.col("w"))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    s = s.withColumn("reach", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    s = s.withColumn("water", F.min(F.when(F.col("reach") <= F.col("level"), F.struct("level", "source", "reach")))
                     .over(everything)["reach"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("w") * F.col("water"), F.col("cap").cast("double")))
    return s.select("source", "source_size", target.alias("target"))


def mix_plan(slim: DataFrame, n: dict[str, str], **mix) -> DataFrame:
    """Per source: size, target, whole epochs and the cut of the fractional selection."""
    src, size, draw, key, bin_ = F.col("source"), n["size"], n["draw"], n["key"], n["bin"]
    bins = staged(slim.groupBy("source", F.col(bin_).alias("bin")).agg(F.sum(size).alias("words")), "mix-bins")
    targets = source_targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")), **mix)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs)
    targets = staged(targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    order = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    t = targets.select(src.alias("t_source"), "rest")
    sums = bins.join(broadcast_if_small(t), src.eqNullSafe(F.col("t_source"))).drop("t_source")
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    crossing = staged(sums.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
                      .select(src.alias("c_source"), F.col("bin").alias("cut_bin"), "before", "rest"), "mix-crossing")

    inside = slim.join(broadcast_if_small(crossing), src.eqNullSafe(F.col("c_source")) & (F.col(bin_) == F.col("cut_bin")))
    inside = inside.groupBy("source", "cut_bin", "before", "rest", F.col(key).alias("k"), F.col(draw).alias("d")) \
        .agg(F.sum(size).alias("words"))
    in_order = Window.partitionBy("source").orderBy("k", "d").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("words").over(in_order), F.lit(0)) + F.col("words") / 2
    cut = inside.withColumn("taken", middle <= F.col("rest")).groupBy(src.alias("c_source"), "cut_bin") \
        .agg(F.max(F.when(F.col("taken"), F.struct("k", "d"))).alias("cut"))
    return staged(targets.join(cut, src.eqNullSafe(F.col("c_source")), "left").select(
        src.alias("p_source"), "source_size", "target", "epochs", "cut_bin",
        F.col("cut.k").alias("cut_k"), F.col("cut.d").alias("cut_d")), "mix-plan")


def with_times(rows: DataFrame, plan: DataFrame, n: dict[str, str]) -> DataFrame:
    """Join the plan and add how often the mix takes each row."""
    key, draw, bin_ = F.col(n["key"]), F.col(n["draw"]), F.col(n["bin"])
    chosen = (bin_ < F.col("cut_bin")) | ((bin_ == F.col("cut_bin")) & (
        (key < F.col("cut_k")) | ((key == F.col("cut_k")) & (draw <= F.col("cut_d")))))
    rows = rows.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("p_source")))
    return rows.withColumn(n["times"], F.col("epochs") + F.coalesce(chosen, F.lit(False)).cast("long"))


_NAMES = ("size", "draw", "key", "bin", "times")


def mix_report(docs: DataFrame, **mix) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, times."""
    n = unclash(docs, *_NAMES)
    slim = staged(sampling_columns(docs.select("doc_id", "text", "source"), n).drop("text"), "mix-rows")
    rows = with_times(slim, mix_plan(slim, n, **mix), n)
    return rows.select("doc_id", F.col(n["size"]).alias("size"), F.col("source_size").cast("long").alias("source_size"),
                       "target", (F.col(n["times"]) * F.col(n["size"])).alias("taken"),
                       F.col(n["times"]).alias("times"), "source")


def mix_sources(docs: DataFrame, weight: Column | None = None, **mix) -> DataFrame:
    """The mixed documents: input columns, each row as often as the mix takes it."""
    n = unclash(docs, *_NAMES, "copy")
    keyed = sampling_columns(docs, n, weight)
    slim = staged(keyed.select("source", *[n[k] for k in _NAMES[:4]]), "mix-rows")
    taken = with_times(keyed, mix_plan(slim, n, **mix), n).filter(F.col(n["times"]) > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col(n["times"]).cast("int")))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias(n["copy"])).drop(n["copy"])


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


# The whole source is ordered at once here, without bins or cuts.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(coalesce(text, '')) AS chars,
         md5(coalesce(doc_id::VARCHAR, '?' || coalesce(text, ''))) AS draw
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(draw, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / ((CASE WHEN size < 50 THEN 0.5 ELSE 1.0 END)::DOUBLE
            * (CASE WHEN chars::DOUBLE / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0 ELSE 0.5 END)::DOUBLE) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w
  FROM k GROUP BY source),
r AS (
  SELECT *, 2.0::DOUBLE * source_size / w AS level, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(w) OVER () AS all_w,
         coalesce(sum(2 * source_size) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before
  FROM s WINDOW b AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (budget - cap_before) / (all_w - w_before) AS reach FROM r),
t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, coalesce(w * (SELECT arg_min(reach, level) FROM l WHERE reach <= level),
                                                   2.0::DOUBLE * source_size)) AS target
  FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
u AS (SELECT source, key, draw, sum(size) AS words FROM k GROUP BY source, key, draw),
p AS (
  SELECT u.*, coalesce(sum(words) OVER (PARTITION BY u.source ORDER BY key, draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + words / 2.0::DOUBLE <= target - epochs * source_size AND target > epochs * source_size AS chosen
  FROM u JOIN e ON u.source IS NOT DISTINCT FROM e.source)
SELECT k.doc_id, k.source, k.size, e.source_size, e.target,
       ((e.epochs + p.chosen::INT) * k.size)::BIGINT AS taken, (e.epochs + p.chosen::INT)::BIGINT AS times
FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
JOIN p ON k.source IS NOT DISTINCT FROM p.source AND k.draw = p.draw AND k.key = p.key
"""
