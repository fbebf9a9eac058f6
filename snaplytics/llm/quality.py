"""Quality rules with robust multivariate outlier rejection, in DataFrame functions only.

Base statistics of a text: words, code points in words, symbols, repeated lines, and
words inside repeated three-word windows. Windows are compared by their 64-bit hash
within the row: hashes are sorted with their positions, equal neighbours mark repeated
windows, and the union of the marked windows is measured on the sorted positions, so a
text of n words costs n log n and no row leaves its task.

The method: every document becomes a vector of four transformed statistics (log mean
word length, root of symbols per word, shares of repeated lines and of repeated words),
rounded to integers so that sums do not depend on their order. For each language and
source the minimum covariance determinant is estimated from the documents that pass
the base rules: from three starts (medians with quartile ranges, means with standard deviations,
lower quartiles with quartile ranges) concentration steps are repeated (Mahalanobis
distances of all rows, keep the nearest share, take their mean and covariance) as long as the
determinant falls, at most ``MAX_STEPS`` times, and of the starts the one with the least determinant
is kept. The share's cut is found on a histogram of log distances, so a group of any
size is only summed, never gathered or sorted. Distances are scaled down where the group's
median distance is above that of a normal sample; a document beyond the cutoff is rejected.

A (language, source) group with under ``MIN_GROUP`` fitted rows joins the pooled small
groups of its language, and that pool, when still small, one pool for all. A group
with fewer than ``MIN_FIT`` rows even so rejects nothing.

Cases: a null text has no words and fails the base rule; null language or source is a
group value of its own; identical vectors (no spread) are handled by a floor under each
statistic's spread; repeated rows are judged alike; an empty table gives an empty
result; input columns are kept as they are (working columns get names the input does
not use).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged, table, unclash, word_array

MIN_WORDS = 50          # base rule: fewer words fail
MAX_REPEAT_PERCENT = 50  # base rule: a larger share of repeated words fails
SYMBOLS = r"[^#*$%&|<>]+"
CORE_SHARE = 0.55       # of a group's rows, those nearest to its centre carry the estimate
MAX_STEPS = 8           # concentration steps at most
STARTS = 3
MIN_GROUP = 100
MIN_FIT = 20
CUTOFF = 28.473         # scaled squared distance beyond which a document is rejected: the 0.99999 quantile
UNIT = 1000             # vectors are rounded to 1 / UNIT
FLOORS = (100.0, 100.0, 100.0, 100.0)   # least spread of each statistic, in units
MEDIAN_CHI2 = 3.3567    # median of the chi-squared distribution with 4 degrees of freedom
BINS = 64               # histogram bins per unit of log distance

DIM = len(FLOORS)
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def with_statistics(docs: DataFrame, n: dict[str, str]) -> DataFrame:
    """Append the base statistics (named by ``n``) to the documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words, tri, ranked, marked, lines = (F.col(n[k]) for k in ("words", "tri", "ranked", "marked", "lines"))
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    docs = docs.withColumn(n["words"], word_array(F.col("text")))
    docs = docs.withColumn(n["n_words"], F.size(words).cast("long")) \
        .withColumn(n["word_chars"], F.length(F.array_join(words, "")).cast("long")) \
        .withColumn(n["n_symbols"], F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")) \
        .withColumn(n["lines"], F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")) \
        .withColumn(n["tri"], F.when(F.size(words) >= 3, windows).otherwise(F.array().cast("array<bigint>"))) \
        .drop(n["words"])
    docs = docs.withColumn(n["n_lines"], F.size(lines).cast("long")) \
        .withColumn(n["n_dup_lines"], (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")).drop(n["lines"])
    repeats = F.size(F.array_distinct(tri)) < F.size(tri)
    docs = docs.withColumn(n["ranked"], F.when(repeats, F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))) \
        .drop(n["tri"])
    same = lambda x, other: F.coalesce(x["h"] == F.get(ranked, other)["h"], F.lit(False))
    docs = docs.withColumn(n["marked"], F.sort_array(F.transform(
        F.filter(ranked, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))).drop(n["ranked"])
    covered = F.aggregate(F.transform(marked, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(marked, i + 1) - p, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    return docs.withColumn(n["n_repeat_words"], F.coalesce(covered, F.lit(0)).cast("long")).drop(n["marked"])


def base_failed(n: dict[str, str]) -> Column:
    return (F.col(n["n_words"]) < MIN_WORDS) | (100 * F.col(n["n_repeat_words"]) > MAX_REPEAT_PERCENT * F.col(n["n_words"]))


def vector(n: dict[str, str]) -> list[Column]:
    """The transformed statistics in whole units (null without words)."""
    words = F.nullif(F.col(n["n_words"]), F.lit(0)).cast("double")
    parts = (F.ln(F.col(n["word_chars"]) / words),
             F.sqrt(F.col(n["n_symbols"]) / words),
             F.col(n["n_dup_lines"]) / F.nullif(F.col(n["n_lines"]), F.lit(0)),
             F.col(n["n_repeat_words"]) / words)
    return [F.round(p * UNIT).cast("long") for p in parts]


def squared_distance(x: list[Column]) -> Column:
    """Mahalanobis distance from a row's joined parameters m0.. and Cholesky factor l00.. by
    forward substitution."""
    z: list[Column] = []
    for i in range(DIM):
        rest = x[i] - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def cholesky(cov: dict[tuple[int, int], Column], df: DataFrame) -> DataFrame:
    """Add the lower factor l00.. of the covariance columns, each spread raised to its floor."""
    for i in range(DIM):
        for j in range(i + 1):
            rest = cov[i, j] + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}"))
    return df


def determinant() -> Column:
    """Of the covariance, from its factor."""
    out = F.col("l00") * F.col("l00")
    for i in range(1, DIM):
        out = out * (F.col(f"l{i}{i}") * F.col(f"l{i}{i}"))
    return out


KEYS = ("g_lang", "g_source", "start")


def distance_cut(rows: DataFrame, share: float, name: str) -> DataFrame:
    """Per group and start: the log-distance bin that completes ``share`` of the rows."""
    order = Window.partitionBy(*KEYS).orderBy("bin")
    bins = rows.groupBy(*KEYS, "bin").agg(F.count(F.lit(1)).alias("c"))
    bins = bins.withColumn("cum", F.sum("c").over(order)) \
        .withColumn("all", F.sum("c").over(Window.partitionBy(*KEYS)))
    return bins.filter(F.col("cum") >= F.col("all") * share).groupBy(*KEYS).agg(F.min("bin").alias(name))


def same_keys(prefix: str) -> Column:
    return (F.col("g_lang") == F.col(f"{prefix}_lang")) & (F.col("g_source") == F.col(f"{prefix}_source")) & (F.col("start") == F.col(f"{prefix}_start"))


def starting_points(rows: DataFrame) -> DataFrame:
    """KEYS, n, m0.., s0..: centres and spreads from which the steps begin."""
    x = [F.col(f"v{i}").cast("double") for i in range(DIM)]
    stats = rows.groupBy("g_lang", "g_source").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"a{i}") for i in range(DIM)], *[F.sum(x[i] * x[i]).alias(f"b{i}") for i in range(DIM)],
        *[F.percentile(f"v{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p{i}") for i in range(DIM)])
    stats = stats.withColumns({f"a{i}": F.col(f"a{i}") / F.col("n") for i in range(DIM)})
    ranges = [((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349).alias(f"s{i}") for i in range(DIM)]
    spreads = [F.sqrt(F.greatest(F.col(f"b{i}") / F.col("n") - F.col(f"a{i}") * F.col(f"a{i}"), F.lit(0.0))).alias(f"s{i}") for i in range(DIM)]
    kinds = ([F.col(f"p{i}")[1].alias(f"m{i}") for i in range(DIM)] + ranges,
             [F.col(f"a{i}").alias(f"m{i}") for i in range(DIM)] + spreads,
             [F.col(f"p{i}")[0].alias(f"m{i}") for i in range(DIM)] + ranges)
    points = F.array(*[F.struct(F.lit(k).alias("start"), *kind) for k, kind in enumerate(kinds)])
    return stats.select("g_lang", "g_source", "n", F.explode(points).alias("p")).select("g_lang", "g_source", "n", "p.*")


def fit_groups(fit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MCD estimates of the rows (lang, source, v0..). Returns the group of each (lang, source)
    and the estimates per group: m0.., l00.., scale, rows."""
    by_lang, everything = Window.partitionBy("k_lang"), Window.partitionBy()
    sizes = fit.groupBy(F.col("lang").alias("k_lang"), F.col("source").alias("k_source")).agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < MIN_GROUP
    sizes = sizes.withColumn("lang_n", F.sum(F.when(small, F.col("n"))).over(by_lang))
    alone = small & (F.col("lang_n") < MIN_GROUP)
    # a pool's name is a struct with a flag, so it can't clash with a source's value
    groups = staged(sizes.select(
        "k_lang", "k_source",
        F.struct(alone.alias("pool"), F.when(~alone, F.col("k_lang")).alias("v")).alias("g_lang"),
        F.struct(small.alias("pool"), F.when(~small, F.col("k_source")).alias("v")).alias("g_source")), "mcd-groups")
    rows = staged(join_groups(fit, groups).select("g_lang", "g_source", *[f"v{i}" for i in range(DIM)]), "mcd-rows")

    pairs = [(i, j) for i in range(DIM) for j in range(i + 1)]
    cov = {(i, j): F.col(f"s{i}") * F.col(f"s{i}") if i == j else F.lit(0.0) for i, j in pairs}
    columns = ["n", *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i, j in pairs], "det"]
    estimate = cholesky(cov, starting_points(rows)).withColumn("det", F.lit(float("inf")))
    estimate = staged(estimate.select(*KEYS, *columns), "mcd-start")

    for step in range(MAX_STEPS):
        near = placed(rows, estimate)
        cut = staged(distance_cut(near, CORE_SHARE, "cut"), f"mcd-cut{step}")
        near = near.join(broadcast_if_small(cut.toDF("c_lang", "c_source", "c_start", "cut")), same_keys("c"))
        core = near.filter(F.col("bin") <= F.col("cut"))
        x = [F.col(f"v{i}").cast("double") for i in range(DIM)]
        sums = core.groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("k"), *[F.sum(x[i]).alias(f"m{i}") for i in range(DIM)],
            *[F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i, j in pairs])
        means = sums.select(*KEYS, F.col("k").alias("n"), *[(F.col(f"m{i}") / F.col("k")).alias(f"m{i}") for i in range(DIM)],
                            *[(F.col(f"q{i}{j}") / F.col("k")).alias(f"q{i}{j}") for i, j in pairs])
        cov = {(i, j): F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in pairs}
        new = cholesky(cov, means).withColumn("det", determinant()).select(*KEYS, F.struct(*columns).alias("new"))
        old = estimate.select(*[F.col(k).alias(f"o_{k.removeprefix('g_')}") for k in KEYS], F.struct(*columns).alias("old"))
        falls = F.col("new.det") < F.col("old.det")
        both = new.join(broadcast_if_small(old), same_keys("o")).select(*KEYS, falls.alias("falls"), F.when(falls, F.col("new")).otherwise(F.col("old")).alias("e"))
        both = staged(both, f"mcd-step{step}")
        estimate = both.select(*KEYS, "e.*")
        if both.filter("falls").isEmpty():
            break

    best = F.min_by(F.struct("start", *columns), F.struct("det", "start"))
    estimate = staged(estimate.groupBy("g_lang", "g_source").agg(best.alias("e")).select("g_lang", "g_source", "e.*"), "mcd-best")
    middle = distance_cut(placed(rows, estimate), 0.5, "middle")
    scale = F.greatest((F.exp((F.col("middle") + 1) / BINS) - 1) / MEDIAN_CHI2, F.lit(1.0))
    estimate = estimate.join(middle.toDF("c_lang", "c_source", "c_start", "middle"), same_keys("c"))
    return groups, staged(estimate.withColumn("scale", scale).drop("c_lang", "c_source", "c_start", "middle", "start"), "mcd-estimate")


def join_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    on = F.col("lang").eqNullSafe(F.col("k_lang")) & F.col("source").eqNullSafe(F.col("k_source"))
    return rows.join(broadcast_if_small(groups), on, "left").drop("k_lang", "k_source")


def placed(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Rows with their log-distance bin under each start's estimate of their group."""
    e = estimate.withColumnsRenamed({"g_lang": "e_lang", "g_source": "e_source"}).drop("n", "det")
    rows = rows.join(broadcast_if_small(e), (F.col("g_lang") == F.col("e_lang")) & (F.col("g_source") == F.col("e_source")))
    d2 = squared_distance([F.col(f"v{i}") for i in range(DIM)])
    return rows.select(*KEYS, *[f"v{i}" for i in range(DIM)],
                       F.floor(F.ln(1 + d2) * BINS).cast("long").alias("bin"))


def judged(rows: DataFrame, n: dict[str, str]) -> DataFrame:
    """Staged rows with statistics -> plus base_failed, distance and kept (named by ``n``)."""
    failed = base_failed(n)
    slim = rows.filter(~failed).select("lang", "source", *[v.alias(f"v{i}") for i, v in enumerate(vector(n))])
    groups, estimate = fit_groups(slim)
    params = groups.join(estimate.withColumnsRenamed({"g_lang": "e_lang", "g_source": "e_source"}),
                         (F.col("g_lang") == F.col("e_lang")) & (F.col("g_source") == F.col("e_source")))
    params = staged(params.select("k_lang", "k_source", F.struct(
        "n", "scale", *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i in range(DIM) for j in range(i + 1)]).alias("p")), "mcd-params")
    e = n["estimate"]
    params = params.toDF(n["k_lang"], n["k_source"], e)
    out = rows.join(broadcast_if_small(params), F.col("lang").eqNullSafe(F.col(n["k_lang"]))
                    & F.col("source").eqNullSafe(F.col(n["k_source"])), "left")
    z: list[Column] = []
    for i, v in enumerate(vector(n)):
        rest = v - F.col(f"{e}.m{i}")
        for j in range(i):
            rest = rest - F.col(f"{e}.l{i}{j}") * z[j]
        z.append(rest / F.col(f"{e}.l{i}{i}"))
    d2 = sum((v * v for v in z[1:]), z[0] * z[0]) / F.col(f"{e}.scale")
    out = out.withColumn(n["failed"], failed).withColumn(n["distance"], F.when(F.col(f"{e}.n") >= MIN_FIT, d2))
    kept = ~F.col(n["failed"]) & F.coalesce(F.col(n["distance"]) <= CUTOFF, F.lit(True))
    return out.withColumn(n["kept"], kept)


_NAMES = (*STATS, "words", "tri", "ranked", "marked", "lines", "k_lang", "k_source", "estimate", "failed", "distance", "kept")


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the statistics, base_failed, kept and the scaled squared distance."""
    n = unclash(docs, *_NAMES)
    rows = with_statistics(docs.select("doc_id", "lang", "source", "text"), n).drop("text")
    rows = judged(staged(rows, "quality-rows"), n)
    return rows.select("doc_id", *[F.col(n[k]).alias(k) for k in STATS[:5]], F.col(n["failed"]).alias("base_failed"),
                       F.col(n["kept"]).alias("kept"), F.round(n["distance"], 3).alias("distance"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, with the input's columns."""
    n = unclash(docs, *_NAMES)
    rows = judged(staged(with_statistics(docs, n), "quality-rows", "zstd"), n)
    return rows.filter(F.col(n["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents")).drop("distance")


def oracle_sql() -> str:
    """The query in DuckDB SQL: windows are rows there, groups are named by one text, and each
    step of the estimate is a pair of common table expressions."""
    dims = range(DIM)
    pairs = [(i, j) for i in dims for j in range(i + 1)]
    factor = lambda cov: ", ".join(  # noqa: E731  later columns use earlier ones of the same select
        (f"sqrt(greatest({cov(i, j)} + {FLOORS[i] ** 2}" if i == j else f"({cov(i, j)}")
        + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j)) + (", 1e-6))" if i == j else f") / l{j}{j}") + f" AS l{i}{j}" for i, j in pairs)
    z = ", ".join(f"(v{i} - m{i}" + "".join(f" - l{i}{j} * z{j}" for j in range(i)) + f") / l{i}{i} AS z{i}" for i in dims)
    d2 = "(" + " + ".join(f"z{i} * z{i}" for i in dims) + ")"
    m, v = ", ".join(f"m{i}" for i in dims), ", ".join(f"v{i}" for i in dims)
    chars = "\\x20\\x09-\\x0D"
    each = lambda text: ", ".join(text.replace("#", str(i)) for i in dims)
    det = " * ".join(f"(l{i}{i} * l{i}{i})" for i in dims)
    steps = [f"""
a0 AS MATERIALIZED (
  SELECT g, count(*) AS n, {each("quantile_cont(v#, 0.25)::DOUBLE AS lo#, quantile_cont(v#, 0.5)::DOUBLE AS mid#, quantile_cont(v#, 0.75)::DOUBLE AS hi#")},
         {each("avg(v#::DOUBLE) AS a#, avg(v#::DOUBLE * v#) AS b#")} FROM r GROUP BY g),
b0 AS (
  SELECT g, 0 AS s, n, {each("mid# AS m#, (hi# - lo#) / 1.349::DOUBLE AS s#")} FROM a0 UNION ALL
  SELECT g, 1, n, {each("a#, sqrt(greatest(b# - a# * a#, 0.0::DOUBLE))")} FROM a0 UNION ALL
  SELECT g, 2, n, {each("lo#, (hi# - lo#) / 1.349::DOUBLE")} FROM a0),
e0 AS MATERIALIZED (
  SELECT g, s, n, {m}, {factor(lambda i, j: f"s{i} * s{i}" if i == j else "0.0::DOUBLE")}, 'infinity'::DOUBLE AS det FROM b0)"""]

    def placed(k: int, share: float) -> str:
        return f"""
p{k} AS MATERIALIZED (SELECT g, s, {v}, {z}, floor(ln(1 + {d2}) * {BINS}) AS bin FROM r JOIN e{k} USING (g)),
c{k} AS (SELECT g, s, min(bin) AS cut FROM (
  SELECT g, s, bin, sum(count(*)) OVER (PARTITION BY g, s ORDER BY bin) AS cum, sum(count(*)) OVER (PARTITION BY g, s) AS whole FROM p{k} GROUP BY g, s, bin)
  WHERE cum >= whole * {share}::DOUBLE GROUP BY g, s)"""

    columns = ["n", *[f"m{i}" for i in dims], *[f"l{i}{j}" for i, j in pairs], "det"]
    for k in range(MAX_STEPS):
        steps += [placed(k, CORE_SHARE), f"""
n{k + 1} AS (SELECT *, {det} AS det FROM (SELECT g, s, n, {m}, {factor(lambda i, j: f"q{i}{j} - m{i} * m{j}")} FROM (
  SELECT g, s, count(*) AS n, {each("avg(v#::DOUBLE) AS m#")}, {", ".join(f"avg(v{i}::DOUBLE * v{j}) AS q{i}{j}" for i, j in pairs)}
  FROM p{k} JOIN c{k} USING (g, s) WHERE bin <= cut GROUP BY g, s))),
e{k + 1} AS MATERIALIZED (SELECT g, s, {", ".join(f"CASE WHEN f.det < o.det THEN f.{c} ELSE o.{c} END AS {c}" for c in columns)}
  FROM n{k + 1} f JOIN e{k} o USING (g, s))"""]
    last = MAX_STEPS + 1
    steps.append(f"""
e{last} AS MATERIALIZED (SELECT DISTINCT ON (g) * FROM e{MAX_STEPS} ORDER BY g, det, s),""" + placed(last, 0.5).lstrip())
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS i, doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^{chars}]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{chars}]')) AS lines
  FROM documents),
w AS (SELECT i, pos, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c
      FROM (SELECT i, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM t) WINDOW o AS (PARTITION BY i ORDER BY pos)),
tri AS (SELECT i, pos, count(*) OVER (PARTITION BY i, a, b, c) AS found FROM w WHERE c IS NOT NULL),
rep AS (SELECT i, sum(span)::BIGINT AS n FROM (
  SELECT i, least(3, coalesce(lead(pos) OVER (PARTITION BY i ORDER BY pos) - pos, 3)) AS span FROM tri WHERE found > 1) GROUP BY i),
s AS (
  SELECT i, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '{SYMBOLS}', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(ws) < {MIN_WORDS} OR 100 * coalesce(n, 0) > {MAX_REPEAT_PERCENT} * len(ws) AS base_failed
  FROM t LEFT JOIN rep USING (i)),
f AS (
  SELECT i, coalesce('=' || lang, '-') AS a, coalesce('=' || source, '-') AS b, round(ln(word_chars / n_words::DOUBLE) * {UNIT})::BIGINT AS v0,
         round(sqrt(n_symbols / n_words::DOUBLE) * {UNIT})::BIGINT AS v1, round(n_dup_lines / n_lines::DOUBLE * {UNIT})::BIGINT AS v2,
         round(n_repeat_words / n_words::DOUBLE * {UNIT})::BIGINT AS v3
  FROM s WHERE NOT base_failed),
k AS (SELECT a, b, n, sum(n) FILTER (WHERE n < {MIN_GROUP}) OVER (PARTITION BY a) AS pool FROM (SELECT a, b, count(*) AS n FROM f GROUP BY a, b)),
r AS (SELECT i, {v}, CASE WHEN n >= {MIN_GROUP} THEN 'own' || a || ' ' || b WHEN pool >= {MIN_GROUP} THEN 'pool' || a ELSE 'all' END AS g FROM f JOIN k USING (a, b)),
{",".join(steps)},
o AS (SELECT i, n >= {MIN_FIT} AND {d2} / greatest((exp((cut + 1) / {BINS}.0::DOUBLE) - 1) / {MEDIAN_CHI2}, 1.0) > {CUTOFF} AS far
      FROM (SELECT i, n, cut, {z} FROM r JOIN e{last} USING (g) JOIN c{last} USING (g)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(far, false) AS kept
FROM s LEFT JOIN o USING (i)
"""


ORACLE = oracle_sql()
