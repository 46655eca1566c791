"""Quality rules: text statistics, and robust multivariate outliers among them.

Per language and source, location and scatter of a transformed statistic vector are
estimated by the minimum covariance determinant: from a start at the medians, the rows with
the smallest Mahalanobis distances are kept and the mean and covariance taken of them, again
and again (C-steps; each lowers the determinant). The scatter is scaled to the median
distance, re-weighted once, and rows far outside are rejected. All of it is DataFrame
expressions; the estimates are a table with one row per language and source.

Sources with fewer than ``min_rows`` rows of a language are pooled, as are languages with
fewer than that. A lower bound on each variance keeps a statistic that is constant in most
texts from rejecting every other value.

Defined cases: a NULL or empty text has zero words and fails the base rule; NULL lang or
source are a group of their own; NULL doc_id and repeated rows are judged each for itself;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import stage, table

SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5

GROUP = ["group_lang", "group_source"]
#: Smallest standard deviation of each statistic, on its transformed scale.
FLOORS = {"f_word_length": 0.10, "f_symbols": 0.50, "f_dup_lines": 0.50, "f_repeats": 0.50}
FEATURES = list(FLOORS)
#: Quantiles of the chi-squared distribution with four degrees of freedom.
CHI_MEDIAN, CHI_975, CHI_CUT = 3.3567, 11.1433, 33.3770


@dataclass
class Settings:
    share: float = 0.75
    steps: int = 4
    min_rows: int = 50
    cutoff: float = CHI_CUT
    accuracy: int = 10_000


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(body, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE}+"))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    kept = docs.columns
    parts = docs.select("*", words.alias("_words"), lines.alias("_lines"), F.length(F.regexp_replace(body, SYMBOLS, "")).cast("long").alias("n_symbols"))
    sized = parts.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    return sized.withColumn("_windows", window_keys(F.col("_hashes"), F.col("n_words"))).select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated_words(F.col("_windows")).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def window_keys(hashes: Column, n: Column) -> Column:
    """A 64-bit key of every window of words, in order; empty where the text is shorter."""
    width = F.greatest(n - WINDOW + 1, F.lit(0)).cast("int")
    shifted = [F.slice(hashes, i + 1, width) for i in range(WINDOW)]
    return F.transform(F.arrays_zip(*shifted), lambda w: F.xxhash64(w))


def repeated_words(keys: Column) -> Column:
    """Words covered by windows whose key occurs twice or more."""
    placed = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("p"))))

    # The sorted array is bound once, so that its neighbours are looked up and not sorted anew.
    def covered(z: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before, after = F.get(z, i - 1)["k"], F.get(z, i + 1)["k"]
            return F.coalesce(x["k"] == before, F.lit(False)) | F.coalesce(x["k"] == after, F.lit(False))

        starts = F.array_sort(F.transform(F.filter(z, twice), lambda x: x["p"]))
        return F.transform(F.array(starts), lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda a, b: a + b))[0]

    found = F.transform(F.array(placed), covered)[0]
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(found).cast("long")


def with_features(rows: DataFrame) -> DataFrame:
    """Statistics per word on a logarithmic scale, where sources differ less in spread."""
    n = F.greatest(F.col("n_words"), F.lit(1))

    def share(column: str) -> Column:
        return F.log1p(100 * F.col(column) / n)

    return rows.withColumns({
        "f_word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), "f_symbols": share("n_symbols"),
        "f_dup_lines": share("n_dup_lines"), "f_repeats": share("n_repeat_words"),
    })


def pooled_groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """For each language and source, the group its rows are estimated in."""
    counts = rows.groupBy("lang", "source").agg(F.sum(F.when(~F.col("base_failed"), 1).otherwise(0)).alias("n"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("n_lang")).withColumnRenamed("lang", "key_lang")
    joined = counts.join(langs, F.col("lang").eqNullSafe(F.col("key_lang")))
    own, by_lang = F.col("n") >= min_rows, F.col("n_lang") >= min_rows

    def named(name: str) -> Column:
        return F.when(F.col(name).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(name)))

    return joined.select(
        F.col("lang").alias("key_lang"),
        F.col("source").alias("key_source"),
        F.when(own | by_lang, named("lang")).otherwise("*").alias("group_lang"),
        F.when(own, named("source")).otherwise("*").alias("group_source"),
    )


def in_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    on = F.col("lang").eqNullSafe(F.col("key_lang")) & F.col("source").eqNullSafe(F.col("key_source"))
    return rows.join(groups, on, "left").drop("key_lang", "key_source")


def start(rows: DataFrame, accuracy: int) -> DataFrame:
    """Medians, and the spread around them, as a first location and scatter."""
    # Limits and medians are staged: as small tables of known size they are broadcast, and the rows need no shuffle.
    middle = stage(rows.groupBy(*GROUP).agg(*[F.percentile_approx(f, 0.5, accuracy).alias(f"m_{f}") for f in FEATURES]), "mcd_medians")
    off = rows.join(middle, GROUP).groupBy(*GROUP).agg(
        *[F.first(f"m_{f}").alias(f"m_{f}") for f in FEATURES],
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5, accuracy).alias(f"d_{f}") for f in FEATURES],
    )
    spread = {(i, j): (F.lit(0.0) if i != j else F.pow(1.4826 * F.col(f"d_{FEATURES[i]}"), 2)) for i in range(4) for j in range(i + 1)}
    return with_factor(off, spread, F.lit(1.0))


def with_factor(groups: DataFrame, scatter: dict[tuple[int, int], Column], scale: Column) -> DataFrame:
    """Keep the location and the lower triangular factor of the bounded scatter (Cholesky)."""
    out = groups
    for i in range(4):
        for j in range(i + 1):
            value = scatter[i, j] * scale
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + FLOORS[FEATURES[i]] ** 2
            for k in range(j):
                value = value - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            out = out.withColumn(f"l_{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l_{j}{j}"))
    return out.select(*GROUP, *[f"m_{f}" for f in FEATURES], *[f"l_{i}{j}" for i in range(4) for j in range(i + 1)])


def distance(rows: DataFrame, estimates: DataFrame, name: str = "d2") -> DataFrame:
    """Add the squared Mahalanobis distance from the row's group."""
    out = rows.join(estimates, GROUP, "left")
    for i, f in enumerate(FEATURES):
        value = F.col(f) - F.col(f"m_{f}")
        for k in range(i):
            value = value - F.col(f"l_{i}{k}") * F.col(f"_y{k}")
        out = out.withColumn(f"_y{i}", value / F.col(f"l_{i}{i}"))
    total = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, 4)), F.col("_y0") * F.col("_y0"))
    return out.withColumn(name, total).drop(*[f"_y{i}" for i in range(4)], *[c for c in estimates.columns if c not in GROUP])


def location_and_scatter(rows: DataFrame, scale: Column) -> DataFrame:
    """Mean and covariance of rows, and the factor of the covariance times ``scale``."""
    pairs = [(i, j) for i in range(4) for j in range(i + 1)]
    sums = rows.groupBy(*GROUP).agg(
        *[F.avg(f).alias(f"m_{f}") for f in FEATURES],
        *[F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c_{i}{j}") for i, j in pairs],
        F.first("scale").alias("scale"),
    )
    return with_factor(sums, {(i, j): F.col(f"c_{i}{j}") for i, j in pairs}, scale)


def estimate(rows: DataFrame, settings: Settings) -> DataFrame:
    """Location and factor of the scatter of every group, from rows with GROUP and FEATURES."""
    found = stage(start(rows, settings.accuracy), "mcd_start")
    for step in range(settings.steps):
        far = distance(rows, found)
        limit = stage(far.groupBy(*GROUP).agg(F.percentile_approx("d2", settings.share, settings.accuracy).alias("limit")), "mcd_limits")
        near = far.join(limit, GROUP).where("d2 <= limit").withColumn("scale", F.lit(1.0))
        found = stage(location_and_scatter(near, F.col("scale")), f"mcd_step{step}")
    # Scale the scatter so that the median distance is what it is in a normal population.
    far = distance(rows, found)
    middle = stage(far.groupBy(*GROUP).agg((F.percentile_approx("d2", 0.5, settings.accuracy) / CHI_MEDIAN).alias("scale")), "mcd_scales")
    near = far.join(middle, GROUP).where(F.col("d2") <= CHI_975 * F.greatest(F.col("scale"), F.lit(1.0)))
    return stage(location_and_scatter(near, F.lit(1.0)), "mcd_reweighted")


def verdicts(rows: DataFrame, groups: DataFrame, estimates: DataFrame, settings: Settings) -> DataFrame:
    """Add ``distance`` and ``kept`` to rows with statistics."""
    judged = distance(in_groups(with_features(rows), groups), estimates, "distance")
    # A group without an estimate has no row that passed the base rule.
    near = F.coalesce(F.col("distance") <= settings.cutoff, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & near).drop(*GROUP, *FEATURES)


def fit(statistics: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The groups and their estimates, from staged rows with lang, source and statistics."""
    groups = stage(pooled_groups(statistics, settings.min_rows), "mcd_groups")
    rows = in_groups(with_features(statistics.where(~F.col("base_failed"))), groups).select(*GROUP, *FEATURES)
    return groups, estimate(rows, settings)


def staged_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    return stage(with_statistics(docs.select(*keep, "lang", "source", "text")).drop("text"), "text_statistics")


def outliers(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and the distance of every document."""
    settings = settings or Settings()
    statistics = staged_statistics(docs, "doc_id")
    groups, estimates = fit(statistics, settings)
    return verdicts(statistics, groups, estimates, settings).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def keep_inliers(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents that are kept, with all their columns.

    The statistics are taken twice, once to estimate and once to judge, which costs less than
    to shuffle every text for a join with its verdict.
    """
    settings = settings or Settings()
    groups, estimates = fit(staged_statistics(docs), settings)
    names = docs.columns
    rows = with_statistics(docs.select(F.struct(*names).alias("_row"), "lang", "source", "text"))
    return verdicts(rows, groups, estimates, settings).where("kept").select("_row.*")


def op3_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers(table(spark, sf_dir, "documents"))
