"""Quality rules: fixed limits, and robust multivariate outliers per language and source.

A document is described by ``STATISTICS``, logarithms of ratios kept as whole thousandths, so that sums over rows
are exact and reruns agree. For every group the minimum covariance determinant is estimated: from two robust starts,
the rows with the smallest distances give a mean and a covariance, which give new distances, and so on until no
determinant falls; the estimate with the smallest determinant is kept. Documents far from it by Mahalanobis distance are rejected.

All of it is built-in functions. A step is one aggregate of a narrow table: map-side sums and histograms, one row
per group, whatever a group's share of the rows. Matrices are factored by expressions on the table of groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webgraph_spark.functions.binding import bind
from webgraph_spark.llm.common import SPACE, same, whole_text
from webgraph_spark.session import cut_lineage

# Fixed values of the base rules.
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent

# name: spread that counts as none. It is added to the covariance, so a statistic that is the same for nearly all
# documents of a group does not reject small deviations.
STATISTICS = {
    "z_word": 0.10,  # mean length of words
    "z_symbol": 0.60,  # symbols among characters
    "z_upper": 0.30,  # capital letters among characters
    "z_mark": 0.60,  # exclamation and question marks among characters
    "z_repeat": 0.60,  # words in repeated windows among words
    "z_distinct": 0.30,  # words per distinct word
}
NAMES = list(STATISTICS)
SCALE = 1000
LIMIT = 10 * SCALE  # statistics are clipped here, which keeps sums of squares in 64 bits

LEAST_ROWS = 100  # smaller groups are pooled by language, then all together
SHARE = 0.75  # of a group's rows in the subset
MOST_STEPS = 200  # far more than subsets need to settle; an error beyond
# For six statistics, the factor that makes the covariance of the nearest three quarters that of all rows of a
# normal distribution; and the squared distance that rejects, the 0.999 quantile of chi-square.
CONSISTENCY = 1.36
CUTOFF = 22.46

STARTS = 2


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def _window_hashes(words: Column) -> Column:
    """The hash of each window of WINDOW words, in order."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(own: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(own) - WINDOW), lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(WINDOW)])
        )

    return F.when(F.size(words) >= WINDOW, bind(hashes, windows)).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs more than once."""

    def repeated(ordered: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)["h"] == x["h"]
            after = F.get(ordered, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.filter(ordered, twin)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.sort_array(F.transform(bind(pairs, repeated), lambda x: x["i"]))

    def step(done: Column, place: Column) -> Column:
        end = place + WINDOW
        more = end - F.greatest(place, done["end"])
        return F.struct(end.cast("int").alias("end"), (done["words"] + more).cast("int").alias("words"))

    return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")), step)["words"]


def _statistic(value: Column) -> Column:
    clipped = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.round(F.log(value) * SCALE)))
    return clipped.cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with the base counts, base_failed and STATISTICS.

    A NULL text counts as empty: no words, all counts 0, and it fails. Columns of these names in ``docs`` are
    replaced, all others stay. Equal rows give equal results.
    """
    text = whole_text()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.withColumns({"_words": _words(text), "_lines": lines})
    second = first.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_distinct": F.size(F.array_distinct("_words")),
            "_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
            "_marks": F.regexp_count(text, F.lit("[!?]")),
            "_hashes": _window_hashes(F.col("_words")),
        }
    ).drop("_words", "_lines")
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    third = second.withColumn("n_repeat_words", F.when(repeats, _covered(F.col("_hashes"))).otherwise(0).cast("long"))
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return third.withColumns(
        {
            "base_failed": (F.col("n_words") < LEAST_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED),
            "z_word": _statistic(chars / words),
            "z_symbol": _statistic(F.col("n_symbols") / chars + 0.005),
            "z_upper": _statistic(F.col("_upper") / chars + 0.01),
            "z_mark": _statistic(F.col("_marks") / chars + 0.005),
            "z_repeat": _statistic(F.col("n_repeat_words") / words + 0.02),
            "z_distinct": _statistic(words / F.greatest(F.col("_distinct"), F.lit(1))),
        }
    ).drop("_hashes", "_distinct", "_upper", "_marks")


def grouped(measured: DataFrame) -> DataFrame:
    """Adds _group: language and source, or a pool for groups of fewer than LEAST_ROWS good rows."""
    good = measured.where(~F.col("base_failed"))
    counts = good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n"))
    large = F.col("_n") >= LEAST_ROWS
    rest = F.sum(F.when(~large, F.col("_n")).otherwise(0)).over(Window.partitionBy("lang"))
    own = F.concat_ws("\x01", F.lit("source"), F.coalesce("lang", F.lit("\x02")), F.coalesce("source", F.lit("\x02")))
    pooled = F.concat_ws("\x01", F.lit("lang"), F.coalesce("lang", F.lit("\x02")))
    name = F.when(large, own).when(rest >= LEAST_ROWS, pooled).otherwise("rest")
    named = counts.select("lang", "source", name.alias("_group"))
    return same(measured, named, ["lang", "source"])


def _quartiles(rows: DataFrame) -> DataFrame:
    """(_group, names_low, names_mid, names_high): quartiles to a hundredth, from one histogram."""
    width = SCALE // 100
    long = rows.select(
        "_group", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.floor(F.col(n) / width).alias("bin")) for n in NAMES])).alias("v")
    )
    counts = long.groupBy("_group", "v.name", "v.bin").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("_group", "name")
    upto = inside.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(inside)})

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bin"))) * width

    each = running.groupBy("_group", "name").agg(quantile(0.25).alias("low"), quantile(0.5).alias("mid"), quantile(0.75).alias("high"))
    by_name = [
        F.max(F.when(F.col("name") == n, F.struct("low", "mid", "high"))).alias(n) for n in NAMES
    ]
    return each.groupBy("_group").agg(*by_name)


def _start_estimates(rows: DataFrame) -> DataFrame:
    """(_group, _start, _mean, _axes) for each start: centre at the medians, axes scaled by the quartiles.

    The second start leans on the statistic that strays most: its scales are all set to the group's widest.
    """
    quartiles = _quartiles(rows)
    mean = F.array(*[F.col(n)["mid"].cast("double") for n in NAMES])
    scales = [
        F.greatest((F.col(n)["high"] - F.col(n)["low"]) / 1.349, F.lit(STATISTICS[n] * SCALE)) for n in NAMES
    ]
    widest = F.greatest(*scales)
    size = len(NAMES)
    both = []
    for start in range(STARTS):
        spread = scales if start == 0 else [widest] * size
        axes = F.array(*[1.0 / spread[i] if i == j else F.lit(0.0) for i in range(size) for j in range(i + 1)])
        both.append(F.struct(F.lit(start).alias("_start"), mean.alias("_mean"), axes.alias("_axes"), F.lit(0.0).alias("_log_det")))
    return quartiles.select("_group", F.explode(F.array(*both)).alias("e")).select("_group", "e.*")


def _distance(mean: Column, axes: Column) -> Column:
    """Squared Mahalanobis distance: the axes are the rows of the inverse of the covariance's lower factor."""
    total, at = F.lit(0.0), 0
    offsets = [F.col(n) - F.get(mean, F.lit(i)) for i, n in enumerate(NAMES)]
    for i in range(len(NAMES)):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.get(axes, F.lit(at)) * offsets[j]
            at += 1
        total = total + part * part
    return total


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(estimates, "_group").withColumn("_d2", _distance(F.col("_mean"), F.col("_axes")))


def _subset(distances: DataFrame) -> DataFrame:
    """(_group, _start, _bin_limit): the histogram bin of distances that completes SHARE of the rows."""
    counts = distances.groupBy("_group", "_start", "_bin").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("_group", "_start")
    upto = inside.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(inside)})
    limit = F.min(F.when(F.col("upto") >= F.col("all") * SHARE, F.col("_bin")))
    return running.groupBy("_group", "_start").agg(limit.alias("_bin_limit"))


def _factor(moments: DataFrame) -> DataFrame:
    """Mean, axes and log determinant of each group's covariance, by expressions on the table of groups."""
    size = len(NAMES)
    n = F.col("n").cast("double")
    table = moments.withColumns({f"m{i}": F.col(f"s{i}") / n for i in range(size)})
    for i in range(size):
        for j in range(i + 1):
            value = F.col(f"q{i}_{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + (list(STATISTICS.values())[i] * SCALE) ** 2
            value = value - reduce(lambda a, b: a + b, [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)], F.lit(0.0))
            # The floor on the diagonal keeps what is under the root positive but for rounding.
            table = table.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(value, F.lit(1e-6))) if i == j else value / F.col(f"l{j}_{j}"))
    for i in range(size):
        for j in range(i, -1, -1):
            if i == j:
                value = 1.0 / F.col(f"l{i}_{i}")
            else:
                value = -reduce(lambda a, b: a + b, [F.col(f"l{i}_{k}") * F.col(f"a{k}_{j}") for k in range(j, i)]) / F.col(f"l{i}_{i}")
            table = table.withColumn(f"a{i}_{j}", value)
    return table.select(
        "_group",
        "_start",
        F.array(*[F.col(f"m{i}") for i in range(size)]).alias("_mean"),
        F.array(*[F.col(f"a{i}_{j}") for i in range(size) for j in range(i + 1)]).alias("_axes"),
        reduce(lambda a, b: a + b, [F.log(F.col(f"l{i}_{i}")) for i in range(size)]).alias("_log_det"),
    )


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """New estimates from the rows of each group that are nearest to the old ones."""
    bins = F.floor(F.log2(F.col("_d2") + 1.0) * 64).cast("int")
    distances = _with_distance(rows, estimates).withColumn("_bin", bins).select("_group", "_start", "_bin", *NAMES)
    limits = cut_lineage(_subset(distances), "mcd-limits")  # written, so that its size is known: rows need no shuffle
    near = distances.join(limits, ["_group", "_start"]).where(F.col("_bin") <= F.col("_bin_limit"))
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)]
    squares = [
        F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"q{i}_{j}") for i in range(len(NAMES)) for j in range(i + 1)
    ]
    moments = near.groupBy("_group", "_start").agg(F.count(F.lit(1)).alias("n"), *sums, *squares)
    return _factor(cut_lineage(moments, "mcd-moments"))


def estimates(rows: DataFrame) -> DataFrame:
    """(_group, _mean, _axes): the estimate with the smallest determinant of all steps, for groups of at least LEAST_ROWS rows.

    ``rows`` has _group and STATISTICS; only rows that pass the base rules should be among them.
    """
    enough = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= LEAST_ROWS)
    current = cut_lineage(_start_estimates(rows).join(enough.select("_group"), "_group", "left_semi"), "mcd-start")
    # The determinant of a start is that of no subset, so every first step counts as a fall.
    current, all_steps = current.withColumn("_log_det", F.lit(float("inf"))), None
    for _ in range(MOST_STEPS):
        before = current.select("_group", "_start", F.col("_log_det").alias("_before"))
        new = cut_lineage(_step(rows, current).join(before, ["_group", "_start"]), "mcd-step")
        all_steps = new if all_steps is None else all_steps.unionByName(new)
        # Sums are whole numbers, so a subset that stays gives the same determinant to the last bit.
        current = new.where(F.col("_log_det") < F.col("_before")).drop("_before")
        if current.isEmpty():
            break
    else:
        raise RuntimeError(f"a determinant still falls after {MOST_STEPS} steps")
    best = F.min_by(F.struct("_mean", "_axes"), F.struct("_log_det", "_start"))
    return all_steps.groupBy("_group").agg(best.alias("e")).select("_group", "e.*")


def judge(measured: DataFrame) -> DataFrame:
    """``measured`` (lang, source and the columns of ``measure``) with distance and kept.

    ``measured`` should be a written table: it is read several times, a few columns each time. distance is NULL
    where no estimate fits: rows that fail the base rules, and pools of fewer than LEAST_ROWS rows, which only the
    base rules judge. NULL languages and sources are values of their own. An empty table gives an empty table.
    """
    # Other columns may have any names, so they go along in one; distance and kept of the input are replaced.
    others = [c for c in measured.columns if c not in ("distance", "kept")]
    row = F.struct(*[measured[c] for c in others]).alias("_row")
    named = grouped(measured.select(row, "lang", "source", "base_failed", *NAMES))
    good = named.where(~F.col("base_failed") & F.col("_group").isNotNull()).select("_group", *NAMES)
    fitted = estimates(cut_lineage(good, "mcd-rows"))
    judged = named.join(fitted, "_group", "left")
    d2 = _distance(F.col("_mean"), F.col("_axes")) / CONSISTENCY
    distance = F.when(~F.col("base_failed") & F.col("_mean").isNotNull(), F.sqrt(d2))
    return (
        judged.withColumn("distance", distance)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF**0.5, F.lit(True)))
        .select("_row.*", "distance", "kept")
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, same columns."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "text", "lang", "source")
    measured = measure(rows)
    needed = ["_row", "lang", "source", "base_failed", *NAMES]
    return judge(cut_lineage(measured.select(*needed), "quality-rows")).where("kept").select("_row.*")
