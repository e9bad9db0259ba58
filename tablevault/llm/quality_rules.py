"""Quality rules: two fixed ones, and robust outliers per language and source.

Everything is a DataFrame expression or aggregate. The statistics of each text
become a vector of four transformed values. Per (language, source) group the
minimum-covariance-determinant estimate of centre and scatter is found by
concentration steps: take the ``CORE`` share of rows nearest to the centre, compute
their mean and covariance, measure again, until the determinant no longer falls.
They are run from three starts (coordinate-wise medians with three shapes of the
scatter); the one that ends at the smallest determinant counts. A ridge keeps the
scatter invertible where a value hardly varies. A text is rejected if its squared
Mahalanobis distance exceeds ``CUTOFF``.

The ridge is the least standard deviation, so a value alone cannot reject below
``sqrt(CUTOFF)`` ridges. Of the repeated lines and words of clean texts nearly
all shares are 0; one line said twice in a short text gives up to a third of either.
Their ridge of 1/16 lets that pass in the tightest group and rejects a text with
over 0.44 of its lines or words repeated there, below the base rule's half.

A step is one aggregate by group and distance bin, so a group that holds most
rows is summed before anything is shuffled. Values are whole numbers of 1/1024,
so sums do not depend on the order of rows and reruns agree.

Null and empty texts have no words and fail the base rule, like all texts under
50 words. Groups of fewer than ``MIN_GROUP`` rows are pooled into one; null
language or source is a value of its own. Repeated rows count as often as they
stand there. Other columns are left alone; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablevault.llm.common import WORD_PATTERN, written

CORE = 0.5  # nearly half of a group may be outliers
TOLERANCE = 1e-4  # by which half the determinant's logarithm falls, for a step to count
MIN_GROUP = 20
UNIT = 1024
SYMBOLS = "[#*$%&|<>]"
VALUES = ("x0", "x1", "x2", "x3")
PAIRS = tuple((x, y) for i, x in enumerate(VALUES) for y in VALUES[:i + 1])
LOWER = tuple(f"l_{i}{j}" for i in range(len(VALUES)) for j in range(i + 1))
KEYS = ("g", "start")
# Standard deviations added as a ridge: log word length, log symbol share, share
# of repeated lines, share of repeated words.
RIDGE = (0.06, 0.12, 0.0625, 0.0625)
# Scatter of the core is too small by CORE / P(chi2(6) <= chi2 quantile CORE of 4).
CONSISTENCY = 2.109
CUTOFF = 48.0  # a chi-square value with 4 degrees of freedom is above it once in 10**9


def text_statistics(text: Column) -> dict[str, Column]:
    """Expressions that need only the text; ``with_statistics`` adds the rest."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_PATTERN))
    return {"_words": F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1)),
            "_lines": lines,
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long")}


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``,
    ``n_dup_lines``, ``n_repeat_words``, and without the text."""
    keep = [F.col(c) for c in docs.columns if c != text_col]
    df = docs.select(*keep, *(e.alias(n) for n, e in text_statistics(F.col(text_col)).items()))
    names = [F.col(c) for c in df.columns if c not in ("_words", "_lines")]
    df = df.select(
        *names, F.size("_words").cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # hashes of the windows of three words
        F.when(F.size("_words") > 2, F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))).alias("_windows"))
    # only texts with a repeated window are looked at again
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_at", F.sort_array(F.transform(
        F.filter("_sorted", lambda x, k: (x["h"] == F.get("_sorted", k - 1)["h"]) | (x["h"] == F.get("_sorted", k + 1)["h"])),
        lambda x: x["i"])))
    covered = F.aggregate("_at", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")))
    return df.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long")).drop(
        "_windows", "_sorted", "_at")


def _vectors(stats: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    values = (F.log(F.col("word_chars") / F.col("n_words")), F.log1p(F.col("n_symbols") * 50 / F.col("word_chars")),
              F.col("n_dup_lines") / F.col("n_lines"), F.col("n_repeat_words") / F.col("n_words"))
    df = stats.withColumn("base_failed", failed)
    return df.withColumns({x: F.when(~F.col("base_failed"), F.round(v * UNIT).cast("long"))
                           for x, v in zip(VALUES, values)})


def _factored(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys``, the centre, the lower triangle (``l_ij``) of the scatter whose entries
    are ``c_xy``, and ``log_det``, half the logarithm of its determinant."""
    for i, x in enumerate(VALUES):
        for j, y in enumerate(VALUES[:i + 1]):
            rest = F.col(f"c_{x}{y}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            if i == j:  # the ridge bounds it from below but for rounding
                df = df.withColumn(f"l_{i}{i}", F.sqrt(F.greatest(rest, F.lit(RIDGE[i] ** 2 * 1e-3))))
            else:
                df = df.withColumn(f"l_{i}{j}", rest / F.col(f"l_{j}{j}"))
    log_det = sum((F.log(f"l_{i}{i}") for i in range(1, len(VALUES))), F.log("l_00"))
    return df.select(*keys, *(f"m_{x}" for x in VALUES), *LOWER, log_det.alias("log_det"))


def _parameters(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``_factored`` from the core's sums."""
    df = sums.select(*keys, *((F.col(f"s_{x}") / F.col("n") / UNIT).alias(f"m_{x}") for x in VALUES),
                     *((F.col(f"p_{x}{y}") / F.col("n") / (UNIT * UNIT)).alias(f"q_{x}{y}") for x, y in PAIRS))
    for x, y in PAIRS:
        c = (F.col(f"q_{x}{y}") - F.col(f"m_{x}") * F.col(f"m_{y}")) * CONSISTENCY
        df = df.withColumn(f"c_{x}{y}", F.greatest(c, F.lit(0.0)) + RIDGE[VALUES.index(x)] ** 2 if x == y else c)
    return _factored(df, keys)


def _with_distance(df: DataFrame) -> DataFrame:
    """Adds ``distance``, the squared Mahalanobis distance, by forward substitution."""
    for i, x in enumerate(VALUES):
        rest = F.col(x) / UNIT - F.col(f"m_{x}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}{k}") * F.col(f"_y{k}")
        df = df.withColumn(f"_y{i}", rest / F.col(f"l_{i}{i}"))
    total = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, len(VALUES))), F.col("_y0") * F.col("_y0"))
    return df.withColumn("distance", total).drop(*(f"_y{i}" for i in range(len(VALUES))))


def _starts(rows: DataFrame) -> DataFrame:
    """Three starts for each group ``g``, all at the coordinate-wise medians and with
    the quartiles' spread, and with no correlation (0), that of the values through
    tanh (1), or that of their directions from the medians (2)."""
    quartiles = rows.groupBy("g").agg(*(F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"_q_{x}")
                                        for x in VALUES))
    first = written(quartiles.select(
        "g", *((F.col(f"_q_{x}")[1] / UNIT).alias(f"m_{x}") for x in VALUES),
        *(F.sqrt(F.pow((F.col(f"_q_{x}")[2] - F.col(f"_q_{x}")[0]) / (1.349 * UNIT), 2) + RIDGE[i] ** 2).alias(f"d_{x}")
          for i, x in enumerate(VALUES))), "medians")
    scaled = rows.join(first, "g").select("g", *(((F.col(x) / UNIT - F.col(f"m_{x}")) / F.col(f"d_{x}")).alias(x) for x in VALUES))
    norm = F.sqrt(sum((F.col(x) * F.col(x) for x in VALUES[1:]), F.col(VALUES[0]) * F.col(VALUES[0])))
    shapes = []
    for value in (F.tanh, lambda x: F.when(norm > 0, F.col(x) / norm).otherwise(0.0)):
        whole = scaled.select("g", *(F.round(value(x) * UNIT).cast("long").alias(x) for x in VALUES))
        shapes.append(whole.groupBy("g").agg(*((F.sum(F.col(x) * F.col(y)) / F.count("*") / (UNIT * UNIT)).alias(f"r_{x}{y}")
                                               for x, y in PAIRS)))
    none = first.select("g", *(F.lit(0.0).alias(f"r_{x}{y}") for x, y in PAIRS))
    shapes = [shape.withColumn("start", F.lit(k)) for k, shape in enumerate((none, *shapes))]
    df = first.join(shapes[0].unionByName(shapes[1]).unionByName(shapes[2]), "g")
    # a little on the diagonal keeps the correlations positive definite
    spread = {x: F.col(f"r_{x}{x}") + 0.01 for x in VALUES}
    df = df.withColumns({f"c_{x}{y}": F.col(f"d_{x}") * F.col(f"d_{y}") * (
        F.lit(1.0) if x == y else F.col(f"r_{x}{y}") / F.sqrt(spread[x] * spread[y])) for x, y in PAIRS})
    return _factored(df, KEYS)


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and scatter by group ``g`` of rows with ``VALUES``."""
    # the first step of a start always counts: its scatter is not that of a core
    found = written(_starts(rows).withColumn("log_det", F.lit(float("inf"))).withColumn("moved", F.lit(True)), "centres")
    while not found.where("moved").isEmpty():  # ends: every further step lowers a determinant that the ridge bounds
        near = _with_distance(rows.join(found.where("moved"), "g")).withColumn("bin", F.floor(F.log1p("distance") * 64))
        bins = near.groupBy(*KEYS, "bin").agg(
            F.count("*").alias("n"), *(F.sum(x).alias(f"s_{x}") for x in VALUES),
            *(F.sum(F.col(x) * F.col(y)).alias(f"p_{x}{y}") for x, y in PAIRS))
        upto = W.partitionBy(*KEYS).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
        names = [c for c in bins.columns if c not in (*KEYS, "bin")]
        core = bins.select(*KEYS, "bin", F.sum("n").over(W.partitionBy(*KEYS)).alias("_all"),
                           *(F.sum(c).over(upto).alias(c) for c in names))
        core = core.where(F.col("n") >= F.col("_all") * CORE).withColumn(
            "_first", F.row_number().over(W.partitionBy(*KEYS).orderBy("bin"))).where("_first = 1")
        new = _parameters(core, KEYS)
        values = [c for c in new.columns if c not in KEYS]
        new = new.select(*KEYS, F.struct(*values).alias("_new"))
        better = F.col("moved") & F.coalesce(F.col("_new.log_det") < F.col("log_det") - TOLERANCE, F.lit(False))
        found = written(found.join(new, list(KEYS), "left").withColumn("_better", better).select(
            *KEYS, *(F.when(F.col("_better"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values),
            F.col("_better").alias("moved")), "centres")
    best = F.row_number().over(W.partitionBy("g").orderBy("log_det", "start"))
    return found.withColumn("_best", best).where("_best = 1").drop("_best", "start", "moved", "log_det")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", more: tuple[Column, ...] = ()) -> DataFrame:
    """The statistics of every row with ``base_failed``, ``distance`` (null if that
    failed) and ``kept``. ``more``: further columns to carry along."""
    spec = docs.select(F.col(id_col).alias("_id"), F.to_json(F.struct(F.col(lang_col).alias("l"), F.col(source_col).alias("s")))
                       .alias("_group"), F.col(text_col).alias("_text"), *more)
    stats = written(_vectors(with_statistics(spec, "_text")), "statistics")
    good = stats.where("not base_failed")
    large = written(good.groupBy("_group").count().where(F.col("count") >= MIN_GROUP).select(
        "_group", F.col("_group").alias("g")), "groups")
    # every other group is pooled under a name that is no JSON
    grouped = stats.join(large, "_group", "left").withColumn("g", F.coalesce("g", F.lit("rest")))
    found = estimates(grouped.where("not base_failed").select("g", *VALUES))
    judged = _with_distance(grouped.join(found, "g", "left"))
    extra = [c for c in stats.columns if c not in {"_id", "_group", "base_failed", *VALUES, "n_words", "n_lines",
                                                  "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"}]
    return judged.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(~F.col("base_failed"), F.col("distance")).alias("distance"),
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).alias("kept"), *extra)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that pass, all columns as they were. Rows are told apart by id and text."""
    mark = F.struct(F.col(id_col).alias("a"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("b"))
    bad = quality(docs, id_col, text_col, more=(mark.alias("_mark"),), **options).where("not kept") \
        .select(F.to_json("_mark").alias("_tv_bad")).distinct()
    return docs.join(bad, F.to_json(mark) == F.col("_tv_bad"), "left_anti")


