"""Quality rules by robust multivariate outliers, in DataFrame functions only.

Base statistics of every whole text feed two rules: a text fails the base rule
if it has too few words or if too many of its words stand in repeated 8-word
windows. Of the rest, a text is rejected if its transformed statistics lie too
far from what is usual for its language and source, by Mahalanobis distance
under minimum-covariance-determinant (MCD) estimates:

- starts that half of the rows cannot break, all about the medians and in units
  of the median deviations: those deviations alone, the scatter of the rows'
  directions, and the correlations of their hyperbolic tangents. Starts about
  single rows would find lower determinants still, but those of halves that take
  in a dense third of junk, which is what the estimate must not follow;
- concentration steps from each start: mean and covariance of the half of the
  rows that are nearest, then the nearest half anew. No step increases the
  determinant of that half's covariance; steps are made until no determinant
  falls by more than ``FALL`` (medians of large groups are sketches, so smaller
  changes mean nothing), and the start that ends lowest gives the estimate;
- the covariance is scaled to be consistent for normal data, and a statistic
  that hardly varies (clean texts have no symbols at all) gets a least spread
  (``SPREAD``), so that the matrix can be inverted and tiny deviations from a
  constant are not outliers.

Texts are heavier-tailed than normal data; the limit is therefore not a
chi-square quantile but ``LIMIT`` robust standard deviations in any direction.

Groups of fewer than ``LEAST_ROWS`` eligible texts are estimated together with
the other small ones of their language, and languages still smaller with each
other; every row is judged either way. Medians come from mergeable sketches and
moments from partial sums, so a language and source with a third of all rows
costs one task no more than another; estimates are one small row per group.

Defined cases: null and empty texts have no words and fail the base rule; a
null language or source is a language or source of its own; repeated rows are
judged alike; with an empty table the result is empty. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise

SPACE = " \t\n\x0b\f\r"
WINDOW = 8
STARTS = 3
FALL = 1e-3
# Against an endless loop only: every step but the last lowers some determinant by FALL.
MOST_STEPS = 100
LIMIT = 10.0
LEAST_ROWS = 100
# Files of the tables that have one row per group.
FEW = 4
# Least standard deviation of each transformed statistic.
SPREAD = {"x0": 0.5, "x1": 0.05, "x2": 0.25, "x3": 0.5, "x4": 0.1}
NAMES = list(SPREAD)
# Half of normal data in five dimensions, taken from the middle, has a covariance smaller by this factor.
CONSISTENCY = 1.915


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs again; windows by place."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    start = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        _let(placed, repeated),
        start,
        lambda a, p: F.struct((a["words"] + F.least(F.lit(WINDOW), p - a["last"])).alias("words"), p.alias("last")),
    )
    return covered["words"]


def _repeat_words(words: Column) -> Column:
    def of_hashes(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        )
        return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(h)))

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_let(hashes, of_hashes))


def statistics(text: str | Column = "text") -> list[Column]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed != "", F.split(trimmed, "[ \\t-\\r]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    whole = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            _repeat_words(w).cast("long").alias("repeat"),
        ),
    )
    return [
        whole["n"].alias("n_words"),
        whole["chars"].alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        whole["repeat"].alias("n_repeat_words"),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def transformed() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "x0": F.log1p("n_words"),
        "x1": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x2": F.log1p(F.col("n_symbols") * 50 / n),
        "x3": F.log1p("n_dup_lines"),
        "x4": F.col("n_repeat_words") / n,
    }


def _join(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(estimates.withColumnRenamed("key", "_key"), F.col("key").eqNullSafe(F.col("_key"))).drop("_key")


def _estimation_keys(rows: DataFrame) -> DataFrame:
    """Add ``key``: language and source, or what is shared with other small groups."""
    sizes = rows.filter("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("small", F.col("n") < LEAST_ROWS)
    langs = sizes.filter("small").groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("_n"))
    keyed = sizes.join(langs, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    name = F.when(~F.col("small"), F.struct(F.lit(0).alias("level"), "lang", "source"))
    name = name.when(F.col("_n") >= LEAST_ROWS, F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source")))
    none = F.lit(None).cast("string")
    name = name.otherwise(F.struct(F.lit(2).alias("level"), none.alias("lang"), none.alias("source")))
    keys = keyed.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.to_json(name).alias("key"))
    keys = materialise(keys, "keys", FEW)
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    return rows.join(keys, same, "left").drop("_l", "_s")


def _cholesky(cov) -> dict[str, Column]:
    """Columns ``l{i}{j}`` of the lower factor of the matrix ``cov(i, j)``, in the order they need one another."""
    p, out = len(NAMES), {}
    for j in range(p):
        diagonal = cov(j, j) - sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out[f"l{j}{j}"] = F.sqrt(F.greatest(diagonal, F.lit(1e-12)))
        for i in range(j + 1, p):
            inner = cov(i, j) - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out[f"l{i}{j}"] = inner / F.col(f"l{j}{j}")
    return out


def _factored(moments: DataFrame) -> DataFrame:
    def cov(i: int, j: int) -> Column:
        scaled = F.col(f"c{j}{i}" if i > j else f"c{i}{j}") * F.lit(CONSISTENCY)
        return scaled + F.lit(SPREAD[NAMES[i]] ** 2) if i == j else scaled

    for name, column in _cholesky(cov).items():
        moments = moments.withColumn(name, column)
    factor = list(_cholesky(cov))
    log_det = sum((F.log(f"l{i}{i}") for i in range(len(NAMES))), F.lit(0.0)) * 2
    return moments.select("key", *[f"m{i}" for i in range(len(NAMES))], *factor, log_det.alias("log_det"))


def _distance(rows: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance, by forward substitution."""
    for i, name in enumerate(NAMES):
        inner = F.col(name) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"z{i}", inner / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(NAMES))), F.lit(0.0)))


def _nearest_half(rows: DataFrame) -> DataFrame:
    limits = rows.groupBy("key").agg(F.percentile_approx("d2", 0.5, 10000).alias("half"))
    return _join(rows, materialise(limits, "halves", FEW)).filter("d2 <= half")


def _moments(rows: DataFrame) -> DataFrame:
    p = range(len(NAMES))
    means = [F.avg(NAMES[i]).alias(f"m{i}") for i in p]
    return rows.groupBy("key").agg(*means, *[F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i in p for j in p if i <= j])


def _starts(rows: DataFrame) -> DataFrame:
    """A location and factor per start; ``key`` is the number of the start before the rows' key."""
    p = range(len(NAMES))
    medians = [F.percentile_approx(name, 0.5, 10000).alias(f"m{i}") for i, name in enumerate(NAMES)]
    centre = materialise(rows.groupBy("key").agg(*medians), "medians", FEW)
    spread = [F.percentile_approx(F.abs(F.col(name) - F.col(f"m{i}")), 0.5, 10000) for i, name in enumerate(NAMES)]
    spread = [F.greatest(deviation * 1.4826, F.lit(SPREAD[NAMES[i]])).alias(f"s{i}") for i, deviation in enumerate(spread)]
    first = [F.first(f"m{i}").alias(f"m{i}") for i in p]
    scaled = materialise(_join(rows, centre).groupBy("key").agg(*first, *spread), "spreads", FEW)

    unit = _join(rows, scaled).withColumns({f"u{i}": (F.col(NAMES[i]) - F.col(f"m{i}")) / F.col(f"s{i}") for i in p})
    norm = F.sqrt(sum((F.col(f"u{i}") * F.col(f"u{i}") for i in p), F.lit(0.0)))
    direction = [F.when(norm > 0, F.col(f"u{i}") / norm).otherwise(0.0) for i in p]
    pairs = [(i, j) for i in p for j in p if i <= j]
    shapes = unit.groupBy("key").agg(
        *[F.avg(direction[i] * direction[j]).alias(f"d{i}{j}") for i, j in pairs],
        *[F.avg(F.tanh(f"u{i}") * F.tanh(f"u{j}")).alias(f"t{i}{j}") for i, j in pairs],
    )
    # A shape says how statistics go together; each keeps its own spread, the least share of it included.
    least = 1e-3
    shapes = _join(scaled, shapes)

    def start(number: int) -> DataFrame:
        letter = {1: "d", 2: "t"}.get(number)

        def cov(i: int, j: int) -> Column:
            if letter is None or i == j:
                return F.col(f"s{i}") * F.col(f"s{j}") if i == j else F.lit(0.0)
            together = F.col(f"{letter}{min(i, j)}{max(i, j)}")
            alone = F.sqrt((F.col(f"{letter}{i}{i}") + least) * (F.col(f"{letter}{j}{j}") + least))
            return together / alone * F.col(f"s{i}") * F.col(f"s{j}")

        factored = shapes
        for name, column in _cholesky(cov).items():
            factored = factored.withColumn(name, column)
        key = F.concat(F.lit(f"{number}:"), F.col("key")).alias("key")
        return factored.select(key, *[f"m{i}" for i in p], *_cholesky(cov))

    out = start(0)
    for number in range(1, STARTS):
        out = out.unionByName(start(number))
    return out


def mcd(rows: DataFrame) -> DataFrame:
    """One row per ``key``: location ``m*``, factor ``l**`` and ``log_det`` of the MCD estimate over ``rows`` (``key``, ``x*``)."""
    numbers = F.explode(F.array(*[F.lit(f"{number}:") for number in range(STARTS)])).alias("_start")
    every = rows.select("*", numbers).withColumn("key", F.concat("_start", "key")).drop("_start")
    estimate, lowest = materialise(_starts(rows), "starts", FEW), None
    for _ in range(MOST_STEPS):
        near = _nearest_half(_distance(_join(every, estimate)))
        estimate = materialise(_factored(_moments(near)), "estimate", FEW)
        if lowest is None:
            lowest = estimate
            continue
        before = lowest.select(F.col("key").alias("_key"), F.col("log_det").alias("_log_det"))
        fell = estimate.join(before, F.col("key") == F.col("_key")).filter(F.col("log_det") < F.col("_log_det") - FALL)
        if not fell.limit(1).count():
            break
        both = lowest.unionByName(estimate)
        values = F.struct(*[name for name in both.columns if name != "key"])
        lowest = both.groupBy("key").agg(F.min_by(values, "log_det").alias("best")).select("key", "best.*")
        lowest = materialise(lowest, "lowest", FEW)
    number, key = F.substring("key", 1, 1), F.expr("substring(key, 3)")
    best = lowest.withColumns({"_start": number, "key": key}).groupBy("key")
    values = F.struct(*[name for name in lowest.columns if name != "key"])
    return best.agg(F.min_by(values, F.struct("log_det", "_start")).alias("best")).select("key", "best.*")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", doc_id: str = "doc_id", limit: float = LIMIT) -> DataFrame:
    """``(doc_id, statistics, base_failed, distance, kept)`` for every row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), *statistics(text)
    )
    rows = materialise(rows.withColumn("base_failed", base_failed()), "statistics")
    keyed = _estimation_keys(rows).withColumns(transformed())
    estimate = mcd(materialise(keyed.filter("not base_failed").select("key", *NAMES), "vectors"))
    far = _distance(keyed.join(estimate.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left"))
    distance = F.when(~F.col("base_failed"), F.sqrt("d2"))
    return far.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"), (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= limit)).alias("kept"),
    )
