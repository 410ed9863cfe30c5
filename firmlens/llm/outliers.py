"""Quality rules: robust multivariate outliers, in DataFrame functions only.

Every text gets four counts; base rules reject short and repetitive texts. The others are judged by
their language and source: the statistics are transformed to be about normal, a minimum covariance
determinant estimate gives centre and scatter, and a text whose squared Mahalanobis distance is beyond
`cut` is rejected. Distances are scaled down, never up, so that their median is that of the chi-squared
distribution; at 50, one text in 700 million of a normal group would be beyond.

The estimate is that of the half of the group whose covariance has the smallest determinant. It is
sought by concentration steps (take the half that lies nearest, estimate anew), which never raise the
determinant, from three starts: the medians with the scatter of the coordinates by themselves, of
their hyperbolic tangents, and of their signs in space. Of what these arrive at, the one with the
smallest determinant counts. Every scatter gets a ridge, a variance that a clean text may have in any
group: without it, a statistic that is zero for nearly all of a group (repeats, symbols) would have no
scatter, and the few texts that are not zero would be outliers however little they have of it. So
repeats under the base rule's limit reject a text only together with something else.

Each step is one aggregation of a narrow table over (lang, source), partial before its shuffle, and
a join with a few numbers for each group; a group of any size is spread over all tasks. A group of
fewer than `least_group` judged texts is judged by the estimate of all texts. Null lang and source
are groups of their own. Null and empty texts have no words and fail the base rules. Rows are judged one by
one, so repeats and ties do no harm; very long texts are read whole; an empty table gives no rows.
Columns of other names are not read, so they cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, Scratch, let, small_or_shuffled

WINDOW = 8
#: Median of the chi-squared distribution with as many degrees of freedom as there are statistics.
MEDIAN = 4.35


def _present(pieces: Column) -> Column:
    return F.filter(pieces, lambda x: x != "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words in windows of `width` words that are found twice or more in the text.

    Windows are hashed; only a text that has equal hashes sorts them, with their places. Places of
    repeated windows, in order, cover min(width, gap to the next) words each."""
    n = F.size(words)
    hashes = F.when(n > width, F.transform(F.sequence(F.lit(1), n - (width - 1)),
                                           lambda i: F.xxhash64(F.slice(words, i, width))))

    def covered(places: Column) -> Column:
        gaps = F.zip_with(F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
                          F.slice(places, 1, F.greatest(F.size(places) - 1, F.lit(0))),
                          lambda b, a: F.least(b - a, F.lit(width)))
        return F.aggregate(gaps, F.lit(width), lambda total, g: total + g)

    def places(ordered: Column) -> Column:
        same = F.filter(ordered, lambda x, i: (
            ((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"]))
            | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False))))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(let(ordered, places), covered))

    return F.coalesce(F.when(n > width, let(hashes, count)), F.lit(0))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = _present(F.split(text, f"[{BLANK}]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(f"[^{BLANK}]")))
    counted = docs.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), words.alias("words"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        F.length(F.regexp_replace(text, f"[{BLANK}]+", "")).alias("word_chars"))
    n = F.size("words").cast("long")
    return counted.select(
        "doc_id", "lang", "source", n.alias("n_words"), F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"), F.col("n_dup_lines").cast("long"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"))


def _vector() -> list[Column]:
    """Statistics transformed towards a normal shape, from the counts."""
    n = F.greatest(F.col("n_words").cast("double"), F.lit(1.0))
    return [F.log1p(n), F.col("word_chars") / n, F.log1p(100 * F.col("n_symbols") / n),
            F.log1p(100 * F.col("n_repeat_words") / n), F.log1p(F.col("n_dup_lines").cast("double"))]


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i + 1)]


def _scatter(p: int, ridge: list[float]) -> list[Column]:
    """Means m_i and the Cholesky factor l_ij of the covariance plus a ridge, which keeps constant
    statistics from making the scatter singular."""
    return ([F.avg(f"x{i}").alias(f"m{i}") for i in range(p)]
            + [(F.covar_pop(f"x{i}", f"x{j}") + (ridge[i] if i == j else 0.0)).alias(f"c{i}{j}")
               for i, j in _pairs(p)])


def _factor(groups: DataFrame, p: int) -> DataFrame:
    for i, j in _pairs(p):
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        groups = groups.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j
                                   else rest / F.col(f"l{j}{j}"))
    return groups.select("g", *[f"m{i}" for i in range(p)], *[f"l{i}{j}" for i, j in _pairs(p)])


def _distance(rows: DataFrame, estimates: DataFrame, p: int) -> DataFrame:
    """`rows` with d2, the squared Mahalanobis distance under their group's estimate."""
    joined = rows.join(small_or_shuffled(estimates, 20_000), "g")
    for i in range(p):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(p)), F.lit(0.0))
    return joined.withColumn("d2", total).select(*rows.columns, "d2")


def _starts(rows: DataFrame, p: int, ridge: tuple[float, ...], scratch: Scratch) -> DataFrame:
    """Estimates (g, start, m_i, l_ij) to start from: medians, and the scatter of the rows, put on the
    scale of their deviations, as they are by coordinate, by hyperbolic tangent and by sign in space."""
    middle = scratch.put(rows.groupBy("g").agg(*[F.percentile_approx(f"x{i}", 0.5, 1000)
                                                 .alias(f"m{i}") for i in range(p)]), "middle")
    around = rows.join(small_or_shuffled(middle, 20_000), "g")
    spread = around.groupBy("g").agg(*[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")),
                                                           0.5, 1000).alias(f"s{i}") for i in range(p)])
    base = scratch.put(middle.join(spread, "g").select(
        "g", *[f"m{i}" for i in range(p)],
        *[(1.4826 * F.col(f"s{i}") + F.lit(ridge[i])).alias(f"d{i}") for i in range(p)]), "scales")
    scaled = rows.join(small_or_shuffled(base, 20_000), "g")
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"d{i}") for i in range(p)]
    length = F.greatest(F.sqrt(sum((x * x for x in z), F.lit(0.0))), F.lit(1e-9))
    kinds = scaled.select("g", *[F.tanh(x).alias(f"t{i}") for i, x in enumerate(z)],
                          *[(x / length).alias(f"u{i}") for i, x in enumerate(z)])
    moments = scratch.put(kinds.groupBy("g").agg(*[
        F.avg(F.col(f"{kind}{i}") * F.col(f"{kind}{j}")).alias(f"{kind}{i}{j}")
        for kind in "tu" for i, j in _pairs(p)]).join(base, "g"), "moments")

    def scatter(kind: str) -> list[Column]:
        out = []
        for i, j in _pairs(p):
            unit = F.lit(1.0 if i == j else 0.0) if kind == "-" else F.col(f"{kind}{i}{j}") + (
                0.05 if i == j else 0.0)
            out.append((unit * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"c{i}{j}"))
        return out

    return _factor(reduce(DataFrame.unionByName, [
        moments.select(F.concat("g", F.lit(f"#{k}")).alias("g"), *[f"m{i}" for i in range(p)], *scatter(kind))
        for k, kind in enumerate("-tu")]), p)


def covariance(rows: DataFrame, p: int, steps: int, half: float, ridge: tuple[float, ...],
               scratch: Scratch) -> DataFrame:
    """(g, m_i, l_ij): each group's estimate of the smallest determinant, of rows (g, x_i)."""
    estimate = scratch.put(_starts(rows, p, ridge, scratch), "estimate-0")
    tried = rows.withColumn("g", F.explode(F.transform(F.array(*map(F.lit, range(3))), lambda k: F.concat(
        "g", F.lit("#"), k.cast("string")))))
    for k in range(1, steps + 1):
        far = _distance(tried, estimate, p)
        within = scratch.put(far.groupBy("g").agg(F.percentile_approx("d2", half, 1000)
                                                  .alias("near")), f"near-{k}")
        nearest = far.join(small_or_shuffled(within, 20_000), "g").where("d2 <= near")
        estimate = scratch.put(_factor(nearest.groupBy("g").agg(*_scatter(p, [r * r for r in ridge])),
                                       p), f"estimate-{k}")
    columns = [c for c in estimate.columns if c != "g"]
    size = sum((F.log(F.col(f"l{i}{i}")) for i in range(p)), F.lit(0.0))
    best = F.min(F.struct(size.alias("size"), "g", *columns)).alias("best")
    return (estimate.groupBy(F.regexp_replace("g", "#[0-9]$", "").alias("own")).agg(best)
            .select(F.col("own").alias("g"), *[F.col(f"best.{c}").alias(c) for c in columns]))


def judged(docs: DataFrame, steps: int = 3, half: float = 0.5, cut: float = 50.0,
           least_group: int = 100, ridge: tuple[float, ...] = (0.3, 0.3, 0.5, 1.0, 0.7)
           ) -> DataFrame:
    """doc_id, the counts, base_failed, distance (null if base_failed) and kept of every text."""
    scratch = Scratch(docs.sparkSession, "outliers")
    stats = text_statistics(docs)
    failed = ((F.col("n_words") < 20)
              | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    vector = _vector()
    p = len(vector)
    stats = scratch.put(stats.withColumn("base_failed", failed)
                        .select("*", *[x.alias(f"x{i}") for i, x in enumerate(vector)]), "stats")
    own = F.concat_ws("|", F.coalesce(F.concat(F.lit("l"), "lang"), F.lit("-")),
                      F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    good = stats.where("not base_failed").withColumn("own", own)
    sizes = scratch.put(good.groupBy("own").agg(F.count("*").alias("n")).select(
        "own", F.when(F.col("n") >= least_group, F.col("own")).otherwise("").alias("g")), "groups")
    stats = scratch.put(stats.withColumn("own", own).join(small_or_shuffled(sizes, 20_000), "own",
                                                          "left").drop("own"), "grouped")
    good = stats.where("not base_failed").select("g", *[f"x{i}" for i in range(p)])
    rows = good.where("g <> ''").unionByName(good.withColumn("g", F.lit("")))
    estimate = scratch.put(covariance(rows, p, steps, half, ridge, scratch), "estimate")
    last = scratch.put(
        _distance(rows, estimate, p).groupBy("g").agg(
            F.percentile_approx("d2", 0.5, 1000).alias("middle")), "scale")
    final = stats.withColumn("g", F.coalesce("g", F.lit("")))
    scored = _distance(final.where("not base_failed"), estimate, p)
    scored = scored.join(small_or_shuffled(last, 20_000), "g").withColumn(
        "distance", F.col("d2") / F.greatest(F.col("middle") / MEDIAN, F.lit(1.0)))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "base_failed"]
    return (scored.select(*columns, "distance", (F.col("distance") <= cut).alias("kept"))
            .unionByName(final.where("base_failed").select(
                *columns, F.lit(None).cast("double").alias("distance"),
                F.lit(False).alias("kept"))))
