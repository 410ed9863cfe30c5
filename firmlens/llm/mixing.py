"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each source has a target of words: its weight's share of the whole budget, at most `most_epochs`
times its own size, the excess going to the others by weight. A target of two and a half sizes means
two complete epochs of the source and half an epoch of chosen documents. Those are the first by the
exponential key -ln(u) / quality, u being a hash of the document, until the words reach the rest of
the target; a document that the rest ends in is taken if at least half of it fits.

The order within a source is made in two levels, so that no source lands in one task: keys are cut
into `bins` bins that rise with the key, words are prefix-summed over the bins of a source, and the
documents of a bin are ordered by themselves.

Null and empty texts have size 0 and are taken with whole epochs only as far as rows go (0 words).
A null source is a source of its own, the last. Repeated rows are documents of their own, with the
same key; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, Scratch, small_or_shuffled

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANK}]+")), F.lit(0)).cast("long")


def symbol_quality(text: Column) -> Column:
    """A document's quality weight, 0.25 to 1: less the more of its characters are symbols."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    share = symbols / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.25), 1 - 5 * F.coalesce(share, F.lit(0.0)))


def targets(sizes: DataFrame, budget_share: float = 1.5, most_epochs: float = 2.0,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row for each source.

    The excess of capped sources is reshared by weight until none is above its cap. Sources in the
    order of cap / weight reach their caps one after the other, so the first k are capped for the
    least k whose remaining budget keeps the next below its cap: two running sums."""
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    n = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n + 1).cast("int"))
    by_cap = Window.orderBy("full", F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    rows = (sizes.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(float(most_epochs)))
            .withColumn("full", F.col("cap") / F.col("weight"))
            .withColumn("budget", F.sum("source_size").over(everyone) * F.lit(budget_share)))
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = (F.sum("weight").over(everyone)
                   - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", F.greatest(left, F.lit(0.0)) / open_weight)
    level = F.min(F.when(F.col("level") < F.col("full"), F.struct("full", "level"))).over(everyone)
    target = F.coalesce(F.least("cap", F.col("weight") * level["level"]), F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, quality: Column | None = None, budget_share: float = 1.5,
        most_epochs: float = 2.0, weights: tuple[int, ...] = WEIGHTS, bins: int | None = None,
        seed: str = "mix") -> DataFrame:
    """`docs` with size, source_size, target, copies (times the document is taken) and taken
    (copies x size). Quality weights must be in (0, 1]."""
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.col("text")
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "__own")), 1, 13), 16, 10).cast("double")
    u = (digest + 0.5) / F.lit(float(2 ** 52))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("__doc"), F.col("source").cast("string").alias("__source"),
        word_count(text).alias("size"), (quality if quality is not None
                                         else symbol_quality(text)).alias("__quality"),
        F.xxhash64("text").alias("__text"),
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.md5("text")).alias("__own"))
    narrow = scratch.put(narrow.withColumn("__key", -F.log(u) / F.col("__quality"))
                         .drop("__own", "__quality"), "keys")
    if bins is None:
        bins = max(4096, narrow.count() // 20_000)
    # key / (1 + key) spreads the keys of all weights: no bin has a thousandth of a source.
    bin_ = F.floor(F.col("__key") / (1 + F.col("__key")) * bins).cast("int")
    narrow = narrow.withColumn("__bin", bin_)
    per_bin = scratch.put(narrow.groupBy("__source", "__bin").agg(F.sum("size").alias("words")),
                          "bins")
    sizes = (per_bin.groupBy("__source").agg(F.sum("words").alias("source_size"))
             .withColumnRenamed("__source", "source"))
    goal = scratch.put(targets(sizes, budget_share, most_epochs, weights)
                       .withColumnRenamed("source", "__goal"), "targets")
    up_to = (Window.partitionBy("__source").orderBy("__bin")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = (per_bin.withColumn("start", F.sum("words").over(up_to) - F.col("words"))
              .join(small_or_shuffled(goal), F.col("__source").eqNullSafe(F.col("__goal")))
              .select(F.col("__source").alias("__s"), F.col("__bin").alias("__b"), "start",
                      "source_size", "target"))
    starts = scratch.put(starts, "starts")
    in_bin = Window.partitionBy("__source", "__bin").orderBy("__key", "__doc", "size", "__text")
    seen = F.sum("size").over(in_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = (narrow.withColumn("__seen", seen - F.col("size"))
              .join(small_or_shuffled(starts), F.col("__source").eqNullSafe(F.col("__s"))
                    & (F.col("__bin") == F.col("__b"))))
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    fits = F.col("start") + F.col("__seen") + F.col("size") / 2 <= rest
    copies = epochs + F.when(fits & (F.col("size") > 0) & (rest > 0), 1).otherwise(0)
    return joined.select(F.col("__doc").alias("doc_id"), "__source", "__text", "size", "source_size", "target",
                         (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    return mix(docs.select("doc_id", "text", "source")).drop("__source", "__text")


def take(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken.

    Rows alike in doc_id, source and text are taken alike, but for one such group in a source at most,
    which the target's words end in: there, some of the rows are taken once more. Only rows of such groups
    are numbered, in the order of the table, each task's by itself. `docs` should be a stored table: it
    is read twice, and its rows are told apart by where they stand."""
    scratch = Scratch(docs.sparkSession, "taking")
    keys = ["__doc", "__source", "__text"]
    groups = scratch.put(
        mix(docs, **params).withColumnRenamed("doc_id", "__doc").groupBy(*keys).agg(
            F.min("copies").alias("__low"),
            (F.sum("copies") - F.count("*") * F.min("copies")).alias("__extra")), "groups")
    split = scratch.put(groups.where("__extra > 0"), "split")
    placed = docs.withColumns({
        "__d": F.col("doc_id").cast("long"), "__s": F.col("source").cast("string"),
        "__t": F.xxhash64("text"), "__place": F.monotonically_increasing_id()})

    def met(rows: DataFrame, some: DataFrame) -> DataFrame:
        return rows.join(some, F.col("__d").eqNullSafe(F.col("__doc"))
                         & F.col("__s").eqNullSafe(F.col("__source")) & (F.col("__t") == F.col("__text")))

    joined = met(placed, groups).withColumn("__copies", F.col("__low"))
    if not split.isEmpty():
        task = F.shiftright("__place", 33)
        rows = scratch.put(met(placed.select("__d", "__s", "__t", "__place"), small_or_shuffled(split))
                           .select(F.struct(*keys).alias("__group"), task.alias("__task"), "__place",
                                   "__low", "__extra"), "rows")
        before = (Window.partitionBy("__group").orderBy("__task")
                  .rowsBetween(Window.unboundedPreceding, -1))
        per_task = (rows.groupBy("__group", "__task").agg(F.count("*").alias("__n"))
                    .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))
        in_task = Window.partitionBy("__group", "__task").orderBy("__place")
        left, right = rows.withColumn("__own", F.row_number().over(in_task)).alias("l"), per_task.alias("r")
        once = F.col("__before") + F.col("__own") <= F.col("__extra")
        chosen = scratch.put(
            left.join(right, F.col("l.__group").eqNullSafe(F.col("r.__group"))
                      & (F.col("l.__task") == F.col("r.__task")))
            .where(once).select(F.col("__place").alias("__at"), (F.col("__low") + 1).alias("__more")),
            "chosen")
        joined = joined.join(small_or_shuffled(chosen), F.col("__place") == F.col("__at"), "left")
        joined = joined.withColumn("__copies", F.coalesce("__more", "__low"))
    copies = F.array_repeat(F.lit(1), F.col("__copies").cast("int"))
    repeated = joined.where("__copies > 0").withColumn("__n", F.explode(copies))
    return repeated.select(*[docs[c] for c in docs.columns])


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, text,
      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
      greatest(0.25, 1 - 5 * coalesce((length(text) - length(translate(text, '#*$%&|<>', '')))::DOUBLE
          / greatest(length(text), 1), 0)) AS quality,
      ((('0x' || substr(md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, md5(text)))), 1, 13))::BIGINT)::DOUBLE + 0.5)
          / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
      CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS full_at,
      1.5 * sum(source_size) OVER () AS budget FROM s),
l AS (
  SELECT *, greatest(budget - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM f WINDOW w AS (ORDER BY full_at, source NULLS LAST)),
t AS (
  SELECT source, source_size,
      coalesce(least(cap, weight * (SELECT level FROM l WHERE level < full_at ORDER BY full_at, level LIMIT 1)), cap)::DOUBLE AS target
  FROM l),
r AS (
  SELECT d.doc_id, d.size, t.source_size::BIGINT AS source_size, t.target,
      floor(t.target / greatest(t.source_size, 1))::BIGINT AS epochs,
      sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / d.quality, d.doc_id) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, epochs + CASE WHEN before + size / 2.0 <= target - epochs * source_size AND size > 0
      AND target - epochs * source_size > 0 THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM c
"""
