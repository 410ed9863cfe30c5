"""What the operators share: scratch tables in the shared folder, size-checked joins, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts, as the inside of a character class.
BLANK = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def replace_columns(df: DataFrame, **new: Column) -> DataFrame:
    """`df` with output columns added; inputs of the same name (in any case) give way."""
    taken = {name.lower() for name in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(name) for name, c in new.items()])


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as `spark.checkpoint.dir` names it. Only a local session
    that names none gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="firmlens-llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """Tables that an operator writes to the shared folder, so that what follows reads finished
    files and a lost executor costs only its own tasks. `drop` removes what is no longer read; the
    tables that a lazy result reads stay until `release`."""

    _made: list[Scratch] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        Scratch._made.append(self)

    def put(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(f"{self.path}/{name}")
        return self.get(name, df.schema)

    def get(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema else reader).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *names: str) -> None:
        """Remove all tables but these, which a result still reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for found in files.listStatus(path):
            if found.getPath().getName() not in names:
                files.delete(found.getPath(), True)

    @classmethod
    def release(cls) -> None:
        """Remove every scratch table of this program; results that read them must be written."""
        while cls._made:
            cls._made.pop().drop()


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """`docs` with __row, the place of the row in the table, for readers that read it twice. A plan that
    shuffles gives its rows no such place, so they are stored first."""
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = scratch.put(docs, "rows")
    return docs.withColumn("__row", F.monotonically_increasing_id())


def small_or_shuffled(right: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """`right`, marked for broadcast if a count shows that it has at most `max_rows` (narrow) rows;
    a larger one is joined by shuffle. Give it a stored table: it is counted."""
    return F.broadcast(right) if right.limit(max_rows + 1).count() <= max_rows else right


def bounded_batches(docs: DataFrame, rows: int = 2000) -> DataFrame:
    """`docs`, whose session from now on sends at most `rows` rows to Python at a time, unless it is
    set to fewer: batches of whole texts are held several times over, here and in the JVM."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", docs.sparkSession.conf
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return docs


def byte_portions(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, list[bytes | None]]]:
    """(start, UTF-8 texts) of runs of about `most` bytes of a text column; only one run is Python
    objects at a time, so a batch of long texts is not held twice over."""
    begin = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        size += length
        if size >= most or i + 1 == len(column):
            yield begin, column.slice(begin, i + 1 - begin).cast(pa.binary()).to_pylist()
            begin, size = i + 1, 0


def components(edges: DataFrame, scratch: Scratch, name: str, max_rounds: int = 60,
               small: int = 300_000) -> DataFrame:
    """(node, root) of every node of `edges` (a, b), root the least node of its component.

    Alternating large-star and small-star steps; each round is a written table, so lineage stays
    short, and hubs are reduced before the shuffle by partial minima. While there are at most
    `small` edges, the minima (a row for each node, so at most twice as many) are broadcast instead
    of shuffled with the edges. Rounds grow with the logarithm of the nodes; a graph that has not
    settled after `max_rounds` is an error."""
    count = F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    links = scratch.put(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), f"{name}-0")
    before = links.agg(*count).first()
    for k in range(1, max_rounds + 1):
        few = before[0] <= small
        near = F.broadcast if few else (lambda df: df)
        packed = (lambda df: df.coalesce(8)) if few else (lambda df: df)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(near(least), "a").where("b > a").select(F.col("b").alias("a"),
                                                                  F.col("m").alias("b"))
        large = scratch.put(large, f"{name}-{k}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = (large.join(near(least), "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        links = scratch.put(packed(stars), f"{name}-{k}")
        scratch.drop(f"{name}-{k}-large")
        scratch.drop(f"{name}-{k - 1}")
        now = links.agg(*count).first()
        if now == before:
            roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(links.select(F.col("b").alias("node"),
                                                  F.col("b").alias("root"))).distinct()
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def in_share(key: Column, share: float, seed: int) -> Column:
    """True for about `share` of the keys, always the same ones."""
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) < int(share * 1_000_000))


def learnable(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text is no multiple of 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def bounded_labels(labels: DataFrame, column: str, bound: int, seed: int = 17) -> DataFrame:
    """(doc_id, label) of learnable rows with a 0/1 label, at most about `bound` of them, chosen by
    a hash of the id. A doc_id with several labels counts as 1 if any of them is 1."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(column).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
            .where(learnable(F.col("doc_id"))))
    n = rows.count()
    if n > bound:
        rows = rows.where(in_share(F.col("doc_id"), bound / n, seed))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))
