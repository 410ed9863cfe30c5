"""Approximate nearest neighbours by largest inner product, with a permutation index.

Pivots are some of the vectors. Each vector is represented by its nearest pivots in order, and posted
in their inverted files with its place in that order. A query goes through the files of its own
nearest pivots and sums, for each vector that it meets, how far apart the places of the common pivots
are (the footrule distance of the two orders, pivots outside an order counting as just behind it).
The nearest by footrule are reranked by the exact inner product of the original vectors.

Vectors get one more coordinate that makes their lengths equal, so nearness of pivots follows the
inner product whatever the lengths. The index is cut into blocks of vectors, the queries into chunks;
each pair of a block and a chunk is one group with bounded memory. A fixed share of each block is
reranked, so the work grows with the data and no list is capped.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without an id. Of rows that repeat a vec_id, the least vector counts. Vectors are compared with those
of their own dimension. Equal scores go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

_SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim, square) of the vectors that take part, in double precision."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite)
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .select("vec_id", "v", F.size("v").alias("dim"), square.alias("square"))
            .where("square > 0"))


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The numbers of the `length` nearest pivots of each vector, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :length]


def footrule_search(queries: np.ndarray, query_ids: np.ndarray, block: np.ndarray,
                    block_ids: np.ndarray, pivots: np.ndarray, longest: float, length: int,
                    share: float, least: int, k: int):
    """(query, vector, score) of the `k` best of the block for each query. Rows of the block come in
    the order of their ids."""
    length = min(length, len(pivots))
    extra = np.sqrt(np.maximum(longest - (block * block).sum(axis=1), 0.0))[:, None]
    lists = orders(np.hstack([block, extra]), pivots, length)
    asked = orders(np.hstack([queries, np.zeros((len(queries), 1))]), pivots, length)
    # The inverted file of a pivot: for each vector of the block how near it has the pivot, `length` for
    # the first place of its order and 0 where it is not posted.
    small = length < 256
    files = np.zeros((len(pivots), len(block)), "u1" if small else "u4")
    places = np.arange(length, 0, -1)
    files[lists, np.arange(len(block))[:, None]] = places
    count = min(len(block), max(least, int(np.ceil(share * len(block)))))
    met = np.empty(len(block), files.dtype)
    # Sums of up to `length` places; 16-bit numbers are sorted by digits, in linear time.
    whole = "u2" if length * (length + 1) // 2 < 2 ** 16 else "u4"
    out = []
    for q, own, order in zip(queries, query_ids, asked):
        # Footrule = constant - 2 * sum over common pivots of (length - the later place).
        common = np.zeros(len(block), whole)
        for place, pivot in zip(places, order):
            np.minimum(files[pivot], files.dtype.type(place), out=met)
            common += met
        near = np.argsort(np.iinfo(whole).max - common, kind="stable")[:count]
        rows = block[near]
        rough = rows @ q
        if len(near) > k:
            # All that may be among the best, ties included, get the exact product, row by row.
            edge = np.partition(rough, len(near) - k)[len(near) - k]
            keep = rough >= edge - 1e-9 * (1 + abs(edge))
            near, rows = near[keep], rows[keep]
        score = (rows * q).sum(axis=1)
        best = np.lexsort((block_ids[near], -score))[:k]
        out.append((np.full(len(best), own), block_ids[near[best]], score[best]))
    return [np.concatenate(x) for x in zip(*out)]


def search(vectors: DataFrame, k: int = 20, every: int = 20, n_pivots: int = 128,
           length: int = 64, share: float = 0.2, least: int = 400, block: int = 16384,
           chunk: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of every vector whose id is divisible by
    `every`. The pivots are a sample of at most `n_pivots` vectors of each dimension, by hash; every
    vector is indexed. `share` of each block (at least `least` vectors) is reranked."""
    scratch = Scratch(vectors.sparkSession, "permutations")
    every_row = scratch.put(usable(vectors), "rows")
    wanted = F.col("vec_id") % every == 0
    rows = scratch.put(every_row.groupBy("v").agg(
        F.min("vec_id").alias("vec_id"), F.any_value("dim").alias("dim"),
        F.any_value("square").alias("square"), F.bool_or(wanted).alias("asked")), "vectors")
    ids = scratch.put(every_row.select("vec_id", "v").join(
        rows.select("v", F.col("vec_id").alias("rep")), "v").select("rep", "vec_id"), "ids")
    dims = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max("square").alias("longest"),
                                   F.sum(F.col("asked").cast("long")).alias("q"))
    dims = {r["dim"]: r for r in dims.collect()}  # a row for each dimension that occurs
    pivots = {}
    for dim, r in dims.items():
        h = F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.lit(2 ** 31))
        within = min(1.0, 4 * n_pivots / r["n"])
        sample = (rows.where(F.col("dim") == dim).withColumn("h", h)
                  .where(F.col("h") <= int(within * 2 ** 31)).orderBy("h", "vec_id")
                  .limit(n_pivots).select("v").collect())
        table = np.array([x["v"] for x in sample], "f8")
        extra = np.sqrt(np.maximum(r["longest"] - (table * table).sum(axis=1), 0.0))[:, None]
        pivots[dim] = np.hstack([table, extra])
    longest = {dim: r["longest"] for dim, r in dims.items()}
    n_blocks = {dim: -(-r["n"] // block) for dim, r in dims.items()}
    n_chunks = {dim: max(1, -(-r["q"] // chunk)) for dim, r in dims.items()}

    def per_dim(numbers: dict):
        pairs = [x for d, n in numbers.items() for x in (F.lit(d), F.lit(n).cast("long"))]
        return F.create_map(*pairs)[F.col("dim")] if pairs else F.lit(1).cast("long")

    index = rows.select(
        "dim", F.pmod(F.xxhash64("vec_id"), per_dim(n_blocks)).cast("long").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), per_dim(n_chunks) - 1)).alias("chunk"),
        "vec_id", "v")
    asked = rows.where("asked").select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), per_dim(n_blocks) - 1)).alias("block"),
        F.pmod(F.xxhash64(F.lit(5), "vec_id"), per_dim(n_chunks)).cast("long").alias("chunk"),
        "vec_id", "v")

    def group(key, left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("vec_id").to_numpy()
        wanted = right.column("vec_id").to_numpy()
        if not len(ids) or not len(wanted):
            return pa.table({"query_id": pa.array([], "i8"), "vec_id": pa.array([], "i8"),
                             "score": pa.array([], "f8")})
        dim = key[0].as_py()
        order = np.argsort(ids)
        flat = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        q, v, s = footrule_search(flat(right), wanted, flat(left)[order], ids[order], pivots[dim],
                                  longest[dim], length, share, least, k + 1)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    keys = ["dim", "block", "chunk"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(group, _SCHEMA)
    # The k + 1 best vectors, the query's own among them, hold its k best ids: each has its least.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = scratch.put(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
                        .select(F.col("query_id").alias("query"), F.col("vec_id").alias("rep"), "score"),
                        "found")
    firsts = Window.partitionBy("rep").orderBy("vec_id")
    few = ids.withColumn("n", F.row_number().over(firsts)).where(F.col("n") <= k + 1).drop("n")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = (found.join(few, "rep").withColumn("n", F.row_number().over(best))
               .where(F.col("n") <= k + 1).groupBy("query")
               .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("answers")))
    asking = ids.where(wanted).select(F.col("rep").alias("query"), F.col("vec_id").alias("query_id"))
    others = F.filter("answers", lambda x: x["vec_id"] != F.col("query_id"))
    return (asking.join(answers, "query")
            .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", "x.score"))
