"""Near-duplicate documents by DartMinHash signatures and a banded join.

A text is the set of its runs of five lower-cased words (a shorter text with words is one run).
Elements have weights, 1 in a set or the number of occurrences. The plane of weight and rank above
each element is cut into regions whose sides double; each unit cell of a region holds a Poisson
number of darts, placed by hashes of element and cell alone, so equal elements get equal darts. A
text keeps the darts below its elements' weights and below a rank that leaves about k ln k + 2k of
them, however long it is; each dart belongs to one of k coordinates, and the earliest of each is
the signature. Two texts agree in a coordinate with probability equal to their weighted Jaccard
similarity. Texts that leave a coordinate empty are thrown again with twice the rank.

Texts of equal words are one node. Nodes that agree in a band are compared on their elements, which
are 32-bit hashes (two elements of a pair of texts are taken for one with probability n m / 2^32):
first each node of a bucket with the bucket's least node; then the nodes of all buckets
where several classes are left meet in an exact join, so that no link between nodes that share a
band is missed. In it, elements are ordered rarest first; similar nodes share one of the first few
(prefix) at a place that leaves enough of both behind it (position filter). Nodes are compared by
groups of equal element, size and place first, so filtered pairs of a hot element cost nothing;
groups and their members meet in salted blocks, and nodes already of one class are passed over. Where
members meet, a sketch of each set (for each of 512 hash classes, whether it holds an odd number of
elements) is a condition of the join: sets whose sketches differ in more bits than similar sets may
have elements apart are not similar, which is exact. So a family of texts that are nearly, but not
quite, similar enough yields no rows to verify.

Null and empty texts, and texts without a word, are classes of their own, as documents. Rows that
repeat a doc_id and a text are one document. A null doc_id is a document that comes last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField,
                               StructType)

from .common import Scratch, bounded_batches, components, in_share, small_or_shuffled

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SKETCH = [f"p{i}" for i in range(8)]
#: Below which share of uniform numbers a cell has at most 0, 1, 2, ... darts: Poisson of mean 1.
_POISSON = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 13)])])


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype("f8") * 2.0 ** -53


def plain_words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingles(words: list[list[str]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(element, text) of every run of `width` words of every text."""
    code: dict[str, int] = {}
    for ws in words:
        for w in set(ws):
            if w not in code:
                code[w] = xxhash.xxh3_64_intdigest(w)
    sizes = np.array([len(ws) for ws in words], "i8")
    flat = np.fromiter((code[w] for ws in words for w in ws), "u8", int(sizes.sum()))
    ends = np.cumsum(sizes)
    begin = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    runs = np.arange(len(flat)) - begin[owner] <= np.maximum(sizes - width, 0)[owner]
    at = np.flatnonzero(runs)
    element = np.zeros(len(at), "u8")
    with np.errstate(over="ignore"):
        for j in range(width):
            inside = at + j < ends[owner[at]]
            word = flat[np.minimum(at + j, len(flat) - 1)]
            element = np.where(inside, _mix(element * _STEP + word), element)
    return element, owner[at]


def _throw(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, limit: np.ndarray, k: int):
    """(text, coordinate, rank, dart) of the darts in the regions below weight and rank limit."""
    found = []
    nu = 0
    while (wide := np.flatnonzero(weight > 2 ** nu - 1)).size:
        rho = 0
        while (tall := wide[limit[owner[wide]] > 2 ** rho - 1]).size:
            columns = np.minimum(2 ** nu, np.ceil(weight[tall] - (2 ** nu - 1))).astype("i8")
            lines = np.minimum(2 ** rho, np.ceil(limit[owner[tall]] - (2 ** rho - 1))).astype("i8")
            cells = columns * lines
            who = np.repeat(tall, cells)
            cell = np.arange(len(who)) - np.repeat(np.cumsum(cells) - cells, cells)
            column, line = np.divmod(cell, np.repeat(lines, cells))
            place = ((nu << 58) + (rho << 52) + (column << 26) + line).astype("u8")
            seed = _mix(element[who] + _mix(place * _GOLD + np.uint64(1)))
            count = np.searchsorted(_POISSON, _uniform(seed))
            dart = np.repeat(np.arange(len(who)), count)
            nth = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
            mark = _mix(seed[dart] + (nth.astype("u8") + np.uint64(1)) * _GOLD)
            height = 2 ** nu - 1 + column[dart] + _uniform(_mix(mark + np.uint64(3)))
            rank = 2 ** rho - 1 + line[dart] + _uniform(_mix(mark + np.uint64(5)))
            text = owner[who[dart]]
            keep = (height < weight[who[dart]]) & (rank < limit[text])
            coordinate = (_mix(mark + np.uint64(7)) % np.uint64(k)).astype("i8")
            found.append((text[keep], coordinate[keep], rank[keep], mark[keep]))
            rho += 1
        nu += 1
    return [np.concatenate(x) for x in zip(*found)]


def signatures(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int,
               k: int) -> np.ndarray:
    """An n x k table of dart marks; a text without elements has zeros. Elements that occur twice
    in a text throw the same darts, so a set needs no deduplication."""
    out = np.zeros((n, k), "u8")
    total = np.bincount(owner, weight, n)
    limit = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-9), 0.0)
    with np.errstate(over="ignore"):
        while len(element):
            text, coordinate, rank, mark = _throw(element, weight, owner, limit, k)
            last_first = np.argsort(-rank, kind="stable")
            out.reshape(-1)[(text * k + coordinate)[last_first]] = mark[last_first]
            empty = (out == 0).any(axis=1) & (total > 0)
            again = empty[owner]
            element, weight, owner = element[again], weight[again], owner[again]
            limit = limit * 2
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """The hash of each text's marks in each band; bands never share a key."""
    n, k = signature.shape
    keys = np.zeros((n, bands), "u8")
    parts = signature.reshape(n, bands, k // bands)
    with np.errstate(over="ignore"):
        keys = _mix(keys + np.arange(1, bands + 1, dtype="u8") * _GOLD)
        for j in range(k // bands):
            keys = _mix(keys * _STEP + parts[:, :, j])
    return keys.view("i8")


def elements_of(texts: list[str | None], width: int, weights: str):
    """(words, element, weight, text) of a list of texts."""
    words = [plain_words(t) for t in texts]
    element, owner = shingles(words, width)
    weight = np.ones(len(element))
    if weights == "count" and len(element):
        order = np.lexsort((element, owner))
        element, owner = element[order], owner[order]
        first = np.flatnonzero(np.concatenate(
            [[True], (element[1:] != element[:-1]) | (owner[1:] != owner[:-1])]))
        weight = np.diff(np.append(first, len(element))).astype("f8")
        element, owner = element[first], owner[first]
    return words, element, weight, owner


def _portions(column: pa.Array, most: int = 700_000) -> Iterator[tuple[int, list[str | None]]]:
    """(start, texts) of runs of about `most` bytes; only one is Python objects at a time."""
    begin = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        size += length
        if size >= most or i + 1 == len(column):
            yield begin, column.slice(begin, i + 1 - begin).to_pylist()
            begin, size = i + 1, 0


def _node(words: list[str]) -> bytes | None:
    """Identity of a text: the 128-bit hash of its words; None without words."""
    return xxhash.xxh3_128_digest(" ".join(words)) if words else None


def signed(docs: DataFrame, width: int, bands: int, rows: int, weights: str) -> DataFrame:
    """(doc_id, node, bands) of every row."""
    schema = StructType([StructField("doc_id", LongType()), StructField("node", BinaryType()),
                         StructField("bands", ArrayType(LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _portions(batch.column(1)):
                n = len(texts)
                words, element, weight, owner = elements_of(texts, width, weights)
                marks = signatures(element, weight, owner, n, bands * rows)
                keys = band_keys(marks, bands).reshape(-1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(keys))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), pa.array(map(_node, words), pa.binary()),
                     lists], names=schema.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def element_sets(docs: DataFrame, width: int, weights: str) -> DataFrame:
    """(node, elements, p0..p7) with the 32-bit element hashes and the sketch of every row's text that
    has a word. For weights by count, an element's second occurrence is an element of its own, and so on."""
    schema = StructType([StructField("node", BinaryType()),
                         StructField("elements", ArrayType(IntegerType(), False)),
                         *[StructField(p, LongType()) for p in _SKETCH]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _portions(batch.column(0)):
                words, element, weight, owner = elements_of(texts, width, weights)
                if weights == "count" and len(element):
                    count = weight.astype("i8")
                    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    with np.errstate(over="ignore"):
                        element = _mix(np.repeat(element, count) + nth.astype("u8") * _GOLD)
                    owner = np.repeat(owner, count)
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                sets = [np.unique(element[a:b].astype("u4")).view("i4")
                        for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(_node, words), pa.binary()), pa.array(sets, pa.list_(pa.int32())),
                     *map(pa.array, sketches(sets).T)], names=schema.names)

    return docs.select("text").mapInArrow(run, schema).where("node is not null")


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 8 words for each set: bit by bit, whether it has an odd number of elements of a class."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    element = np.concatenate([np.zeros(0, "i4"), *sets]).view("u4").astype("u8")
    with np.errstate(over="ignore"):
        bit = _mix(element * _GOLD) % np.uint64(64 * len(_SKETCH))
    out = np.zeros(len(sets) * len(_SKETCH), "u8")
    np.bitwise_xor.at(out, owner * len(_SKETCH) + (bit >> np.uint64(6)).astype("i8"),
                      np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(len(sets), len(_SKETCH)).view("i8")


def _linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity is `least` or more."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    small, big = F.least(F.size("x"), F.size("y")), F.greatest(F.size("x"), F.size("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b").where(small >= least * big)
            .where(both >= least * (F.size("x") + F.size("y") - both)).select("a", "b"))


def _common(sets: DataFrame, most: int = 20_000,
            distinct: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Elements that occur three times or more in at most about `most` of the sets, ascending, and
    how often they do; the `distinct` most frequent ones. They only order the elements: any order
    gives the same links."""
    n = sets.count()
    some = sets.where(in_share(F.col("node"), most / n, 29)) if n > most else sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            element, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(element, pa.int32()), pa.array(n, pa.int64())],
                                             names=["element", "n"])

    found = (some.select("elements").mapInArrow(run, "element int, n long").groupBy("element")
             .agg(F.sum("n").alias("n")).where("n > 2").orderBy(F.desc("n"), "element").limit(distinct)
             .toPandas().sort_values("element"))
    return found["element"].to_numpy("i4"), found["n"].to_numpy("i8")


def _prefixes(sets: DataFrame, least: float) -> DataFrame:
    """(element, size, place, node, root) of the first elements, rarest first, of each set: sets of
    similarity `least` share one of them."""
    often, times = _common(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            size = pc.list_value_length(lists).to_numpy().astype("i8")
            element = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(size)), size)
            count = np.zeros(len(element), "i8")
            if len(often):
                at = np.minimum(np.searchsorted(often, element), len(often) - 1)
                count = np.where(often[at] == element, times[at], 0)
            element = element[np.lexsort((element, count, owner))]
            place = np.arange(len(element)) - (np.cumsum(size) - size)[owner]
            first = place <= (size - np.ceil(least * size - 1e-9))[owner]
            who = pa.array(owner[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(element[first], pa.int32()), pa.array(size[owner][first], pa.int32()),
                 pa.array(place[first], pa.int32()), batch.column(0).take(who),
                 batch.column(1).take(who)], names=["element", "size", "place", "node", "root"])

    return sets.select("node", "root", "elements").mapInArrow(
        run, "element int, size int, place int, node binary, root binary")


def _blocks(n: str, part: int) -> Column:
    return F.ceil(F.col(n) / part).cast("int")


def _candidates(sets: DataFrame, least: float, part: int, scratch: Scratch) -> DataFrame:
    """The pairs (u, v) of sets (node, root, elements, and the sketch, if there is one) of different
    roots that may have similarity `least`: they share an element of both prefixes, and sizes, places
    and sketches allow it."""
    key = ["element", "size", "place"]
    firsts = scratch.put(_prefixes(sets, least), "firsts")
    groups = firsts.groupBy(*key).agg(F.count("*").alias("n"), F.min("root").alias("r1"),
                                      F.max("root").alias("r2"))
    several = (firsts.groupBy("element").agg(F.min("root").alias("least"), F.max("root").alias("most"),
                                             F.count("*").alias("of")).where("least <> most"))
    groups = scratch.put(groups.join(several.select("element", "of"), "element"), "groups")

    # Groups with groups, in blocks where an element has many.
    own = F.pmod(F.xxhash64("size", "place"), _blocks("of", part)).cast("int")
    every = F.explode(F.sequence(F.lit(0), _blocks("of", part) - 1))
    x, y = ([F.col(c).alias(f"{c}_{side}") for c in ("size", "place", "n", "r1", "r2")]
            for side in "xy")
    left = groups.select("element", own.alias("i"), every.alias("j"), *x)
    right = groups.select("element", every.alias("i"), own.alias("j"), *y)
    # What both still have from the shared element on, if it is the first that they share.
    behind = F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    needed = F.lit(least / (1 + least)) * (F.col("size_x") + F.col("size_y")) - 1e-6
    pairs = left.join(right, ["element", "i", "j"]).where(
        F.expr("(size_x, place_x) <= (size_y, place_y)")
        & (F.col("size_x") >= least * F.col("size_y") - 1e-6) & (behind >= needed)
        & ~F.expr("r1_x = r2_x and r1_y = r2_y and r1_x = r1_y"))
    pairs = scratch.put(pairs.select("element", "size_x", "place_x", "n_x", "size_y", "place_y",
                                     "n_y"), "group-pairs")

    # Members with members, in blocks where a group has many.
    live = scratch.put(pairs.select("element", *[F.col(f"{c}_x").alias(c) for c in ("size", "place", "n")])
                       .union(pairs.select("element", "size_y", "place_y", "n_y")).distinct(), "live")
    sketch = [p for p in _SKETCH if p in sets.columns]
    members = scratch.put(
        firsts.join(small_or_shuffled(live), key).withColumn(
            "block", F.pmod(F.xxhash64("node"), _blocks("n", part)).cast("int")).drop("n")
        .join(sets.select("node", *sketch), "node"), "met")
    x, y = (members.select("element", *[F.col(c).alias(f"{c}_{side}") for c in
                                        ("size", "place", "block", "node", "root", *sketch)])
            for side in "xy")
    apart = F.lit(0)
    for p in sketch:
        apart = apart + F.bit_count(F.col(f"{p}_x").bitwiseXOR(F.col(f"{p}_y")))
    # Similar sets have at most this share of their sizes' sum on one side only.
    alike = apart <= F.lit((1 - least) / (1 + least)) * (F.col("size_x") + F.col("size_y")) + 1e-6
    blocks = [F.explode(F.sequence(F.lit(0), _blocks(f"n_{side}", part) - 1)).alias(f"block_{side}")
              for side in "xy"]
    pairs = scratch.put(pairs.select("*", blocks[0]).select("*", blocks[1]).drop("n_x", "n_y"),
                        "block-pairs")
    return (small_or_shuffled(pairs).join(x, ["element", "size_x", "place_x", "block_x"])
            .join(y, ["element", "size_y", "place_y", "block_y"])
            .where((F.col("root_x") != F.col("root_y")) & alike
                   & ((F.col("size_x") != F.col("size_y")) | (F.col("place_x") != F.col("place_y"))
                      | (F.col("node_x") < F.col("node_y"))))
            .select(F.col("node_x").alias("u"), F.col("node_y").alias("v")))


def near_classes(docs: DataFrame, width: int = 5, least: float = 0.8, bands: int = 20,
                 rows: int = 4, weights: str = "set", steps: tuple[int, ...] = (4,),
                 part: int = 4096) -> DataFrame:
    """(doc_id, node, class_id, class_size, kept) of every document: class_id is the least doc_id
    of its class, and one document of each class is kept."""
    scratch = Scratch(docs.sparkSession, "near")
    docs = bounded_batches(docs)
    signs = scratch.put(signed(docs, width, bands, rows, weights), "signs")
    reps = (signs.where("node is not null").groupBy("node")
            .agg(F.any_value("bands").alias("bands")))
    keys = reps.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = (keys.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("centre"))
              .where("n > 1"))
    members = scratch.put(keys.join(shared, "bucket"), "members")
    nodes = scratch.put(signs.select("doc_id", "node")
                        .join(members.select("node").distinct(), "node", "left_semi")
                        .groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = texts.join(small_or_shuffled(nodes.select("doc_id")),
                       F.col("id").eqNullSafe(F.col("doc_id")), "left_semi")
    sets = scratch.put(element_sets(texts, width, weights)
                       .groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("elements", *_SKETCH)]),
                       "sets")

    def canonical(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("u", "v").alias("a"),
                            F.greatest("u", "v").alias("b")).distinct()

    # With the least node of the bucket, some bands after the other: in later ones only nodes that have
    # no linked neighbour in common with it yet, and so may be of another class.
    stars = members.where("node <> centre").select("band", F.col("node").alias("u"),
                                                   F.col("centre").alias("v"))
    tried = links = None
    for low, high in zip((0, *steps), (*steps, bands)):
        pairs = stars.where((F.col("band") >= low) & (F.col("band") < high)).select("u", "v")
        if links is None:
            pairs = scratch.put(canonical(pairs), f"tried-{low}-star")
        else:
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            label = scratch.put(both.groupBy("a").agg(F.least(F.min("b"), F.col("a"))
                                                      .alias("label")), f"label-{low}")
            side = {x: label.select(F.col("a").alias(x), F.col("label").alias(f"{x}_label"))
                    for x in "uv"}
            pairs = (pairs.distinct().join(small_or_shuffled(side["u"]), "u", "left")
                     .join(small_or_shuffled(side["v"]), "v", "left")
                     .where(F.coalesce("u_label", "u") != F.coalesce("v_label", "v")))
            pairs = scratch.put(canonical(pairs).join(tried, ["a", "b"], "left_anti"),
                                f"tried-{low}-star")
        found = scratch.put(_linked(pairs, sets, least), f"links-{low}-star")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
    roots = scratch.put(components(links, scratch, "parts-0"), last := "roots-0")
    placed = (members.join(small_or_shuffled(roots), "node", "left")
              .select("bucket", "node", F.coalesce("root", "node").alias("root")))
    split = (placed.groupBy("bucket").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
             .where("r1 <> r2").select("bucket"))
    open_ = scratch.put(placed.join(split, "bucket", "left_semi").select("node", "root").distinct(),
                        "open")
    open_ = scratch.put(sets.join(small_or_shuffled(open_), "node"), "open-sets")
    fresh = scratch.put(canonical(_candidates(open_, least, part, scratch))
                        .join(tried, ["a", "b"], "left_anti"), "tried-exact")
    found = scratch.put(_linked(fresh, sets, least), "links-exact")
    if not found.isEmpty():
        # Only classes are merged: the new links, as links between roots, are a small graph.
        old = {x: roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
               for x in "ab"}
        between = (found.join(small_or_shuffled(old["a"]), "a", "left")
                   .join(small_or_shuffled(old["b"]), "b", "left")
                   .select(F.coalesce("a_root", "a").alias("a"),
                           F.coalesce("b_root", "b").alias("b")))
        merged = components(between, scratch, "parts-exact")
        merged = scratch.put(merged.withColumnRenamed("root", "new"), "merged")
        moved = (roots.join(small_or_shuffled(merged.withColumnRenamed("node", "root")), "root",
                            "left").select("node", F.coalesce("new", "root").alias("root")))
        roots = scratch.put(moved.unionByName(merged.select("node", F.col("new").alias("root")))
                            .distinct(), last := "roots-exact")
    scratch.keep("signs", last)
    ids = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "node")
    rows = signs.select("doc_id", "node")
    own = (rows.where("node is not null").groupBy("node").agg(F.min(ids).alias("first"),
                                                              F.count("*").alias("copies"))
           .join(roots, "node", "left"))
    classes = (own.where("root is not null").groupBy("root")
               .agg(F.min("first").alias("least"), F.sum("copies").alias("size")))
    # A node of one row and no link is its class, so the table of the others is all that rows meet.
    named = (own.where("copies > 1 or root is not null").join(classes, "root", "left")
             .select("node", F.coalesce("least", "first").alias("least"),
                     F.coalesce("size", "copies").alias("size")))
    classed = rows.where("node is not null").join(named, "node", "left").withColumn(
        "least", F.coalesce("least", ids))
    first = (F.col("least.doc_id").eqNullSafe(F.col("doc_id"))
             & (F.col("least.node") == F.col("node")))
    one = F.lit(1).cast("long")
    return classed.select(
        "doc_id", "node", F.col("least.doc_id").alias("class_id"),
        F.coalesce("size", one).alias("class_size"), first.alias("kept")).unionByName(
        rows.where("node is null").select(
            "doc_id", "node", F.col("doc_id").alias("class_id"), one.alias("class_size"),
            F.lit(True).alias("kept")))


@pandas_udf(BinaryType())
def _node_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: _node(plain_words(t)))


def _row_key(doc_id: Column, node: Column) -> Column:
    """A document and its text as one text that is never null; without a node, it is none of a node's."""
    return F.concat_ws(":", F.hex(node), doc_id.cast("string"))


def near_documents(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, kept of every document."""
    return near_classes(docs.select("doc_id", "text")).drop("node")


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """One document of each class, whole, with the columns it had. Documents without a word stay."""
    kept = near_classes(docs.select("doc_id", "text"), **params).where("kept and node is not null")
    kept = Scratch(docs.sparkSession, "kept").put(
        kept.select(_row_key(F.col("doc_id"), F.col("node")).alias("__key")).distinct(), "ids")
    rows = docs.withColumn("__own", _node_udf(F.col("text")))
    # Most documents are kept, so the ids grow with the texts: shuffled at every size. The key is one
    # column without nulls, so the rows that meet it are dealt for what follows, too: texts move once.
    with_words = (rows.withColumn("__key", _row_key(docs["doc_id"].cast("long"), F.col("__own")))
                  .join(kept.hint("merge"), "__key", "left_semi").dropDuplicates(["doc_id", "__key"]))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return with_words.select(*columns).unionByName(rows.where("__own is null").select(*columns))
