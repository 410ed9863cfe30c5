"""N-gram Jaccard join by PartEnum signatures.

A text is the set of its runs of `width` lower-cased words; texts with fewer words are one run. Texts
of equal sets are one node, known by the 64-bit sum of its elements' hashes (any two of n different
sets have the same with probability n^2 / 2^65).

Nodes are grouped by size into bands, each `100 / percent` times as wide as the last. A pair that links
has its smaller set in some band i and its larger set in i or i+1, and at most k = (100 - percent) /
percent times the band's largest size elements that only one of them has. So the elements' domain is
hashed into n1 parts of n2 parts each, n1 > k / 2: in one of the n1, at most one of the n2 differs, and
the two sets agree on all others. A set's signatures are its projections on every choice of all but one
of the n2, in every one of the n1, in its own band and, as the larger set, in the one below.

Projections without an element are shared by many and say little. n1 is larger than needed, so linked
sets agree on 2 n1 - k projections or more; a set with fewer empty ones than that leaves them out, and
another keeps them. Two sets that agree on empty ones only have that many both, so no link is lost.

The last bit of a signature tells whether its band's number is odd, so a node's two kinds are apart.
Linked sets share at least 2 n1 - k signatures less the empty ones of either, `spare` for short. So when
groups are looked into, a node may leave out its spare - 1 most frequent signatures, in an order that is
the same for all: the rarest that two linked nodes share is never among them. Signatures from a passage
that many documents quote are few beside that, and go.

Two nodes that share many signatures are listed at few of them: in the same order, each membership knows
the next `AHEAD` signatures of its node, and two nodes that share one of these are left to it. The last
one that they share is never passed over. Two nodes that are still classes of their own when all nodes
meet have met when one of each class did, and are not listed again.

Texts are cut into words twice: once for sizes, keys, sketches and signatures, which are stored, and, of
nodes that are compared, once more for the sets. Signatures are shuffled once, with 64-bit node keys. Each node is compared first with one other: of the
least nodes of its signatures' groups, the one that it shares the most signatures with. Pairs must agree
in size and in a sketch: of each of 512 hash classes, whether the set holds an odd number of elements.
Sketches that differ in more bits than linked sets may have elements apart are no link, which is exact,
and so are checked inside joins, but for sets so large that no two sketches differ in more; what remains is compared on the sets themselves, which move once for a
pair, to the least node of the two. Then nodes of groups that still hold several classes
meet: first one of each class, then all nodes that are not of one class by then, in blocks where a group
is large. So pairs within a class are not listed, and no link between different sets is missed.

Null and empty texts, and those without a word, are empty sets, linked with nothing: each row is a
component of its own. A null doc_id is the component only of rows without another id. Rows that repeat
are documents of their own, in one component. An empty table gives no rows. Columns of other names are
not read, so they cannot clash.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, byte_portions, components, numbered, small_or_shuffled

_GOLD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SKETCH = 8
_SKETCHES = [f"p{i}" for i in range(_SKETCH)]
_SPARES = ["spare0", "spare1"]
#: Bands whose largest size is this or more have longer projections.
WIDE = 800
#: Signatures ahead that a membership knows.
AHEAD = 8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---- bands --------------------------------------------------------------------------------


@functools.lru_cache
def bands(percent: int, upto: int) -> np.ndarray:
    """The largest size of each band, until one holds `upto`."""
    ends = [1]
    while ends[-1] < upto:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array(ends, "i8")


@functools.lru_cache
def scheme(percent: int, end: int) -> tuple[int, int, int]:
    """(n1, n2, k) of the band whose largest size is `end`; k = 0: only equal sets can link.

    Few elements are cut into few parts, so there more of the n2 are chosen at once; and so they are for
    sets that are too large for sketches to tell much, whose longer projections are shared by chance
    more rarely. n1 is the least for which at most one in a hundred of the band's smallest sets has
    2 n1 - k empty projections, taken as Poisson; for small sets, for which no n1 does that, the best."""
    k = (100 - percent) * end // percent
    fewest, n2 = (k + 2) // 2, 3 if end >= WIDE else max(2, min(8, 24 // (k + 2)))
    least = max(1, end * percent // 100)

    def kept(n1: int) -> float:
        mean = n1 * n2 * (1 - (n2 - 1) / (n1 * n2)) ** least
        term = below = math.exp(-mean)
        for j in range(1, 2 * n1 - k):
            term *= mean / j
            below += term
        return 1 - below

    options = range(fewest, 2 * fewest + 1)
    n1 = next((n for n in options if kept(n) <= 0.01), None) or min(options, key=kept)
    return n1, n2, k


# ---- sets ---------------------------------------------------------------------------------


def runs_of(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(element, text) of every run of `width` words of every text; a shorter text is one run."""
    words = [(t or b"").lower().split() for t in texts]
    flat = list(chain.from_iterable(words))
    code = {w: xxhash.xxh3_64_intdigest(w) for w in set(flat)}
    hashed = np.fromiter(map(code.__getitem__, flat), "u8", len(flat))
    sizes = np.array([len(w) for w in words], "i8")
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.flatnonzero(np.arange(len(flat)) <= np.maximum(ends - width, ends - sizes)[owner])
    owner, short = owner[at], sizes[owner[at]] < width
    element = np.zeros(len(at), "u8")
    with np.errstate(over="ignore"):
        for j in range(width):
            value = _mix(element * _STEP + hashed[np.minimum(at + j, len(flat) - 1)])
            element = np.where(short & (at + j >= ends[owner]), element, value)
    return element, owner


def sets_of(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(element, text): the distinct elements of every text, in no order."""
    element, owner = runs_of(texts, width)
    # Equal elements of a text have equal keys; those of two texts that have, once in 2^64, only stay
    # unrecognised as repeats if they stand between two that are equal.
    with np.errstate(over="ignore"):
        order = np.argsort(element ^ _mix((owner + 1).astype("u8") * _GOLD), kind="stable")
    element, owner = element[order], owner[order]
    if len(element):
        first = np.concatenate([[True], (element[1:] != element[:-1]) | (owner[1:] != owner[:-1])])
        element, owner = element[first], owner[first]
    return element, owner


def _sums(value: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, "u8")
    np.add.at(out, at, value)
    return out


def node_keys(element: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(_sums(_mix(element + _GOLD), owner, n)).view("i8")


def sketches(element: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x 8 words: bit by bit, whether a set has an odd number of elements of a hash class."""
    with np.errstate(over="ignore"):
        bit = _mix(element * _STEP) % np.uint64(64 * _SKETCH)
    out = np.zeros(n * _SKETCH, "u8")
    np.bitwise_xor.at(out, owner * _SKETCH + (bit >> np.uint64(6)).astype("i8"),
                      np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(n, _SKETCH).view("i8")


def signatures(element: np.ndarray, owner: np.ndarray, n: int,
               percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, text) of every text's set, and for each text how many signatures with an even and an
    odd last bit a linked set shares with it at least (0 where it has none)."""
    size = np.bincount(owner, minlength=n)
    ends = bands(percent, int(size.max(initial=1)))
    own = np.searchsorted(ends, size)
    made, whose, spare = [], [], np.zeros((n, 2), "i8")
    for below in (0, 1):
        band = own - below
        fits = (size > 0) & (band >= 0)
        if below:
            fits &= size * percent <= 100 * ends[np.maximum(band, 0)]
        used = np.unique(band[fits])
        plan = np.zeros((len(ends), 3), "i8")
        for b in used:
            plan[b] = scheme(percent, int(ends[b]))
        n1, n2, k = plan[np.maximum(band, 0)].T
        fits &= k > 0
        parts = np.where(fits, n1 * n2, 0)
        begin = np.cumsum(parts) - parts
        inside = fits[owner]
        who = owner[inside]
        with np.errstate(over="ignore"):
            seed = _mix(ends[np.maximum(band, 0)].astype("u8") * _GOLD)
            hashed = _mix(element[inside] ^ seed[who])
            part = begin[who] + (hashed % parts[who].astype("u8")).astype("i8")
            value = _sums(_mix(hashed + _STEP), part, int(parts.sum()))
        count = np.bincount(part, minlength=int(parts.sum()))
        # The projection on all but one of n2 parts: the whole of the n1 part less that one.
        text = np.repeat(np.arange(n), parts)
        place = np.arange(len(text)) - begin[text]
        group = np.concatenate([[0], np.cumsum(np.where(fits, n1, 0))])[text] + place // np.maximum(
            n2[text], 1)
        with np.errstate(over="ignore"):
            value = _sums(value, group, int(np.where(fits, n1, 0).sum()))[group] - value
            count = np.bincount(group, count).astype("i8")[group] - count
            mark = _mix(value + _mix(seed[text] + (place.astype("u8") + np.uint64(1)) * _STEP))
        mark = (mark & ~np.uint64(1)) | (band[text] & 1).astype("u8")
        empty = np.bincount(text[count == 0], minlength=n)
        keep = (count > 0) | (empty >= 2 * n1 - k)[text]
        spare[np.flatnonzero(fits), band[fits] & 1] = np.maximum(1, 2 * n1 - k - empty)[fits]
        made.append(mark[keep])
        whose.append(text[keep])
    return np.concatenate(made), np.concatenate(whose), spare


def digests(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(row, doc_id, n, node, p0..p7, spare0, spare1, signatures) of every row: the set's size, key (null
    if empty) and sketch, its signatures and what is known of shared ones. Of rows of one node in one
    portion of texts, the first has them."""
    columns = ["row", "doc_id", "n", "node", *_SKETCHES, *_SPARES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in byte_portions(batch.column(2)):
                n = len(texts)
                element, owner = sets_of(texts, width)
                size = np.bincount(owner, minlength=n)
                node = node_keys(element, owner, n)
                mark, text, spare = signatures(element, owner, n, percent)
                first = np.zeros(n, bool)
                first[np.unique(node, return_index=True)[1]] = True
                mark, text = mark[first[text]], text[first[text]]
                mark = mark[np.argsort(text, kind="stable")].view("i8")
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, n), batch.column(1).slice(begin, n), pa.array(size),
                     pa.array(node, mask=size == 0), *map(pa.array, sketches(element, owner, n).T),
                     *map(pa.array, spare.T),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(mark))],
                    names=[*columns, "signatures"])

    return docs.select("__row", F.col("doc_id").cast("long"), "text").mapInArrow(
        run, ", ".join(f"{c} long" for c in columns) + ", signatures array<long>")


# ---- links --------------------------------------------------------------------------------


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether sizes and sketches allow the nodes of two sides (columns n_x, p0_x, ...) a link. A node
    without a sketch is refuted by its size only."""
    small, big = F.least(f"n_{x}", f"n_{y}"), F.greatest(f"n_{x}", f"n_{y}")
    apart = F.lit(0)
    for p in _SKETCHES:
        apart = apart + F.coalesce(F.bit_count(F.col(f"{p}_{x}").bitwiseXOR(F.col(f"{p}_{y}"))), F.lit(0))
    return ((100 * small >= percent * big)
            & ((100 + percent) * apart <= (100 - percent) * (small + big)))


def _side(df: DataFrame, side: str, *keys: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in keys])


def _blocks(n: Column, part: int) -> Column:
    return F.ceil(n / part).cast("int")


def _links(docs: DataFrame, known: DataFrame, pairs: DataFrame, scratch: Scratch, name: str,
           width: int, percent: int, part: int) -> DataFrame:
    """The pairs (a, b) that link, decided on the sets.

    b's set is sent to a, where a's waits; an a with many partners waits in several blocks. Each set is
    made from one row of its node, and goes at once to where it is wanted: `lists` has, for each node,
    up to about `part` such places in a row."""
    sizes = pairs.groupBy("a").agg(_blocks(F.count("*"), part).alias("blocks"))
    salt = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wants = scratch.put(
        pairs.join(sizes, "a").select(F.col("b").alias("node"), "a", salt.alias("salt"),
                                      F.lit(1).alias("guest"))
        .unionByName(sizes.select(F.col("a").alias("node"), "a", every.alias("salt"),
                                  F.lit(0).alias("guest"))), f"{name}-wants")
    rows = wants.groupBy("node").agg(_blocks(F.count("*"), part).alias("rows"))
    lists = (wants.join(rows, "node")
             .groupBy("node", F.pmod(F.xxhash64("a", "salt"), F.col("rows")).alias("k"))
             .agg(F.collect_list(F.struct("a", "salt", "guest")).alias("places"))
             .join(known.select("node", "row"), "node").select("node", "row", "places"))
    lists = scratch.put(lists, f"{name}-lists")
    sent = docs.select(F.col("__row").alias("row"), "text").join(small_or_shuffled(lists), "row")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2)
            for begin, texts in byte_portions(batch.column(0)):
                element, owner = sets_of(texts, width)
                order = np.lexsort((element, owner))
                element, owner = element[order], owner[order]
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                sets = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(element.view("i8")))
                mine = places.slice(begin, len(texts))
                who = np.repeat(np.arange(len(texts)), mine.value_lengths().to_numpy())
                flat = mine.flatten()
                # Few at a time: a set is there once for each of its places.
                for i in range(0, len(who), 256):
                    part_of = pa.array(who[i:i + 256])
                    a, salt, guest = flat.slice(i, 256).flatten()
                    yield pa.RecordBatch.from_arrays(
                        [a, salt, guest, batch.column(1).slice(begin, len(texts)).take(part_of),
                         sets.take(part_of)], names=["a", "salt", "guest", "node", "elements"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, own = None, np.zeros(0, "u8")
        for batch in batches:
            a, salt, guest, node = (batch.column(i).to_pylist() for i in range(4))
            ends = batch.column(4).offsets.to_numpy()
            flat = batch.column(4).values.to_numpy().view("u8")
            found = []
            for i in range(batch.num_rows):
                mine = flat[ends[i]:ends[i + 1]]
                if not guest[i]:
                    host, own = (a[i], salt[i]), mine.copy()
                elif host == (a[i], salt[i]):
                    at = np.searchsorted(own, mine)
                    both = int((own[np.minimum(at, len(own) - 1)] == mine).sum())
                    if 100 * both >= percent * (len(own) + len(mine) - both):
                        found.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found, pa.int64())),
                                              batch.column(3).take(pa.array(found, pa.int64()))],
                                             names=["a", "b"])

    sets = sent.select("text", "node", "places").mapInArrow(
        send, "a long, salt int, guest int, node long, elements array<long>")
    met = sets.repartition("a", "salt").sortWithinPartitions("a", "salt", "guest")
    return scratch.put(met.mapInArrow(meet, "a long, b long").distinct(), name)


def _merged(roots: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) after more links (a, b): a small graph of roots."""
    for side in "ab":
        links = links.join(small_or_shuffled(roots.select(F.col("node").alias(side), F.col("root").alias(
            f"root_{side}"))), side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    between = links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    merged = scratch.put(components(between, scratch, f"{name}-parts")
                         .select(F.col("node").alias("root"), F.col("root").alias("new")),
                         f"{name}-merged")
    moved = roots.join(small_or_shuffled(merged), "root", "left").select(
        "node", F.coalesce("new", "root").alias("root"))
    fresh = merged.select(F.col("root").alias("node"), F.col("new").alias("root"))
    return scratch.put(moved.unionByName(fresh).distinct(), f"{name}-roots")


def _open(members: DataFrame, roots: DataFrame, known: DataFrame) -> DataFrame:
    """(signature, of, node, root, single, later) of the members (signature, node) of signatures with
    several roots, less those that their nodes can spare; single: a class of its own; later: the node's
    next signatures in the order of leaving out."""
    placed = (members.join(small_or_shuffled(roots), "node", "left")
              .withColumn("single", F.col("root").isNull())
              .withColumn("root", F.coalesce("root", "node")))
    several = (placed.groupBy("signature").agg(F.min("root").alias("r1"), F.max("root").alias("r2"),
                                               F.count("*").alias("of"))
               .where("r1 <> r2").select("signature", "of"))
    placed = placed.join(several, "signature").select("signature", "of", "node", "root", "single")
    odd = F.col("signature").bitwiseAND(1)
    often = Window.partitionBy("node", odd).orderBy(F.desc("of"), "signature")
    spare = F.when(odd == 1, F.col("spare1")).otherwise(F.col("spare0"))
    # Those left out come first, so what follows a member that stays stays too.
    later = F.filter(F.array(*[F.lead("signature", k).over(often) for k in range(1, AHEAD + 1)]),
                     lambda s: s.isNotNull())
    return (placed.withColumn("nth", F.row_number().over(often)).withColumn("later", later)
            .join(known.select("node", *_SPARES), "node").where(F.col("nth") >= spare)
            .select("signature", "of", "node", "root", "single", "later"))


def _across(members: DataFrame, known: DataFrame, percent: int, part: int, new: Column) -> DataFrame:
    """The pairs (a, b) of members of one signature and of different roots that sizes and sketches
    allow, where `new` holds; members of large groups meet block by block."""
    # Half of a sketch's bits differ at most, on average; where links may differ in more, it is no use.
    telling = (100 - percent) * 2 * F.col("n") < (100 + percent) * 32 * _SKETCH
    told = known.select("node", "n", *[F.when(telling, F.col(p)).alias(p) for p in _SKETCHES])
    members = members.join(told, "node")
    blocks = _blocks(F.col("of"), part)
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    left = _side(members.select("*", own.alias("i"), every.alias("j")).drop("of"), "a",
                 "signature", "i", "j")
    right = _side(members.select("*", every.alias("i"), own.alias("j")).drop("of"), "b",
                  "signature", "i", "j")
    return (left.join(right, [left[c] == right[c] for c in ("signature", "i", "j")]
                      + [F.col("root_a") < F.col("root_b"), new, _may_link("a", "b", percent),
                         ~F.arrays_overlap("later_a", "later_b")])
            .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
            .distinct())


def linked_classes(docs: DataFrame, scratch: Scratch, width: int, percent: int, part: int) -> tuple:
    """(digests, roots): a digest of every row, and (node, root) of every node that links."""
    docs = numbered(docs, scratch)
    rows = scratch.put(digests(docs, width, percent), "digests")
    by_node = Window.partitionBy("signature").orderBy("node")
    signed = rows.select(F.explode("signatures").alias("signature"), "node")
    stars = scratch.put(signed.withColumn("centre", F.first("node").over(by_node))
                        .where("node <> centre").distinct(), "stars")
    met = stars.select("node").union(stars.select("centre")).distinct()
    known = scratch.put(
        rows.where("node is not null").groupBy("node").agg(
            *[F.min(c).alias(c) for c in ("row", "n", *_SKETCHES, *_SPARES)])
        .join(small_or_shuffled(scratch.put(met, "met")), "node", "left_semi"), "known")
    sides = {s: _side(known.drop("row", *_SPARES), s) for s in "ab"}
    counted = stars.groupBy(F.col("centre").alias("node_a"), F.col("node").alias("node_b")).agg(
        F.count("*").alias("shared"))
    likely = counted.join(sides["b"], "node_b").join(sides["a"], "node_a").where(
        _may_link("a", "b", percent))
    best = F.max(F.struct("shared", (-F.col("node_a")).alias("minus"), F.col("node_a").alias("a")))
    pairs = scratch.put(likely.groupBy(F.col("node_b").alias("b")).agg(best.alias("best"))
                        .select("best.a", "b"), "pairs")
    how = (width, percent, part)
    links = _links(docs, known, pairs, scratch, "links", *how)
    roots = scratch.put(components(links, scratch, "parts"), "roots")
    members = stars.select("signature", "node").union(stars.select("signature", "centre").distinct())
    tried = pairs
    for name in ("classes", "rest"):
        open_ = scratch.put(_open(members, roots, known), f"{name}-open")
        some, new = open_, ~(F.col("single_a") & F.col("single_b"))
        if name == "classes":
            least = F.min(F.struct("node", "of", "single", "later")).alias("least")
            some, new = open_.groupBy("signature", "root").agg(least).select(
                "signature", "root", "least.*"), F.lit(True)
        pairs = scratch.put(_across(some, known, percent, part, new)
                            .join(tried, ["a", "b"], "left_anti"), f"{name}-pairs")
        if pairs.isEmpty():
            continue
        tried = tried.unionByName(pairs)
        links = _links(docs, known, pairs, scratch, f"{name}-links", *how)
        if not links.isEmpty():
            roots = _merged(roots, links, scratch, name)
    return rows, roots


def linked_documents(docs: DataFrame, width: int = 5, percent: int = 80,
                     part: int = 4096) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: documents link whose sets share at least
    `percent` of 100 parts of their union; a component's id is its least doc_id."""
    scratch = Scratch(docs.sparkSession, "links")
    rows, roots = linked_classes(docs.select("doc_id", "text"), scratch, width, percent, part)
    scratch.put(roots, "ends")
    scratch.keep("digests", "ends")
    roots = scratch.get("ends")
    least = (rows.where("node is not null").groupBy("node")
             .agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
             .join(roots, "node", "left"))
    of_root = (least.where("root is not null").groupBy("root").agg(F.min("first").alias("least")))
    # Only nodes of several rows or links need another id than their row's own.
    named = scratch.put(
        least.where("copies > 1 or root is not null").join(small_or_shuffled(scratch.put(
            of_root, "least")), "root", "left")
        .select("node", F.coalesce("least", "first").alias("component_id")), "named")
    return rows.join(small_or_shuffled(named), "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


LINK_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i + 1:i + 5], ' ') AS shingle FROM (
    SELECT doc_id, words, unnest(range(greatest(len(words) - 4, 1))) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.shingle = y.shingle
  JOIN sizes s ON s.doc_id = x.doc_id JOIN sizes t ON t.doc_id = y.doc_id
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, s.n, t.n
  HAVING 100 * count(*) >= 80 * (s.n + t.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""
