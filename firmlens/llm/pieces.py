"""SentencePiece encoding and decoding by suffix-array matching.

A batch of texts is split before every run of spaces (no piece goes on past a space), and its
distinct parts are laid end to end. Their suffixes are sorted by as many characters as the longest
piece has; a binary search of each piece gives the range of its occurrences. The occurrences are
the edges of a lattice. Edges are put in the order of their piece's rank and then of position, and
relaxed in that order: an edge is taken if both its ends are still boundaries, and then the
boundaries inside it go. For a merge-trained vocabulary this gives the merges' result; `Vocabulary`
checks that each piece can be built from its own characters by merges of falling score, and
leaves out those that can't, which merges never make either.

Characters without a piece become their UTF-8 bytes. Null texts have null ids, empty texts no ids.
Texts are encoded whole; U+2581 counts as a space, as the format has it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, StringType, StructField,
                               StructType)

from .common import bounded_batches

SPACE = "▁"
_PARTS = re.compile(f"{SPACE}+[^{SPACE}]*")
_GAP = 0x110000  # stands between parts; no character and in no piece


def default_model() -> str:
    """Place of the public 32k model, if the package that brings it is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with their ids and ranks, in plain arrays that travel with the tasks."""

    def __init__(self, pieces: list[str], scores: list[float], bytes_of: dict[int, int],
                 special: dict[int, str]):
        ids = [i for i in range(len(pieces)) if i not in bytes_of and i not in special]
        self.single = {ord(pieces[i]): i for i in ids if len(pieces[i]) == 1}
        rank = {pieces[i]: -scores[i] for i in ids}
        long = [i for i in ids if len(pieces[i]) > 1 and _built(pieces[i], rank)]
        long.sort(key=lambda i: rank[pieces[i]])
        if any(SPACE in pieces[i].lstrip(SPACE) for i in long):
            raise ValueError("a piece goes on past a space")
        self.ids = np.array(long, "i8")
        self.ranks = np.unique([rank[pieces[i]] for i in long], return_inverse=True)[1]
        self.lengths = np.array([len(pieces[i]) for i in long], "i8")
        self.width = int(self.lengths.max(initial=1))
        self.codes = np.zeros((len(long), self.width), "i8")
        for row, i in enumerate(long):
            self.codes[row, : len(pieces[i])] = [ord(c) for c in pieces[i]]
        self.byte_ids = [0] * 256
        for i, b in bytes_of.items():
            self.byte_ids[b] = i
        self.plain = [special.get(i, p.replace(SPACE, " ")).encode() for i, p in enumerate(pieces)]
        for i, b in bytes_of.items():
            self.plain[i] = bytes([b])

    @classmethod
    @lru_cache(maxsize=4)
    def load(cls, path: str) -> Vocabulary:
        """Read a merge model with byte fallback, a dummy prefix and no normalisation."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        pieces = [sp.id_to_piece(i) for i in n]
        bytes_of = {i: int(pieces[i][3:5], 16) for i in n if sp.is_byte(i)}
        if len(bytes_of) != 256:
            raise ValueError("the model has no byte fallback")
        special = {i: " ⁇ " if sp.is_unknown(i) else "" for i in n
                   if sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)}
        return cls(pieces, [sp.get_score(i) for i in n], bytes_of, special)

    def decode(self, ids) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _built(piece: str, rank: dict[str, float]) -> bool:
    """Whether merges, best first, build the piece from its characters at ranks that never fall."""
    parts, last = list(piece), float("-inf")
    while len(parts) > 1:
        best = min(((rank.get(a + b, np.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best[0] == np.inf or best[0] < last:
            return False
        last, k = best
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return True


class Suffixes:
    """The suffixes of `codes` in the order of their first `width` characters (at least). `heads`
    are their first `span` characters as numbers, in that order."""

    def __init__(self, codes: np.ndarray, width: int):
        n = len(codes)
        present = np.zeros(_GAP + 1, "i4")
        present[codes] = 1
        self.rank_of = np.where(present, np.cumsum(present), 0)  # 0 stands for the end
        small = self.rank_of[codes].astype("i8")
        self.base = int(small.max(initial=1)) + 1
        self.span, key = 1, small
        while self.base ** (self.span + 1) < 2 ** 62 and self.span < width:
            key = key * self.base
            key[: max(0, n - self.span)] += small[self.span:]
            self.span += 1
        heads, span = key, self.span
        while True:
            self.order = np.argsort(key)
            if span >= width:
                break
            in_order = key[self.order]
            rank = np.empty(n, "i8")
            rank[self.order] = np.cumsum(np.concatenate([[1], in_order[1:] != in_order[:-1]]))
            key = rank * (n + 2)
            key[: max(0, n - span)] += rank[span:]
            span *= 2
        self.heads = heads[self.order]

    def ranges(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where suffixes that begin as the rows of `codes` do begin and end, by their heads only."""
        ranks = self.rank_of[codes[:, : self.span]]
        inside = np.arange(ranks.shape[1]) < lengths[:, None]
        absent = (inside & (ranks == 0)).any(axis=1)
        low, high = np.zeros(len(codes), "i8"), np.zeros(len(codes), "i8")
        for j in range(self.span):
            rank, there = (ranks[:, j], inside[:, j]) if j < ranks.shape[1] else (0, False)
            low = low * self.base + np.where(there, rank, 0)
            high = high * self.base + np.where(there, rank, self.base - 1)
        first = np.searchsorted(self.heads, low, side="left")
        last = np.searchsorted(self.heads, high, side="right")
        return first, np.where(absent, first, last)


def _bound(codes: np.ndarray, suffixes: Suffixes, vocabulary: Vocabulary, low: np.ndarray,
           high: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of every piece between `low` and `high`: the first suffix that is not smaller
    (upper: that is greater and does not begin with it)."""
    low, high, width = low.copy(), high.copy(), vocabulary.width
    inside = np.arange(width) < vocabulary.lengths[:, None]
    while len(left := np.flatnonzero(low < high)):
        middle = (low[left] + high[left]) // 2
        seen = codes[suffixes.order[middle][:, None] + np.arange(width)]
        gap = np.where(inside[left], seen - vocabulary.codes[left], 0)
        sign = gap[np.arange(len(left)), np.argmax(gap != 0, axis=1)]
        right = sign <= 0 if upper else sign < 0
        low[left[right]] = middle[right] + 1
        high[left[~right]] = middle[~right]
    return low


def lattice(codes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(piece row, start) of every occurrence of every piece, by rank and then position."""
    suffixes = Suffixes(codes, vocabulary.width)
    first, last = suffixes.ranges(vocabulary.codes, vocabulary.lengths)
    short = vocabulary.lengths <= suffixes.span
    padded = np.concatenate([codes, np.full(vocabulary.width, _GAP, "i8")])
    begin = _bound(padded, suffixes, vocabulary, first, np.where(short, first, last), upper=False)
    end = np.where(short, last,
                   _bound(padded, suffixes, vocabulary, begin, np.where(short, begin, last),
                          upper=True))
    count = end - begin
    piece = np.repeat(np.arange(len(count), dtype="i4"), count)
    within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    start = suffixes.order[np.repeat(begin, count) + within].astype("i4")
    by = np.argsort(vocabulary.ranks[piece] * (len(codes) + 1) + start)
    return piece[by], start[by]


def encode_parts(parts: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts end to end, and the number of ids of each."""
    sizes = np.fromiter(map(len, parts), "i8", len(parts))
    text = "\x00".join(parts)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype("i8")
    begin = np.cumsum(sizes + 1) - sizes - 1
    codes[(begin + sizes)[:-1]] = _GAP
    piece, start = lattice(codes, vocabulary)
    ends = start + vocabulary.lengths[piece]
    boundary = bytearray(b"\1") * (len(codes) + 1)
    nothing = [bytes(k) for k in range(vocabulary.width + 1)]
    chars, at = np.unique(codes, return_inverse=True)
    single = np.array([vocabulary.single.get(int(c), -1) for c in chars], "i4")
    token = array("i", single[at].tobytes())
    for k in range(0, len(start), 250_000):
        some = slice(k, k + 250_000)
        for i, j, number in zip(start[some].tolist(), ends[some].tolist(),
                                vocabulary.ids[piece[some]].tolist()):
            if boundary[i] and boundary[j]:
                token[i] = number
                i += 1
                if i + 1 == j:
                    boundary[i] = 0
                else:
                    boundary[i:j] = nothing[j - i]
    is_start = np.frombuffer(boundary, "u1")[:-1].astype(bool)
    is_start[(begin + sizes)[:-1]] = False
    starts = np.flatnonzero(is_start)
    ids = np.frombuffer(token, "i4")[starts].astype("i8")
    owner = np.searchsorted(begin, starts, side="right") - 1
    raw = ids < 0
    if raw.any():
        spelled = [[vocabulary.byte_ids[b] for b in chr(c).encode()] for c in codes[starts[raw]]]
        width = np.ones(len(ids), "i8")
        width[raw] = [len(x) for x in spelled]
        wide = np.repeat(raw, width)
        ids, owner = np.repeat(ids, width), np.repeat(owner, width)
        ids[wide] = [b for x in spelled for b in x]
    return ids.astype("i4"), np.bincount(owner, minlength=len(parts))


class Encoder:
    """Encodes batch after batch. Parts met before keep their ids, until `most_parts` are known;
    then all are forgotten, so memory stays bounded."""

    def __init__(self, vocabulary: Vocabulary, most_parts: int = 200_000):
        self.vocabulary, self.most_parts = vocabulary, most_parts
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.sizes = np.array([], "i4"), np.array([], "i8")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text (0 for null)."""
        if len(self.index) > self.most_parts:
            self.forget()
        index, known, used = self.index, len(self.index), array("i")
        parts_of = np.zeros(len(texts), "i8")
        for k, text in enumerate(texts):
            if text:
                parts = _PARTS.findall(SPACE + text.replace(" ", SPACE))
                used.extend([index.setdefault(p, len(index)) for p in parts])
                parts_of[k] = len(parts)
        if not used:
            return np.array([], "i4"), np.zeros(len(texts), "i8")
        if len(index) > known:
            ids, sizes = encode_parts(list(index)[known:], self.vocabulary)
            self.ids = np.concatenate([self.ids, ids])
            self.sizes = np.concatenate([self.sizes, sizes])
        begin = np.cumsum(self.sizes) - self.sizes
        rows = np.frombuffer(used, "i4")
        width = self.sizes[rows]
        ends = np.cumsum(width)
        out = self.ids[np.repeat(begin[rows] - ends + width, width) + np.arange(ends[-1])]
        total = np.concatenate([[0], ends])
        return out, np.diff(total[np.concatenate([[0], np.cumsum(parts_of)])])


def _slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut a batch where its texts exceed `most` bytes together; a longer text stands alone."""
    begin = size = 0
    for k, length in enumerate(lengths):
        if k > begin and size + length > most:
            yield begin, k
            begin, size = k, 0
        size += length
    if begin < len(lengths):
        yield begin, len(lengths)


def encode(docs: DataFrame, model: str | None = None, text: str = "text", ids: str = "tokens",
           same: str | None = None, batch_bytes: int = 3_000_000) -> DataFrame:
    """`docs` with the ids of the whole text as array<int>; no special tokens are added. `same` names
    a column that tells whether the ids, decoded, are the text again."""
    vocabulary = Vocabulary.load(model or default_model())
    taken = {ids.lower(), (same or ids).lower()}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = StructType([*kept, StructField(ids, ArrayType(IntegerType(), False)),
                         *([StructField(same, BooleanType())] if same else [])])
    source = bounded_batches(docs).select(*[F.col(f"`{f.name}`") for f in kept],
                                          F.col(f"`{text}`").alias("__encoded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for a, b in _slices(lengths, batch_bytes):
                texts = column.slice(a, b - a).to_pylist()
                values, sizes = encoder.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
                absent = pa.array([t is None for t in texts])
                made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()),
                                                mask=absent)
                columns = [*[c.slice(a, b - a) for c in batch.columns[:-1]], made]
                if same:
                    columns.append(pa.array([
                        text is None or vocabulary.decode(values[i:j].tolist())
                        == text.replace(SPACE, " ")
                        for text, i, j in zip(texts, offsets, offsets[1:])]))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, model: str | None = None, ids: str = "tokens",
           text: str = "text") -> DataFrame:
    """`df` with the text that the ids spell; null ids give null. A space that the encoder put
    first is taken away; bytes that are no UTF-8 become U+FFFD."""
    vocabulary = Vocabulary.load(model or default_model())

    @pandas_udf(StringType())
    def spelled(column: pd.Series) -> pd.Series:
        return column.map(lambda x: None if x is None else vocabulary.decode(x.tolist()))

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != text.lower()]
    return df.select(*kept, spelled(F.col(f"`{ids}`")).alias(text))


def encoded_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, tokens of every document, and whether they decode to its text again."""
    encoded = encode(docs.select("doc_id", F.col("text").alias("original")), model, "original",
                     same="round_trip")
    return encoded.select("doc_id", F.coalesce(F.size("tokens"), F.lit(0)).alias("n_tokens"),
                          "tokens", "round_trip")
