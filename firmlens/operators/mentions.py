"""Which items mention which companies.

No text is compared with every name. Each name gets one anchor word; the distinct words of the texts
are matched against the anchors once, texts meet the matched words by equality, and every hit is
verified on the whole text. The plan is the same whatever the sizes; Spark alone decides at run
time which sides are small enough to be sent around.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import clean_name, normalise_words

def name_keys(companies: DataFrame, cleaned: bool = True) -> DataFrame:
    """(company, key): lower-case cleaned names. A name that cleans to nothing would be found
    in every text and is dropped; `unsearchable` lists those."""
    key = F.lower(clean_name(F.col("company")) if cleaned else F.trim("company"))
    return (companies.select("company").distinct()
            .select("company", key.alias("key")).filter(F.col("key") != ""))


def unsearchable(companies: DataFrame) -> DataFrame:
    return (companies.select("company").distinct()
            .filter(clean_name(F.col("company")) == ""))


# ---- anchors ------------------------------------------------------------------------------
#
# Words are what stands between spaces. A name of three words or more holds a whole word of any text
# that has it; a name of two ends one word and begins the next; a name of one may sit anywhere
# inside a word. The longest such part is the anchor; of parts of words, up to RUN characters are.

WHOLE, TAIL, HEAD, INSIDE = "whole", "tail", "head", "inside"
RUN = 8


def _anchors(keys: DataFrame, whole_words: bool) -> DataFrame:
    """(key, anchor, kind) of every key."""
    words = F.split("key", " ")
    n = F.size(words)
    kind = F.lit(WHOLE) if whole_words else (
        F.when(n == 1, INSIDE).when(F.col("_i") == 0, TAIL)
        .when(F.col("_i") == n - 1, HEAD).otherwise(WHOLE))
    part = F.when(F.col("kind") == WHOLE, F.col("anchor")).when(
        F.col("kind") == TAIL, F.right("anchor", F.lit(RUN))).otherwise(
        F.substring("anchor", 1, RUN))
    options = (keys.select("key", F.posexplode(words).alias("_i", "anchor"))
               .withColumn("kind", kind).withColumn("anchor", part)
               .filter(F.col("anchor") != ""))
    # Of parts of one length the whole word has the fewest hits.
    best = F.min(F.struct(-F.length("anchor"), (F.col("kind") != WHOLE).alias("_k"), "_i",
                          "anchor", "kind")).alias("_b")
    return options.groupBy("key").agg(best).select("key", "_b.anchor", "_b.kind")


def _matched(words: DataFrame, anchors: DataFrame) -> DataFrame:
    """(word, key) where the word has the key's anchor in the anchor's place.

    Anchors that are whole words are such pairs already. For the others the distinct words of the
    texts are taken apart, each once, into pieces of the kinds and lengths that anchors have; those
    are at most three times RUN, and one small job tells which."""
    whole = anchors.filter(F.col("kind") == WHOLE).select(F.col("anchor").alias("word"), "key")
    parts = anchors.filter(F.col("kind") != WHOLE)
    shapes = sorted(tuple(r) for r in parts.select("kind", F.length("anchor")).distinct().collect())
    if not shapes:
        return whole
    word, n = F.col("word"), F.length("word")

    def piece(kind: str, start, length: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"),
                        F.substring(word, start, F.lit(length)).alias("anchor"))

    def cut(kind: str, length: int) -> Column:
        if kind == INSIDE:
            places = F.sequence(F.lit(1), n - length + 1)
            pieces = F.transform(places, lambda at: piece(kind, at, length))
        else:
            pieces = F.array(piece(kind, F.lit(1) if kind == HEAD else n - length + 1, length))
        return F.when(n >= length, pieces).otherwise(
            F.array().cast("array<struct<kind:string,anchor:string>>"))

    pieces = F.array_distinct(F.concat(*[cut(*shape) for shape in shapes]))
    vocabulary = words.select("word").distinct()
    found = (vocabulary.select("word", F.inline(pieces)).join(parts, ["kind", "anchor"])
             .select("word", "key"))
    return whole.unionByName(found)


def _row_key(columns: Sequence[str]) -> Column:
    """A row's own 128-bit key, from its content: rows alike in everything share it, NULL ids are
    as good as any, and it is the same however often the row is read."""
    cells = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return F.struct(F.xxhash64(F.lit(1), *cells).alias("a"), F.xxhash64(F.lit(2), *cells)
                    .alias("b"))


def _mentions(items: DataFrame, item_id: str, body: Column, names: DataFrame,
              carry: Sequence[str], whole_words: bool) -> DataFrame:
    out = [item_id, *carry]
    texts = items.select(*out, body.alias("_text")).withColumn("_row", _row_key([*out, "_text"]))
    words = texts.select("_row", F.explode(F.array_distinct(F.split("_text", " "))).alias("word"))
    words = words.filter(F.col("word") != "")
    matched = _matched(words, _anchors(names.select("key").distinct(), whole_words))
    candidates = words.join(matched, "word").select("_row", "key").distinct()
    pad = F.lit(" " if whole_words else "")
    found = F.contains(F.concat(pad, F.col("_text"), pad), F.concat(pad, F.col("key"), pad))
    return (texts.join(candidates, "_row").filter(found).select(*out, "key")
            .join(names, "key").select(*out, "company"))


def mentions_substring(items: DataFrame, item_id: str, text: Column, companies: DataFrame,
                       normalise_text: bool = False,
                       carry: Sequence[str] = ()) -> DataFrame:
    """(item_id, *carry, company) where the cleaned name is a substring of the text, whatever
    the case; a row for each item row and name.

    Exact. `normalise_text` takes punctuation out of the text as it is out of the name. Columns
    named in `carry` come along, which saves reading and joining the items again.
    """
    body = normalise_words(text) if normalise_text else F.lower(text)
    return _mentions(items, item_id, body, name_keys(companies), carry, whole_words=False)


def mentions_words(items: DataFrame, item_id: str, text: Column, companies: DataFrame,
                   carry: Sequence[str] = ()) -> DataFrame:
    """(item_id, *carry, company) where the cleaned name occurs as whole words, punctuation aside;
    free of hits inside words."""
    names = name_keys(companies).withColumn("key", normalise_words(F.col("key")))
    return _mentions(items, item_id, normalise_words(text), names.filter(F.col("key") != ""),
                     carry, whole_words=True)


def attach_companies(items: DataFrame, item_id: str, companies: DataFrame,
                     between: str = " ", words: bool = False) -> DataFrame:
    """Feed items that belong to nobody yet (title, snippet), once per company whose name their
    text mentions. `between` joins title and snippet."""
    text = F.concat_ws(between, "title", "snippet")
    match = mentions_words if words else mentions_substring
    rest = [c for c in items.columns if c not in (item_id, "company")]
    return match(items, item_id, text, companies, carry=rest)


def any_word(words: Sequence[str]) -> str:
    """Pattern matching any of some words or phrases."""
    return "|".join(w.replace(".", r"\.") for w in words)


def news_matches(items: DataFrame, item_id: str, text: Column, companies: DataFrame,
                 words_pattern: str | None = None, published: Column | None = None,
                 since: Column | None = None, until: Column | None = None,
                 equals: dict[str, str] | None = None, **kw) -> DataFrame:
    """(item_id, company): the search predicate over a landed item table — exact phrase, any of
    the words, a date window, and fixed values such as a section or form type.

    Everything but the phrase is a plain filter ahead of the match, so it reaches the scan.
    """
    kept = items
    for column, value in (equals or {}).items():
        kept = kept.filter(F.col(column) == value)
    if since is not None:
        kept = kept.filter(published >= since)
    if until is not None:
        kept = kept.filter(published <= until)
    if words_pattern:
        kept = kept.filter(F.lower(text).rlike(words_pattern))
    return mentions_substring(kept, item_id, text, companies, **kw)
