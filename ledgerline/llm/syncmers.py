"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is a sequence of tokens: runs of letters and digits (cut at 32), each other visible character on its own, and
each character of scripts written without spaces.  A k-mer of K tokens is selected if the least of its inner s-mers (S
tokens, by hash) is its first or its last one: a rule that looks at nothing outside the k-mer, so that equal passages
select equal k-mers wherever they stand.  At least one of any K - S + 1 neighbouring k-mers is selected; where a text has
fewer k-mers and none of them is, the one with the least hash stands in.  A k-mer's hash depends on all its tokens.

The fingerprint keeps the SKETCH least hashes of the distinct selected k-mers; the likeness of two fingerprints is the
share of common hashes among the SKETCH least of both together (a bottom-k estimate of their Jaccard similarity j, with
a standard error of sqrt(j * (1 - j) / SKETCH), 0.072 at most; exact where both texts have no more k-mers than that.
Hashes have 32 bits: of two sketches without a common k-mer, about 48 * 48 in 2**32 pairs have a common hash).
`places` returns all selected k-mers with their places, and `matches` finds by them where texts run in parallel, however
short the common passage is.

Edge cases: a null or empty text, or one without visible characters, has an empty fingerprint (like another empty one by
1, like any other by 0); fewer than K tokens make one k-mer of them all; repeated rows and equal keys are ordered by
their texts' hashes; null keys come first; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import int_array, text_or_empty

K, S = 6, 2
#: Hashes in a fingerprint.
SKETCH = 48
#: The ranges in front are letters and digits too: nearly all characters are found there, without a look at properties.
TOKEN = (
    r"[a-zA-Z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F[\p{L}\p{M}\p{N}"
    r"&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]]{1,32}+"
    r"|[^\s\p{Z}\p{C}]"
)
#: Stands for k-mers that are not selected; above all hashes of a fingerprint.
NONE = 1 << 32
#: Documents in a range of keys, ranges between quantiles of the keys, and equal parts of such a range at most.
RANGE_DOCS, QUANTILES, MAX_PARTS = 500, 4096, 256


def _selected(text: Column, named: Callable[[Column], Column], none: Column) -> Column:
    """For each k-mer of the text named(its hash), or none where it is not selected.  The index is the k-mer's place.

    Functions of array elements are interpreted, and take nearly all of the time: there are three for each token.
    """
    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))

    def of_tokens(h: Column) -> Column:
        # the last one lacks a token, and no k-mer looks at it
        smers = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + (S - 1))))
        return F.transform(F.array(smers), of_smers)[0]

    def of_smers(s: Column) -> Column:
        def name(x: Column, i: Column) -> Column:
            # the s-mers at 0, 2 and 4 hold all tokens of a k-mer
            return F.xxhash64(F.xxhash64(x, F.get(s, i + S)), F.get(s, i + (K - S)))

        def closed(x: Column, i: Column) -> Column:
            inner = F.least(*(F.get(s, i + j) for j in range(1, K - S)))
            return F.when(F.least(x, F.get(s, i + (K - S))) <= inner, named(name(x, i))).otherwise(none)

        heads = F.slice(s, F.lit(1), F.size(s) - (K - 1))
        def least(names: Column) -> Column:
            return F.transform(names, lambda x: F.when(x == F.array_min(names), named(x)).otherwise(none))

        def some(c: Column) -> Column:
            found = F.exists(c, lambda x: ~x.eqNullSafe(none))
            return F.when(found, c).otherwise(F.transform(F.array(F.transform(heads, name)), least)[0])

        # a last place, of the last s-mers, without a k-mer of its own
        return F.transform(F.array(F.concat(F.transform(heads, closed), F.array(none))), some)[0]

    # arrays of one element bind an intermediate array to a name, so that it is computed once
    whole = F.transform(
        F.array(tokens),
        lambda h: F.when(F.size(h) >= K, of_tokens(h)).when(F.size(h) > 0, F.array(named(F.xxhash64(h)))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    return whole[0]


def selected(text: Column) -> Column:
    """For each k-mer of the text its hash, or null where it is not selected.  The index is the k-mer's place."""
    return _selected(text, lambda x: x, F.lit(None).cast("long"))


def sketch(text: Column) -> Column:
    """The least hashes (32 bits) of the selected k-mers, ascending."""
    # no nulls, so that numbers are sorted as such
    names = _selected(text, lambda x: F.shiftrightunsigned(x, 32), F.lit(NONE).cast("long"))
    return F.array_remove(F.slice(F.sort_array(F.array_distinct(names)), 1, SKETCH), F.lit(NONE).cast("long"))


def as_string(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union)).cast("double")


def places(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, place (of its first token), name of every selected k-mer of each document."""
    found = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.posexplode(selected(text_or_empty(text))).alias("place", "name")
    )
    return found.where("name is not null")


def matches(queries: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 2) -> DataFrame:
    """query_id, doc_id, shift, anchors, first, last: stretches at one shift of places with at least `least` k-mers in common.

    first, last: places of the outermost common k-mers in the document.  queries: a stated set, matched against all rows.
    """
    asked = places(queries, key, text).select(F.col("doc_id").alias("query_id"), F.col("place").alias("at"), "name")
    met = places(docs, key, text).join(asked, "name").where(~F.col("query_id").eqNullSafe(F.col("doc_id")))
    return (
        met.groupBy("query_id", "doc_id", (F.col("place") - F.col("at")).alias("shift"))
        .agg(F.count("*").alias("anchors"), F.min("place").alias("first"), F.max("place").alias("last"))
        .where(F.col("anchors") >= least)
    )


def _part(cuts: list[int], inner: list[int]) -> Column:
    """The range of a key: between which quantiles it lies (by bisection), and in which of inner[i] equal parts there."""
    key, bounds = F.col("doc_id"), int_array(cuts)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    found = F.aggregate(
        int_array(steps),
        F.lit(0).cast("long"),
        lambda n, step: n + F.when(F.get(bounds, (n + step - 1).cast("int")) <= key, step).otherwise(F.lit(0).cast("long")),
    )
    found = F.when(key.isNull(), F.lit(0).cast("long")).otherwise(found)
    if not any(n > 1 for n in inner):
        return found
    low, high = (F.get(bounds, (found + i).cast("int")).cast("double") for i in (-1, 0))
    parts = F.get(int_array(inner), found.cast("int"))
    place = F.floor((key.cast("double") - low) / (high - low) * parts)
    return found * MAX_PARTS + F.coalesce(F.greatest(F.lit(0), F.least(place, parts - 1)), F.lit(0)).cast("long")


def with_next(rows: DataFrame, part: Column) -> DataFrame:
    """Each row with the next one's text and sketch (after the last: the first).  rows: doc_id, text, content, prints.

    Rows are dealt by ranges of the key; the last row of a range meets the first one of the next range that has rows.
    """
    # never null, so that both readers of the exchange below are alike and it is made once
    dealt = rows.withColumn("part", F.coalesce(part, F.lit(0))).repartition("part")
    order = Window.partitionBy("part").orderBy("doc_id", "content")
    # the range before each one that has rows; at most QUANTILES * MAX_PARTS ranges
    parts = dealt.select("part").distinct()
    before = parts.select("part", F.lag("part").over(Window.orderBy("part")).alias("before"))
    before = before.crossJoin(F.broadcast(parts.agg(F.max("part").alias("top"))))
    before = before.select("part", F.coalesce("before", "top").alias("before"))
    firsts = (
        dealt.withColumn("rank", F.row_number().over(order))
        .where("rank = 1")
        .join(F.broadcast(before), "part")
        .select(F.col("before").alias("part"), F.struct("text", "prints").alias("follower"))
    )
    # both sides deal the rows out alike, so that texts are shuffled once
    inner = dealt.withColumn("next", F.lead(F.struct("text", "prints")).over(order)).alias("i")
    following = (F.col("i.part") == F.col("f.part")) & F.col("i.next").isNull()
    return inner.join(firsts.alias("f"), following, "left").select(
        "i.doc_id", "i.text", "i.prints", F.coalesce("i.next", "f.follower").alias("next")
    )


def ranges(source: DataFrame, range_docs: int = RANGE_DOCS) -> Column:
    """The range of a row's key, so that ranges have about `range_docs` rows wherever the keys lie."""
    n = source.count()
    wanted = max(1, n // range_docs)
    if wanted == 1:
        return F.lit(0).cast("long")
    quantiles = min(QUANTILES, wanted)
    shares = [i / quantiles for i in range(1, quantiles)]
    found = source.agg(F.percentile_approx("doc_id", shares, 20 * quantiles)).head()[0] or []
    cuts = sorted(set(found))
    inner = min(MAX_PARTS, -(-wanted // quantiles))
    # the outermost ranges have no two ends
    return _part(cuts, [1, *[inner] * (len(cuts) - 1), 1])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document.

    The edited text has the last floor(n_chars / 2) code points replaced by the next document's first as many.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    rows = source.select(
        "doc_id", "text", F.xxhash64("text").alias("content"), sketch(F.col("text")).alias("prints")
    )
    paired = with_next(rows, ranges(source))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring("next.text", F.lit(1), half)
    )
    edited_rows = paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        edited.alias("edited"),
        "prints",
        F.col("next.prints").alias("next_prints"),
    )
    return edited_rows.withColumn("edited_prints", sketch(F.col("edited"))).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("prints")).alias("fingerprint"),
        as_string(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"),
    )
