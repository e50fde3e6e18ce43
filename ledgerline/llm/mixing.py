"""Mixing sources to target weights by temperature.

Each source's token share p is raised to an exponent a and normalised.  a = 1 keeps the shares, a = 0 makes them equal.
The exponent is the smallest in [0, 1] (the most even mixture) that keeps the entropy at or under a target and no
source's repetition (tokens drawn over tokens held) over a limit; it is bisected, sixteen intervals at a time, by
aggregates over the table of sources, so that only sums reach the driver.

The weights are realised as budgeted block permutations: the documents of a source are dealt into blocks by hash, whole
epochs take every document, and in the last epoch blocks follow in an order hashed from (seed, source, epoch, block)
until the source's budget of tokens is used up; the block at the limit is cut between documents, in hashed order.

Without a budget the least one is taken at which every document appears once at least.

Edge cases: a null source is a source of its own; null and empty texts have no tokens; a source without any tokens gets
no weight and one epoch; repeated rows are rows like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

#: Documents in a block, and blocks of a source until blocks grow too: beyond, n documents make sqrt(n) blocks of
#: sqrt(n), so that neither the order of the blocks nor the block that is cut is large for one task.
BLOCK_DOCS, MAX_BLOCKS = 256, 4096
WORD = r"[^\x20\x09-\x0D]+"


def _sums(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: sum of p^a, entropy of the weights, largest weight over share."""
    live = sources.where("tokens > 0")
    aggs = []
    for i, a in enumerate(exponents):
        power = F.exp(F.log("p") * a)
        aggs += [
            F.sum(power).alias(f"z{i}"),
            F.sum(power * F.log(power)).alias(f"y{i}"),
            F.max(power / F.col("p")).alias(f"r{i}"),
        ]
    row = live.agg(*aggs).head()
    out = []
    for i in range(len(exponents)):
        z, y, r = row[f"z{i}"], row[f"y{i}"], row[f"r{i}"]
        out.append((z, math.log(z) - y / z, r / z))
    return out


def find_exponent(
    sources: DataFrame, total: float, budget: float | None, target_entropy: float | None, max_repetition: float | None
) -> tuple[float, float, float]:
    """(exponent, normaliser, budget in tokens).  target_entropy: as a share of the logarithm of the sources."""
    live = sources.where("tokens > 0").agg(F.count("*").alias("n"), F.max("p").alias("top")).head()
    if not live["n"]:
        return 1.0, 1.0, 0.0
    limit = math.inf if target_entropy is None else target_entropy * math.log(live["n"])

    def tokens(a: float, z: float) -> float:
        return budget if budget is not None else total * z * live["top"] ** (1 - a)

    def even(a: float, sums: tuple[float, float, float]) -> bool:
        """Whether the mixture is too even still."""
        z, entropy, ratio = sums
        over = max_repetition is not None and tokens(a, z) / total * ratio > max_repetition * (1 + 1e-12)
        return entropy > limit * (1 + 1e-12) or over

    low, high = 0.0, 1.0
    for _ in range(8):
        grid = [low + (high - low) * i / 16 for i in range(17)]
        fits = [i for i, (a, s) in enumerate(zip(grid, _sums(sources, grid), strict=True)) if not even(a, s)]
        first = fits[0] if fits else 16
        low, high = grid[max(0, first - 1)], grid[first]
    (z, _, _) = _sums(sources, [high])[0]
    return high, z, tokens(high, z)


def mix(
    docs: DataFrame,
    budget: float | None = None,
    target_entropy: float | None = 0.98,
    max_repetition: float | None = 4.0,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per drawn copy: doc_id, source, n_tokens, weight, epoch, block, tag (checksum), block_place.

    budget: tokens of the mixture as a multiple of the corpus.
    """
    rows = staged(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("n_tokens"),
            F.crc32(F.encode(text_or_empty(text), "UTF-8")).alias("tag"),
        ),
        "mix-rows",
    )
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    sources = staged(sources, "mix-sources")
    total = sources.agg(F.sum("tokens")).head()[0] or 0
    sources = sources.withColumn("p", F.col("tokens") / F.lit(float(max(1, total))))
    wanted = None if budget is None else budget * total
    a, z, tokens = find_exponent(sources, max(1, total), wanted, target_entropy, max_repetition)
    weight = F.when(F.col("tokens") > 0, F.exp(F.log("p") * a) / z).otherwise(0.0)
    drawn = F.when(
        F.col("tokens") > 0, F.greatest(F.col("weight") * tokens, F.lit(0.0)) / F.col("tokens")
    ).otherwise(1.0)
    plan = (
        sources.withColumn("weight", weight)
        .withColumn("drawn", F.round(drawn, 9))
        .select(
            "source",
            "weight",
            F.floor("drawn").cast("int").alias("epochs"),
            F.floor((F.col("drawn") - F.floor("drawn")) * F.col("tokens")).cast("long").alias("rest"),
            F.least(F.greatest(F.lit(MAX_BLOCKS), F.ceil(F.sqrt("n_docs"))), F.ceil(F.col("n_docs") / BLOCK_DOCS))
            .cast("int")
            .alias("blocks"),
        )
    )
    plan = staged(plan, "mix-plan")
    r, s = rows.alias("r"), plan.alias("s")
    dealt = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        "r.doc_id",
        "r.source",
        "r.n_tokens",
        "r.tag",
        "s.weight",
        "s.epochs",
        "s.rest",
        F.pmod(F.xxhash64(F.lit(seed), "r.doc_id"), F.col("s.blocks")).cast("int").alias("block"),
    )
    dealt = staged(dealt, "mix-dealt")
    # the last, partial epoch: whole blocks in hashed order, then the documents of the block at the limit
    turn = F.xxhash64(F.lit(seed), "source", "epochs", "block")
    blocks = dealt.where("rest > 0").groupBy("source", "epochs", "rest", "block").agg(F.sum("n_tokens").alias("size"))
    order = Window.partitionBy("source").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = (
        blocks.withColumn("turn", turn)
        .withColumn("until", F.sum("size").over(order))
        .withColumn("since", F.col("until") - F.col("size"))
        .where("since < rest")
        .select("source", "block", "since", (F.col("until") <= F.col("rest")).alias("whole"))
    )
    blocks = staged(blocks, "mix-blocks")
    d, b = dealt.where("rest > 0").alias("d"), blocks.alias("b")
    last = d.join(
        b, F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.block") == F.col("b.block"))
    ).select("d.*", "b.since", "b.whole")
    inner = (
        Window.partitionBy("source", "block")
        .orderBy(F.xxhash64(F.lit(seed), "epochs", "doc_id"), "doc_id", "tag")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    cut = (
        last.where("not whole")
        .withColumn("until", F.col("since") + F.sum("n_tokens").over(inner))
        .where("until <= rest")
        .drop("until")
    )
    final = last.where("whole").unionByName(cut).withColumn("epoch", F.col("epochs"))
    full = dealt.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    columns = ["doc_id", "source", "n_tokens", "weight", "epoch", "block", "tag"]
    return (
        full.select(columns)
        .unionByName(final.select(columns))
        .withColumn("block_place", F.xxhash64(F.lit(seed), "source", "epoch", "block"))
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:  # noqa: ANN003
    """The documents of the mixture, with all their columns, each as often as it is drawn.

    Wholly repeated rows are drawn alike, in the epochs of any of them.
    """
    drawn = mix(docs, key=key, text=text, **settings)
    copies = drawn.groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias("own"), "tag").agg(
        F.countDistinct("epoch").cast("int").alias("copies")
    )
    rows = docs.select(
        F.struct("*").alias("d"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("own"),
        F.crc32(F.encode(text_or_empty(text), "UTF-8")).alias("tag"),
    )
    found = rows.join(staged(copies, "mix-copies"), ["own", "tag"])
    return found.select("d", F.explode(F.sequence(F.lit(1), "copies"))).select([F.col(f"d.`{c}`") for c in docs.columns])
