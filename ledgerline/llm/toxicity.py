"""Toxicity by a counterfactual-regularised classifier.

A logistic model over hashed features of the distinct words of a text: each word and its first 4, 5 and 6 bytes, in
lower case; only features that speak for the label are in the model.  It is fitted on a bounded sample of labelled texts.  For each sampled text that names a group of people,
a counterfactual is made by swapping every such term for others of its kind; the loss adds
`penalty * (z(text) - z(swapped))**2`, so that a neutral mention of a group does not move the score.

Scores use nothing but the text.  Rows whose crc32(key) mod 5 is 0 are held out from fitting.

Edge cases: a null or empty text has no words and gets the score of the intercept; a row with a null key is scored but
never learnt from; several labels for a key count as so many rows; without labels of both kinds every score is 0;
repeated rows get equal scores; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs, staged, texts

#: Hashed features; the weights (4 bytes each) are the whole model that goes to the workers.
FEATURES = 1 << 18
#: Bytes of text whose words are hashed at once.
SLAB_BYTES = 500_000
#: Labelled rows of each class that the model is fitted on at most, those with the least hash of their key.
SAMPLE = 3000
PREFIXES = (4, 5, 6)
#: Least log-likelihood ratio of a feature in the model, and features in the model at most (the strongest).
EVIDENCE, MODEL = 15.0, 4096
#: Terms that name groups of people, by kind; swaps stay within a kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("she", "he", "they"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("femmes", "hommes", "filles", "garçons"),
    ("mujeres", "hombres", "chicas", "chicos"),
)
_SWAPS = {
    term: [x for x in kind if x != term] for kind in IDENTITY_TERMS for term in kind
}
_TERM = re.compile(r"\b(" + "|".join(sorted(_SWAPS, key=len, reverse=True)) + r")\b", re.IGNORECASE)
_INNER = np.zeros(256, dtype=bool)
_INNER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_TABLE = np.random.default_rng(20240101).integers(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def counterfactuals(text: str) -> list[str]:
    """The text with its group terms swapped: one version for each of two shifts through their kinds."""
    if not _TERM.search(text):
        return []
    return [
        _TERM.sub(lambda m, k=k: (s := _SWAPS[m[0].lower()])[k % len(s)], text) for k in range(2)
    ]


def features(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct words of each text, as parallel arrays ordered by row."""
    lowered = [x.decode("utf-8", "replace").lower().encode() for x in data]
    buffer = np.frombuffer(b"\n".join([*lowered, b""]) + b"\0" * 8, dtype=np.uint8)
    lengths = np.array([len(x) + 1 for x in lowered])
    inner = _INNER[buffer]
    edges = np.diff(np.concatenate([[False], inner, [False]]).astype(np.int8))
    starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.searchsorted(np.cumsum(lengths), starts, side="right")
    sizes = ends - starts
    with np.errstate(over="ignore"):
        # running hash over the first bytes of every word
        powers = np.cumprod(np.full(64, _STEP, dtype=np.uint64))
        hashes = np.zeros(len(starts), dtype=np.uint64)
        prefixes = {}
        for i in range(int(min(sizes.max(), 64))):
            live = sizes > i
            if live.all():
                hashes = hashes + _TABLE[buffer[starts + i]] * powers[i]
            else:
                hashes[live] += _TABLE[buffer[starts[live] + i]] * powers[i]
            if i + 1 in PREFIXES:
                prefixes[i + 1] = hashes.copy()
        words = hashes ^ (sizes.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        _, first = np.unique((words >> np.uint64(20)) | (rows.astype(np.uint64) << np.uint64(44)), return_index=True)
        first = np.sort(first)
        found = [words[first]]
        found += [np.where(sizes >= k, h + np.uint64(k), np.uint64(0))[first] for k, h in prefixes.items()]
        mixed = [((h ^ (h >> np.uint64(29))) * _STEP) >> np.uint64(64 - 18) for h in found]
    at = np.stack(mixed, axis=1).astype(np.int64)
    kept = np.stack([h != 0 for h in found], axis=1)
    owner = np.repeat(rows[first][:, None], at.shape[1], axis=1)
    return owner[kept], at[kept]


def telling(ones: np.ndarray, zeros: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The features that speak for label 1, strongest first: log-likelihood ratio of at least EVIDENCE, and more
    frequent there.  ones, zeros: texts of each label with each feature, of n1 and n0.

    Only those enter the model, so that the many other words of a long text don't add up against it.
    """
    rate = (ones + zeros) / (n1 + n0)

    def log_likelihood(k: np.ndarray, m: int, p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (m - k) * np.log(1 - p)

    gain = log_likelihood(ones, n1, ones / n1) + log_likelihood(zeros, n0, zeros / n0)
    gain = 2 * (gain - log_likelihood(ones, n1, rate) - log_likelihood(zeros, n0, rate))
    found = np.nonzero((gain >= EVIDENCE) & (ones / n1 > 2 * zeros / n0))[0]
    return found[np.argsort(-gain[found], kind="stable")]


def fit(
    rows: list[tuple[np.ndarray, list[np.ndarray], int]],
    base_rate: float,
    penalty: float = 1.0,
    decay: float = 1e-3,
    steps: int = 120,
) -> tuple[np.ndarray, float]:
    """Weights and intercept.  rows: (features, features of the counterfactuals, label), with features of the model
    only; base_rate: share of label 1."""
    labels = np.array([y for _, _, y in rows], dtype=float)
    if not len(rows) or labels.min() == labels.max():
        return np.zeros(FEATURES, np.float32), -np.inf
    owner = np.repeat(np.arange(len(rows)), [len(x) for x, _, _ in rows])
    used, column = np.unique(np.concatenate([x for x, _, _ in rows]).astype(np.int64), return_inverse=True)
    pairs = [(i, swapped) for i, (_, others, _) in enumerate(rows) for swapped in others]
    place = {f: j for j, f in enumerate(used)}
    swap_owner = np.array([k for k, (_, x) in enumerate(pairs) for f in x if f in place], dtype=np.int64)
    swap_column = np.array([place[f] for _, x in pairs for f in x if f in place], dtype=np.int64)
    origin = np.array([i for i, _ in pairs], dtype=np.int64)
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    w, bias = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(owner, w[column], len(rows)) + bias
        slope = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        if len(pairs):
            other = np.bincount(swap_owner, w[swap_column], len(pairs)) + bias
            gap = 2 * penalty * (z[origin] - other) / len(rows)
            slope = slope + np.bincount(origin, gap, len(rows))
        grad = np.bincount(column, slope[owner], len(w)) + decay * w / len(rows)
        if len(pairs):
            grad -= np.bincount(swap_column, gap[swap_owner], len(w))
        gb = float((share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)).sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = 0.05 / (1 - 0.9**t)
        w -= rate * m / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        bias -= rate * mb / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(FEATURES, np.float32)
    weights[used] = w
    # classes weighed alike in fitting: the intercept takes the classes' shares back in
    return weights, bias + 0.5 * float(np.log(base_rate / (1 - base_rate)))


def _packed(at: np.ndarray) -> bytes:
    """Distinct features as 32-bit integers."""
    return np.unique(at).astype("<i4").tobytes()


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slabs(batches, "text", SLAB_BYTES):
        data = texts(batch)
        owner, at = features(data)
        cuts = np.searchsorted(owner, np.arange(len(data) + 1))
        swapped = []
        for x in data:
            versions = counterfactuals(x.decode("utf-8", "replace"))
            swapped.append([_packed(features([v.encode()])[1]) for v in versions])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                pa.array([_packed(at[a:b]) for a, b in itertools.pairwise(cuts)], pa.binary()),
                pa.array(swapped, pa.list_(pa.binary())),
            ],
            ["label", "at", "swapped"],
        )


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label have each feature."""
    tally = np.zeros((2, FEATURES), dtype=np.int64)
    for batch in batches:
        for label, at in zip(batch.column("label").to_pylist(), batch.column("at").to_pylist(), strict=True):
            tally[label, np.frombuffer(at, dtype="<i4")] += 1
    used = np.nonzero(tally.any(axis=0))[0]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, *tally[:, used])], ["feature", "zeros", "ones"])


def _within(chosen: np.ndarray):  # noqa: ANN202
    """Keeps the chosen features only."""
    live = np.zeros(FEATURES, dtype=bool)
    live[chosen] = True

    def kept(x: bytes) -> bytes:
        at = np.frombuffer(x, dtype="<i4")
        return at[live[at]].tobytes()

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [kept(x) for x in batch.column("at").to_pylist()]
            swapped = [[kept(x) for x in versions] for versions in batch.column("swapped").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(at, pa.binary()), pa.array(swapped, pa.list_(pa.binary()))],
                ["label", "at", "swapped"],
            )

    return thinned


def held_out(key: str = "doc_id"):  # noqa: ANN201
    """Whether a row is kept from fitting: crc32 of the key as text, mod 5, is 0; null keys are kept from it too."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = SAMPLE,
    key: str = "doc_id",
    text: str = "text",
) -> tuple[np.ndarray, float]:
    """Fit on at most `sample` rows of each class.

    What reaches the driver is bounded: sums per hashed feature, and of each sampled row the features of the model.
    """
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out())
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = [
        known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)
    ]
    chosen = staged(chosen[0].unionByName(chosen[1]), "toxic-sample")
    # 2 * sample rows at most
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").select("label", "text")
    schema = "label int, at binary, swapped array<binary>"
    rows = staged(rows.mapInArrow(_extracted, schema), "toxic-features")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    found = []
    if len(sizes) == 2:
        # sums over hashed features, however long the texts are
        tally = rows.mapInArrow(_tallied, "feature long, zeros long, ones long").groupBy("feature")
        tally = tally.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
        feature, zeros, ones = (tally.column(c).to_numpy() for c in ("feature", "zeros", "ones"))
        order = np.argsort(feature)
        strongest = feature[order][telling(ones[order], zeros[order], sizes[1], sizes[0])][:MODEL]
        found = rows.mapInArrow(_within(strongest), schema).collect()
    found = sorted((r["label"], bytes(r["at"]), tuple(map(bytes, r["swapped"]))) for r in found)
    found = [(np.frombuffer(at, "<i4"), [np.frombuffer(x, "<i4") for x in swapped], y) for y, at, swapped in found]
    total = sum(shares.values())
    rate = min(0.9, max(0.01, shares.get(1, 0) / total)) if total else 0.5
    return fit(found, rate)


def score(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = SAMPLE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5)."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    weights, bias = learn(docs, labels, label, sample, key, text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text", SLAB_BYTES):
            owner, at = features(texts(batch))
            z = np.bincount(owner, weights[at], batch.num_rows)[: batch.num_rows] + bias
            found = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    rows = source.mapInArrow(scored, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = SAMPLE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with a score under 0.5, with all their columns."""
    weights, bias = learn(docs, labels, label, sample, key, text)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, text, SLAB_BYTES):
            owner, at = features(texts(batch, text))
            z = np.bincount(owner, weights[at], batch.num_rows)[: batch.num_rows] + bias
            yield batch.filter(pa.array(z < 0))

    return docs.mapInArrow(passed, docs.schema)
