"""The pipeline's near-copy stage against all pairs compared plainly."""

import itertools
import random

import corpus_pipeline
import numpy as np
import pytest

from ledgerline.llm import near_copies


def plain(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def survivors(texts):
    """The keys left when of each component of pairs with a similarity of 0.8 or more the least key stays."""
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    sets = {k: plain(x) for k, x in texts.items()}
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k for k in texts if find(k) == k}


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"edit{rng.random()}"
    return out


@pytest.fixture(scope="module")
def near():
    """Texts with 0 to 12 changed words of 120, a crowd about one passage, and short ones."""
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        texts += [" ".join(words), *(" ".join(edited(rng, words, rng.randrange(1, 8))) for _ in range(3))]
        texts.append(" ".join([*words, *(f"x{rng.random()}" for _ in range(rng.randrange(15, 45)))]))
    crowd = [f"c{i}" for i in range(80)]
    texts += [" ".join(edited(rng, crowd, rng.randrange(1, 4))) for _ in range(80)]
    texts += [" ".join([*crowd, *(f"y{rng.random()}" for _ in range(20))]) for _ in range(40)]
    texts += ["", " ", "One two", "one TWO", "one two three", "ÄRGER über Öl und Eis", "ärger ÜBER öl und eis"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_the_stage_keeps_one_of_each_group_of_similarity_four_fifths(spark, sf_dir, near, texts):
    for some in (near, texts):
        df = spark.createDataFrame([(k, x, "en", "s", len(x)) for k, x in some.items()], "doc_id long, text string, lang string, source string, n_chars long")
        kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, sf_dir).collect()}
        assert kept == survivors(some)


def test_prefixes_alone_find_every_pair(spark, near, monkeypatch):
    """Nothing depends on the covering tables, nor on which shingles are taken for frequent."""
    monkeypatch.setattr(near_copies, "covering_masks", lambda radius: [-1])
    monkeypatch.setattr(near_copies, "FREQUENT", 1)
    df = spark.createDataFrame([(k, x) for k, x in near.items()], "doc_id long, text string")
    assert {r["doc_id"] for r in near_copies.one_of_each(df).collect()} == survivors(near)


def test_bitmaps_never_differ_in_more_bits_than_the_sets_in_shingles():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    found = [np.unique(rng.choice(pool, int(n))) for n in rng.integers(1, 900, 60)]
    bits = near_copies.bitmaps(found)
    for (x, p), (y, q) in itertools.combinations(zip(found, bits, strict=True), 2):
        assert sum(int(i ^ j).bit_count() if i ^ j >= 0 else (int(i ^ j) + (1 << 64)).bit_count() for i, j in zip(p, q, strict=True)) <= len(np.setxor1d(x, y))


def test_odd_rows(odd, empty):
    out = near_copies.one_of_each(odd)
    assert out.columns == odd.columns
    found = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert {k for k, _ in found} == {None, 1, 4, 5, 7, 9, 10, 11, 9223372036854775807, -5}
    assert sum(k is None for k, _ in found) == 2
    assert sum(k == 9 for k, _ in found) == 2
    assert near_copies.one_of_each(empty).count() == 0
