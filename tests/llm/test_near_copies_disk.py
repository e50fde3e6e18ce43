"""What the near-copy stage sends and leaves on disk."""

import os
import random

import pytest

from ledgerline.llm import near_copies
from test_near_copies import edited, survivors


@pytest.fixture(scope="module")
def long_texts():
    """Texts of 3,000 words that share a fifth, which bitmaps of 256 bits cannot tell apart, and near copies of some."""
    rng = random.Random(11)
    common = [f"common{i}" for i in range(600)]
    texts = []
    for i in range(24):
        words = [*common, *(f"t{i}x{rng.randrange(10**6)}" for _ in range(2400))]
        texts.append(" ".join(words))
        if i % 4 == 0:
            texts.append(" ".join(edited(rng, words, 40)))
    return dict(enumerate(texts))


def run(spark, texts, monkeypatch):
    """The keys kept, and the staged tables in order, by tag."""
    seen, plain = [], near_copies.common.staged

    def staged(df, tag, *rest):
        out = plain(df, tag, *rest)
        seen.append((tag, out.count(), out.staged_path))
        return out

    monkeypatch.setattr(near_copies.common, "staged", staged)
    # pairs of each long text with each other one
    monkeypatch.setattr(near_copies, "covering_masks", lambda radius: [0])
    monkeypatch.setattr(near_copies, "FREQUENT", 10**9)
    df = spark.createDataFrame([(k, x) for k, x in texts.items()], "doc_id long, text string")
    return {r["doc_id"] for r in near_copies.one_of_each(df).collect()}, seen


def test_texts_of_pairs_far_apart_are_not_sent(spark, long_texts, monkeypatch):
    kept, seen = run(spark, long_texts, monkeypatch)
    assert kept == survivors(long_texts)
    assert sum(n for tag, n, _ in seen if tag in ("near-likely", "near-pairs")) > 100
    # six pairs are near
    assert max(n for tag, n, _ in seen if tag == "near-texts") <= 12


def test_slices_give_the_same_and_large_tables_go(spark, long_texts, monkeypatch):
    monkeypatch.setattr(near_copies, "PAIRS", 50)
    monkeypatch.setattr(near_copies, "WORDS", 1)
    kept, seen = run(spark, long_texts, monkeypatch)
    assert kept == survivors(long_texts)
    assert sum(tag == "near-sifted" for tag, *_ in seen) > 3
    left = {tag for tag, _, path in seen if os.path.exists(path.removeprefix("file:"))}
    assert not left & {"near-heads", "near-shared", "near-met", "near-texts", "near-wide"}
    assert "near-nodes" in left
