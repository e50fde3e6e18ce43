"""Short texts, and the names of k-mers."""

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import syncmers


@pytest.mark.parametrize("n", [6, 7, 8, 9])
def test_short_texts_have_fingerprints_of_their_own(spark, n):
    texts = [" ".join(f"t{i}x{j}" for j in range(n)) for i in range(300)]
    df = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    found = [r["fingerprint"] for r in syncmers.fingerprints(df).collect()]
    assert all(found)
    assert len(set(found)) == len(texts)


@pytest.mark.parametrize("place", range(6))
def test_every_token_enters_the_name_of_a_kmer(spark, place):
    pairs = []
    for i in range(300):
        a = [f"t{i}x{j}" for j in range(6)]
        b = [*a[:place], "other", *a[place + 1 :]]
        pairs.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = (syncmers.sketch(F.col(c)) for c in "ab")
    assert df.where(syncmers.likeness(a, b) > 0).count() == 0
