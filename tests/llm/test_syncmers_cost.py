"""What a fingerprint costs: functions of array elements are interpreted, one call for each token."""

from pyspark.sql import functions as F

from ledgerline.llm import syncmers

PLAIN = (
    r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]{1,32}"
    r"|[^\s\p{Z}\p{C}]"
)


def test_a_sketch_has_few_functions_of_array_elements(spark, capsys):
    df = spark.createDataFrame([("a",)], "text string").select(syncmers.sketch(F.col("text")).alias("s"))
    df.explain()
    # three over all tokens, one up to the first selected k-mer, three that bind an array, three for short texts only
    assert 0 < capsys.readouterr().out.count("lambdafunction(") <= 10


def test_tokens_are_those_of_the_plain_expression(spark):
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    rows = [("".join(points[i : i + 40]),) for i in range(0, len(points), 37)]
    rows += [("x" * n + "é" * m,) for n in (31, 32, 33, 70) for m in (0, 1, 40)]
    df = spark.createDataFrame(rows, "text string").repartition(8)
    plain, fast = (F.regexp_extract_all("text", F.lit(x), F.lit(0)) for x in (PLAIN, syncmers.TOKEN))
    assert df.where(plain != fast).count() == 0
    assert df.select(F.sum(F.size(fast))).head()[0] > 100_000
