"""Winnowing where one run of words stands in many items and documents, in different surroundings."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from tallystar.llm.winnowing import Winnowing, _sided

COMMON = "as every child in town knows well".split()


def texts(seed, n, alphabet):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice(alphabet) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = COMMON[rng.randrange(2):rng.randrange(4, 8)]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("window, gram", [(10, 5), (10, 4), (10, 10), (6, 1), (7, 6)])
def test_spans_over_a_common_run(spark, window, gram):
    few = [f"w{i}" for i in range(3)]  # so that surroundings agree now and then
    docs = list(enumerate(texts(1, 150, few) + texts(2, 50, ["only", "documents"])))
    items = [(f"q{i}", t) for i, t in enumerate(texts(3, 80, few) + texts(4, 20, ["or", "items"]))]
    found = Winnowing(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id string, text string"),
        window, gram,
    )
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in found.documents().collect()}
    want = brute.overlaps(docs, items, window)
    assert got == {i: w for (i, _), w in zip(docs, want)}


def test_a_run_in_other_surroundings_meets_nothing(spark):
    """300 places and 300 variants of one hash give no pair, not 90,000."""
    rows = spark.range(300).select(
        F.lit(7).cast("long").alias("hash"), F.lit(0).alias("size"),
        F.expr("transform(sequence(0, 14), i -> if(i between 5 and 9, i, xxhash64(id, i)))").alias("around"),
    )
    other = rows.withColumn(
        "around", F.expr("transform(around, (x, i) -> if(i between 5 and 9, x, x + 1))")
    )
    on = ["hash", "size", "part", "beside"]
    mine, same, strange = (_sided(r, "around", 5, 5) for r in (rows, rows, other))
    assert mine.join(strange, on).count() == 0
    assert mine.join(same, on).count() == 600
