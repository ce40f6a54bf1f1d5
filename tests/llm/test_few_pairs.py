"""How many pairs meet: parities rule out near misses, small buckets need no prefix join."""

import random

from pyspark.sql import functions as F

from corpusloom.llm import bag_minhash, buckets
from tests.llm.test_families import text_family


def test_parities_rule_out_near_misses_and_no_similar_pair(spark):
    bags = [bag_minhash.bag(x.encode()) for x in [*text_family(20, 60, random.Random(4)), "a b c d e f g h", "a b c d e f g h " * 9]]
    rows = spark.createDataFrame([(k, int(b[1].sum()), bag_minhash.parities(b)) for k, b in enumerate(bags)], "node long, n long, bits array<long>")
    x, y = rows.toDF("a", "n_a", "bits_a"), rows.toDF("b", "n_b", "bits_b")
    met = x.crossJoin(y).filter("a < b").filter(buckets.may_share(F.col("bits_a"), F.col("bits_b"), F.col("n_a"), F.col("n_b"), 0.8))
    got = {(r.a, r.b) for r in met.select("a", "b").collect()}
    want = {(i, j) for j in range(len(bags)) for i in range(j) if bag_minhash.jaccard(bags[i], bags[j]) >= 0.8}
    assert len(want) == 20 and want <= got and len(got) <= 40


def test_small_buckets_meet_without_their_elements(spark):
    pairs = {(a, b) for b in range(20) for a in range(b) if a % 5 == b % 5 and a >= 5}
    asked, met = [], []

    def verify(found):
        met.extend((r.a, r.b) for r in found.collect())
        return found.filter("a % 5 = b % 5 and a >= 5")

    def elements(nodes):
        asked.append(nodes.count())
        return spark.createDataFrame([], "node long, n int, element long")

    shared = spark.createDataFrame([(1, k, 0) for k in range(20)], "key long, node long, hub long")
    roots = buckets.settled(shared, verify, lambda x: x, elements, 0.8, "test")
    got = {r.node: r.root for r in roots.collect()}
    assert got == {k: 5 + k % 5 for k in range(5, 20)} and pairs <= set(met) and asked == [0]
