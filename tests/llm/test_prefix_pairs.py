"""The prefix join against all pairs, where many nodes share their rarest elements."""

import random

from corpusloom.llm import buckets


def test_no_pair_is_missed_at_elements_of_many_components(spark, monkeypatch):
    monkeypatch.setattr(buckets, "SLICE", 8)
    rng, sets = random.Random(5), []
    pool = range(1000, 1024)  # every node has some of these, so each is in many components
    for _ in range(60):
        own = set(rng.sample(pool, 20))
        sets += [own, (own - {min(own)}) | {rng.choice(pool)}]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    nodes = spark.createDataFrame([(k, k) for k in range(len(sets))], "node long, comp long")
    elements = spark.createDataFrame([(k, len(s), e) for k, s in enumerate(sets) for e in s], "node long, n int, element long")
    got = {(r.a, r.b) for r in buckets.prefix_pairs(nodes, elements, 0.8, "test").collect()}
    assert len(want) > 100 and want <= got
