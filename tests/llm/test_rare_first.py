"""Which elements the prefix join looks up."""

import random

from corpusloom.llm import buckets


def test_frequent_elements_are_not_looked_up_and_no_pair_is_missed(spark, monkeypatch):
    monkeypatch.setattr(buckets, "RARE", 6)
    rng, sets, template = random.Random(8), [], set(range(100))
    for k in range(40):
        own = template | {1000 + 20 * k + j for j in range(25 if k % 2 else 5)}
        sets += [own, (own - {rng.randrange(100)}) | {-k - 1}]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    nodes = spark.createDataFrame([(k, k) for k in range(len(sets))], "node long, comp long")
    elements = spark.createDataFrame([(k, len(s), e) for k, s in enumerate(sets) for e in s], "node long, n int, element long")
    seen, put = {}, buckets.written

    def written(df, label):
        table = put(df, label)
        seen[label] = table.collect() if label == "test-rare" else []
        return table

    monkeypatch.setattr(buckets, "written", written)
    got = {(r.a, r.b) for r in buckets.prefix_pairs(nodes, elements, 0.8, "test").collect()}
    assert len(want) > 200 and want <= got
    assert not template & {e for r in seen["test-rare"] for e in r.s} and {r.enough for r in seen["test-rare"]} == {True, False}
