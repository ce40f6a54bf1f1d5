import random

import numpy as np

from corpusloom.llm import bag_minhash as B


def test_registers_agree_like_the_weighted_similarity():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    a = [rng.choice(words) for _ in range(150)] * 2
    b = list(a)
    for _ in range(8):
        b[rng.randrange(len(b))] = "zz"
    similar = B.jaccard(B.bag(" ".join(a).encode()), B.bag(" ".join(b).encode()))
    agree = []
    for s in range(25):
        two = [B.bag(" ".join(f"{s}q{t}" for t in x).encode()) for x in (a, b)]
        sig = B.signatures(two)
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - similar) < 0.04


def docs():
    rng = random.Random(2)
    words = [f"word{i}" for i in range(500)]
    base = [[rng.choice(words) for _ in range(rng.randint(30, 120))] for _ in range(12)]
    rows = [(-1, None), (-2, ""), (None, "a b"), (None, "A b!"), (-7, "a b"), (7, "one two three four")]
    for i in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((100 + i, " ".join(t)))
    return rows


def classes(rows):
    bags = [B.bag((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(bags[i][0]) and len(bags[j][0]) and B.jaccard(bags[i], bags[j]) >= 0.8:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_classes_equal_brute_force(spark):
    rows = docs()
    root = classes(rows)
    frame = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, bag string")
    got = B.near_duplicates(frame).collect()
    want = {}
    for (i, _), r in zip(rows, root):
        want.setdefault(r, []).append(str(i))
    found, alone = {}, []
    for r in got:
        (alone.append([str(r.doc_id)]) if r.root is None else found.setdefault(bytes(r.root), []).append(str(r.doc_id)))
    assert sorted(map(sorted, [*found.values(), *alone])) == sorted(map(sorted, want.values()))
    for r in got:
        if r.root is not None:
            ids = [x.doc_id for x in got if x.root == r.root and x.doc_id is not None]
            assert r.class_id == (min(ids) if ids else None)
    kept = B.without_near_duplicates(frame)
    assert kept.columns == ["doc_id", "text", "bag"] and kept.count() == len(want)


def test_empty_table(spark):
    assert B.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
