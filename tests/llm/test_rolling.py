import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import rolling as W


def brute(rows, widths, shares):
    """``rows`` of (key, step, value, category): the features of each row and width."""
    out = []
    for k, s, _, _ in rows:
        for w in widths:
            own = [] if s is None else [r for r in rows if r[0] == k and r[1] is not None and s - w <= r[1] < s]
            values = sorted(r[2] for r in own if r[2] is not None)
            ranks = [values[-(-a * len(values) // b) - 1] if values else None for a, b in shares]
            out.append((k, s, w, len(own), sum(values), len({r[3] for r in own if r[3] is not None}), *ranks))
    return sorted(map(repr, out))


def entries(rng, n, keys, steps, values):
    some = lambda x, p: None if rng.random() < p else x
    return [(rng.choice(keys), some(rng.randint(*steps), 0.03), some(rng.randint(0, values), 0.2), some(rng.choice("abcd"), 0.3)) for _ in range(n)]


@pytest.mark.parametrize("seed, steps, values, slab, block", [(1, (0, 60), 5, None, 1 << 17), (2, (-50, 400), 1000, 7, 40), (3, (10, 12), 3, 64, 8), (4, (0, 3000), 50, 16, 100)])
def test_windows_equal_brute_force(spark, monkeypatch, seed, steps, values, slab, block):
    monkeypatch.setattr(W, "BLOCK_ROWS", block)
    rows = entries(random.Random(seed), 400, ["x", "x", "y", None], steps, values)
    frame = spark.createDataFrame([(*r, "c") for r in rows], "key string, step long, value long, category string, width string")
    got = W.rolling(frame, "key", "step", "value", "category", [5, 32], [(1, 2), (75, 100), (1, 1)], slab)
    assert sorted(repr((r.row.key, r.row.step, r.width, r.rows, r.total, r.categories, r.r0, r.r1, r.r2)) for r in got.collect()) == brute(rows, [5, 32], [(1, 2), (75, 100), (1, 1)])


def test_tree_counts():
    rng = np.random.default_rng(5)
    slab, step, value, weight = rng.integers(0, 3, 500), rng.integers(0, 37, 500), rng.integers(0, 20, 500), rng.integers(1, 4, 500)
    tree = W.Tree(slab, step, value, weight, 3)
    for _ in range(200):
        k, end = int(rng.integers(0, 3)), int(rng.integers(0, 70))
        own = np.flatnonzero(slab == k)
        own = own[np.argsort(value[own], kind="stable")]
        place = int(rng.integers(0, len(own) + 1))
        want = weight[own[:place]][step[own[:place]] < end].sum()
        assert tree.before(np.array([k]), np.array([end]), np.array([place]))[0] == want


def docs():
    rng = random.Random(6)
    out = [(None, None, "de", "s"), (None, "abc", None, None), (5, None, None, None), (7, "", "en", "s")]
    out += [(i * 3, "x" * rng.randint(0, 9), rng.choice(["en", "de", None]), rng.choice(["s", "t", None])) for i in range(150)]
    return out + [(31, "y" * 150_000, "en", "s"), out[9], out[9]]


def test_documents_equal_brute_force(spark):
    got = W.document_windows(spark.createDataFrame([(*r, "c", 1) for r in docs()], "doc_id long, text string, lang string, source string, width string, minute int"))
    at = lambda i: None if i is None else 60 * ((i + zlib.crc32(str(i).encode()) % 4000) // 6)
    rows = [(s, at(i), None if t is None else len(t), x) for i, t, x, s in docs()]
    want = brute(rows, [3600, 21600], [(1, 2), (75, 100)])
    source = {i: s for i, _, _, s in docs() if i is not None}
    have = [repr((source[r.doc_id], r.event_s, r.window_s, r.n_events, r.sum_chars, r.n_langs, r.median_chars, r.high_chars)) for r in got.collect() if r.doc_id is not None]
    assert sorted(have) == [w for w in want if ", None, 3600" not in w and ", None, 21600" not in w]
    assert [tuple(r)[2:] for r in got.filter("doc_id is null").collect()] == [(None, 0, 0, 0, None, None)] * 4


def test_times_of_large_and_negative_ids(spark):
    ids = [2**55 + 12345, 2**54 + 1, -1, -5000, 0, 7]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", W.event_second(F.col("i")).alias("e")).collect()
    assert {r.i: r.e for r in got} == {i: 60 * ((i + zlib.crc32(str(i).encode()) % 4000) // 6) for i in ids}


def test_empty_table(spark):
    assert W.document_windows(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []
