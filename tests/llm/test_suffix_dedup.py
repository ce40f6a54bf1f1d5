import hashlib
import random

import numpy as np

from corpusloom.llm import suffix_dedup as S


def brute(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                gone[k : k + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(c for c, r in zip(b, gone) if not r)
        out.append((i, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


def rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abc ") for _ in range(rng.randint(50, 600))) for _ in range(8)]
    out = [(None, base[0]), (-1, None), (-2, ""), (-3, "a" * 700), (-4, "b" + "a" * 300 + "c"), (-5, "ab" * 250), (7, base[0]), (7, base[0]), (7, base[1])]
    for i in range(100, 150):
        t, u = rng.choice(base), rng.choice(base)
        k = rng.randint(0, len(t))
        out.append((i, rng.choice([t, t[:k] + "é" + t[k:], t[k:] + u[:200], t[k:] * 3, u + t + u])))
    return out


def test_suffix_array_is_sorted():
    raw = np.frombuffer(("".join(t or "" for _, t in rows())[:9000] + "aaaa" * 60).encode(), np.uint8)
    order = S.two_stage_suffix_array(raw, 100)
    b = raw.tobytes()
    assert sorted(order.tolist()) == list(range(len(b)))
    cut = [b[i : i + 100] for i in order]
    assert cut == sorted(cut)
    lcp = S.common_prefixes(raw, order, 100)
    for k in range(1, len(order), 97):
        x, y = b[order[k - 1] :][:100], b[order[k] :][:100]
        same = next((n for n in range(min(len(x), len(y))) if x[n] != y[n]), min(len(x), len(y)))
        assert lcp[k] == same or lcp[k] >= same == min(len(x), len(y))


def test_equals_brute_force_also_with_hot_anchors(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows()], "doc_id long, text string, n_bytes int")
    want = sorted(brute(rows(), 100), key=repr)
    assert sorted((tuple(r) for r in S.suffix_dedup(docs, digest=True).collect()), key=repr) == want
    monkeypatch.setattr(S, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 4000)
    assert sorted((tuple(r) for r in S.suffix_dedup(docs, digest=True, hot=3).collect()), key=repr) == want


def test_spans_and_kept(spark):
    rng = random.Random(1)
    text = "x" * 40 + "".join(rng.choice("abcdef") for _ in range(200))
    docs = spark.createDataFrame([(1, text), (2, "new" + text)], "doc_id long, text string")
    first, second = S.suffix_dedup(docs).orderBy("doc_id").collect()
    assert first.n_removed == 0 and bytes(first.kept) == text.encode()
    assert [(s.start, s.end) for s in second.spans] == [(3, 243)] and bytes(second.kept) == b"new"


def test_a_run_repeats_itself(spark):
    """Each 100-byte string of the run but its first one also starts earlier."""
    docs = spark.createDataFrame([(1, "x" * 40 + "b" * 200)], "doc_id long, text string")
    row = S.suffix_dedup(docs).first()
    assert row.n_removed == 199 and [(s.start, s.end) for s in row.spans] == [(41, 240)] and bytes(row.kept) == b"x" * 40 + b"b"


def test_empty_table(spark):
    assert S.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
