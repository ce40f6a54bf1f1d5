import hashlib
import random
import zlib

import pytest

from corpusloom.llm import periodic_runs as P


def brute(words, least=P.LEAST):
    """Runs by trying every period at every place."""
    n, spans = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                spans.setdefault((i, j + q), q)  # the least period comes first
            i = j
    return sorted((s, e - s, q) for (s, e), q in spans.items())


def planted(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed):
    rng = random.Random(seed)
    out = ["", "a", "a " * 12, "a " * 11, "a b " * 6, "x " + "a b c " * 9 + "a d"]
    for _ in range(150):
        letters = "abcdefghijklmnop"[: rng.choice([1, 2, 2, 3, 16])]
        words = []
        for _ in range(rng.randint(1, 6)):
            part = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
            words += part * rng.choice([1, 1, 2, 3, 6]) + part[: rng.randint(0, len(part))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("least", [12, 2, 5])
def test_blocks_equal_brute_force(least):
    docs = [t.encode().split() for t in texts(least)]
    for words, (own, stays) in zip(docs, P.block_runs(docs, least), strict=True):
        want = brute(words, least)
        assert [(s, e - s, q) for s, e, q in own.tolist()] == want
        assert b" ".join(w for w, s in zip(words, stays.tolist(), strict=True) if s) == collapsed(words, want)


def rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    out = [(None, None), (None, "a " * 30), (-1, None), (-2, ""), (-3, " \n\t "), (-4, "é é\x0bé " * 9)]
    out += [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 400)))) for i in range(120)]
    return out + [out[20], out[20], (7, "a b c " * 200), (500, "x" * 150_000)]


def test_query_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows()], "doc_id long, text string, w string, a int")
    got = P.periodic_runs(P.with_planted_runs(docs), digest=True).collect()
    want, repeats = [], 0
    for i, t in rows():
        words = planted(i, t) if i is not None else (t or "").encode().split()
        runs = brute(words)
        repeats += i is not None and words != (t or "").encode().split()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and repeats > 5


def test_texts_and_runs(spark):
    docs = spark.createDataFrame([(1, "so " + "la la li " * 5 + "end"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.periodic_runs(docs).collect()}
    assert got[1].runs == [(1, 15, 3)] and got[1].collapsed == "so la la li end" and got[1].n_words == 17
    assert got[2].runs == [] and got[2].collapsed == ""


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.periodic_runs(P.with_planted_runs(docs), digest=True).collect() == []


def test_long_repeats():
    words = [str(i).encode() for i in range(5000)] * 4
    ((own, stays),) = P.block_runs([words])
    assert own.tolist() == [[0, 20_000, 5000]] and stays.sum() == 5000
