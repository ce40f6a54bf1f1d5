"""Parts of the methods against enumeration: segmentations of the field, determinants of subsets, links of
a large family."""

import itertools
import math
import random

import numpy as np
import test_fuzzy_lines

from corpusloom.llm import pii_crf, quality_mcd


def segmentations(n, scores):
    if n == 0:
        return [([], 0.0)]
    return [([*s, (i, n, k)], w + v) for i in range(n) if (i, n) in scores for s, w in segmentations(i, scores) for k, v in enumerate(scores[i, n]) if v > -math.inf]


def test_field_equals_enumeration():
    rng = np.random.default_rng(3)
    for n in range(1, 6):
        scores = {(i, j): rng.normal(0, 2, len(pii_crf.KINDS)) for i in range(n) for j in range(i + 1, min(n, i + 3) + 1)}
        for (i, j), s in scores.items():
            if j - i > 1:
                s[0] = -math.inf
        every = segmentations(n, scores)
        z = np.logaddexp.reduce([w for _, w in every])
        got_z, posterior = pii_crf.Field.forward_backward(n, scores)
        assert abs(got_z - z) < 1e-9
        for (i, j), p in posterior.items():
            for k in range(len(pii_crf.KINDS)):
                assert abs(p[k] - sum(math.exp(w - z) for s, w in every if (i, j, k) in s)) < 1e-9
        assert pii_crf.Field.viterbi(n, scores) == max(every, key=lambda e: e[1])[0]


def test_secrets_are_told_by_what_stands_before_them():
    value = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"
    found = lambda text: [text[a:b] for a, b, k in pii_crf.field().spans(text, []) if k == "secret"]
    assert found(f'the house\ntoken = "{value}"\nand on') == [value] and found(f"password: {value}") == [value]
    assert found(f"commit {value} was merged") == [] and found(f"file {value[:8]} of {value[:16]}") == []


def test_core_is_the_subset_of_least_determinant(spark):
    rng = np.random.default_rng(7)
    p = quality_mcd.P
    rows = np.vstack([rng.normal(0, 1, (13, p)), rng.normal(9, 1, (3, p))])
    take = math.ceil(quality_mcd.CORE * len(rows))
    best = min(itertools.combinations(range(len(rows)), take), key=lambda s: np.linalg.slogdet(np.cov(rows[list(s)].T, bias=True))[1])
    assert len(set(best) & {13, 14, 15}) == 0
    frame = spark.createDataFrame([("en", "s", *map(float, r)) for r in rows], "lang string, source string, " + ", ".join(f"{x} double" for x in quality_mcd.FEATURES))
    params = quality_mcd.mcd(frame)
    far = sorted(r.d2 for r in quality_mcd._joined(frame, params).collect())
    assert far[12] < quality_mcd.chi2_quantile(quality_mcd.CUTOFF, p) * 2 < far[13]


def test_every_source_is_judged_by_itself(spark):
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 7)))
    rows = [(i, " ".join(word("abcdefgh") for _ in range(rng.randint(60, 150))), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, " ".join(word("ABCDEFGH") for _ in range(rng.randint(60, 150))), "en", "loud") for i in range(60)]
    rows += [(900, " ".join(word("ABCDEFGH") for _ in range(90)), "en", "s0")]
    got = {r.doc_id: r for r in quality_mcd.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(got[100 + i].kept for i in range(60)) >= 58  # upper case is usual in its own source alone
    assert got[900].distance > 2 * max(got[i].distance for i in range(0, 60, 4))


def test_a_family_of_near_lines(spark):
    """No line goes that brute force keeps; of those that go by it at most one in fifty is left."""
    rng = random.Random(14)
    base = "".join(test_fuzzy_lines.SCRIPTS["words"](rng) for _ in range(30)).strip()
    lines = [base]
    for _ in range(150):
        line = rng.choice(lines[:20])
        for _ in range(rng.randint(1, 5)):
            line = test_fuzzy_lines.edited(line, rng)
        lines.append(line)
    want, got = test_fuzzy_lines.brute_kept(lines), test_fuzzy_lines.kept(spark, lines)
    assert want <= got and len(got - want) <= (len(lines) - len(want)) / 50


def test_secrets_in_other_wordings():
    """Names that no training sentence has, and names that tell of something else."""
    rng = random.Random(77)
    value = lambda n=40: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    found = lambda text: [text[a:b] for a, b, k in pii_crf.field().spans(text, []) if k == "secret"]
    for form in ("aws_secret_access_key = {}", "GITHUB_TOKEN={}", "secret_key: {}", "passwort = {}", "my key is {}", "Authorization: bearer {}", "export DEPLOY_PASSWORD={}", "stripe-secret: {} and", "the token is {} now"):
        v = value()
        assert found("so " + form.format(v)) == [v], form
    for form in ("commit = {}", "sha256: {}", "the file {} is", "house = {}", "merge_commit: {}", "checksum={}", "page {}"):
        assert found("so " + form.format(value())) == [], form
    for n in (96, 119, 120, 121, 128):
        v = value(n)
        assert found(f'so token = "{v}" end') == [v], n
    v = "sk_live_" + value(24)
    assert found(f"use {v} here") == [v]
    assert pii_crf.field().spans("a1" * 50_000, []) == []
