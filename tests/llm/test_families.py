"""Families that share a template, so that all are nearly similar, with planted pairs that are."""

import random

import pytest

from corpusloom.llm import bag_minhash, fuzzy_lines


def line_family(pairs, others, rng):
    """Lines of one template: 0.757 similar to each other, and 0.827 to the other one of a pair."""
    some = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    template, out = some(104), []
    for _ in range(pairs):
        own = some(16)
        out += [template + own, template + own[:5] + some(11)]
    return out + [template + some(16) for _ in range(others)]


def text_family(pairs, others, rng):
    some = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    template, out = some(104), []
    for _ in range(pairs):
        own = some(16)
        out += [template + own, template + own[:5] + some(11)]
    return [" ".join(x) for x in [*out, *(template + some(16) for _ in range(others))]]


def grams(x, n):
    return {x[i : i + n] for i in range(len(x) - n + 1)}


def links(sets, least=0.8):
    """Pairs of an all-pairs comparison."""
    return {(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])}


@pytest.mark.parametrize("pairs, others", [(30, 170), (30, 770)])
def test_line_families(spark, pairs, others):
    lines = line_family(pairs, others, random.Random(others))
    assert links([grams(x, 5) for x in lines]) == {(2 * k + 1, 2 * k) for k in range(pairs)}
    got = fuzzy_lines.fuzzy_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    gone = {r.doc_id for r in got.filter("n_removed = 1").collect()}
    assert gone <= {2 * k + 1 for k in range(pairs)} and len(gone) >= 0.95 * pairs


def test_text_families(spark):
    pairs, others = 30, 770
    texts = text_family(pairs, others, random.Random(3))
    assert links([grams(tuple(x.split()), 5) for x in texts]) == {(2 * k + 1, 2 * k) for k in range(pairs)}
    got = bag_minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id for r in got if r.class_id != r.doc_id}
    assert found <= {2 * k + 1 for k in range(pairs)} and len(found) >= 0.95 * pairs
