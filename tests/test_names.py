"""Names alike by a ratio against all pairs."""

from __future__ import annotations

import difflib
import random

import pytest

from palaver.operators import names


@pytest.mark.parametrize("least", [0.85, 0.8])
def test_no_pair_is_lost(spark, least):
    rng = random.Random(1)
    words = {"hahahahahaha", "ahahahahahah", "xaaaaaaaa", "aaaaaaaa", "aaa", "aaaa", "abc", "abcd", "aba", "", "a", "ab", "éèéèéè", "éèéèé", "lo" * 60, "lo" * 59 + "x"}
    for _ in range(80):
        w = "".join(rng.choice("ab") if rng.random() < 0.5 else rng.choice("abcde") for _ in range(rng.randint(3, 14)))
        words.add(w)
        cut = rng.randrange(len(w))
        words |= {w[:cut] + w[cut + 1 :], w[:cut] + rng.choice("abxyz") + w[cut:], w[cut:] + w[:cut]}
    words = sorted(words)
    a, b = words[::2] + words[:40], words[1::2] + words[:30]
    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    want = {(x, y) for x in a for y in b if x != y and min(len(x), len(y)) >= 3 and ratio(x, y) >= least}
    frames = spark.createDataFrame([(x,) for x in a], "__a string").distinct(), spark.createDataFrame([(y,) for y in b], "__b string").distinct()
    got = [tuple(r) for r in names.alike(*frames, least).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 40


def test_low_ratios_are_an_error(spark):
    with pytest.raises(ValueError, match="0.8"):
        names.alike(spark.createDataFrame([("abc",)], "__a string"), spark.createDataFrame([("abd",)], "__b string"), 0.7)


def test_the_named_pairs(spark):
    a = spark.createDataFrame([("hahahahahaha",), ("xaaaaaaaa",)], "key string")
    b = spark.createDataFrame([("ahahahahahah",), ("aaaaaaaa",)], "key string")
    got = {(r["__a"], r["__b"], r["score"]) for r in names.name_pairs(a, b, 0.85).collect()}
    assert got == {("hahahahahaha", "ahahahahahah", 1), ("xaaaaaaaa", "aaaaaaaa", 1)}


def test_unlike_names_hardly_meet(spark):
    """Of 4 million pairs of names over sixteen letters only those come up that nearly are alike."""
    rng = random.Random(2)
    known = ["".join(rng.choice("0123456789abcdef") for _ in range(14)) for _ in range(2000)]
    asked = [w[:4] + w[5:] if i % 3 == 0 else w[:6] + "zzz" + w[6:] if i % 3 == 1 else "x" + w[1:7] + "y" + w[8:] for i, w in enumerate(known)]
    frames = spark.createDataFrame([(x,) for x in asked], "__a string"), spark.createDataFrame([(y,) for y in known], "__b string")
    met = {tuple(r) for r in names.may_be_alike(*frames, 0.85).collect()}
    assert met >= set(zip(asked, known, strict=True)) and len(met) < 2 * len(known)
