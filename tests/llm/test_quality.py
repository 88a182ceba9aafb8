"""Quality rules against plain Python: base counts, Kneser-Ney probabilities, bands and verdicts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from palaver.llm import quality_rules
from palaver.llm.blocks import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def rows_of(seed=5):
    rng = random.Random(seed)
    alphabets = {"en": "etaoinshrd", "ru": "оеаинтсрвл", "zh": "的一是不了人我在有他这中大来上", None: "xyz#é$"}
    out = []
    for i in range(120):
        lang = list(alphabets)[i % 4]
        letters = alphabets[lang]
        words = ["".join(rng.choice(letters[: rng.randint(2, len(letters))]) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(8, 60))]
        text = " ".join(words)
        if i % 5 == 0:
            text = text[:20] + "\n" + text[:20] + "\n \n" + text
        if i % 7 == 0:
            text += " " + " ".join(words[:30])
        out.append((i, text, lang, "s", 0, "e"))
    out += [(200, "的" * 400 + " word" * 12, "zh", "s", 0, "e"), (201, None, "en", None, None, None), (202, "", None, "s", 0, ""), (203, "😀 \U0001f600 ab" * 20, "en", "s", 0, ""), out[3]]
    out.append((204, "alone " + " ".join(f"w{i}" for i in range(30)), "only", "s", 0, ""))
    return out


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3).cache()


def base(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def grams(text):
    raw = text.encode("utf-16-le")
    unit = [0, 0, 0, *(raw[i] | raw[i + 1] << 8 for i in range(0, len(raw), 2))]
    return [tuple(unit[i - 3 : i + 1]) for i in range(3, len(unit))]


class Model:
    """Modified Kneser-Ney with dictionaries."""

    def __init__(self, texts):
        level = Counter(g for t in texts for g in grams(t))
        self.levels = [level]
        for _ in range(3):
            level = Counter(g[1:] for g in level)
            self.levels.insert(0, level)
        self.d, self.total, self.left = [], [], []
        for level in self.levels:
            n = Counter(level.values())
            if min(n[i] for i in range(1, 5)):
                y = n[1] / (n[1] + 2 * n[2])
                d = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i) for i in (1, 2, 3)]
            else:
                d = [0.5, 0.75, 0.9]
            total, taken = defaultdict(int), defaultdict(float)
            for g, c in level.items():
                total[g[:-1]] += c
                taken[g[:-1]] += d[min(c, 3) - 1]
            self.d.append(d)
            self.total.append(total)
            self.left.append(taken)

    def p(self, g):
        if not g:
            return 1 / 65536
        k = len(g) - 1
        total = self.total[k].get(g[:-1], 0)
        if not total:
            return self.p(g[1:])
        c = self.levels[k].get(g, 0)
        kept = (c - self.d[k][min(c, 3) - 1]) / total if c else 0
        return kept + self.left[k][g[:-1]] / total * self.p(g[1:])


def test_base_counts_model_bands_and_verdicts(docs, rows):
    judged = quality_rules.judge(docs).collect()
    assert len(judged) == len(rows)
    text = {r[0]: r[1] or "" for r in rows}
    lang = {r[0]: r[2] for r in rows}
    models = {x: Model([r[1] or "" for r in rows if r[2] == x]) for x in set(lang.values())}
    bits = {}
    for i, t in text.items():
        own = grams(t)
        bits[i] = -sum(math.log2(models[lang[i]].p(g)) for g in own) / max(1, len(own))
    good = defaultdict(list)
    for r in judged:
        i = r["doc_id"]
        want = base(text[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert math.isclose(r["bits"], bits[i], rel_tol=1e-5, abs_tol=1e-6)
        if not r["base_failed"]:
            good[lang[i]].append(r["bits"])
    for r in judged:
        if not r["base_failed"]:
            values = np.sort(good[lang[r["doc_id"]]])
            q = [values[max(0, math.ceil(p * len(values)) - 1)] for p in (0.25, 0.5, 0.75)]
            reach = 6 * max((q[2] - q[0]) / 1.349, 0.02) * math.sqrt(1 + 400 / max(r["n_units"], 1))
            assert math.isclose(r["low"], q[1] - reach, rel_tol=1e-9) and math.isclose(r["high"], q[1] + reach, rel_tol=1e-9)
            assert r["kept"] == (r["low"] <= r["bits"] <= r["high"])
        else:
            assert not r["kept"]
    assert 60 < sum(r["kept"] for r in judged) < len(rows)


def test_probabilities_sum_to_one(spark, docs, rows):
    model = Model([r[1] or "" for r in rows if r[2] == "ru"])
    context = next(iter(model.levels[3]))[:3]
    seen = {g[-1] for level in model.levels for g in level}
    assert math.isclose(sum(model.p((*context, u)) for u in seen) + (65536 - len(seen)) * model.p((*context, 1)), 1, rel_tol=1e-9)


def test_parts_score_as_the_broadcast_model(docs):
    key = ("doc_id", "text_id", "lang", "n_words", "n_units")
    one = Counter((*(r[k] for k in key), round(r["bits"], 9)) for r in quality_rules.score(docs).collect())
    parts = Counter((*(r[k] for k in key), round(r["bits"], 9)) for r in quality_rules.score(docs, broadcast_mb=0, part_bytes=3_000).collect())
    assert one == parts


def test_scripts_without_case_are_told_apart(spark):
    rng = random.Random(3)
    hanzi = [chr(0x4E00 + i) for i in range(300)]
    pairs = [rng.choice(hanzi) + rng.choice(hanzi) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(pairs) for _ in range(200)), "zh") for i in range(60)]
    rows.append((99, " ".join(rng.choice(hanzi) + rng.choice(hanzi) for _ in range(200)), "zh"))
    out = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not out.pop(99) and all(out.values())


def test_regular_lines_are_compared_exactly():
    for n in (256, 512, 1024, 2048, 4096):
        x = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
        y = x.translate(str.maketrans("ab", "ba"))
        for b in blocks(pa.array([x + "\n" + y, x + "\n" + x, " ".join([x, y] * 5)])):
            counts = quality_rules.base_counts(b)
            assert counts["n_dup_lines"].tolist() == [0, 1, 0]
            assert counts["n_repeat_words"].tolist() == [0, 0, 10]


def test_empty_table_and_clashing_names(spark, docs, rows):
    empty = spark.createDataFrame([], KIND)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.judge(empty.select("doc_id", "text", "lang")).count() == 0
    clash = docs.withColumnRenamed("extra", "Text").withColumnRenamed("source", "band").withColumnRenamed("n_chars", "kept_doc")
    kept = quality_rules.quality_filter(clash)
    assert kept.columns == clash.columns
    assert kept.count() == quality_rules.quality_filter(docs).count() == sum(r["kept"] for r in quality_rules.judge(docs).collect())
