"""The prefix trie against a plain walk over dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from palaver.llm import prefix_trie

KIND = "conv_id long, turn long, role string, text string, key string, `Text` long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {c: own.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in own.items()}
    members = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    out = []
    for node, m in members.items():
        under = [n for n in members if n[: len(node)] == node]
        children = [n for n in under if len(n) == len(node) + 1]
        leaves = [n for n in under if not any(len(x) == len(n) + 1 and x[: len(n)] == n for x in under)]
        saved = sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in under if n)
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed=1):
    rng = random.Random(seed)
    say = ["hello there", "hello  there", "", "what is this?", "a b\tc\nd", "x" * 300, "Grüße aus dem Süden"]
    rows = []
    for c in [*range(70), 200, 201, 205, 400]:
        for turn in range(rng.choice([1, 2, 3, 5])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(say), "k", 1))
    rows += [(c, t, "user", "common start" if t == 0 else f"then {t}", None, 2) for c in range(300, 380) for t in range(3)]
    rows += [(7, t, "user", f"on and on {t}", "k", 3) for t in range(20, 200)]  # one long conversation
    rows += [(5, None, None, None, None, None), (5, None, "user", None, None, None), (None, 0, "user", "lost", None, None), (9, 0, "user", "again", None, None), (9, 0, "user", "again", None, None)]
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_equals_a_plain_walk(spark, partitions):
    rows = rows_of()
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mine = prefix_trie.trie_report(spark.createDataFrame(rows, KIND)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sorted(map(tuple, mine), key=repr) == brute(rows)


def test_ends_of_one_node_over_many_runs(spark, monkeypatch):
    rows = [(c, 0, "user", "same words", None, None) for c in range(0, 4000 * 20, 20)]
    got = {tuple(r)[:2]: tuple(r) for r in prefix_trie.trie_report(spark.createDataFrame(rows, KIND).repartition(7)).collect()}
    ends = ",".join(str(c) for c in range(0, 4000 * 20, 20))
    assert got[0, 1][3:] == (4000, 0, 1, 3999 * 2, hashlib.sha256(ends.encode()).hexdigest())


def test_small_partial_tries(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FOLD", 8)
    rows = rows_of(2)[:200]
    assert sorted(map(tuple, prefix_trie.trie_report(spark.createDataFrame(rows, KIND)).collect()), key=repr) == brute(rows)


def test_empty_and_other_ids(spark):
    assert prefix_trie.trie_report(spark.createDataFrame([], KIND)).count() == 0
    rows = [(str(c), 0, "user", f"hello {c % 2}") for c in range(5)] + [("x", 0, "user", "no number")]
    mine = prefix_trie.trie_report(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert sorted(map(tuple, mine.collect()), key=repr) == brute([(int(r[0]), *r[1:]) for r in rows[:5]])
