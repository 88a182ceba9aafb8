"""Choices in order against deciding row after row."""

from __future__ import annotations

import random

from palaver.operators import assignment


def test_one_after_another(spark):
    rng = random.Random(2)
    pairs = [(r, c, r % 3) for r in range(60) for c in rng.sample(range(r % 3 * 30, r % 3 * 30 + 30), rng.choice([1, 1, 2, 3]))]
    want, taken = {}, set()
    for r in range(60):
        free = [c for x, c, _ in pairs if x == r and c not in taken]
        if len(free) == 1:
            want[r] = free[0]
            taken.add(free[0])
    frame = spark.createDataFrame(pairs, "row long, candidate long, topic_id long")
    assert {r["row"]: r["candidate"] for r in assignment.choose_in_order(frame, assignment.only_candidate).collect()} == want
    assert assignment.choose_in_order(frame.limit(0), assignment.only_candidate).count() == 0


def test_ties(spark):
    rows = spark.createDataFrame([(1, "5", "file"), (2, "9", "file"), (3, "/attach/ma/post-1-1234567890.jpg", "image"), (4, "x", "file"), (5, None, "image")], "post_id long, ref string, kind string")
    url = "http://2.forumer.com/uploads/metanet/post-1-1234567890.jpg"
    files = spark.createDataFrame([(10, url, None, "upload", None), (11, "http://h/i?id=9", 9, "attach-id", "d"), (12, "http://h/i?id=9&b", 9, "attach-id", None), (13, "http://h/i?id=1", 1, "attach-id", "d")], "id long, url string, old_attach_id long, kind string, data string")
    blocks = spark.createDataFrame([(1, url)], "post_id long, url string")
    got = {r["post_id"]: r["attachment_id"] for r in assignment.tie_attachments(rows, files, blocks).collect()}
    assert got == {1: 10, 2: 11, 3: 10, 4: None, 5: None}
    assert [tuple(r) for r in assignment.pair_attachments(files, blocks).collect()] == [(13, 10, 13, 10)]


def test_addresses_of_uploads_are_read_on_all_cores(spark, sf_dir):
    from palaver.plans.assigning import _files
    from palaver.plans.registry import Board

    _, blocks = _files(Board(spark, sf_dir))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "transform" not in plan[plan.rindex("Exchange") :]  # parts are dealt before their addresses are read
    number = spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_size % 2 = 0").select("p_partkey").collect()
    assert rows_of(blocks) == sorted((k % 50, f"http://2.forumer.com/uploads/metanet/post-{k % 30}-{1_100_000_000 + k}.jpg") for (k,) in number)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
