"""Late data in any order of batches against a fold over all of it."""

from __future__ import annotations

import datetime as dt
import random
import re
import tempfile
from pathlib import Path

from palaver.streaming import late

KIND = "post_id long, captured_at timestamp_ntz, file string, edited_at timestamp_ntz, html string, filtered boolean, lossy boolean, topic_id long, forum_id long"
DAY = dt.datetime(2010, 1, 1)


def lossy_form(html):
    return re.sub(r"""\b(href|src|action)=(?:"[^"]*"|'[^']*')""", r"\1=", html.encode("ascii", "ignore").decode())


def copies_of(seed, n=160):
    rng = random.Random(seed)
    texts = ['<a href="/1">café</a>', '<a href="/2">caf</a>', "<p>other</p>", "<p>öther</p>", "<p>ther</p>", "", None]
    rows = []
    for i in range(n):
        day = rng.choice([None, *range(12)])
        rows.append((rng.randrange(12), None if day is None else DAY + dt.timedelta(days=day), f"f{i:03}", rng.choice([None, None, DAY, DAY + dt.timedelta(1)]), rng.choice(texts), rng.random() < 0.3, rng.random() < 0.5, rng.choice([None, 1, 2]), rng.choice([None, 7])))
    return rows


def folded(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or DAY, r[2])):
        post, _, _, stamp, html, filtered, lossy, topic, forum = r
        if not html:
            continue
        if post not in out:
            out[post] = {"html": html, "stamp": stamp, "lossy": lossy, "topic": topic, "forum": forum, "edited": False}
            continue
        k = out[post]
        k["topic"], k["forum"] = topic or k["topic"], forum or k["forum"]
        if stamp is not None and (k["stamp"] is None or stamp > k["stamp"]):
            k.update(html=html, stamp=stamp, lossy=lossy, edited=True)
        elif stamp == k["stamp"] and html != k["html"] and not filtered and ((k["lossy"] and not lossy) or not (lossy and lossy_form(html) == lossy_form(k["html"]))):
            k.update(html=html, lossy=lossy)
    return {p: (k["html"], k["stamp"], k["topic"], k["forum"], k["edited"]) for p, k in out.items()}


def test_copies_equal_a_fold(spark):
    for seed in range(4):
        rows = copies_of(seed)
        got = {r["post_id"]: tuple(r)[1:] for r in late.kept_posts(spark.createDataFrame(rows, KIND)).collect()}
        assert got == folded(rows)


def test_any_order_of_batches(spark):
    rows = copies_of(9, 80)
    rng = random.Random(4)
    for trial in range(2):
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        log = late.KeyedLog(spark, f"{folder}/log", KIND, "post_id", 8)
        kept = late.KeyedLog(spark, f"{folder}/kept", late.kept_posts(spark.createDataFrame([], KIND)).schema, "post_id", 8)
        assert kept.latest().count() == 0
        dealt = [[], [], []]
        for r in rows:
            dealt[rng.randrange(3)].append(r)
        for number, part in [(1, dealt[0]), (2, dealt[1]), (1, dealt[0]), (3, dealt[2])][trial:]:
            late.apply_batch(log, kept, spark.createDataFrame(part, KIND), number, late.kept_posts)
        want = folded([r for d in dealt for r in d])
        assert {r["post_id"]: tuple(r)[1:] for r in kept.latest().collect()} == want
        kept.compact()
        assert kept.batches() == [3] and {r["post_id"]: tuple(r)[1:] for r in kept.latest().collect()} == want


def test_what_is_written_follows_the_batch(spark):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    log = late.KeyedLog(spark, f"{folder}/log", "k long, v long", "k", 8)
    sums = late.KeyedLog(spark, f"{folder}/sums", "k long, v long", "k", 8)
    add = lambda rows: rows.groupBy("k").agg({"v": "sum"}).toDF("k", "v")
    late.apply_batch(log, sums, spark.range(5000).selectExpr("id as k", "1L as v"), 1, add)
    late.apply_batch(log, sums, spark.createDataFrame([(3, 5), (4, 6)], "k long, v long"), 2, add)
    rows = lambda n: spark.read.parquet(f"{folder}/sums/batch={n}").count()
    assert (rows(1), rows(2)) == (5000, 2)
    got = {r["k"]: r["v"] for r in sums.latest().filter("k < 6").collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 6, 4: 7, 5: 1}
    sums.write(sums.latest("seen"), 2, "compacted")  # as a compaction that was cut short leaves it
    assert sums.batches() == [2] and sums.latest().count() == 5000 and not Path(f"{folder}/sums/compacted=2").exists()


def test_a_stream_of_files(spark):
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    rows = copies_of(5, 40)
    log = late.KeyedLog(spark, f"{folder}/log", KIND, "post_id", 4)
    kept = late.KeyedLog(spark, f"{folder}/kept", late.kept_posts(spark.createDataFrame([], KIND)).schema, "post_id", 4)
    frame = spark.createDataFrame([], KIND)
    for part in (rows[20:], rows[:20]):
        spark.createDataFrame(part, KIND).write.mode("append").parquet(f"{folder}/in")
        late.follow(spark.readStream.schema(frame.schema).parquet(f"{folder}/in"), log, kept, late.kept_posts, f"{folder}/checkpoint").awaitTermination()
    assert {r["post_id"]: tuple(r)[1:] for r in kept.latest().collect()} == folded(rows)


def test_members(spark):
    kind = "member_id long, captured_at timestamp_ntz, posted_at timestamp_ntz, file string, filtered boolean, lossy boolean, profile boolean, name string, signature string, group_name string, location string"
    at = lambda d: DAY + dt.timedelta(days=d)
    rows = [
        (1, at(3), at(1), "a", False, False, False, "Al", None, "Members", "here"),
        (1, at(9), at(0), "b", False, False, False, "Al2", None, "Admins", ""),
        (1, None, at(8), "c", False, False, False, "", None, "Guests", "there"),
        (1, at(1), None, "d", False, False, True, "Al", "from profile", None, None),
        (2, at(1), at(1), "a", False, False, False, "Bo", "sig", "Members", None),
        (2, at(5), None, "e", False, False, True, "Bo", "profile sig", "Members", None),
    ]
    got = {r["member_id"]: r for r in late.members_from(spark.createDataFrame(rows, kind), ["group_name", "location"]).collect()}
    assert (got[1]["name"], got[1]["group_name"], got[1]["location"], got[1]["signature"]) == ("Al", "Admins", "here", "from profile")
    assert (got[2]["signature"], got[2]["location"]) == ("sig", None)


def test_only_copies_of_the_latest_edit_are_put_in_order(spark):
    schema = "post_id long, captured_at timestamp, file string, edited_at long, html string, filtered boolean, lossy boolean, topic_id long, forum_id long"
    found = late.kept_posts(spark.createDataFrame([(1, None, "a", None, "x", False, False, 1, 2), (1, None, "b", 3, "y", False, False, None, 4)], schema))
    plan = found._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Sort [") :].partition("]")[0]
    assert "post_id" in first and "at#" not in first  # all copies by post alone
    assert [tuple(r) for r in found.collect()] == [(1, "y", 3, 1, 4, True)]


def test_a_batch_reads_its_part_of_the_copies_alone(spark, sf_dir, monkeypatch):
    from palaver.plans import QUERIES
    from palaver.plans import late as plans

    by = []
    monkeypatch.setattr(plans, "materialized", lambda df, name, *columns, materialized=plans.materialized: by.append(columns) or materialized(df, name, *columns))
    assert QUERIES["l12_merged_posts"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey").distinct().count()
    assert by == [("part",)]
