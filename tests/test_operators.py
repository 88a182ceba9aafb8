"""Writes, trees, merges and incremental ingest on tiny tables."""

from __future__ import annotations

import sqlite3

import pytest

from palaver import schema
from palaver.operators import history, ids, ranges, sets, trees, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_keeps_other_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, name string, n long")
    new = spark.createDataFrame([(2, 20), (3, 30), (3, 31)], "id long, n long")
    assert rows(upsert.upsert(old, new, ["id"])) == [(1, "a", 1), (2, "b", 20), (3, None, 31)]
    assert rows(upsert.update(old, new, ["id"])) == [(1, "a", 1), (2, "b", 20)]


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([(1, 1)], "id long, n long")
    new = spark.createDataFrame([(1, 5), (2, 6)], "id long, n long")
    once = upsert.upsert(old, new, ["id"])
    assert rows(upsert.upsert(once, new, ["id"])) == rows(once)


def test_posts_are_dealt_before_they_are_sorted(spark, sf_dir, monkeypatch):
    from palaver import lens
    from palaver.operators import shared

    seen = []
    monkeypatch.setattr(lens, "_written", {})
    monkeypatch.setattr(shared, "materialized", lambda df, name, materialized=shared.materialized: seen.append(df) or materialized(df, name))
    posts = lens.posts(spark, sf_dir)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "Sort" not in below and "Aggregate" not in below
    assert posts.count() == posts.select("id").distinct().count() == lens.table(spark, sf_dir, "post_rows").select("id").distinct().count()


def test_number_rows_is_a_total_order(spark):
    df = spark.range(1000).selectExpr("1000 - id as v")
    assert rows(upsert.number_rows(df, ["v"], "n")) == [(i, i) for i in sorted(range(1, 1001), key=repr)] or {r["v"]: r["n"] for r in upsert.number_rows(df, ["v"], "n").collect()} == {i: i for i in range(1, 1001)}


def test_ranges_of_numbers_follow_the_rows(spark):
    df = spark.range(3000).selectExpr("nullif(id * 7919 % 1009, 5) as v", "id")
    many = upsert.number_rows(df, ["v", "id"], "n", most=10)
    assert "__p" not in many.columns
    want = sorted(((i * 7919 % 1009, i) for i in range(3000)), key=lambda r: (r[0] != 5, r))
    assert [r["n"] for r in many.orderBy("n").collect()] == list(range(1, 3001))
    assert [r["id"] for r in many.orderBy("n").collect()] == [i for _, i in want]


def test_cuts_up_to_a_value(spark):
    from bisect import bisect_right

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    for cuts in ([], [3], [3, 4], list(range(0, 90, 3))):
        found = spark.range(100).select("id", upsert._cuts_up_to(F.col("id"), cuts, T.LongType()).alias("n")).collect()
        assert [r["n"] for r in found] == [bisect_right(cuts, r["id"]) for r in found]


def test_posts_are_linked_with_two_sorts(spark):
    from palaver.operators.members import link_posts

    schema = "id long, topic_id long, posted_at timestamp_ntz, author long"
    found = link_posts(spark.createDataFrame([], schema), spark.createDataFrame([], schema))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(" Sort [") <= 2 and plan.count("Window [") >= 3


def test_ids_are_stable(spark):
    found = spark.createDataFrame([("x", 5), ("y", 9), ("z", 9)], "url string, uses long")
    known = spark.createDataFrame([("x", 3)], "url string, id long")
    first = ids.assign_ids(known, found, "url", [found.uses.desc(), "url"])
    assert {r["url"]: r["id"] for r in first.collect()} == {"x": 3, "y": 4, "z": 5}
    again = ids.assign_ids(first.select("url", "id"), found, "url", [found.uses.desc(), "url"])
    assert {r["url"]: r["id"] for r in again.collect()} == {"x": 3, "y": 4, "z": 5}


def test_evolve_renames_adds_and_drops(spark):
    old = spark.createDataFrame([(1, "upload", "u", 7)], "id int, kind string, url string, old_member_id int")
    new = schema.evolve(old, schema.TABLES["attachments"])
    assert new.columns == [n for n, _ in schema.TABLES["attachments"].columns]
    row = new.first()
    assert (row["id"], row["old_forum_id"], row["data"]) == (1, 7, None)
    assert "NOT NULL" in schema.TABLES["posts"].ddl()


def test_tree_totals_and_cycles(spark):
    forums = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (8, 9, "x"), (9, 8, "y")], "id long, parent_id long, name string")
    counts = spark.createDataFrame([(1, 1, 10), (2, 2, None), (3, 4, 30)], "id long, topics long, posts long")
    got = {r["id"]: (r["topics"], r["posts"]) for r in trees.subtree_totals(forums, counts, {"topics": "sum", "posts": "absorb"}).collect()}
    assert got == {1: (7, None), 2: (6, None), 3: (4, 30)}
    assert {r["id"]: r["crumbs"] for r in trees.crumbs(forums).collect()}[3] == "a > b > c"


def test_nested_answers_flatten(spark):
    tree = '{"id":1,"name":"a","child":["{\\"id\\":2,\\"name\\":\\"b\\",\\"child\\":[]}"]}'
    df = spark.createDataFrame([(tree,)], "tree string")
    assert rows(trees.flatten_tree(spark, df)) == [(1, None, "a"), (2, 1, "b")]


def test_six_counts(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(2,), (3,)], "k long")
    assert tuple(sets.six_counts(a, b, "k", "x").first()) == ("x", 3, 2, 2, 1, 1, 1)


def test_asof_windows_agree(spark):
    known = spark.createDataFrame([(i, f"2020-01-01 00:{i % 60:02d}:00") for i in range(0, 60, 7)], "id long, t string").selectExpr("id", "to_timestamp_ntz(t) ts")
    points = spark.range(0, 70, 3)
    a = rows(ranges.asof_window(points, known))
    assert a == rows(ranges.asof_by_blocks(points, known, width=8))


def test_history(spark):
    c = spark.createDataFrame([("f", 1, "x"), ("f", 2, "x"), ("f", 3, "y"), ("f", 4, "x")], "f string, t long, d string")
    assert rows(history.collapse_runs(c, ["f"], ["t"], "d")) == [("f", 1, "x"), ("f", 3, "y"), ("f", 4, "x")]
    assert rows(history.latest(c, ["f"], "t")) == [("f", 4, "x")]
    folded = history.ordered_fold(c, "f", ["t"], "f string, d string", lambda g: g.tail(1)[["f", "d"]])
    assert rows(folded) == [("f", "x")]


def test_sqlite_source(spark, tmp_path):
    from palaver.sources.sqlite import read_table

    path = str(tmp_path / "board.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE topics (id INTEGER PRIMARY KEY, forum_id INTEGER, name TEXT, stickied INTEGER, locked INTEGER, created_at TEXT)")
        db.executemany("INSERT INTO topics VALUES (?,?,?,?,?,?)", [(i, 1, f"t{i}", i % 2, 0, "2009-01-14 04:12:07") for i in range(1, 21)])
    df = read_table(spark, path, "topics", parts=3)
    assert df.count() == 20 and df.filter("stickied").count() == 10
    assert str(df.first()["created_at"]) == "2009-01-14 04:12:07"


def test_dumps_merge(spark, tmp_path):
    from palaver.sources.dumps import merge_dumps, oldest_first, read_flat, read_snapshots

    flat, snaps = tmp_path / "flat", tmp_path / "snaps" / "20080101000000"
    flat.mkdir()
    snaps.mkdir(parents=True)
    (flat / "t1.html").write_bytes(b"same")
    (flat / "t2.html").write_bytes(b"other one")
    (snaps / "t1.html").write_bytes(b"same")
    merged = merge_dumps([read_flat(spark, str(flat)), read_snapshots(spark, str(tmp_path / "snaps"))])
    assert sorted((r["file_id"], r["source"]) for r in merged.collect()) == [("t1.html", "snapshots"), ("t2.html", "flat")]
    assert oldest_first(merged).filter("place = 1").count() == 2


def test_stream_merges_once(spark, tmp_path):
    from palaver.streaming.incremental import VersionedTable, merge_flags, merge_stream

    kind = "id long, pinned boolean, question boolean"
    table = VersionedTable(spark, str(tmp_path / "flags"), kind)
    inbox = str(tmp_path / "in")
    for batch in ([(1, False, None), (2, True, False)], [(1, True, None)]):
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").json(inbox)
        merge_stream(spark.readStream.schema(kind).json(inbox), table, merge_flags, str(tmp_path / "cp")).awaitTermination()
    want = [(1, True, None), (2, True, False)]
    assert rows(table.read()) == want
    merge_stream(spark.readStream.schema(kind).json(inbox), table, merge_flags, str(tmp_path / "cp")).awaitTermination()
    assert rows(table.read()) == want


def test_reports(spark):
    from palaver.sources import sinks

    df = spark.createDataFrame([("a|b", 1234), ("c", None)], "x string, n long")
    assert "1,234" in sinks.as_text(df) and "a\\|b" in sinks.as_markdown(df) and "<td>c</td>" in sinks.as_html(df)


def test_recorded_answers(spark, tmp_path):
    from palaver.sources.recorded import read_posts, read_topics

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.json").write_text('{"forum_id":1,"mode":1,"page":0,"topics":[{"topic_id":5,"real_topic_id":0,"forum_id":1,"reply_number":3,"view_number":9},{"topic_id":6,"forum_id":2}]}\n{"forum_id":1,"mode":0,"page":0,"topics":[{"topic_id":5,"forum_id":1,"total_post_num":9},{"topic_id":7,"forum_id":1,"is_moved":true}]}\n')
    got = read_topics(spark, str(tmp_path / "t")).collect()
    assert [(r["id"], r["post_count"]) for r in got] == [(5, 9)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('{"topic_id":5,"start":50,"posts":[{"post_id":1,"timestamp":"0"},{"post_id":2,"position":99,"timestamp":"1100000000"}]}\n')
    assert sorted((r["id"], r["post_index"], r["posted_at"] is None) for r in read_posts(spark, str(tmp_path / "p")).collect()) == [(1, 51, True), (2, 99, False)]


def test_unknown_table_is_refused():
    with pytest.raises(ValueError):
        schema.register(schema.TABLES["posts"])


def test_quotes_split_or_are_refused(spark):
    from palaver.sources.recorded import split_quotes

    text = "[quote=a]one[/quote]\n\n[quote=b]two [quote]x[/quote][/quote]"
    df = spark.createDataFrame([([1, 2], text), ([3, 4, 5], text)], "ids array<long>, text string")
    assert rows(split_quotes(df)) == [(1, "one"), (2, "two [quote]x[/quote]")]


def test_members_of_pages(spark, tmp_path):
    from palaver.sources.recorded import read_members

    (tmp_path / "m.json").write_text('{"page":0,"members":{"0":{"user_id":4,"username":"Al"},"1":{"user_id":0,"username":"guest"}}}\n{"page":1,"members":{"0":{"user_id":4,"username":"Al B"}}}\n')
    assert rows(read_members(spark, str(tmp_path)).select("id", "name")) == [(4, "Al B")]


def test_archive_addresses(spark, sf_dir, tmp_path):
    from palaver.sources.archive import open_archive, register_views

    spark.createDataFrame([(1, "a")], "id long, name string").write.parquet(str(tmp_path / "groups.parquet"))
    assert rows(open_archive(spark, str(tmp_path))("groups")) == [(1, "a")]
    assert register_views(spark, str(tmp_path), ["groups"]) == ["groups"]
    assert spark.sql("SELECT count(*) FROM groups").first()[0] == 1


def test_image_outcomes(spark):
    from palaver.operators import images

    tries = spark.createDataFrame([("h", i, ok) for i, ok in enumerate([False, False, True, False, False, False, False])], "host string, tried int, ok boolean")
    assert rows(images.dead_hosts(tries)) == [("h", 5)]


def test_files_are_written_once(spark, tmp_path):
    from palaver.sources.files import write_files

    df = spark.createDataFrame([("a/x.html", "hi"), ("b.html", "é")], "name string, data string")
    for _ in range(2):
        write_files(df, str(tmp_path))
    assert (tmp_path / "a" / "x.html").read_text() == "hi" and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b.html"]


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    from pyspark.sql import functions as F

    from palaver.sources.files import write_files

    (tmp_path / "0.html").write_text("before")
    df = spark.range(0, 40, 1, 4).select(F.concat(F.col("id").cast("string"), F.lit(".html")).alias("name"), F.when(F.col("id") < 39, "new").otherwise(F.raise_error(F.lit("lost"))).alias("data"))
    with pytest.raises(Exception, match="lost"):
        write_files(df, str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["0.html"] and (tmp_path / "0.html").read_text() == "before"
    write_files(df.filter("name <> '39.html'"), str(tmp_path))
    assert len(list(tmp_path.iterdir())) == 39 and (tmp_path / "0.html").read_text() == "new"


def test_nearest_marks_are_running_windows(spark, capsys):
    """No frame runs from each row to the end, which Spark reads again for every row."""
    points = spark.range(0, 40).filter("id % 5 <> 0")
    known = spark.sql("select id, timestampadd(DAY, id, timestamp_ntz'2020-01-01') as ts from range(40) where id in (3, 17, 18, 31)")
    for found in (ranges.asof_by_blocks(points, known, width=4), ranges.asof_window(points, known)):
        found.explain()
        plan = capsys.readouterr().out
        assert "Window" in plan and "unboundedfollowing" not in plan
        days = {r["id"]: (r["low"] and r["low"].timetuple().tm_yday - 1, r["high"] and r["high"].timetuple().tm_yday - 1) for r in found.collect()}
        assert days[2] == days[3] == days[32] == (None, None)
        assert days[4] == days[17] == (3, 17) and days[18] == (17, 18) and days[19] == days[31] == (18, 31)
