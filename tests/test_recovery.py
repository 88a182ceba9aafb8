"""Choices among archived copies."""

from __future__ import annotations

import datetime as dt

from palaver.operators import recovery


def day(n):
    return dt.datetime(2010, 1, 1) + dt.timedelta(days=n)


def test_avatars_prefer_the_file_that_was_shown(spark):
    members = spark.createDataFrame([(1, "https://h/av-1.gif"), (2, None), (3, "http://h/x.png")], "member_id long, avatar_url string")
    captures = spark.createDataFrame(
        [(1, "http://H:80/AV-1.gif?2", day(1), "a", True), (1, "http://h/av-1.jpg", day(9), "b", True), (1, "http://h/av-1.gif", day(5), "c", False), (2, "http://h/o.gif", day(2), "d", True), (2, "http://h/p.gif", day(3), "e", True), (3, "http://h/x.png", day(1), "f", False)],
        "member_id long, original string, at timestamp_ntz, archived string, image boolean",
    )
    got = {r["member_id"]: r["archived"] for r in recovery.best_avatars(members, captures).collect()}
    assert got == {1: "a", 2: "e"}


def test_files_of_numbers(spark):
    missing = spark.createDataFrame([(50, day(3)), (51, day(30)), (52, day(31))], "upload_id long, posted_at timestamp_ntz")
    gaps = spark.createDataFrame([(1, day(2), day(4)), (2, day(29), day(32)), (3, day(3), day(3))], "attach_id long, low timestamp_ntz, high timestamp_ntz")
    guesses = {r["attach_id"]: r["upload_id"] for r in recovery.guessed_uploads(gaps, missing).collect()}
    assert guesses == {1: 50, 3: 50}
    numbers = spark.createDataFrame([(1, 50, "u.gif", True), (2, 51, "u.gif", False), (3, 50, "u.gif", True), (4, None, None, False), (5, 77, "z.gif", False)], "attach_id long, upload_id long, upload_name string, guessed boolean")
    captures = spark.createDataFrame(
        [(1, day(1), "a", "n.GIF", True), (2, day(1), "b0", "x.gif", False), (2, day(2), "b", None, True), (3, day(1), "c", "n.jpg", True), (4, day(1), "d", "f.txt", True), (5, day(1), "e", "z.gif", True)]
        + [(6, day(n), f"g{n}", "z.gif", n == 4) for n in range(5)],
        "attach_id long, at timestamp_ntz, archived string, file_name string, valid boolean",
    )
    rows = spark.createDataFrame([(50, None), (51, None), (60, 2), (61, 4), (62, 6)], "id long, old_attach_id long")
    got = sorted(tuple(r) for r in recovery.recovered_files(numbers, captures, rows).fillna(0, ["target"]).collect())
    assert got == [
        (1, 50, "a", "recovered by time"), (2, 51, "b", "recovered"), (2, 60, "b", "recovered"), (3, 0, None, "guess not confirmed"),
        (4, 61, "d", "recovered"), (5, 0, None, "nothing missing"), (6, 0, None, "archived copies aren't the file"),
    ]


def test_manifests(spark):
    from pyspark.sql import functions as F

    from palaver.sources import dumps

    snapshots = spark.createDataFrame([("1", "a", "u1"), ("1", "b", "u2"), ("2", "a", "u3"), ("2", "b", "u4"), ("3", "a", "u5"), ("4", "a", "u6")], "timestamp string, file_id string, url string")
    listed = spark.createDataFrame([("1", "a"), ("1", "odd"), ("2", "odd"), ("3", "odd"), ("3", "odder"), ("4", "a"), ("4", "odd")], "timestamp string, file_id string")
    got = {(r["timestamp"], r["file_id"]): r["url"] for r in dumps.claimed_snapshots(listed, snapshots).collect()}
    assert got == {("1", "a"): "u1", ("1", "odd"): "u2", ("2", "odd"): None, ("3", "odd"): None, ("3", "odder"): None, ("4", "a"): "u6", ("4", "odd"): None}
    layouts = [("cdx.json", "20100101000000/a"), ("cdx.json", "index__q1.php"), ("index.php_x", "a/t1.html")]
    assert [dumps.layout_of(spark.createDataFrame([(p,) for p in paths], "path string"), "cdx.json") for paths in layouts] == ["snapshots", "hashed", "flat"]
    texts = {"a%2520b": "a b", "100%": "100%", "%25%32%30x+y": " x+y", "%E4%BD%A0": "你", "": ""}
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", dumps.decoded(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == texts


def test_guessed_uploads_do_not_multiply_with_the_uploads_around(spark, capsys):
    missing = spark.sql("""select * from values (1L, timestamp_ntz'2020-01-02 00:00'), (2L, timestamp_ntz'2020-01-09 12:00'), (3L, timestamp_ntz'2020-01-09 12:00'),
        (4L, timestamp_ntz'2020-03-01 10:00'), (5L, null), (6L, timestamp_ntz'2020-03-01 10:01') as t(upload_id, posted_at)""")
    numbers = spark.sql("""select * from values (1L, timestamp_ntz'2020-01-01 00:00', timestamp_ntz'2020-01-02 00:00'), (2L, timestamp_ntz'2020-01-02 00:00', timestamp_ntz'2020-01-09 11:59'),
        (3L, timestamp_ntz'2020-01-03 00:00', timestamp_ntz'2020-02-03 00:00'), (4L, timestamp_ntz'2020-01-10 00:00', timestamp_ntz'2020-03-01 10:00'), (5L, timestamp_ntz'2020-01-10 00:00', timestamp_ntz'2020-03-02 00:00'),
        (6L, timestamp_ntz'2020-03-02 00:00', timestamp_ntz'2020-04-01 00:00'), (7L, null, timestamp_ntz'2020-04-01 00:00'), (8L, timestamp_ntz'2020-03-01 10:00:30', timestamp_ntz'2020-03-01 10:01'),
        (9L, timestamp_ntz'2020-01-02 00:00', timestamp_ntz'2020-01-01 00:00'), (10L, timestamp_ntz'2019-12-01 00:00', timestamp_ntz'2020-01-01 23:59') as t(attach_id, low, high)""")
    found = recovery.guessed_uploads(numbers, missing)
    assert {(r["attach_id"], r["upload_id"]) for r in found.collect()} == {(1, 1), (2, 1), (4, 4), (8, 6)}
    found.explain()
    assert "Generate" not in capsys.readouterr().out  # an interval was a row for each of its days before
