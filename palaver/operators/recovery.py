"""Which archived copy a lost file is taken from: choices among captures as aggregates and joins.

Captures are rows that were fetched before, with what the download is; nothing here
reads the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions.attachments import extension, file_key
from palaver.operators.shared import materialized


def best_avatars(members: DataFrame, captures: DataFrame) -> DataFrame:
    """member_id, original, archived of each member's avatar.

    ``members``: member_id, avatar_url (as last shown, may be null).  ``captures``:
    member_id, original, at, archived, image (whether it is one).  Copies of the file
    that was shown last come first, of those, as of the others, the latest.
    """
    shown = members.groupBy("member_id").agg(F.max("avatar_url").alias("avatar_url"))
    asked = captures.filter("image").join(shown, "member_id", "left")
    same = F.coalesce(file_key(F.col("original")) == file_key(F.col("avatar_url")), F.lit(False))
    best = asked.groupBy("member_id").agg(F.max_by(F.struct("original", "archived"), F.struct(same.alias("same"), "at", "original", "archived")).alias("r"))
    return best.select("member_id", "r.original", "r.archived")


def guessed_uploads(numbers: DataFrame, missing: DataFrame) -> DataFrame:
    """attach_id, upload_id: the one missing upload whose post lies in the time that a number can have.

    ``numbers``: attach_id, low, high.  ``missing``: upload_id, posted_at.
    """
    from palaver.operators.ranges import day_number, first_from, following

    # One row a time; an interval holds one upload if its first time does and the next time lies behind its end.
    times = missing.filter("posted_at is not null").groupBy("posted_at").agg(F.count("*").alias("n"), F.min("upload_id").alias("upload_id"))
    times = following(times, "posted_at", ["posted_at"], block=day_number(F.col("posted_at")))
    inside = first_from(numbers.select("attach_id", "low", "high"), times, "low", "posted_at").filter(F.col("found.posted_at") <= F.col("high"))
    n = F.when(F.col("found.next_posted_at") <= F.col("high"), 2).otherwise(F.col("found.n"))
    return inside.groupBy("attach_id").agg(F.sum(n).alias("n"), F.min("found.upload_id").alias("upload_id")).filter("n = 1").drop("n")


def recovered_files(numbers: DataFrame, captures: DataFrame, rows: DataFrame, most: int = 3) -> DataFrame:
    """attach_id, target, archived, outcome of each numbered attachment with captures.

    ``numbers``: attach_id, upload_id (its upload's row or null), upload_name, guessed.
    ``captures``: attach_id, at, archived, file_name, valid.  ``rows``: id,
    old_attach_id of attachments without data.  The first valid download among the
    ``most`` oldest captures counts for every row that lacks the file; a guessed
    upload only if the file's extension confirms it.
    """
    oldest = captures.withColumn("__n", F.row_number().over(Window.partitionBy("attach_id").orderBy("at", "archived"))).filter(F.col("__n") <= most)
    found = oldest.groupBy("attach_id").agg(F.min_by(F.struct("archived", "file_name"), F.when(F.col("valid"), F.col("__n"))).alias("f"))
    known = found.join(numbers, "attach_id", "left")
    confirmed = ~F.coalesce("guessed", F.lit(False)) | F.coalesce(extension(F.col("f.file_name")) == extension(F.col("upload_name")), F.lit(False))
    lacking = rows.select(F.col("id").alias("upload_id")).withColumn("__lacks", F.lit(True)).distinct()
    known = known.join(lacking, "upload_id", "left")
    upload = F.when(F.coalesce("__lacks", F.lit(False)) & confirmed, F.col("upload_id"))
    tried = F.coalesce("__lacks", F.lit(False))
    # Read three times below, and worked out once.
    known = materialized(known.select("attach_id", "f", upload.alias("upload"), tried.alias("tried"), F.coalesce("guessed", F.lit(False)).alias("guessed"), confirmed.alias("confirmed")), "recovery")
    own = rows.filter("old_attach_id is not null").select(F.col("old_attach_id").alias("attach_id"), F.col("id").alias("target"))
    both = known.join(own, "attach_id").select("attach_id", "target").union(known.filter("upload is not null").select("attach_id", F.col("upload").alias("target"))).distinct()
    out = known.join(both, "attach_id", "left")
    lost = F.col("f.archived").isNull()
    outcome = (
        F.when(F.col("target").isNull() & ~F.col("tried"), "nothing missing")
        .when(lost, "archived copies aren't the file")
        .when(F.col("target").isNull(), "guess not confirmed")
        .when(F.col("guessed") & F.col("confirmed") & F.col("tried"), "recovered by time")
        .otherwise("recovered")
    )
    kept = F.when(~lost, F.col("target"))
    return out.select("attach_id", kept.alias("target"), F.when(kept.isNotNull(), F.col("f.archived")).alias("archived"), outcome.alias("outcome")).distinct()
