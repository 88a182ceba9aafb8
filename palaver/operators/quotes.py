"""Record linkage of quotes to the posts they quote.

Stages, all joins and windows: wanted trigrams of quote bodies, postings of posts'
own texts, candidates by text, by time zone and by author within the topic,
evidence, habits of viewers, the decision.  Levels of nesting follow each other,
because a nested quote is bounded by the post that its parent was matched to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions import dates, text
from palaver.functions.markup import percent
from palaver.operators.names import name_pairs
from palaver.operators.ranges import bucketed_range_join, minutes
from palaver.operators.shared import materialized

#: Fixed values of the linkage: trigrams a quote, posts a trigram, trigrams that make a text comparable, candidates by text, latest posts of a topic, likeness of names.
SAMPLE, COMMON, LEAST, TOP, SCAN, ALIKE = 60, 2000, 3, 20, 500, 0.85
#: Hashes of trigrams that are broadcast at most, 8 bytes each.
FEW = 2_000_000
#: Fixed value: minutes by which a quoted post may seem later than its bound.
SLACK = 2


def wanted_trigrams(quotes: DataFrame, body: str = "body") -> DataFrame:
    """quote_id, s: hashes of at most ``SAMPLE`` distinct trigrams of each body, spread over their md5 order."""
    s = text.sampled(text.shingles(text.words(F.col(body))), SAMPLE)
    return materialized(quotes.select("quote_id", F.explode(s).alias("s")).select("quote_id", F.xxhash64("s").alias("s")).distinct(), "quote-trigrams")


def postings(posts: DataFrame, wanted: DataFrame, own: Column) -> DataFrame:
    """post_id, s of wanted trigrams that at most ``COMMON`` posts hold.

    Up to ``FEW`` wanted trigrams go to all tasks, so that the others never leave theirs.
    """
    every = posts.select(F.col("id").alias("post_id"), F.explode(text.shingles(text.words(own), hashed=True)).alias("s"))
    keys = materialized(wanted.select("s").distinct(), "quote-wanted")
    found = materialized(every.join(F.broadcast(keys) if keys.count() <= FEW else keys, "s", "left_semi"), "quote-postings")
    rare = found.groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") <= COMMON).select("s")
    return found.join(rare, "s")


def text_hits(wanted: DataFrame, posted: DataFrame) -> DataFrame:
    """quote_id, post_id, hits, usable, similarity; similarity is null below ``LEAST`` usable trigrams.

    A trigram's posts, ``COMMON`` at most, move to each quote as one list and are
    counted where the quote is.
    """
    lists = posted.groupBy("s").agg(F.collect_list("post_id").alias("posts"))
    asked = wanted.join(lists, "s")
    usable = asked.groupBy("quote_id").agg(F.count("*").alias("usable"))
    here = asked.select("quote_id", "posts").repartition("quote_id")
    hits = here.select("quote_id", F.explode("posts").alias("post_id")).groupBy("quote_id", "post_id").agg(F.count("*").alias("hits"))
    return hits.join(usable, "quote_id").withColumn("similarity", F.when(F.col("usable") >= LEAST, F.col("hits") / F.col("usable")))


def top_hits(hits: DataFrame, n: int = TOP) -> DataFrame:
    w = Window.partitionBy("quote_id").orderBy(F.desc("hits"), "post_id")
    return hits.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n).drop("place")


def asked_trigrams(wanted: DataFrame, posted: DataFrame) -> DataFrame:
    """quote_id, usable, asked: how many wanted trigrams of a quote any post holds, and these, rarest first."""
    held = posted.groupBy("s").agg(F.count("*").alias("n"))
    ordered = wanted.join(held, "s").groupBy("quote_id").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("asked"))
    return ordered.select("quote_id", F.size("asked").alias("usable"), F.transform("asked", lambda x: x["s"]).alias("asked"))


def likely_candidates(asked: DataFrame, posted: DataFrame, held: DataFrame, every: DataFrame, n: int = TOP) -> DataFrame:
    """quote_id, post_id of a quote's ``n`` first posts by hits that have half of its trigrams; for quotes in ``every`` (quote_id) also with less.

    A post with half of u trigrams has one at least of any u - ceil(u / 2) + 1 of
    them, so only the lists of the rarest that many move; the others are counted
    where the post's own trigrams (``held``: post_id, held) are.
    """
    half = F.ceil(F.col("usable") / 2).cast("int")
    flagged = asked.join(every.select("quote_id", F.lit(True).alias("every")).distinct(), "quote_id", "left").withColumn("every", F.coalesce("every", F.lit(False)))
    flagged = flagged.withColumn("first", F.when(F.col("every"), F.col("usable")).otherwise(F.col("usable") - half + 1))
    lists = posted.groupBy("s").agg(F.collect_list("post_id").alias("posts"))
    first = flagged.select("quote_id", F.explode(F.slice("asked", F.lit(1), F.col("first"))).alias("s"))
    here = first.join(lists, "s").select("quote_id", "posts").repartition("quote_id")
    met = here.select("quote_id", F.explode("posts").alias("post_id")).groupBy("quote_id", "post_id").agg(F.count("*").alias("met"))
    rest = flagged.select("quote_id", "usable", "every", F.slice("asked", F.col("first") + 1, F.greatest(F.col("usable") - F.col("first"), F.lit(0))).alias("rest"))
    hits = met.join(rest, "quote_id").join(held, "post_id").withColumn("hits", F.col("met") + F.size(F.array_intersect("held", "rest")))
    return top_hits(hits.filter(F.col("every") | (F.col("hits") >= half)), n).select("quote_id", "post_id")


def zone_candidates(quotes: DataFrame, posts: DataFrame) -> DataFrame:
    """quote_id, post_id, offset: posts of the topic whose time some zone shows as the quote's date."""
    exact = quotes.filter("quoted_at is not null").select("quote_id", F.col("topic_id").alias("__t"), "quoted_at")
    at = minutes(F.col("quoted_at"))
    found = bucketed_range_join(exact, posts.select(F.col("id").alias("post_id"), "topic_id", "posted_at"), at - 842, at + 722, minutes(F.col("posted_at")), 1440, [("__t", "topic_id")])
    offset = dates.exact_offset(F.col("quoted_at"), F.col("posted_at"))
    return found.withColumn("offset", offset).filter("offset is not null").select("quote_id", "post_id", "offset")


def lessons(evidence: DataFrame) -> DataFrame:
    """viewer, offset of quotes of which one candidate alone has both author and date."""
    sure = evidence.filter("author = 2 and offset is not null and viewer is not null")
    return sure.groupBy("quote_id", "viewer").agg(F.count("*").alias("n"), F.min("offset").alias("offset")).filter("n = 1").select("viewer", "offset")


def usual(learned: DataFrame) -> DataFrame:
    """viewer, offset: the zones a viewer's quotes usually show, seen twice and in a fifth of the lessons."""
    seen = learned.groupBy("viewer", "offset").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("viewer"))
    return seen.withColumn("total", total).filter((F.col("n") >= 2) & (F.col("n") >= F.col("total") / 5)).select("viewer", "offset")


def habits(evidence: DataFrame) -> DataFrame:
    return usual(lessons(evidence))


def decide(evidence: DataFrame, usual: DataFrame) -> DataFrame:
    """quote_id, post_id, match, similarity, offset: the best candidate of each quote.

    ``evidence``: quote_id, post_id, viewer, author (0-2), offset, similarity,
    same_topic, posted_at, named, dated_quote, exact_quote.  Equal ranks are
    ambiguous unless only repeated text or the author decides.
    """
    known = usual.select(F.col("viewer").alias("__v"), F.col("offset").alias("__o"), F.lit(True).alias("__usual"))
    some = usual.select(F.col("viewer").alias("__w")).distinct().withColumn("__some", F.lit(True))
    e = evidence.join(some, F.col("viewer") == F.col("__w"), "left").join(known, (F.col("viewer") == F.col("__v")) & (F.col("offset") == F.col("__o")), "left")
    similarity, author, same = F.col("similarity"), F.col("author"), F.col("same_topic")
    habit = F.col("offset").isNotNull() & F.when(F.col("__some"), F.coalesce("__usual", F.lit(False))).otherwise(F.coalesce(F.col("offset") == 0, F.lit(False)))
    words = F.coalesce(similarity, F.lit(0.0))
    chance = similarity.isNotNull() & (similarity < 0.2) & ~(habit & same)
    dated = F.col("offset").isNotNull() & ~chance
    tier = (
        F.when(dated & (author == 2), 0)
        .when(dated & (words >= 0.5), 1)
        .when((author > 0) & (words >= 0.5), 2)
        .when(dated & (author == 1) & (similarity.isNull() | (similarity >= 0.3)), 3)
        .when((words >= 0.8) & same, 4)
        .when(dated & F.col("exact_quote") & same & ~F.col("named") & similarity.isNull(), 5)
        .when((author == 2) & similarity.isNull() & same & ~F.col("dated_quote"), 6)
    )
    names = F.array(*map(F.lit, ("author+date", "date+text", "author+text", "near-author+date", "text", "date", "author")))
    rank = F.struct((-F.col("tier")).alias("a"), habit.alias("b"), F.bround(words, 2).alias("c"), author.alias("d"), same.alias("e"))
    ranked = e.withColumn("tier", tier).filter("tier is not null").withColumn("rank", rank)
    w = Window.partitionBy("quote_id").orderBy(F.desc("rank"), F.desc("posted_at"), F.desc("post_id"))
    ranked = ranked.withColumn("place", F.row_number().over(w)).withColumn("next_rank", F.lead("rank").over(w)).withColumn("next_tier", F.lead("tier").over(w))
    best = ranked.filter("place = 1")
    tie = (F.col("next_rank") == F.col("rank")) & ~F.col("tier").isin(4, 6)
    ambiguous = F.coalesce(tie, F.lit(False)) | F.coalesce((F.col("tier") == 5) & (F.col("next_tier") == 5), F.lit(False))
    return best.select(
        "quote_id",
        F.when(~ambiguous, F.col("post_id")).alias("post_id"),
        F.when(ambiguous, "ambiguous").otherwise(F.get(names, F.col("tier"))).alias("match"),
        F.when(~ambiguous, percent(similarity)).alias("similarity"),
        F.when(~ambiguous, F.col("offset")).alias("offset"),
    )


def read_dates(quotes: DataFrame) -> DataFrame:
    """The quotes with ``when`` (its parts), ``quoted_at`` (to the minute, null if parts are lost) and ``utc``.

    Unix seconds are UTC; a written date is in the zone of whoever quoted.
    """
    stamp = F.timestamp_seconds("unix").cast("timestamp_ntz")
    parts = F.struct(F.year(stamp).alias("year"), F.month(stamp).alias("month"), F.day(stamp).alias("day"), F.hour(stamp).alias("hour"), F.minute(stamp).alias("minute"))
    when = F.when(F.col("unix").isNotNull(), parts).otherwise(dates.quote_date(F.col("date")))
    out = quotes.withColumn("when", when).withColumn("utc", F.col("unix").isNotNull())
    w = F.col("when")
    digits = F.format_string("%04d-%02d-%02d %02d:%02d", w["year"], w["month"], w["day"], w["hour"], w["minute"])
    whole = w["month"].isNotNull() & w["hour"].isNotNull()
    return out.withColumn("quoted_at", F.when(whole, F.try_to_timestamp(digits, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")))


def shown_offset(when: Column, quoted_at: Column, utc: Column, posted_at: Column) -> Column:
    """Minutes between a post's time and how a quote shows it; null if they do not agree."""
    same = F.when(F.abs(minutes(quoted_at) - minutes(posted_at)) <= 1, F.lit(0).cast("long"))
    lost = dates.partial_offset(when, F.date_trunc("minute", posted_at).cast("timestamp_ntz")).cast("long")
    return F.when(utc, same).when(quoted_at.isNotNull(), dates.exact_offset(quoted_at, posted_at)).when(when.isNotNull(), lost)


def name_scores(quotes: DataFrame, names: DataFrame, holder: str) -> DataFrame:
    """quote_id, holder, score (1 or 2) of the holders whose name is, or is nearly, a quote's author.

    ``names`` has ``holder`` and ``key``; a holder with several names counts by the best.
    """
    asked = quotes.filter("author is not null").select("quote_id", text.name_key(F.col("author")).alias("key"))
    pairs = name_pairs(asked.select("key").distinct().withColumn("asked", F.col("key")), names.select(holder, "key"), ALIKE).select("asked", holder, "score")
    return asked.join(pairs, F.col("key") == F.col("asked")).groupBy("quote_id", holder).agg(F.max("score").alias("score"))


def latest_of_topic(bounds: DataFrame, posts: DataFrame, by_user: DataFrame, by_post: DataFrame) -> DataFrame:
    """quote_id, post_id: of the last ``SCAN`` posts of a quote's topic up to its bound (all of the topic without one) those by its author.

    ``bounds``: quote_id, topic_id, before.  A running maximum over posts and bounds
    of a topic gives each bound its last place.  Places join as a range with the posts
    of the topic by a user of ``by_user`` (quote_id, user_id), and with those in
    ``by_post`` (quote_id, post_id), so that no quote meets posts of others.
    """
    placed = posts.filter("posted_at is not null").withColumn("place", F.row_number().over(Window.partitionBy("topic_id").orderBy("posted_at", "post_id")))
    marks = placed.select("topic_id", F.col("posted_at").alias("t"), F.lit(0).alias("kind"), "place", F.lit(None).cast("string").alias("quote_id"))
    asked = bounds.select("topic_id", (F.col("before") + F.make_interval(mins=F.lit(SLACK))).alias("t"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("place"), "quote_id")
    asked = asked.withColumn("t", F.coalesce("t", F.lit("9999-12-31").cast("timestamp_ntz")))
    last = F.max("place").over(Window.partitionBy("topic_id").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0))
    ends = marks.unionByName(asked).withColumn("last", last).filter("kind = 1 and last is not null").select("quote_id", F.col("topic_id").alias("__t"), "last")
    places = placed.select("post_id", "topic_id", "user_id", "place")
    users = ends.join(by_user.select("quote_id", F.col("user_id").alias("__u")).distinct(), "quote_id")
    of_user = bucketed_range_join(users, places, F.col("last") - SCAN + 1, F.col("last"), F.col("place"), SCAN, [("__t", "topic_id"), ("__u", "user_id")])
    named = ends.join(by_post.select("quote_id", "post_id").distinct(), "quote_id").join(places, "post_id")
    named = named.filter((F.col("__t") == F.col("topic_id")) & F.col("place").between(F.col("last") - SCAN + 1, F.col("last")))
    return of_user.select("quote_id", "post_id").unionByName(named.select("quote_id", "post_id")).distinct()


def link_level(quotes: DataFrame, posts: DataFrame, names: DataFrame, asked: DataFrame, held: DataFrame, top: DataFrame, learned: DataFrame | None = None, guests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Decisions (see ``decide``) for quotes whose bounds are known, and their lessons.

    ``quotes``: quote_id, container, topic_id, author, when, quoted_at, utc, post_ref,
    user_ref, before, viewer.  ``posts``: id, topic_id, user_id, posted_at.  ``names``:
    user_id, key.  ``asked``, ``held`` and ``top`` (see ``likely_candidates``) may be of
    more quotes.
    ``guests``: post_id, key of posts without a user.  ``learned``:
    lessons of levels before.
    """
    slim = posts.select(F.col("id").alias("post_id"), "topic_id", "user_id", "posted_at")
    by_user = name_scores(quotes, names, "user_id").unionByName(quotes.filter("user_ref is not null").select("quote_id", F.col("user_ref").alias("user_id"), F.lit(2).alias("score")))
    by_user = by_user.groupBy("quote_id", "user_id").agg(F.max("score").alias("score"))
    by_user = materialized(by_user, "quote-users")
    by_post = materialized(name_scores(quotes, guests, "post_id"), "quote-guests") if guests is not None else by_user.limit(0).select("quote_id", F.col("user_id").alias("post_id"), "score")
    # In the topic by the author; at the quoted time in the topic, or anywhere by the author; by text.
    by_author = latest_of_topic(quotes.filter("author is not null or user_ref is not null").select("quote_id", "topic_id", "before"), slim, by_user, by_post)
    timed = quotes.filter("quoted_at is not null").select("quote_id", "topic_id", "quoted_at")
    at, point = minutes(F.col("quoted_at")), minutes(F.col("posted_at"))
    near = bucketed_range_join(timed.withColumnRenamed("topic_id", "__t"), slim, at - 842, at + 722, point, 1440, [("__t", "topic_id")]).select("quote_id", "post_id")
    owned = timed.join(by_user.select("quote_id", F.col("user_id").alias("__u")), "quote_id")
    elsewhere = bucketed_range_join(owned.drop("topic_id"), slim, at - 842, at + 722, point, 1440, [("__u", "user_id")]).select("quote_id", "post_id")
    guest_posts = timed.drop("topic_id").join(by_post.select("quote_id", "post_id"), "quote_id").join(slim.select("post_id", "posted_at"), "post_id")
    guest_posts = guest_posts.filter(point.between(at - 842, at + 722)).select("quote_id", "post_id")
    pool = by_author.unionByName(near).unionByName(elsewhere).unionByName(guest_posts).unionByName(top.join(quotes, "quote_id", "left_semi").select("quote_id", "post_id")).distinct()
    named = quotes.filter("author is not null").select("quote_id", text.name_key(F.col("author")).alias("key")).join(names.select("key").distinct(), "key", "left_semi").select("quote_id", F.lit(True).alias("named"))
    e = pool.join(quotes.withColumnRenamed("topic_id", "__qt"), "quote_id").join(slim, "post_id").filter("post_id <> container and posted_at is not null")
    e = e.filter(F.col("before").isNull() | (F.col("posted_at") <= F.col("before") + F.make_interval(mins=F.lit(SLACK))))
    e = e.join(by_user.withColumnRenamed("score", "__su"), ["quote_id", "user_id"], "left").join(by_post.withColumnRenamed("score", "__sp"), ["quote_id", "post_id"], "left")
    e = e.join(asked.withColumnRenamed("usable", "__n"), "quote_id", "left").join(held, "post_id", "left").join(named, "quote_id", "left")
    e = e.withColumn("__h", F.size(F.array_intersect(F.coalesce("held", F.array().cast("array<bigint>")), "asked")))
    e = e.select(
        "quote_id", "post_id", "viewer", "posted_at",
        F.greatest(F.coalesce("__su", F.lit(0)), F.coalesce("__sp", F.lit(0))).alias("author"),
        shown_offset(F.col("when"), F.col("quoted_at"), F.col("utc"), F.col("posted_at")).alias("offset"),
        F.when(F.col("__n") >= LEAST, F.coalesce("__h", F.lit(0)) / F.col("__n")).alias("similarity"),
        (F.col("__qt") == F.col("topic_id")).alias("same_topic"),
        F.coalesce("named", F.lit(False)).alias("named"),
        F.col("when").isNotNull().alias("dated_quote"),
        F.col("quoted_at").isNotNull().alias("exact_quote"),
    )
    e = materialized(e, "quote-evidence")
    new = lessons(e)
    learned = new if learned is None else learned.unionByName(new)
    given = quotes.filter("post_ref is not null").select("quote_id", F.col("post_ref").alias("post_id")).join(posts.select(F.col("id").alias("post_id")), "post_id", "left_semi")
    given = given.select("quote_id", "post_id", F.lit("post-id").alias("match"), F.lit(None).cast("long").alias("similarity"), F.lit(None).cast("long").alias("offset"))
    weighed = decide(e, usual(learned)).join(given, "quote_id", "left_anti")
    return given.unionByName(weighed.withColumn("offset", F.col("offset").cast("long"))), learned


def link_quotes(quotes: DataFrame, posts: DataFrame, names: DataFrame, guests: DataFrame | None = None) -> DataFrame:
    """post_id, position, level, parent, author, date, quoted_post_id, quoted_user_id, match, similarity, tz_offset of every quote.

    ``quotes`` as ``brackets.quotes_of`` gives them; ``posts``: id, topic_id, user_id,
    posted_at, text (its own words).  Levels follow each other, each written to the
    shared folder: a nested quote is no later than the post that its parent was
    matched to, and is shown in the zone of that post's author.
    """
    keyed = read_dates(quotes).withColumn("quote_id", F.concat_ws(":", "post_id", "position"))
    holders = posts.select(F.col("id").alias("post_id"), "topic_id", F.col("user_id").alias("__viewer"), F.col("posted_at").alias("__at"))
    keyed = materialized(keyed.join(holders, "post_id"), "quotes")
    wanted = wanted_trigrams(keyed)
    posted = materialized(postings(posts, wanted, F.col("text")), "quote-posted")
    held = materialized(posted.groupBy("post_id").agg(F.collect_list("s").alias("held")), "quote-held")
    asked = materialized(asked_trigrams(wanted, posted), "quote-asked")
    # Less than half of a quote's trigrams only count with its author and date, by which posts are met as well; but where parts of the date are lost, by text alone.
    partly = keyed.filter("when is not null and quoted_at is null and (author is not null or user_ref is not null)")
    top = materialized(likely_candidates(asked, posted, held, partly), "quote-top")
    deepest = keyed.agg(F.max("level")).first()[0] or 0  # one number
    found, learned = None, None
    for level in range(1, deepest + 1):
        own = keyed.filter(F.col("level") == level).withColumnRenamed("post_id", "container")
        before, viewer = F.col("__at"), F.col("__viewer")
        if found is not None:
            parents = found.filter("post_id is not null").select(F.col("quote_id").alias("__parent"), "post_id").join(holders.select("post_id", F.col("__at").alias("__pt"), F.col("__viewer").alias("__pv")), "post_id").drop("post_id")
            own = own.join(parents, F.concat_ws(":", "container", "parent") == F.col("__parent"), "left")
            matched = F.col("__parent").isNotNull()
            before, viewer = F.when(matched, F.col("__pt")).otherwise(before), F.when(matched, F.col("__pv")).otherwise(viewer)
        own = own.select("quote_id", "container", "topic_id", "author", "when", "quoted_at", "utc", "post_ref", "user_ref", before.alias("before"), viewer.alias("viewer"))
        decided, learned = link_level(own, posts.drop("text"), names, asked, held, top, learned, guests)
        learned = materialized(learned, "quote-lessons")
        decided = materialized(decided, "quote-decisions")
        found = decided if found is None else found.unionByName(decided)
    if found is None:
        found = decide_schema(quotes)
    # Without a post, the user that the tag or a name of one user alone gives.
    alone = names.groupBy("key").agg(F.min("user_id").alias("__one"), F.count_distinct("user_id").alias("__n")).filter("__n = 1").select("key", "__one")
    out = keyed.join(found.withColumnRenamed("post_id", "quoted_post_id"), "quote_id", "left").withColumn("key", text.name_key(F.col("author"))).join(alone, "key", "left")
    out = out.join(posts.select(F.col("id").alias("quoted_post_id"), F.nullif("user_id", F.lit(0)).alias("__quoted")), "quoted_post_id", "left")
    user = F.when(F.col("quoted_post_id").isNotNull(), F.col("__quoted")).otherwise(F.coalesce("user_ref", "__one"))
    return out.select("post_id", "position", "level", "parent", "author", "date", "quoted_post_id", user.alias("quoted_user_id"), "match", "similarity", F.col("offset").alias("tz_offset"))


def decide_schema(quotes: DataFrame) -> DataFrame:
    """No decisions at all."""
    return quotes.sparkSession.createDataFrame([], "quote_id string, post_id long, match string, similarity long, offset long")
