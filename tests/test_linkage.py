"""Quotes linked by joins against a plain walk over all pairs; names, chains, trees and windows beyond their old limits."""

from __future__ import annotations

import datetime as dt
import difflib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from palaver.functions import markup
from palaver.functions.attribution import attribution, clean_name, opening_tag, trailing_date
from palaver.operators import brackets, members, names, quotes, ranges, trees
from palaver.sources import sinks

START = dt.datetime(2005, 3, 1, 12, 0)


def word(rng):
    return "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(3, 7)))


def board(seed=3):
    """Posts of a few topics; some quote earlier ones, nested, with and without dates, ids and names."""
    rng = random.Random(seed)
    people = {1: "Robert", 2: "Robert Jones", 3: "Al", 4: "Kristina", 5: "Zed"}
    posts, zone = [], {1: 0, 2: 60, 3: -300, 4: 0, 5: 345}
    for i in range(1, 91):
        user = rng.choice(list(people))
        at = START + dt.timedelta(minutes=37 * i, seconds=rng.randint(0, 59))
        own = " ".join(word(rng) for _ in range(rng.choice([1, 3, 8, 15])))
        source, topic = own, rng.randint(1, 3)
        if i > 10 and rng.random() < 0.6:
            source = ""
            for depth in range(rng.randint(1, 2)):
                near = [p for p in posts if p["topic"] == topic] or posts
                q = rng.choice(near[-12:] if rng.random() < 0.8 else posts)
                shown = (q["at"] + dt.timedelta(minutes=zone[user])).strftime("%b %-d %Y, %I:%M %p")
                name = people[q["user"]] if rng.random() < 0.7 else people[q["user"]][:-1] + "y"
                tag = rng.choice([f"[quote={name} @ {shown}]", f"[quote={name}]", f'[quote="{name}, post: {q["id"]}"]', f"[quote={name} @ {shown[4:]}]", f"[quote name='{name}' timestamp='{int(q['at'].replace(tzinfo=dt.timezone.utc).timestamp())}']", "[quote]"])
                body = q["own"] if rng.random() < 0.8 else " ".join(word(rng) for _ in range(6))
                source = f"{tag}{source if depth else ''} {body}[/quote]"
            source += " " + own
        posts.append({"id": i, "topic": topic, "user": user, "at": at, "own": own, "source": source})
    return people, posts


ZONES = sorted({*range(-720, 841, 30), 345, 525, 765}, key=abs)


def offset_of(q, posted):
    minute = posted.replace(second=0)
    if q["when"] is None:
        return None
    year, month, day, hour, mins, utc = q["when"]
    exact = dt.datetime(year, month, day, hour, mins) if month and hour is not None else None
    if utc:
        return 0 if abs((exact - minute).total_seconds()) <= 60 else None
    if exact:
        diff = round((exact - minute).total_seconds() / 60)
        good = [z for z in ZONES if abs(z - diff) <= 1 and z % 15 == 0]
        return good[0] if good else None
    for z in ZONES:
        local = minute + dt.timedelta(minutes=z)
        if (local.year, local.day) == (year, day) and (not month or local.month == month) and (hour is None or (local.hour, local.minute) == (hour, mins)):
            return z
    return None


def score_of(author, name):
    a, b = (author or "").lower(), name.lower()
    if not a:
        return 0
    if a == b:
        return 2
    if min(len(a), len(b)) < 3 or abs(len(a) - len(b)) > max(len(a), len(b)) * 0.3 + 2:
        return 0
    return int(a.startswith(b) or b.startswith(a) or difflib.SequenceMatcher(None, a, b).ratio() >= 0.85)


def trigrams(t):
    w = re.findall(r"\w+", t.lower())
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def read_when(q):
    if q["unix"]:
        t = dt.datetime.fromtimestamp(q["unix"], dt.timezone.utc)
        return t.year, t.month, t.day, t.hour, t.minute, True
    m = re.fullmatch(r"(?:([A-Z][a-z]{2}) )?(\d+) (\d{4}), (\d+):(\d+) ([AP])M", q["date"] or "")
    if not m:
        return None
    month = dt.datetime.strptime(m[1], "%b").month if m[1] else None
    return int(m[3]), month, int(m[2]), int(m[4]) % 12 + 12 * (m[6] == "P"), int(m[5]), False


def plain_links(people, posts):
    by_id = {p["id"]: p for p in posts}
    every = []
    for p in posts:
        parsed, own = markup.parse_quotes(p["source"])
        p["words"] = trigrams(own)
        every += [q | {"holder": p, "when": read_when(q)} for q in parsed]
    known = set().union(*(p["words"] for p in posts))
    found, habit = {}, defaultdict(Counter)
    for level in range(1, 1 + max(q["level"] for q in every)):
        weighed = []
        for q in [q for q in every if q["level"] == level]:
            holder = q["holder"]
            before, viewer = holder["at"], holder["user"]
            parent = found.get((holder["id"], q["parent"]))
            if parent and parent[0]:
                before, viewer = by_id[parent[0]]["at"], by_id[parent[0]]["user"]
            usable = trigrams(q["body"]) & known
            evidence = []
            for p in posts:
                if p["id"] == holder["id"] or p["at"] > before + dt.timedelta(minutes=2):
                    continue
                author, off = score_of(q["author"], people[p["user"]]), offset_of(q, p["at"])
                same = p["topic"] == holder["topic"]
                hits = len(usable & p["words"])
                exact = q["when"] and q["when"][1] and q["when"][3] is not None
                if not (hits or (author and same) or (exact and off is not None and (same or author))):
                    continue
                evidence.append((p, author, off, hits / len(usable) if len(usable) >= 3 else None, same))
            sure = [e[2] for e in evidence if e[1] == 2 and e[2] is not None]
            if len(sure) == 1:
                habit[viewer][sure[0]] += 1
            weighed.append((q, viewer, evidence))
        for q, viewer, evidence in weighed:
            key = (q["holder"]["id"], q["position"])
            if q["post_ref"] in by_id:
                found[key] = (q["post_ref"], "post-id")
                continue
            seen = habit[viewer]
            usual = {o for o, n in seen.items() if n >= 2 and n >= sum(seen.values()) / 5}
            named = (q["author"] or "").lower() in {n.lower() for n in people.values()}
            exact = bool(q["when"] and q["when"][1] and q["when"][3] is not None)
            ranked = []
            for p, author, off, sim, same in evidence:
                like = sim or 0
                fits = off is not None and (off in usual if usual else off == 0)
                dated = off is not None and not (sim is not None and sim < 0.2 and not (fits and same))
                rules = (
                    (dated and author == 2, "author+date"), (dated and like >= 0.5, "date+text"), (author > 0 and like >= 0.5, "author+text"),
                    (dated and author == 1 and (sim is None or sim >= 0.3), "near-author+date"), (like >= 0.8 and same, "text"),
                    (dated and exact and same and not named and sim is None, "date"), (author == 2 and sim is None and same and not q["when"], "author"),
                )
                tier = next((i for i, (ok, _) in enumerate(rules) if ok), None)
                if tier is not None:
                    ranked.append(((-tier, fits, round(like, 2), author, same), p["at"], p["id"], rules[tier][1]))
            ranked.sort(reverse=True)
            if not ranked:
                found[key] = (None, None)
            elif len(ranked) > 1 and ((ranked[0][0] == ranked[1][0] and ranked[0][3] not in ("text", "author")) or ranked[0][3] == ranked[1][3] == "date"):
                found[key] = (None, "ambiguous")
            else:
                found[key] = (ranked[0][2], ranked[0][3])
    return found


@pytest.mark.parametrize("seed", [3, 8])
def test_quotes_link_as_by_hand(spark, seed):
    people, posts = board(seed)
    want = plain_links(people, posts)
    rows = spark.createDataFrame([(p["id"], p["topic"], p["user"], p["at"], p["source"]) for p in posts], "id long, topic_id long, user_id long, posted_at timestamp_ntz, source string")
    own = rows.withColumn("text", markup.own_text("source")).drop("source")
    known = spark.createDataFrame([(i, n.lower()) for i, n in people.items()], "user_id long, key string")
    out = quotes.link_quotes(brackets.quotes_of(rows), own, known).collect()
    assert {(r["post_id"], r["position"]): (r["quoted_post_id"], r["match"]) for r in out} == want
    kinds = Counter(m for _, m in want.values())
    assert len(kinds) >= 5 and max(q["level"] for q in out) == 2
    none = brackets.quotes_of(rows.limit(0))
    assert quotes.link_quotes(none, own, known).count() == 0


def common_texts(seed, n):
    """Texts of 150 words of a few, so that all share trigrams."""
    rng = random.Random(seed)
    return [" ".join(rng.choice(["ant", "bee", "cow", "dog", "elk", "fox"]) for _ in range(150)) for _ in range(n)]


def test_likely_candidates_are_the_first_of_all(spark):
    texts = common_texts(5, 60)
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    bodies = [(f"q{i}", " ".join(t.split()[: (4, 30, 150)[i % 3]])) for i, t in enumerate(texts[:30])]
    wanted = quotes.wanted_trigrams(spark.createDataFrame(bodies, "quote_id string, body string"))
    posted = quotes.postings(posts, wanted, F.col("text"))
    held = posted.groupBy("post_id").agg(F.collect_list("s").alias("held"))
    every = spark.createDataFrame([(f"q{i}",) for i in range(0, 30, 4)], "quote_id string")
    asked = quotes.asked_trigrams(wanted, posted)
    got = {tuple(r) for r in quotes.likely_candidates(asked, posted, held, every, 50).collect()}
    plain = defaultdict(list)
    for r in quotes.text_hits(wanted, posted).collect():
        plain[r["quote_id"]].append((-r["hits"], r["post_id"], r["usable"]))
    want = {(q, p) for q, hits in plain.items() for h, p, u in sorted(hits)[:50] if -h >= u / 2 or int(q[1:]) % 4 == 0}
    assert got == want and len(want) < sum(len(hits[:50]) for hits in plain.values())
    assert {r["quote_id"]: r["usable"] for r in asked.collect()} == {q: hits[0][2] for q, hits in plain.items()}


def test_no_rows_for_posts_that_share_a_few_trigrams(spark, monkeypatch):
    texts, sizes = common_texts(6, 200), []
    at = dt.datetime(2005, 1, 1)
    rows = [(i, i % 50, i, at + dt.timedelta(hours=i), t) for i, t in enumerate(texts)]
    rows += [(1000 + i, i % 50, 500, at + dt.timedelta(days=400), f'[quote="user {i}"]{t}[/quote] yes') for i, t in enumerate(texts)]
    rows = spark.createDataFrame(rows, "id long, topic_id long, user_id long, posted_at timestamp_ntz, source string")
    written = quotes.materialized
    monkeypatch.setattr(quotes, "materialized", lambda df, name, *by: sizes.append((out := written(df, name, *by)).count()) or out)
    known = spark.createDataFrame([(i, f"user {i}") for i in range(200)], "user_id long, key string")
    out = quotes.link_quotes(brackets.quotes_of(rows), rows.withColumn("text", markup.own_text("source")).drop("source"), known).collect()
    assert [r["quoted_post_id"] for r in sorted(out, key=lambda r: r["post_id"])] == list(range(200))
    assert max(sizes) < 200 * 150  # pairs of quotes and posts are 40,000


def test_names_by_prefix_and_likeness(spark):
    rng = random.Random(5)
    known = ["customer" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["al", "al", "bob", "bobby", "kristina"]
    asked = known[::3] + ["kristine", "customer", "bo"]
    a = spark.createDataFrame(list(enumerate(asked)), "q long, key string")
    k = spark.createDataFrame(list(enumerate(known)), "id long, key string")
    for fuzzy in (None, 0.85):
        want = {(i, j): s for i, x in enumerate(asked) for j, y in enumerate(known) if (s := score_of(x, y)) and (fuzzy or x == y or x.startswith(y) or y.startswith(x))}
        got = names.name_pairs(a, k, fuzzy).select("q", "id", "score").collect()
        assert len(got) == len(want) and {(r["q"], r["id"]): r["score"] for r in got} == want


def test_one_chain_of_anchors(spark):
    rng = random.Random(6)
    n = 400
    order = list(range(n))
    for _ in range(60):
        i, j = rng.randrange(n), rng.randrange(n)
        order[i], order[j] = order[j], order[i]
    old = spark.createDataFrame([(i * 1000, f"n{i}") for i in range(n)], "id long, key string")
    new = spark.createDataFrame([(p * 1000, f"n{i}") for p, i in enumerate(order)], "id long, key string")
    out = members.link_members(old, new).collect()
    chain = sorted((r["old_id"], r["new_id"]) for r in out if r["match"] == "name")
    assert all(a < b for (_, a), (_, b) in zip(chain, chain[1:]))
    best = []
    for _, p in sorted((i, p) for p, i in enumerate(order)):
        k = next((k for k, x in enumerate(best) if x >= p), len(best))
        best[k : k + 1] = [p]
    assert len(chain) == len(best) and n - 5 <= len(out) <= n
    assert {r["match"] for r in out} <= {"name", "position", "only-name"}


def test_trees_of_any_depth(spark):
    rows = [(i, i - 1 if i else None, f"f{i}") for i in range(130)] + [(900, 901, "x"), (901, 900, "y"), (902, 901, "z"), (200, 7, "side")]
    forums = spark.createDataFrame(rows, "id long, parent_id long, name string")
    out = {r["id"]: r for r in trees.paths(forums).collect()}
    assert len(out) == 131 and out[129]["depth"] == 129 and out[129]["path"] == list(range(130)) and out[200]["depth"] == 8
    json = '{"id":1,"name":"a"}'
    for i in range(2, 70):
        json = f'{{"id":{i},"name":"a","child":[{json}]}}'
    assert trees.flatten_tree(spark, spark.createDataFrame([(json,)], "tree string")).count() == 69


def test_windows_over_blocks(spark):
    rng = random.Random(7)
    ids = sorted(rng.sample(range(3_000_000), 400))
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    got = {r["id"]: r["next_id"] for r in ranges.following(df, "id", ["id"], width=1000).collect()}
    assert got == dict(zip(ids, [*ids[1:], None]))
    blocks = spark.createDataFrame([(i, i if i % 3 else None, i if i % 5 else None) for i in range(50)], "b long, last long, first long")
    for r in ranges.carried(blocks, "b", "last", "first", width=4).collect():
        assert r["before"] == max((i for i in range(r["b"]) if i % 3), default=None)
        assert r["behind"] == min((i for i in range(r["b"] + 1, 50) if i % 5), default=None)


def test_reports_are_whole_and_names_stay_below(spark):
    assert sinks.as_text(spark.range(1500).toDF("n")).count("\n") == 1501
    assert [sinks.safe_name(n) for n in ("/etc/x", "../../y", "a/./b:c", "", "d/..")] == ["etc/x", "_/_/y", "a/b_c", "_", "d/_"]


def test_attributions():
    assert trailing_date("Al, Nov 4 2005") == (4, False)
    assert trailing_date("marble 3 2004") == (7, False)
    assert trailing_date("Al @ Nov 4 2005, 07:37PM") == (5, True) and trailing_date("Al @ Nov 44 2005") is None and trailing_date("Nov 4 2005, 07:77 pm") is None
    assert clean_name(" Al \xa0 B posted on @") == "Al B" and clean_name("said") == "said"
    assert attribution('[quote="A \\"b\\" c" date="x" pid=4]') == {"author": 'A "b" c', "date": "x", "unix": None, "post_ref": 4, "user_ref": None}
    assert attribution("[quote=O'Neil]")["author"] == "O'Neil"
    assert opening_tag("(Al @ someday)") == '[quote="Al @ someday"]' and opening_tag("") == "[quote]"


def test_only_posts_of_the_author_are_met_in_a_topic(spark):
    """Of the last 500 posts up to a bound, and of no earlier or later ones, those by the author."""
    at = "timestamp'2005-01-01' + make_interval(0, 0, 0, 0, 0, cast(id as int))"
    posts = spark.range(1200).selectExpr("id as post_id", "7 as topic_id", "id % 3 as user_id", f"cast({at} as timestamp_ntz) as posted_at")
    bounds = spark.createDataFrame([("a", 7, 799), ("b", 7, None), ("c", 8, None)], "quote_id string, topic_id int, id int").selectExpr("quote_id", "topic_id", f"cast({at} as timestamp_ntz) as before")
    by_user = spark.createDataFrame([("a", 1, 2), ("b", 0, 1), ("c", 1, 2)], "quote_id string, user_id long, score int")
    by_post = spark.createDataFrame([("a", 5, 2), ("a", 300, 2), ("a", 600, 2), ("a", 601, 1)], "quote_id string, post_id long, score int")
    got = sorted(tuple(r) for r in quotes.latest_of_topic(bounds, posts, by_user, by_post).select("quote_id", "post_id").collect())
    last = 799 + quotes.SLACK
    a = {i for i in range(last - quotes.SCAN + 1, last + 1) if i % 3 == 1 or i in (600, 601)}
    assert got == sorted([("a", i) for i in a | ({300} if last - quotes.SCAN < 300 else set())] + [("b", i) for i in range(700, 1200) if i % 3 == 0])
