"""Page and payload extraction on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.operators.cleaning import usable_pages
from folkmeter.sources import listings, trees
from folkmeter.sources import pages as P
from folkmeter.sources import payloads as J

LISTING = """<body><ol>
<li><div>1. <a href="/u/mira?from=list">Mira</a> <em>12 posts</em> <b>KARMA 40.5k</b></div></li>
<li><div><a href="/u/oto#top">Oto</a><p>no number</p></div></li>
<li><div><p><a href="/u/mira">Mira once more</a> 3 karma</p></div></li>
<li><section><a href="/u/zed">Zed</a></section></li></ol>
<p>karma is counted daily</p><a href="/m/garden">a place</a></body>"""

PROFILE = """<html><head><style>i{karma:9}</style><script>var karma = "7 karma";</script></head><body>
<p>A notice before the name.</p><header><h1>Mira <small>online</small></h1></header>
<article><p>Grows &lt;tomatoes&gt; on a balcony</p><p>second line</p></article>
<table><tr><td>JOINED 30/11/2023 </td><td> 18 follower </td><td>1.25M Following</td></tr></table>
<p>Karma: 6k</p><a href="https://twitter.com/@mira_keeper/">keeper</a></body></html>"""

PLAIN = """<body><h1>bob</h1><p>A social network for agents</p><div class="description">own words</div>
karma: 77</body>"""

BLOCK = """<body><a href="https://x.com/site_team">team</a>
<div class="flex items-start gap-4 wide"><div class="flex-1">
<div><h1>ada</h1></div><p class="mt-1">hello there</p>
<div class="flex flex-wrap mt-3"><div class="text-sm"><span class="font-bold">1.5K</span> karma</div>
<div class="text-sm"><span class="font-bold">12</span> followers</div>
<div class="text-sm"><span class="font-bold">3</span> following</div>
<div class="text-sm">Joined 2/3/2024</div></div>
<div class="mt-4 pt-4 border-t"><span class="text-white">Owner Name</span></div></div></div></body>"""

LOOSE = """<body><a href="https://x.com/site_team">team</a><p class="mt-1">the social network</p>
<p class="text-gray-400">bio two</p><a href="https://twitter.com/@real">o</a>
<span>42 karma</span> Joined March Online</body>"""

CARDS = """<body><a href="/post/abc"><h3>First <b>one</b></h3><p class="x line-clamp-3">text</p>
<div class="text-xs">m/town <span class="hover:underline">u/ann</span> 2d ago</div>
<span class="text-white font-bold">128</span></a>
<a href="/post/notitle"><p>no heading</p></a>
<a href="https://x.org/m/other">out</a>
<a href="/post/def"><h3>Second</h3><div class="text-xs">now</div><span class="text-white font-bold">many</span></a>
<a href="/post/ghi"><h3>Third</h3></a></body>"""

TALK = """<body><div class="mt-6"><h2>3 comments</h2>
<div class="py-2"><div class="flex items-center gap-2 text-xs"><a href="/u/ann">u/ann</a><span>3h ago</span></div>
<div class="prose prose-invert"><p>hello <i>you</i></p></div>
<span class="flex items-center gap-1"><b>^</b><span>5</span></span>
  <div class="py-2"><div class="flex items-center gap-2 text-xs"><a href="/u/bob">u/bob</a></div>
  <div class="prose-invert"><p>reply</p></div></div></div>
<div class="py-2"><div class="prose-invert"><p>nobody wrote this</p></div></div></div>
<div class="py-2"><a href="/u/out">outside</a><div class="prose-invert"><p>outside</p></div></div></body>"""


def pages(spark, **named):
    rows = [(f"https://x.org{path}", html) for path, html in named.items()]
    return spark.createDataFrame(rows, "url string, html string")


def at(spark, path, html):
    return spark.createDataFrame([(f"https://x.org{path}", html)], "url string, html string")


NOW = "2024-03-10 01:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def test_user_listing(spark):
    rows = P.user_listing(at(spark, "/u", LISTING)).orderBy("pos").collect()
    assert [(r.name, r.karma, r.profile_url) for r in rows] == [
        ("mira", 40_500, "/u/mira?from=list"),
        ("oto", 0, "/u/oto#top"),
        ("zed", 0, "/u/zed"),
    ]


def test_community_listing(spark):
    html = """<div><a href="/m/a">a</a><p> about <b>a</b></p></div><div><a href="/m/b">b</a></div>
    <a href="/m/a">again</a>"""
    rows = P.community_listing(at(spark, "/m", html)).orderBy("pos").collect()
    assert [(r.name, r.description, r.page_url) for r in rows] == [
        ("a", "abouta", "/m/a"),
        ("b", None, "/m/b"),
    ]


def test_profiles(spark):
    row = P.profiles(at(spark, "/u/mira?tab=posts", PROFILE)).first()
    assert (row.name, row.karma, row.description) == ("mira", 6000, "Grows <tomatoes> on a balcony")
    assert (row.human_owner, row.joined) == ("@mira_keeper", "30/11/2023")
    assert (row.followers, row.following) == (18, 1_250_000)
    other = P.profiles(at(spark, "/u/bob", PLAIN)).first()
    assert (other.description, other.karma, other.human_owner, other.joined) == ("own words", 77, None, None)


def test_profiles_by_block(spark):
    row = P.profiles_by_block(at(spark, "/u/ada", BLOCK), ("site_team",)).first()
    assert (row.karma, row.followers, row.following, row.joined) == (1500, 12, 3, "2/3/2024")
    assert (row.description, row.human_owner) == ("hello there", "Owner Name")
    loose = P.profiles_by_block(at(spark, "/u/bob", LOOSE), ("site_team",)).first()
    assert (loose.karma, loose.followers, loose.human_owner) == (42, 0, "@real")
    assert (loose.description, loose.joined) == ("bio two", "March")
    team = P.profiles_by_block(at(spark, "/u/bob", LOOSE)).first()
    assert team.human_owner == "site_team"


def test_posts(spark):
    rows = P.posts_on_pages(at(spark, "/m/town", CARDS), now()).orderBy("pos").collect()
    assert [(r.title, r.description, r.author, r.rating, r.date) for r in rows] == [
        ("Firstone", "text", "ann", 128, "2024-03-08"),
        ("Second", None, None, 0, "2024-03-10"),
        ("Third", None, None, 0, None),
    ]
    assert {r.community for r in rows} == {"town"} and rows[0].post_url == "/post/abc"
    assert P.posts_on_pages(at(spark, "/m/town", CARDS), now(), max_posts=2).count() == 2


def test_comments(spark):
    rows = P.comments_on_pages(at(spark, "/post/abc", TALK), now()).orderBy("pos").collect()
    assert [(r.author, r.description, r.rating, r.date) for r in rows] == [
        ("ann", "helloyou", 5, "2024-03-09"),
        ("bob", "reply", 0, None),
    ]


def test_description_and_refs(spark):
    meta = '<meta name="description" content="from meta">'
    cases = {
        "/m/a": meta,
        "/m/b": meta + '<p class="description big"> from <b>page</b></p>',
        "/m/c": '<div class="about"></div><p class="text-gray-400">later</p>',
        "/m/d": '<p class="text-gray-400">grey</p>',
        "/m/e": "<p class='descriptions'>no</p>",
    }
    frame = spark.createDataFrame(list(cases.items()), "url string, html string")
    got = {r.url: r.d for r in frame.select("url", P.page_description(F.col("html")).alias("d")).collect()}
    assert got == {"/m/a": "from meta", "/m/b": "from page", "/m/c": "", "/m/d": "grey", "/m/e": None}
    html = 'x /m/town y href="/m/null" /m/a /m/big-city_1. /m/create/ /m/town'
    refs = P.page_refs(at(spark, "/", html)).collect()
    assert {r.name for r in refs} == {"town", "big-city_1"}


def test_visible_text(spark):
    html = "<html><script>var t='</p>';</script><!-- c --><p>a &lt;b&gt;</p>c<br/>d &amp;amp;</html>"
    assert at(spark, "/", html).select(P.visible_text(F.col("html"))).first()[0] == "a <b>cd &amp;"


def test_refused_pages(spark):
    frame = spark.createDataFrame(
        [("a", "<p>ok</p>"), ("b", "Rate limit exceeded, wait"), ("c", None)], "url string, html string"
    )
    assert [r.url for r in usable_pages(frame).collect()] == ["a"]


def test_broken_pages_give_nothing(spark):
    frame = spark.createDataFrame([("https://x.org/u", "<div><a href='/u/"), ("https://x.org/u2", None)], "url string, html string")
    assert P.user_listing(frame).count() == 0
    assert P.comments_on_pages(frame, now()).count() == 0


# --- payloads -----------------------------------------------------------------------


def bodies(spark, schema, *rows):
    return spark.createDataFrame([(k, b if isinstance(b, str) else json.dumps(b)) for k, b in rows], schema)


def no_users(spark):
    return schemas.empty_table(spark, "users")


def test_listing_payloads(spark):
    frame = bodies(
        spark,
        "offset bigint, body string",
        (0, {"communities": [{"name": "a"}, {"name": None}, {"x": 1}], "count": 5}),
        (3, {"communities": [{"name": "b"}]}),
        (4, {"communities": []}),
        (9, "{broken"),
    )
    rows = J.listing_names(frame).orderBy("pos").collect()
    assert [(r.pos, r.name) for r in rows] == [(0, "a"), (3, "b")]


def test_community_payloads(spark):
    post = {"id": 7, "title": "t", "content": "c", "upvotes": 5, "downvotes": None, "created_at": "2024-01-02T03", "author": {"name": "Ann"}}
    good = {"success": True, "community": {"description": "d"}, "posts": [post, {**post, "author": None}, {"url": "/x", "author": {"name": "b"}, "downvotes": 2}]}
    frame = bodies(spark, "name string, body string", ("one", good), ("two", {"success": False, "posts": [post]}), ("three", "no json"))
    listed = J.posts_in_payloads(frame)
    rows = J.post_rows(listed, no_users(spark), F.lit("s")).orderBy("rating").collect()
    assert [(r.rating, r.date, r.description) for r in rows] == [(-2, None, None), (5, "2024-01-02", "c")]
    assert rows[1].id_post == "7"
    assert J.posts_in_payloads(frame, max_posts=2).count() == 1
    assert [r.name for r in J.community_rows(frame, F.lit("s")).collect()] == ["one"]


def listing_rows(*pages):
    """(listing, offset, landed_at, body) with items named after their place."""
    for listing, offset, n, landed in pages:
        items = [{"name": f"{listing}{offset + i}"} for i in range(n)] if n is not None else None
        yield listing, offset, landed, json.dumps({"communities": items}) if items is not None else "refused"


LISTINGS = [
    ("full", 0, 3, 1), ("full", 3, 3, 1), ("full", 6, 2, 1), ("full", 9, 3, 1),  # short, then one too many
    ("gap", 0, 3, 1), ("gap", 6, 3, 1), ("gap", 9, 1, 1),
    ("empty", 0, 3, 1), ("empty", 3, 0, 1), ("empty", 6, 3, 1),
    ("broken", 0, 3, 1), ("broken", 3, None, 1), ("broken", 6, 3, 1),
    ("again", 3, 3, 1), ("again", 0, 3, 2), ("again", 0, 3, 1), ("again", 0, 3, 2), ("again", 6, 1, 1),
    ("lap", 0, 3, 1), ("lap", 2, 3, 1), ("lap", 1, 3, 1), ("lap", 5, 3, 1),
    ("late", 3, 3, 1),
]


def test_listings_from_pages(spark):
    frame = spark.createDataFrame(list(listing_rows(*LISTINGS)), "listing string, offset bigint, landed_at int, body string").repartition(4)
    pages = listings.listing_pages(frame, 3)
    status = {(r.listing, r.offset): r.status for r in pages.collect()}
    want = {
        ("full", 0): "accepted", ("full", 3): "accepted", ("full", 6): "accepted", ("full", 9): "after_end",
        ("gap", 0): "accepted", ("gap", 6): "after_gap", ("gap", 9): "after_gap",
        ("empty", 0): "accepted", ("empty", 3): "accepted", ("empty", 6): "after_end",
        ("broken", 0): "accepted", ("broken", 6): "after_gap",
        ("again", 0): "accepted", ("again", 3): "accepted", ("again", 6): "accepted",
        ("lap", 0): "accepted", ("lap", 1): "accepted", ("lap", 2): "accepted", ("lap", 5): "accepted",
        ("late", 3): "after_gap",
    }
    assert status == want
    gaps = {(r.listing, r.gap_from, r.gap_to, r.pages_refused) for r in listings.listing_gaps(pages).collect()}
    assert gaps == {("gap", 3, 6, 2), ("broken", 3, 6, 1), ("late", 0, 3, 1)}
    names = {}
    for r in listings.listed_names(frame, pages).orderBy("listing", "pos").collect():
        names.setdefault(r.listing, []).append(r.pos)
    assert names == {"full": list(range(8)), "gap": [0, 1, 2], "empty": [0, 1, 2], "broken": [0, 1, 2], "again": list(range(7)), "lap": list(range(8))}


def test_profile_payloads(spark):
    agent = {"karma": 4, "description": "d", "follower_count": 2, "created_at": "2024-01-02T", "owner": {"x_handle": ""}}
    frame = bodies(spark, "name string, body string", ("Ann", {"success": True, "agent": agent}), ("b", {"success": True}), ("c", {"success": False, "agent": agent}))
    row = J.profile_rows(frame, F.lit("s")).collect()
    assert [(r.name, r.karma, r.followers, r.following, r.human_owner, r.joined) for r in row] == [("Ann", 4, 2, 0, None, "2024-01-02")]


def chain(depth):
    node = {"author": {"name": f"a{depth}"}, "content": f"c{depth}", "replies": []}
    for i in range(depth - 1, 0, -1):
        node = {"author": {"name": f"a{i}"}, "content": f"c{i}", "replies": [node]}
    return node


def test_flatten_replies(spark):
    tree = {"comments": [chain(7), {"author": {"name": "z"}, "content": "last"}]}
    frame = bodies(spark, "id_post string, body string", ("p", tree), ("q", {"comments": []}), ("r", "bad"))
    rows = J.flatten_replies(frame).orderBy("id_post", "path").collect()
    assert [r.content for r in rows] == [f"c{i}" for i in range(1, 8)] + ["last"]
    assert [r.depth for r in rows] == [1, 2, 3, 4, 5, 6, 7, 1]


@pytest.mark.parametrize("depth", [200, 2_000])
def test_deep_trees_are_read_once(spark, depth):
    """No stored rounds, no shuffle."""
    link = '{"author":{"name":"a"},"content":"c \\" ]","upvotes":%d,"replies":[1,'
    body = '{"comments":[' + "".join(link % i for i in range(depth)) + '{"content":"leaf"}' + "]}" * depth + "]}"
    frame = spark.createDataFrame([(7, body), (8, body[:-1]), (9, None)], "id_post bigint, body string")
    flat = J.flatten_replies(frame)
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    rows = flat.select("id_post", "depth", "upvotes", "content", F.col("path")[0].alias("a"), F.element_at("path", -1).alias("z")).orderBy("depth").collect()
    assert [r.depth for r in rows] == list(range(1, depth + 2)) and {r.id_post for r in rows} == {7}
    assert [r.upvotes for r in rows] == [*range(depth), None] and rows[-1].content == "leaf"
    assert rows[0].z == 0 and {r.z for r in rows[1:]} == {1} and rows[3].content == 'c " ]'


def test_tree_values_keep_their_kinds(spark):
    node = {"author": {"name": 5}, "content": {"a": [1, "é"]}, "upvotes": "3", "downvotes": 2.5, "created_at": None}
    tree = {"comments": [node, None, "text", {"author": "x", "upvotes": 1 << 70, "replies": {"no": "list"}}]}
    rows = J.flatten_replies(bodies(spark, "id_post string, body string", ("p", tree), ("q", [1]), ("r", {"comments": 1}))).collect()
    assert [r.path for r in rows] == [[0], [3]]
    assert (rows[0].author, rows[0].content, rows[0].upvotes, rows[0].downvotes) == ("5", '{"a":[1,"é"]}', None, None)
    assert (rows[1].author, rows[1].upvotes) == (None, None)


def test_deep_parser_equals_the_library():
    tree, depth = trees.parse('{"r":[' * 30_000 + "]}" * 30_000), 0
    while tree["r"]:
        tree, depth = tree["r"][0], depth + 1
    assert depth == 29_999
    good = ['[]', '{}', ' [1, {"a": [true, null, "x\\u00e9 ,]"]}, -1.5e3] ', '"s"', '12', '{"a":{"b":{}},"c":[[],[{}]]}']
    for text in good:
        assert trees.loads_deep(text) == json.loads(text)
    for text in ['[', ']', '{"a"}', '[1 2]', '[,]', '{"a":1,}', '[1,]', '{1:2}', '"a', '[1]]', 'nul', '', '{"a":}', '[}', '{"a" 1}']:
        with pytest.raises(ValueError):
            trees.loads_deep(text)


def test_comment_rows(spark):
    tree = {"comments": [chain(3), {"content": "no author"}, {"author": {"name": "A1"}, "content": "c9", "upvotes": 3, "downvotes": 1}]}
    frame = bodies(spark, "id_post string, body string", ("p", tree))
    rows = J.comment_rows(frame, no_users(spark), F.lit("s")).orderBy("path").collect()
    assert [r.description for r in rows] == ["c1", "c2", "c3", "c9"]
    assert rows[0].id_user == rows[3].id_user and rows[3].rating == 2
    cut = J.comment_rows(frame, no_users(spark), F.lit("s"), max_comments=4)
    assert cut.count() == 3  # the fourth comment has no author


def test_pages_of_one_partition_are_spread(spark):
    pages = spark.createDataFrame([(f"https://x.org/u?page={i}", LISTING) for i in range(40)], "url string, html string")
    found = P.user_listing(pages.coalesce(1))
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert found.count() == P.user_listing(pages.repartition(16)).count() == 3 * 40


def test_pages_stay_in_arrow_and_all_their_texts_are_counted(spark):
    pages = spark.createDataFrame([("https://x.org/u/a", BLOCK), ("https://x.org/u/b", None)], "url string, html string")
    rows = P.extract(pages, "profile_blocks")
    assert "MapInArrow" in rows._jdf.queryExecution().optimizedPlan().toString()
    first = rows.filter("url like '%a'").first()
    assert first.bios[0] == "hello there" and first.stats[1].number == "12" and len(first.other_hrefs) == 1
    assert P._chars({"bios": ["ab", None], "stats": [{"line": "cde", "number": None}], "has_section": True}) == 5
