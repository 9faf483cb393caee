"""Stand-ins for the governance and forum payload jobs.

Payloads are built from the driver tables with ``to_json`` and flattened by the
library; the oracle computes the flat truth straight from the tables.  Every
payload groups a bounded number of rows (one nation, one order, one page of 50
or 100 customers, one conversation), never a whole table.

* spaces ← nation; proposals ← orders; votes ← lineitem; follows ← customer
* profile and directory pages ← customer (pages of 50 ids); overlapping pages of
  100 ids with a 10-id overlap ← customer
* categories ← region with its nations as subcategories
* topics, posts, polls, likes ← conversations (topic = conversation, post = turn);
  topic headers carry aggregates only, posts come in pages of 20, likes in pages of 30
* trades with protocol fees ← one fill per (order, line number), its lineitems as fees
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import joins as J
from quayside.operators import metrics as M
from quayside.operators import payloads as P
from quayside.registry.base import register, src

SPACE = "default.eth"
PROJECT = "p1"


def _unix(c):
    return F.unix_seconds(F.col(c).cast("timestamp"))


def _one(struct_col):
    """A page holding a single element (JSON array of one)."""
    return F.to_json(F.array(struct_col))


# --------------------------------------------------------------------------- #
# Snapshot spaces / proposals / votes / follows
# --------------------------------------------------------------------------- #


@register(
    "snapshot_space_rows",
    f"""SELECT CASE WHEN n_nationkey = 0 THEN '{SPACE}' ELSE lower(n_name) END AS space_id, n_name AS name,
       CAST(n_regionkey + 1 AS VARCHAR) AS network, substr(n_name, 1, 3) AS symbol,
       CAST(n_nationkey * 2 AS BIGINT) AS proposals_count, CAST(n_regionkey AS BIGINT) AS followers_count,
       CAST(0 AS BIGINT) AS votes_count,
       '{{"id":"' || CASE WHEN n_nationkey = 0 THEN '' ELSE lower(n_name) END || '","name":"' || n_name || '","network":' || (n_regionkey + 1)
         || ',"symbol":"' || substr(n_name, 1, 3) || '","proposalsCount":' || (n_nationkey * 2) || ',"followersCount":' || n_regionkey
         || ',"strategies":[]}}' AS raw_json
FROM nation""",
)
def snapshot_space_rows(spark, sf):
    n = src(spark, sf, "nation")
    body = F.to_json(F.struct(
        F.when(F.col("n_nationkey") == 0, F.lit("")).otherwise(F.lower("n_name")).alias("id"),
        F.col("n_name").alias("name"), (F.col("n_regionkey") + 1).alias("network"),
        F.substring("n_name", 1, 3).alias("symbol"), (F.col("n_nationkey") * 2).alias("proposalsCount"),
        F.col("n_regionkey").alias("followersCount"), F.array().cast("array<string>").alias("strategies"),
    ))
    return P.snapshot_space_rows(n.select(body.alias("body")), SPACE)


_STATE = "CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'pending' ELSE 'closed' END"


def _state():
    return F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "P", "pending").otherwise("closed")


@register(
    "snapshot_proposals_rows",
    f"""SELECT 'prop-' || CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderpriority = '5-LOW' THEN '{SPACE}' ELSE 'orders.eth' END AS space_id,
       o_orderpriority AS title, {_STATE} AS state, 'single-choice' AS type, '0x' || CAST(o_custkey AS VARCHAR) AS author,
       '' AS discussion, o_orderdate AS created_at, o_orderdate + INTERVAL 1 HOUR AS start_at,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN TIMESTAMP '1970-01-01'
            ELSE o_orderdate + INTERVAL 7 DAY END AS end_at,
       o_orderkey * 10 AS snapshot_block, o_totalprice AS scores_total, 0.0::DOUBLE AS quorum,
       o_custkey AS votes_count, 'final' AS scores_state,
       '{{"id":"prop-' || o_orderkey || '","title":"' || o_orderpriority || '","state":"' || {_STATE} || '","type":"single-choice","author":"0x'
         || o_custkey || '","created":' || epoch(o_orderdate)::BIGINT || ',"start":' || (epoch(o_orderdate)::BIGINT + 3600) || ',"end":'
         || CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN -5 ELSE epoch(o_orderdate)::BIGINT + 604800 END
         || ',"snapshot":' || (o_orderkey * 10) || ',"scores_total":' || o_totalprice || ',"votes":' || o_custkey || ',"scores_state":"final","space":{{'
         || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '"id":"orders.eth"' END || '}}}}' AS raw_json
FROM orders""",
)
def snapshot_proposals_rows(spark, sf):
    o = src(spark, sf, "orders", spread=True)
    created = _unix("o_orderdate")
    prop = F.struct(
        F.concat(F.lit("prop-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("title"), _state().alias("state"), F.lit("single-choice").alias("type"),
        F.concat(F.lit("0x"), F.col("o_custkey").cast("string")).alias("author"),
        created.alias("created"), (created + 3600).alias("start"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), F.lit(-5))
        .otherwise(created + 7 * 86400).alias("end"),
        (F.col("o_orderkey") * 10).alias("snapshot"), F.col("o_totalprice").alias("scores_total"),
        F.col("o_custkey").alias("votes"), F.lit("final").alias("scores_state"),
        F.struct(F.when(F.col("o_orderpriority") != "5-LOW", F.lit("orders.eth")).alias("id")).alias("space"),
    )
    return P.snapshot_proposals_rows(o.select(_one(prop).alias("body")), SPACE)


@register(
    "snapshot_votes_rows",
    f"""SELECT 'v-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       'prop-' || CAST(l_orderkey AS VARCHAR) AS proposal_id, '{SPACE}' AS space_id,
       '0x' || CAST(l_suppkey AS VARCHAR) AS voter, l_shipdate AS created_at, l_quantity AS vp, 'final' AS vp_state,
       '{{"id":"v-' || l_orderkey || '-' || l_linenumber || '","voter":"0x' || l_suppkey || '","created":' || epoch(l_shipdate)::BIGINT
         || ',"vp":' || l_quantity || ',"vp_state":"final","proposal":{{"id":"prop-' || l_orderkey || '"}}}}' AS raw_json
FROM lineitem""",
)
def snapshot_votes_rows(spark, sf):
    li = src(spark, sf, "lineitem", spread=True)
    vote = F.struct(
        F.concat(F.lit("v-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("id"),
        F.concat(F.lit("0x"), F.col("l_suppkey").cast("string")).alias("voter"),
        _unix("l_shipdate").alias("created"), F.col("l_quantity").alias("vp"), F.lit("final").alias("vp_state"),
        F.struct(F.concat(F.lit("prop-"), F.col("l_orderkey").cast("string")).alias("id")).alias("proposal"),
    )
    return P.snapshot_votes_rows(li.select(_one(vote).alias("body")), SPACE)


@register(
    "snapshot_follows_rows",
    """SELECT 'f-' || CAST(c_custkey AS VARCHAR) AS id, '0x' || CAST(c_custkey AS VARCHAR) AS follower,
       lower(c_mktsegment) AS space_id, TIMESTAMP '2020-01-01' + to_hours(c_custkey) AS created_at,
       '{"id":"f-' || c_custkey || '","follower":"0x' || c_custkey || '","created":' || (1577836800 + c_custkey * 3600)
         || ',"space":{"id":"' || lower(c_mktsegment) || '"}}' AS raw_json
FROM customer""",
)
def snapshot_follows_rows(spark, sf):
    c = src(spark, sf, "customer")
    follow = F.struct(
        F.concat(F.lit("f-"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit("0x"), F.col("c_custkey").cast("string")).alias("follower"),
        (F.lit(1577836800) + F.col("c_custkey") * 3600).alias("created"),
        F.struct(F.lower("c_mktsegment").alias("id")).alias("space"),
    )
    return P.snapshot_follows_rows(c.select(_one(follow).alias("body")), SPACE)


# --------------------------------------------------------------------------- #
# Overlapping pages
# --------------------------------------------------------------------------- #


def customer_pages(spark, sf):
    """Pages of 100 customer ids; the last 10 ids of each page are served again,
    with a changed balance, at the head of the next page."""
    c = src(spark, sf, "customer")
    page = F.floor(F.col("c_custkey") / 100)
    base = c.select(page.alias("page_no"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    again = c.filter(F.col("c_custkey") - page * 100 >= 90).select(
        (page + 1).alias("page_no"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") + 1).alias("acctbal")
    )
    rows = base.unionByName(again)
    pages = rows.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("id", "name", "acctbal"))).alias("items"))
    return pages.select(F.lit("customer").alias("entity"), "page_no", F.to_json("items").alias("body"))


_PAGES_SQL = """WITH rows AS (
  SELECT c_custkey // 100 AS page_no, c_custkey AS id, c_name AS name, c_acctbal AS acctbal FROM customer
  UNION ALL
  SELECT c_custkey // 100 + 1, c_custkey, c_name, c_acctbal + 1 FROM customer WHERE c_custkey - (c_custkey // 100) * 100 >= 90
),
positioned AS (SELECT 'customer' AS entity, page_no, CAST(row_number() OVER (PARTITION BY page_no ORDER BY id) - 1 AS INTEGER) AS pos, id, name, acctbal FROM rows)"""

_ELEMENT = "struct<id: bigint, name: string, acctbal: double>"


def _landed(spark, sf):
    rows, _ = P.landed_pages(customer_pages(spark, sf), _ELEMENT)
    return rows.select("entity", "page_no", "pos", "e.id", "e.name", "e.acctbal")


@register("landed_pages", _PAGES_SQL + "\nSELECT * FROM positioned")
def landed_pages(spark, sf):
    """Page payloads → one row per element, page and position kept."""
    return _landed(spark, sf)


@register(
    "landed_rejects",
    """SELECT 'orders' AS entity, CAST(o_orderkey AS VARCHAR) AS page, CAST(CASE WHEN o_orderkey % 5 = 3 THEN 1 END AS INTEGER) AS pos,
       CASE o_orderkey % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'errors' WHEN 2 THEN 'empty' WHEN 3 THEN 'not_an_object' END AS reason, CAST(NULL AS BIGINT) AS id
FROM orders WHERE o_orderkey % 5 < 4
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), p, NULL, o_orderkey * 10 + p FROM orders, (SELECT unnest([0, 1]) AS p)
WHERE o_orderkey % 5 = 4 OR (o_orderkey % 5 = 3 AND p = 0)""",
)
def landed_rejects(spark, sf):
    """Pages of two elements, of which some are cut off, error answers, empty, or hold
    a bare number: the rows of what can be read beside the rejects."""
    o = src(spark, sf, "orders")
    good = F.to_json(F.array(F.struct((F.col("o_orderkey") * 10).alias("id")), F.struct((F.col("o_orderkey") * 10 + 1).alias("id"))))
    kind = F.col("o_orderkey") % 5
    body = (F.when(kind == 0, F.substring(good, F.lit(1), F.length(good) - 3)).when(kind == 1, F.lit('{"errors":[{"message":"busy"}]}'))
            .when(kind == 2, F.lit(" ")).when(kind == 3, F.concat(F.lit("["), F.to_json(F.struct((F.col("o_orderkey") * 10).alias("id"))), F.lit(",7]"))).otherwise(good))
    pages = o.select(F.lit("orders").alias("entity"), F.col("o_orderkey").alias("page_no"), body.alias("body"))
    rows, rejects = P.landed_pages(pages, "struct<id: bigint>")
    read = rows.select("entity", F.col("page_no").cast("string").alias("page"), "pos", F.lit(None).cast("string").alias("reason"), F.col("e.id"))
    return rejects.select("entity", "page", "pos", "reason", F.lit(None).cast("bigint").alias("id")).unionAll(read)


@register(
    "dedupe_pages_by_id",
    _PAGES_SQL + "\nSELECT id, page_no, pos, name, acctbal FROM positioned QUALIFY row_number() OVER (PARTITION BY id ORDER BY page_no, pos) = 1",
)
def dedupe_pages_by_id(spark, sf):
    """Overlapping pages: the first occurrence of each id wins."""
    return P.dedupe_pages_by_id(_landed(spark, sf), "id", value_cols=("name", "acctbal"))


def _bucket_pages(df, items):
    return df.groupBy(F.floor(F.col("c_custkey") / 50).alias("page_no")).agg(F.collect_list(items).alias("items"))


@register(
    "profiles_rows",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS distinct_id, '{PROJECT}' AS project_id, c_mktsegment AS segment
FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def profiles_rows(spark, sf):
    """Profile pages → (distinct id, project, properties); profiles without an id dropped."""
    c = src(spark, sf, "customer")
    item = F.struct(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_custkey").cast("string")).alias("$distinct_id"),
        F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("$properties"),
    )
    pages = _bucket_pages(c, item).select(
        F.to_json(F.struct(F.lit("s1").alias("session_id"), F.size("items").alias("total"), F.col("items").alias("results"))).alias("body")
    )
    rows = P.profiles_rows(pages, PROJECT)
    return rows.select("distinct_id", "project_id", F.get_json_object("properties", "$.segment").alias("segment"))


# --------------------------------------------------------------------------- #
# Forum categories and users
# --------------------------------------------------------------------------- #


@register(
    "category_tree_flatten",
    """WITH subs AS (
  SELECT *, '{"id":' || n_nationkey || ',"parent_category_id":' || (n_regionkey + 1000) || ',"name":"' || n_name || '","slug":"'
    || lower(replace(n_name, ' ', '-')) || '","topic_count":' || n_regionkey || ',"post_count":' || (n_nationkey * 3)
    || ',"description_text":"nation ' || n_name || '"}' AS raw FROM nation)
SELECT CAST(r_regionkey + 1000 AS BIGINT) AS id, CAST(-1 AS BIGINT) AS parent_id, r_name AS name, lower(r_name) AS slug,
       (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS topic_count, CAST(0 AS BIGINT) AS post_count,
       'region ' || r_name AS description,
       '{"id":' || (r_regionkey + 1000) || ',"name":"' || r_name || '","slug":"' || lower(r_name) || '","topic_count":'
         || (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) || ',"description":"region ' || r_name || '","subcategory_list":['
         || coalesce((SELECT string_agg(raw, ',' ORDER BY n_nationkey) FROM subs WHERE n_regionkey = r_regionkey), '') || ']}' AS raw_json
FROM region
UNION ALL
SELECT n_nationkey, n_regionkey + 1000, n_name, lower(replace(n_name, ' ', '-')), n_regionkey, CAST(n_nationkey * 3 AS BIGINT),
       'nation ' || n_name, raw
FROM subs""",
)
def category_tree_flatten(spark, sf):
    """Parents first, then each subcategory; root parents get −1."""
    r = src(spark, sf, "region")
    n = src(spark, sf, "nation")
    sub = n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 1000).alias("parent_category_id"),
        F.col("n_name").alias("name"), F.lower(F.regexp_replace("n_name", " ", "-")).alias("slug"),
        F.col("n_regionkey").alias("topic_count"), (F.col("n_nationkey") * 3).alias("post_count"),
        F.concat(F.lit("nation "), F.col("n_name")).alias("description_text"),
    ))).alias("subs"))
    cat = r.join(sub, r.r_regionkey == sub.n_regionkey, "left").select(F.struct(
        (F.col("r_regionkey") + 1000).alias("id"), F.col("r_name").alias("name"), F.lower("r_name").alias("slug"),
        F.coalesce(F.size("subs"), F.lit(0)).alias("topic_count"),
        F.concat(F.lit("region "), F.col("r_name")).alias("description"),
        F.coalesce(F.col("subs"), F.array()).alias("subcategory_list"),
    ).alias("cat"))
    body = F.to_json(F.struct(F.struct(F.array("cat").alias("categories")).alias("category_list")))
    return P.category_tree_flatten(cat.select(body.alias("body")))


@register(
    "forum_users_rows",
    """SELECT c_custkey AS id, lower(replace(c_name, '#', '_')) AS username, c_name AS name,
       CAST(c_nationkey AS BIGINT) AS trust_level, CAST(c_nationkey AS BIGINT) AS likes_received,
       CAST(floor(c_acctbal / 100) AS BIGINT) AS likes_given, c_custkey AS post_count,
       CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE c_nationkey END AS BIGINT) AS topic_count,
       CAST(0 AS BIGINT) AS days_visited,
       '{"user":{"id":' || c_custkey || ',"username":"' || lower(replace(c_name, '#', '_')) || '","name":"' || c_name || '","trust_level":' || c_nationkey
         || '},"likes_received":' || c_nationkey || ',"likes_given":' || CAST(floor(c_acctbal / 100) AS BIGINT) || ',"post_count":' || c_custkey
         || ',"topic_count":"' || CASE WHEN c_mktsegment = 'MACHINERY' THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END || '"}' AS raw_json
FROM customer""",
)
def forum_users_rows(spark, sf):
    """Directory pages → user counters (lenient integers: text 'n/a' → 0)."""
    c = src(spark, sf, "customer")
    item = F.struct(
        F.struct(F.col("c_custkey").alias("id"), F.lower(F.regexp_replace("c_name", "#", "_")).alias("username"),
                 F.col("c_name").alias("name"), F.col("c_nationkey").alias("trust_level")).alias("user"),
        F.col("c_nationkey").alias("likes_received"),
        F.floor(F.col("c_acctbal") / 100).cast("bigint").alias("likes_given"),
        F.col("c_custkey").alias("post_count"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string")).alias("topic_count"),
    )
    pages = _bucket_pages(c, item).select(F.to_json(F.struct(F.col("items").alias("directory_items"))).alias("body"))
    return P.forum_users_rows(pages)


# --------------------------------------------------------------------------- #
# Forum topics, posts, polls and likes from conversations
# --------------------------------------------------------------------------- #

_T0 = "2024-01-01 00:00:00"


def _iso(ts_col):
    return F.date_format(ts_col, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _conv_base(spark, sf):
    c = src(spark, sf, "conversations")
    created = F.lit(_T0).cast("timestamp") + F.make_interval(hours=F.col("conv_id").cast("int"))
    return c.select("*", created.alias("_created"))


def _post_struct():
    at = F.col("_created") + F.make_interval(mins=F.col("turn").cast("int"))
    like = F.when(F.col("role") == "system", F.array(F.struct(F.lit(3).alias("id"), F.lit(5).alias("count")))).otherwise(
        F.array(F.struct(F.lit(1).alias("id"), F.lit(9).alias("count")),
                F.struct(F.lit(2).alias("id"), F.size(F.split("text", " ")).alias("count")))
    )
    options = F.array(
        F.struct(F.lit("o1").alias("id"), F.lit("yes").alias("html"), F.size(F.split("text", r"\.")).alias("votes")),
        F.struct(F.lit("o2").alias("id"), F.lit("no").alias("html"), F.lit(None).cast("int").alias("votes")),
        F.struct(F.lit("").alias("id"), F.lit("skip").alias("html"), F.lit(1).alias("votes")),
    )
    poll = F.struct(
        F.col("turn").alias("id"),
        F.when(F.col("turn") == 1, F.lit(None)).otherwise(F.concat(F.lit("poll"), F.col("turn").cast("string"))).alias("name"),
        F.lit("regular").alias("type"),
        F.when(F.length("text") > 500, F.lit("open")).otherwise(F.lit("closed")).alias("status"),
        F.lit("always").alias("results"), (F.col("turn") > 2).alias("public"),
        F.when(F.length("text") > 800, _iso(at + F.expr("INTERVAL 30 DAYS"))).alias("close"),
        F.floor(F.length("text") / 10).alias("voters"), options.alias("options"),
    )
    return F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.when(F.col("role") == "user", F.col("conv_id")).alias("topic_id"),
        (F.col("turn") + 1).alias("post_number"),
        F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2).otherwise(-1).alias("user_id"),
        F.col("role").alias("username"), _iso(at).alias("created_at"), _iso(at).alias("updated_at"),
        F.when(F.col("turn") > 0, F.col("turn")).alias("reply_to_post_number"), F.lit(0).alias("reply_count"),
        F.length("text").alias("reads"), F.col("text").alias("raw"), like.alias("actions_summary"),
        F.when(F.col("role") == "assistant", F.array(poll)).alias("polls"),
    )


POSTS_PER_PAGE = 20   # posts carried by one topic payload (the topic API's chunk size)
LIKES_PER_PAGE = 30   # actions per like-feed page


def topic_details(spark, sf):
    """One topic header per conversation: topic fields from per-topic aggregates
    (no post list), stream holding one id that never lands."""
    c = _conv_base(spark, sf)
    g = c.groupBy("conv_id", "_created").agg(
        F.count(F.lit(1)).alias("n"), F.max("turn").alias("max_turn"),
        F.sum(F.length("text")).alias("views"), F.count_if(F.col("role") == "assistant").alias("likes"),
        F.count_distinct("role").alias("participants"), F.array_sort(F.collect_set("role")).alias("tags"),
        F.count_if(F.col("role") == "system").alias("sys"),
    )
    stream = F.array(F.col("conv_id") * 1000 + 999)
    detail = F.struct(
        F.col("conv_id").alias("id"), F.concat(F.lit("conv "), F.col("conv_id").cast("string")).alias("title"),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("slug"),
        F.when(F.col("sys") > 0, F.col("sys")).alias("category_id"),
        F.col("n").alias("posts_count"), (F.col("n") - 1).alias("reply_count"), F.col("views"),
        F.col("likes").alias("like_count"), F.col("participants").alias("participant_count"), F.col("tags"),
        _iso(F.col("_created")).alias("created_at"),
        _iso(F.col("_created") + F.make_interval(mins=F.col("n").cast("int"))).alias("last_posted_at"),
        F.when(F.col("sys") == 0, _iso(F.col("_created") + F.make_interval(mins=F.col("max_turn").cast("int")))).alias("bumped_at"),
        (F.col("sys") > 0).alias("closed"), F.lit(False).alias("archived"), (F.col("n") > 8).alias("pinned"),
        F.struct(F.array().cast("array<string>").alias("posts"), stream.alias("stream")).alias("post_stream"),
    )
    return g.select(F.to_json(detail).alias("body"))


def post_pages(spark, sf):
    """Posts of each topic in pages of at most ``POSTS_PER_PAGE`` turns, each page
    listing its part of the post stream (so no payload grows with a thread)."""
    c = _conv_base(spark, sf)
    g = c.groupBy("conv_id", "_created", F.floor(F.col("turn") / POSTS_PER_PAGE).alias("_page")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn").alias("_k"), _post_struct().alias("p")))).alias("_posts"),
    )
    posts = F.transform("_posts", lambda x: x["p"])
    stream = F.transform("_posts", lambda x: x["p"]["id"])
    page = F.struct(F.col("conv_id").alias("id"), F.struct(posts.alias("posts"), stream.alias("stream")).alias("post_stream"))
    return g.select(F.to_json(page).alias("body"))


def topic_payloads(spark, sf):
    """Every landed topic payload: headers and post pages."""
    return topic_details(spark, sf).unionByName(post_pages(spark, sf))


def topic_stubs(spark, sf):
    """Latest-list stubs, present for conversations of 4+ turns."""
    c = _conv_base(spark, sf)
    g = c.groupBy("conv_id", "_created").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 4)
    return g.select(F.col("conv_id").cast("string").alias("id"), _iso(F.col("_created") + F.expr("INTERVAL 2 DAYS")).alias("bumped_at"))


_CONV_SQL = f"""WITH conv AS (
  SELECT conv_id, TIMESTAMP '{_T0}' + to_hours(conv_id) AS created, count(*) AS n, max(turn) AS max_turn,
         CAST(sum(length(text)) AS BIGINT) AS views, count(*) FILTER (WHERE role = 'assistant') AS likes,
         count(DISTINCT role) AS participants, list_sort(list(DISTINCT role)) AS tags,
         count(*) FILTER (WHERE role = 'system') AS sys
  FROM conversations GROUP BY conv_id
)"""


@register(
    "forum_topics_rows",
    _CONV_SQL + """
SELECT conv_id AS id, 'conv ' || CAST(conv_id AS VARCHAR) AS title, 'conv-' || CAST(conv_id AS VARCHAR) AS slug,
       CASE WHEN sys > 0 THEN sys ELSE -1 END AS category_id, n AS posts_count, n - 1 AS reply_count, views,
       likes AS like_count, participants AS participant_count, array_to_string(tags, ',') AS tags,
       created AS created_at, created + to_minutes(n) AS last_posted_at,
       CASE WHEN sys = 0 THEN created + to_minutes(max_turn)
            WHEN n >= 4 THEN created + INTERVAL 2 DAY
            ELSE created + to_minutes(n) END AS bumped_at,
       CASE WHEN sys > 0 THEN 1 ELSE 0 END AS closed, 0 AS archived, CASE WHEN n > 8 THEN 1 ELSE 0 END AS pinned,
       '{"id":' || conv_id || ',"title":"conv ' || conv_id || '","slug":"conv-' || conv_id || '"' || CASE WHEN sys > 0 THEN ',"category_id":' || sys ELSE '' END
         || ',"posts_count":' || n || ',"reply_count":' || (n - 1) || ',"views":' || views || ',"like_count":' || likes || ',"participant_count":' || participants
         || ',"tags":["' || array_to_string(tags, '","') || '"],"created_at":"' || strftime(created, '%Y-%m-%dT%H:%M:%S.000Z') || '","last_posted_at":"'
         || strftime(created + to_minutes(n), '%Y-%m-%dT%H:%M:%S.000Z') || '"'
         || CASE WHEN sys = 0 THEN ',"bumped_at":"' || strftime(created + to_minutes(max_turn), '%Y-%m-%dT%H:%M:%S.000Z') || '"' ELSE '' END
         || ',"closed":' || (sys > 0) || ',"archived":false,"pinned":' || (n > 8) || '}' AS raw_json
FROM conv""",
)
def forum_topics_rows(spark, sf):
    """Topic detail ⟕ list stub: bumped_at = detail → stub → last_posted_at; flags 0/1; tags joined."""
    return P.forum_topics_rows(topic_details(spark, sf), topic_stubs(spark, sf))


@register(
    "topic_stub_join",
    _CONV_SQL + """
SELECT conv_id AS id, CASE WHEN sys = 0 THEN created + to_minutes(max_turn)
            WHEN n >= 4 THEN created + INTERVAL 2 DAY ELSE created + to_minutes(n) END AS bumped_at
FROM conv""",
)
def topic_stub_join(spark, sf):
    """The stub join alone: detail ⟕ stub with the three-step bumped_at fallback."""
    from quayside.functions.coerce import iso_or_epoch

    d = topic_details(spark, sf).select(
        F.get_json_object("body", "$.id").cast("bigint").alias("id"),
        F.get_json_object("body", "$.bumped_at").alias("bumped_at"),
        F.get_json_object("body", "$.last_posted_at").alias("last_posted_at"),
    )
    stubs = topic_stubs(spark, sf).select(F.col("id").cast("bigint").alias("id"), "bumped_at")
    return J.topic_stub_join(d, stubs).select("id", iso_or_epoch("bumped_at").alias("bumped_at"))


_AT_SQL = f"strftime(TIMESTAMP '{_T0}' + to_hours(conv_id) + to_minutes(turn), '%Y-%m-%dT%H:%M:%S.000Z')"
# A poll's header, without the closing brace.
_POLL_SQL = f"""'{{"id":' || turn || CASE WHEN turn = 1 THEN '' ELSE ',"name":"poll' || turn || '"' END || ',"type":"regular","status":"'
  || CASE WHEN length(text) > 500 THEN 'open' ELSE 'closed' END || '","results":"always","public":' || (turn > 2)
  || CASE WHEN length(text) > 800
       THEN ',"close":"' || strftime(TIMESTAMP '{_T0}' + to_hours(conv_id) + to_minutes(turn) + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%S.000Z') || '"' ELSE '' END
  || ',"voters":' || (length(text) // 10)"""

_POSTS_SQL = f"""posts AS (
  SELECT conv_id * 1000 + turn AS id, conv_id AS topic_id, turn + 1 AS post_number,
         CAST(CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE -1 END AS BIGINT) AS user_id, role AS username,
         TIMESTAMP '{_T0}' + to_hours(conv_id) + to_minutes(turn) AS created_at,
         TIMESTAMP '{_T0}' + to_hours(conv_id) + to_minutes(turn) AS updated_at,
         CASE WHEN turn > 0 THEN turn ELSE 0 END AS reply_to_post_number, CAST(0 AS BIGINT) AS reply_count,
         length(text) AS reads,
         CASE WHEN role = 'system' THEN 0 ELSE len(string_split(text, ' ')) END AS like_count,
         text AS raw, '' AS cooked, role, text, turn, conv_id,
         '{{"id":' || (conv_id * 1000 + turn) || CASE WHEN role = 'user' THEN ',"topic_id":' || conv_id ELSE '' END || ',"post_number":' || (turn + 1)
           || ',"user_id":' || CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE -1 END || ',"username":"' || role
           || '","created_at":"' || stamp || '","updated_at":"' || stamp || '"' || CASE WHEN turn > 0 THEN ',"reply_to_post_number":' || turn ELSE '' END
           || ',"reply_count":0,"reads":' || length(text) || ',"raw":' || to_json(text)::VARCHAR || ',"actions_summary":'
           || CASE WHEN role = 'system' THEN '[{{"id":3,"count":5}}]'
                   ELSE '[{{"id":1,"count":9}},{{"id":2,"count":' || len(string_split(text, ' ')) || '}}]' END
           || CASE WHEN role = 'assistant' THEN ',"polls":[' || poll || ',"options":[{{"id":"o1","html":"yes","votes":' || len(string_split(text, '.'))
                || '}},{{"id":"o2","html":"no"}},{{"id":"","html":"skip","votes":1}}]}}]' ELSE '' END || '}}' AS raw_json
  FROM (SELECT *, {_AT_SQL} AS stamp, {_POLL_SQL} AS poll FROM conversations)
)"""


def _posts(spark, sf):
    return P.forum_posts_rows(topic_payloads(spark, sf))


@register(
    "forum_posts_rows",
    "WITH " + _POSTS_SQL + """
SELECT id, topic_id, post_number, user_id, username, created_at, updated_at, reply_to_post_number, reply_count,
       reads, like_count, raw, cooked, raw_json FROM posts""",
)
def forum_posts_rows(spark, sf):
    """Posts of each topic; like count = action 2; topic id falls back to the topic."""
    return _posts(spark, sf)


@register(
    "posts_still_missing",
    "SELECT DISTINCT conv_id AS topic_id, conv_id * 1000 + 999 AS post_id FROM conversations",
)
def posts_still_missing(spark, sf):
    """Stream ids of a topic that no landed post carries."""
    return P.posts_still_missing(topic_payloads(spark, sf), _posts(spark, sf))


_POLLS_SQL = f"""polls AS (
  SELECT conv_id * 1000 + turn AS post_id, conv_id AS topic_id, turn AS poll_id,
         CASE WHEN turn = 1 THEN 'poll' ELSE 'poll' || CAST(turn AS VARCHAR) END AS poll_name,
         'regular' AS poll_type, CASE WHEN length(text) > 500 THEN 'open' ELSE 'closed' END AS status,
         'always' AS results_visibility, CASE WHEN turn > 2 THEN 1 ELSE 0 END AS is_public,
         CASE WHEN length(text) > 800 THEN TIMESTAMP '{_T0}' + to_hours(conv_id) + to_minutes(turn) + INTERVAL 30 DAY END AS close_at,
         length(text) // 10 AS voters, o.option_id, o.option_html,
         CASE WHEN o.option_id = 'o1' THEN len(string_split(text, '.')) ELSE -1 END AS option_votes,
         {_POLL_SQL} || '}}' AS raw_json
  FROM conversations, (VALUES ('o1', 'yes'), ('o2', 'no')) o(option_id, option_html)
  WHERE role = 'assistant'
)"""


def _poll_rows(spark, sf):
    return P.forum_poll_options(topic_payloads(spark, sf))


@register("forum_poll_options", "WITH " + _POLLS_SQL + "\nSELECT * FROM polls")
def forum_poll_options(spark, sf):
    """One row per (post, poll, option); option without id skipped; withheld votes → −1."""
    return _poll_rows(spark, sf)


@register(
    "poll_openness",
    "WITH " + _POLLS_SQL + """
SELECT post_id, poll_name, max(CASE WHEN status = 'open' THEN 1 ELSE 0 END) AS is_open, count(*) AS options,
       CAST(sum(nullif(option_votes, -1)) AS BIGINT) AS votes, count(*) FILTER (WHERE option_votes = -1) AS withheld_options
FROM polls GROUP BY ALL""",
)
def poll_openness(spark, sf):
    """Open by status (not close date); withheld counts excluded from the vote sums."""
    return M.poll_openness(_poll_rows(spark, sf))


@register(
    "with_open_polls",
    "WITH " + _POLLS_SQL + f""",
selected AS (SELECT DISTINCT conv_id AS topic_id FROM conversations
             WHERE TIMESTAMP '{_T0}' + to_hours(conv_id) >= TIMESTAMP '2024-01-04')
SELECT topic_id FROM selected
UNION ALL
SELECT DISTINCT topic_id FROM polls WHERE status = 'open' AND topic_id NOT IN (SELECT topic_id FROM selected)""",
)
def with_open_polls(spark, sf):
    """Topics picked by the increment plus topics with an open poll not already picked."""
    topics = P.forum_topics_rows(topic_details(spark, sf))
    selected = topics.filter(F.col("created_at") >= F.lit("2024-01-04").cast("timestamp")).select(F.col("id").alias("topic_id"))
    open_topics = _poll_rows(spark, sf).filter(F.col("status") == "open")
    return J.with_open_polls(selected, open_topics)


def like_pages(spark, sf):
    """Like-action pages per (role, conversation): the role 'liked' every turn of it."""
    c = _conv_base(spark, sf)
    act = F.struct(
        F.when(F.col("turn") > 0, F.col("conv_id") * 1000 + F.col("turn")).alias("post_id"),
        F.col("conv_id").alias("topic_id"), (F.col("turn") + 1).alias("post_number"),
        F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2).otherwise(-1).alias("acting_user_id"),
        _iso(F.col("_created") + F.make_interval(mins=F.col("turn").cast("int"))).alias("created_at"),
        (F.length("text") < 50).alias("deleted"),
    )
    g = c.groupBy("role", "conv_id", F.floor(F.col("turn") / LIKES_PER_PAGE).alias("_page")).agg(F.collect_list(act).alias("acts"))
    return g.select(F.col("role").alias("username"), F.to_json(F.struct(F.col("acts").alias("user_actions"))).alias("body"))


_LIKES_SQL = f"""likes AS (
  SELECT conv_id * 1000 + turn AS post_id, conv_id AS topic_id, turn + 1 AS post_number,
         CAST(CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE -1 END AS BIGINT) AS acting_user_id,
         role AS acting_username, TIMESTAMP '{_T0}' + to_hours(conv_id) + to_minutes(turn) AS created_at,
         0 AS hidden, CASE WHEN length(text) < 50 THEN 1 ELSE 0 END AS deleted,
         '{{"post_id":' || (conv_id * 1000 + turn) || ',"topic_id":' || conv_id || ',"post_number":' || (turn + 1) || ',"acting_user_id":'
           || CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE -1 END || ',"created_at":"' || {_AT_SQL} || '","deleted":'
           || (length(text) < 50) || '}}' AS raw_json
  FROM conversations WHERE turn > 0
)"""


def _likes(spark, sf):
    return P.forum_likes_rows(like_pages(spark, sf))


@register("forum_likes_rows", "WITH " + _LIKES_SQL + "\nSELECT * FROM likes")
def forum_likes_rows(spark, sf):
    """Like edges; acting user = the queried user; actions without a post id dropped."""
    return _likes(spark, sf)


@register(
    "like_post_author",
    "WITH " + _LIKES_SQL + ", " + _POSTS_SQL + """
SELECT l.post_id, l.acting_username, p.user_id AS author_id FROM likes l LEFT JOIN posts p ON l.post_id = p.id""",
)
def like_post_author(spark, sf):
    """Each like edge resolved to the author of the liked post."""
    return J.like_post_author(_likes(spark, sf), _posts(spark, sf)).select("post_id", "acting_username", "author_id")


# --------------------------------------------------------------------------- #
# Like-graph growth on customers / orders
# --------------------------------------------------------------------------- #

_USERS_SQL = """users AS (SELECT o_custkey, count(*) AS likes_given FROM orders GROUP BY o_custkey),
base AS (SELECT o_custkey, count(*) AS likes_given FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_custkey)"""


def _users(spark, sf):
    o = src(spark, sf, "orders")
    users = M.edges_per_user(o, "o_custkey", "likes_given")
    base = M.edges_per_user(o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")), "o_custkey", "likes_given")
    return users, base


@register(
    "growth_targets",
    "WITH " + _USERS_SQL + """
SELECT u.o_custkey, u.likes_given, CAST(coalesce(b.likes_given, 0) AS BIGINT) AS baseline
FROM users u LEFT JOIN base b ON u.o_custkey = b.o_custkey
WHERE u.likes_given > coalesce(b.likes_given, 0) AND u.likes_given > 0""",
)
def growth_targets(spark, sf):
    """Users whose likes-given grew past the previous snapshot (absent = 0)."""
    users, base = _users(spark, sf)
    return J.growth_targets(users, base, "o_custkey", "likes_given")


@register("edges_per_user", "WITH " + _USERS_SQL + "\nSELECT o_custkey, likes_given AS edges FROM users")
def edges_per_user(spark, sf):
    """Stored edges per user."""
    return M.edges_per_user(src(spark, sf, "orders"), "o_custkey", "edges")


@register(
    "capture_rate",
    "WITH " + _USERS_SQL + """,
got AS (SELECT o_custkey, count(*) AS got FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey),
j AS (SELECT u.likes_given, coalesce(g.got, 0) AS got FROM users u LEFT JOIN got g ON u.o_custkey = g.o_custkey)
SELECT CAST(sum(likes_given) AS BIGINT) AS expected_edges, CAST(sum(got) AS BIGINT) AS captured_edges,
       round(sum(got) * 100.0 / sum(likes_given), 4)::DOUBLE AS capture_pct,
       count(*) FILTER (WHERE got = 0 AND likes_given > 0) AS users_empty
FROM j""",
)
def capture_rate(spark, sf):
    """Captured / expected like edges (%), and users whose feed returned nothing."""
    users, _ = _users(spark, sf)
    captured = src(spark, sf, "orders").filter(F.col("o_orderstatus") != "P")
    return M.capture_rate(users, captured, "o_custkey", "likes_given")


# --------------------------------------------------------------------------- #
# Trades with protocol fees
# --------------------------------------------------------------------------- #


def trade_pages(spark, sf):
    """One trades page per fill: every (order, line number) of ``lineitem`` is a
    fill of that order (log index = line number) whose protocol fees are the
    lineitems sharing the key (token = return flag).  Orders without lineitems
    are one fill without fees."""
    # Dealt out by order once, which serves the fees of a fill and the join.
    li = src(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_discount",
                                           "l_returnflag", "l_linestatus").filter(F.col("l_orderkey").isNotNull()).repartition("l_orderkey")
    o = src(spark, sf, "orders", spread=True)  # streamed side of a possible broadcast join
    amount = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    token = F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"), F.lit(None)).otherwise(F.col("l_returnflag"))
    fee = F.struct(
        F.col("l_suppkey").alias("_s"), F.col("l_partkey").alias("_p"), amount.alias("amount"), token.alias("token"),
        F.struct(F.lit("surplus").alias("kind"), F.col("l_discount").alias("factor")).alias("policy"),
    )
    fees = li.groupBy("l_orderkey", "l_linenumber").agg(F.sort_array(F.collect_list(fee)).alias("fees"))
    j = o.join(fees, o.o_orderkey == fees.l_orderkey, "left")
    trade = F.struct(
        F.concat(F.lit("0x"), F.col("o_orderkey").cast("string")).alias("orderUid"),
        F.concat(F.lit("0xAB"), F.col("o_orderkey").cast("string")).alias("txHash"),
        F.col("o_orderkey").alias("blockNumber"), F.col("l_linenumber").alias("logIndex"),
        F.concat(F.lit("0x"), F.col("o_custkey").cast("string")).alias("owner"),
        F.col("o_orderpriority").alias("sellToken"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("sellAmount"),
        F.transform("fees", lambda f: F.struct(f["policy"].alias("policy"), f["amount"].alias("amount"), f["token"].alias("token"))).alias("executedProtocolFees"),
    )
    return j.select(_one(trade).alias("body"))


_TOKEN_SQL = "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN NULL ELSE l_returnflag END"
_FEES_SQL = f"""fees AS (
  SELECT l_orderkey, l_linenumber, coalesce({_TOKEN_SQL}, '') AS token,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey,
                            CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), {_TOKEN_SQL} NULLS FIRST, l_discount) AS pos
  FROM lineitem
),
per_token AS (SELECT l_orderkey, l_linenumber, token, sum(amount) AS s, min(pos) AS first_pos FROM fees GROUP BY ALL),
best AS (SELECT * FROM per_token QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY s DESC, first_pos) = 1),
trades AS (
  SELECT o.*, f.l_linenumber FROM orders o
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) f ON f.l_orderkey = o.o_orderkey
)"""


def _fills(spark, sf):
    return P.fills_rows(trade_pages(spark, sf))


@register(
    "fills_rows",
    "WITH " + _FEES_SQL + """
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS order_uid, '0xAB' || CAST(o_orderkey AS VARCHAR) AS tx_hash,
       o_orderkey AS block_number, CAST(coalesce(t.l_linenumber, 0) AS BIGINT) AS log_index,
       '0x' || CAST(o_custkey AS VARCHAR) AS owner, o_orderpriority AS sell_token, '' AS buy_token,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS sell_amount,
       '0' AS buy_amount, coalesce(b.token, '') AS fee_token, coalesce(CAST(b.s AS VARCHAR), '0') AS fee_amount
FROM trades t LEFT JOIN best b ON b.l_orderkey = t.o_orderkey AND b.l_linenumber = t.l_linenumber""",
)
def fills_rows(spark, sf):
    """Trades → 12 fill columns with ``or`` defaults (fee policies reported separately)."""
    return _fills(spark, sf).drop("fee_policies")


@register(
    "fee_by_dominant_token",
    "WITH " + _FEES_SQL + """
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS order_uid, CAST(coalesce(t.l_linenumber, 0) AS BIGINT) AS log_index,
       coalesce(b.token, '') AS fee_token, coalesce(CAST(b.s AS VARCHAR), '0') AS fee_amount
FROM trades t LEFT JOIN best b ON b.l_orderkey = t.o_orderkey AND b.l_linenumber = t.l_linenumber""",
)
def fee_by_dominant_token(spark, sf):
    """Per fill: the token with the largest summed fee (first seen on ties), its total as text."""
    return _fills(spark, sf).select("order_uid", "log_index", "fee_token", "fee_amount")


@register(
    "fee_long_sums",
    "WITH " + _FEES_SQL + """
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS order_uid, CAST(coalesce(t.l_linenumber, 0) AS BIGINT) AS log_index,
       coalesce(b.token, '') AS fee_token, coalesce(CAST(b.s AS VARCHAR) || repeat('0', 36), '0') AS fee_amount
FROM trades t LEFT JOIN best b ON b.l_orderkey = t.o_orderkey AND b.l_linenumber = t.l_linenumber""",
)
def fee_long_sums(spark, sf):
    """The dominant token by amounts of more digits than any number type holds."""
    wide = F.regexp_replace("body", '"amount":"([0-9]+)"', '"amount":"$1' + "0" * 36 + '"')
    return P.fills_rows(trade_pages(spark, sf).select(wide.alias("body"))).select("order_uid", "log_index", "fee_token", "fee_amount")


@register(
    "fee_policies_json",
    "WITH " + _FEES_SQL + """
SELECT '0x' || CAST(t.o_orderkey AS VARCHAR) AS order_uid, CAST(coalesce(t.l_linenumber, 0) AS BIGINT) AS log_index,
       CAST(count(f.pos) AS INTEGER) AS n_policies,
       coalesce(string_agg(f.token, ',' ORDER BY f.pos), '') AS tokens,
       coalesce(string_agg(CAST(f.amount AS VARCHAR), ',' ORDER BY f.pos), '') AS amounts
FROM trades t LEFT JOIN fees f ON f.l_orderkey = t.o_orderkey AND f.l_linenumber = t.l_linenumber
GROUP BY t.o_orderkey, t.l_linenumber""",
)
def fee_policies_json(spark, sf):
    """Ordered policy array {policy, amount, token}; checked by parsing it back."""
    arr = F.from_json("fee_policies", "array<struct<policy: string, amount: string, token: string>>")
    return _fills(spark, sf).select(
        "order_uid", "log_index", F.size(arr).alias("n_policies"),
        F.array_join(F.transform(arr, lambda x: x["token"]), ",").alias("tokens"),
        F.array_join(F.transform(arr, lambda x: x["amount"]), ",").alias("amounts"),
    )
