"""Landed payload → typed rows.

Every job parses JSON text with a declared schema (``from_json``) or JSON paths,
explodes nested arrays with their positions, and applies the reference's
defaults with column expressions.  Per-payload work (fee sums, like counts,
poll options) uses higher-order functions on the row's own arrays, so it needs
no shuffle at all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayside.functions.coerce import (
    boundary_day,
    col_of,
    iso_or_epoch,
    iso_or_null,
    lenient_double,
    lenient_int,
    millis_to_date,
    or_default,
    try_cast,
    unix_or_epoch,
)
from quayside.operators.tables import TableSpec, append
from quayside.session import scratch_path

POLL_VOTES = ["options", "preloaded_voters"]  # fixed values: what a poll's header leaves to its rows and the post
LIKE_ACTION_ID = 2  # fixed value: the "like" entry of a post's action summary

# --------------------------------------------------------------------------- #
# Schemas of the landed payloads (only the fields the rows use)
# --------------------------------------------------------------------------- #

FEE = "struct<policy: string, amount: string, token: string>"
TRADE = (
    "struct<orderUid: string, txHash: string, blockNumber: bigint, logIndex: bigint, owner: string, "
    f"sellToken: string, buyToken: string, sellAmount: string, buyAmount: string, executedProtocolFees: array<{FEE}>>"
)
# Dynamic-key objects ({coin: {...}}) are parsed once into VARIANT and cast to a typed map.
SPOT_COINS = "map<string, struct<price: double, confidence: double>>"
CHART_COINS = "map<string, struct<prices: array<struct<timestamp: bigint, price: double>>, confidence: double>>"
SPACE = (
    "struct<id: string, name: string, network: string, symbol: string, proposalsCount: string, "
    "followersCount: string, votesCount: string>"
)
PROPOSAL = (
    "struct<id: string, title: string, state: string, type: string, author: string, discussion: string, "
    "created: string, start: string, end: string, snapshot: string, scores_total: string, quorum: string, "
    "votes: string, scores_state: string, space: struct<id: string>>"
)
VOTE = "struct<id: string, voter: string, created: string, vp: string, vp_state: string, proposal: struct<id: string>, space: struct<id: string>>"
FOLLOW = "struct<id: string, follower: string, created: string, space: struct<id: string>>"
CATEGORY_FIELDS = "id: string, parent_category_id: string, name: string, slug: string, topic_count: string, post_count: string, description_text: string, description: string"
CATEGORY = f"struct<{CATEGORY_FIELDS}, subcategory_list: array<struct<{CATEGORY_FIELDS}>>>"
USER_ITEM = (
    "struct<user: struct<id: string, username: string, name: string, trust_level: string>, likes_received: string, "
    "likes_given: string, post_count: string, topic_count: string, days_visited: string>"
)
POLL_OPTION = "struct<id: string, html: string, votes: bigint>"
POLL = (
    "struct<id: string, name: string, type: string, status: string, results: string, public: boolean, "
    f"close: string, voters: string, options: array<{POLL_OPTION}>>"
)
POST = (
    "struct<id: string, topic_id: string, post_number: string, user_id: string, username: string, created_at: string, "
    "updated_at: string, reply_to_post_number: string, reply_count: string, reads: string, raw: string, cooked: string, "
    f"actions_summary: array<struct<id: bigint, count: string>>, polls: array<string>>"
)
TOPIC = (
    "struct<id: string, title: string, slug: string, category_id: string, posts_count: string, reply_count: string, "
    "views: string, like_count: string, participant_count: string, tags: array<string>, created_at: string, "
    "last_posted_at: string, bumped_at: string, closed: boolean, archived: boolean, pinned: boolean, "
    "post_stream: struct<posts: array<string>, stream: array<bigint>>>"
)
LIKE_ACTION = (
    "struct<post_id: string, topic_id: string, post_number: string, acting_user_id: string, created_at: string, "
    "hidden: boolean, deleted: boolean>"
)


def _s(c) -> Column:
    """Text field with the ``or ''`` default."""
    return F.coalesce(F.nullif(col_of(c), F.lit("")), F.lit(""))


# --------------------------------------------------------------------------- #
# Pages → elements and rejects
# --------------------------------------------------------------------------- #


class Payload(NamedTuple):
    """A kind of landed page: where its list of elements stands (a dotted path,
    empty for a body that is the list, ``None`` for a body that is one element),
    and the fields read of each element."""

    entity: str
    path: str | None
    ddl: str


TRADES = Payload("trades", "", TRADE)
PROFILES = Payload("profiles", "results", "struct<`$distinct_id`: string, `$properties`: string>")
SPACES = Payload("space", None, SPACE)
PROPOSALS = Payload("proposals", "", PROPOSAL)
VOTES = Payload("votes", "", VOTE)
FOLLOWS = Payload("follows", "", FOLLOW)
CATEGORIES = Payload("categories", "category_list.categories", f"struct<{CATEGORY_FIELDS}, subcategory_list: array<string>>")
USERS = Payload("users", "directory_items", USER_ITEM)
TOPICS = Payload("topics", None, TOPIC)
LIKES = Payload("likes", "user_actions", LIKE_ACTION)

MARKET_CHARTS = Payload("market_charts", None, "struct<prices: array<array<double>>>")

REJECTS_DDL = "entity STRING, page STRING, pos INT, reason STRING, text STRING"
_REASON = "reject_reason"


def landed(pages: DataFrame, payload: Payload, keep=(), body: str = "body") -> DataFrame:
    """Pages → ``keep..., pos, raw_json, e, reject_reason``: a row per element, and a
    row with a reason per page or element that cannot be read.

    Page reasons: ``empty``, ``malformed`` (cut off or no JSON), ``errors`` (an
    error answer), ``not_a_list``; a well-formed page whose list is missing or
    null holds nothing.  Element reason: ``not_an_object``; ``raw_json`` is then
    the element, and of a page the page.  Of a readable element it is the JSON
    object as parsed, keys in their order.
    """
    text = F.col("_body")
    if payload.path is None:
        items = F.array(text)
    else:
        names = payload.path.split(".") if payload.path else []
        ddl = "array<string>"
        for n in reversed(names):
            ddl = f"struct<`{n}`: {ddl}>"
        items = F.from_json(text, ddl)
        for n in names:
            items = items[n]
    well_formed = F.json_object_keys(text).isNotNull() | F.json_array_length(text).isNotNull()
    page_reason = (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty")
        .when(~well_formed, "malformed")
        .when(F.get_json_object(text, "$.errors").isNotNull(), "errors")
    )
    if payload.path is not None:
        listed = F.lit(True) if not payload.path else F.get_json_object(text, "$." + payload.path).isNotNull()
        page_reason = F.when(F.col("_items").isNull(), page_reason.when(listed, "not_a_list"))
    keep = list(keep)
    parsed = pages.select(*keep, F.col(body).alias("_body")).withColumn("_items", items).withColumn("_why", page_reason)
    none = F.array(F.lit(None).cast("string"))
    rows = parsed.select(*keep, "_why", "_body", F.posexplode(F.when(F.col("_why").isNotNull(), none).otherwise(F.col("_items"))).alias("pos", "_item"))
    fine = F.col("_why").isNull()
    is_object = F.coalesce(F.col("_item").rlike(r"^\s*\{"), F.lit(False))
    return rows.select(
        *keep, F.when(fine, F.col("pos")).alias("pos"), F.when(fine, F.col("_item")).otherwise(F.col("_body")).alias("raw_json"),
        F.when(fine & is_object, F.from_json("_item", payload.ddl)).alias("e"),
        F.when(fine & ~is_object, "not_an_object").otherwise(F.col("_why")).alias(_REASON))


def elements(pages: DataFrame, payload: Payload, keep=(), body: str = "body") -> DataFrame:
    """The readable elements of pages, or of pages already given to :func:`landed`."""
    if _REASON not in pages.columns:
        pages = landed(pages, payload, keep, body)
    return pages.filter(F.col(_REASON).isNull()).select(*keep, "pos", "raw_json", "e")


def page_rejects(parsed: DataFrame, payload: Payload, page=(), entity: str | None = None) -> DataFrame:
    """What :func:`landed` could not read: ``entity, page, pos, reason, text``.
    ``page`` names the columns that identify a page, ``entity`` one that holds the
    entity in place of the payload's."""
    return parsed.filter(F.col(_REASON).isNotNull()).select(
        (F.lit(payload.entity) if entity is None else F.col(entity)).alias("entity"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in page]).alias("page"), "pos", F.col(_REASON).alias("reason"), F.col("raw_json").alias("text"))


def rejects_of(spec: TableSpec) -> TableSpec:
    """The table of what a load into ``spec`` could not take, beside it."""
    return TableSpec(path=spec.path.rstrip("/") + "__rejects", schema=REJECTS_DDL + ", rejected_at TIMESTAMP_NTZ")


def land(pages: DataFrame, payload: Payload, rejects: TableSpec | None = None, keep=(), page=(), run_ts=None, body: str = "body") -> DataFrame:
    """Parses pages once: the result is written to the shared folder, what cannot
    be read goes to the table ``rejects``, and the written rows are returned for
    the row builders, which take them like pages."""
    spark = pages.sparkSession
    path = scratch_path(spark, "landed-" + payload.entity)
    parsed = landed(pages, payload, list(dict.fromkeys([*keep, *page])), body)
    parsed.write.parquet(path)
    parsed = spark.read.schema(parsed.schema).parquet(path)
    if rejects is not None:
        _put_rejects(parsed, payload, rejects, page, run_ts)
    return parsed


def _put_rejects(parsed: DataFrame, payload: Payload, rejects: TableSpec, page, run_ts) -> None:
    append(page_rejects(parsed, payload, page).withColumn("rejected_at", F.lit(run_ts).cast("timestamp_ntz")), rejects)


def land_into(pages: DataFrame, payload: Payload, rejects: TableSpec, write, page=(), run_ts=None, body: str = "body") -> None:
    """:func:`land` for rows that one write reads: ``write`` is given them as they are
    parsed, so no copy of the pages is written and read in between.  The write
    counts what cannot be read; only where there is some, or no count came, are
    the pages read again for the table ``rejects``, without the elements' fields."""
    parsed, seen = landed(pages, payload, page, body), Observation()
    write(parsed.observe(seen, F.count(_REASON).alias("bad")))
    if _counted(seen) != 0:
        _put_rejects(parsed, payload, rejects, page, run_ts)


def _counted(seen: Observation) -> int | None:
    """The count of a write; ``None`` where its plan was cut short and counted nothing."""
    try:
        return seen.get.get("bad")
    except Exception:  # no observed metrics
        return None


# --------------------------------------------------------------------------- #
# Trades / fills
# --------------------------------------------------------------------------- #


def _amount(fee: Column) -> Column:
    """Amount text of a fee; missing and empty count as 0."""
    return F.coalesce(F.nullif(fee["amount"], F.lit("")), F.lit("0"))


LIMB = 10  # digits of one part of a long sum: a row holds fewer numbers than would fill 64 bits
BASE = 10**LIMB
SHORT = 27  # characters of a number that one type sums: 10^10 of these stay within 38 digits
WHOLE = r"^[+-]?[0-9]+$"
WIDE = "decimal(38,0)"


def _limbs(texts: Column) -> Column:
    """The sum of whole numbers' texts by parts of ``LIMB`` digits, the last digits
    first, nothing carried.  Each number is read once, then added part by part."""
    parts = F.ceil(F.array_max(F.transform(texts, lambda t: F.length(t))) / LIMB).cast("int")

    def added(n: Column) -> Column:
        numbers = F.transform(texts, lambda t: F.struct(
            F.lpad(F.ltrim(t, F.lit("+-")), n * LIMB, F.lit("0")).alias("d"), F.when(t.startswith("-"), F.lit(-1)).otherwise(F.lit(1)).alias("sign")))
        return _once(numbers, lambda xs: F.transform(F.sequence(F.lit(1), n), lambda k: F.aggregate(
            xs, F.lit(0).cast("bigint"), lambda acc, x: acc + F.substring(x["d"], (n - k) * LIMB + 1, F.lit(LIMB)).cast("bigint") * x["sign"])))

    return _once(parts, added)


def _carried(limbs: Column) -> Column:
    """Parts brought into 0 .. 10^LIMB - 1, and what is carried out of the last."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(acc, limb):
        total = acc["carry"] + limb
        digit = F.pmod(total, F.lit(BASE))
        return F.struct(F.call_function("div", total - digit, F.lit(BASE)).alias("carry"), F.concat(acc["out"], F.array(digit)).alias("out"))

    return F.aggregate(limbs, start, step)


def _number_text(sign: Column, digits: Column) -> Column:
    """Digits without leading zeros, behind their sign; zero has none."""
    return _once(F.ltrim(digits, F.lit("0")), lambda d: F.when(d == "", "0").otherwise(F.concat(sign, d)))


def sum_of_wholes(texts: Column) -> Column:
    """Sum of an array of whole numbers of any length, as text; NULL where one of
    them is no whole number.  ``[]`` sums to 0."""
    def written(limbs: Column) -> Column:
        def text(sign: str, value: Column) -> Column:
            tops = F.reverse(F.concat(value["out"], F.array(value["carry"])))
            return _number_text(F.lit(sign), F.array_join(F.transform(tops, lambda d: F.lpad(d.cast("string"), LIMB, "0")), ""))

        return _once(_carried(limbs), lambda up: F.when(up["carry"] >= 0, text("", up)).otherwise(
            _once(_carried(F.transform(limbs, lambda x: -x)), lambda down: text("-", down))))

    def summed(trimmed: Column) -> Column:
        only = trimmed[0]
        valid = F.forall(trimmed, lambda t: F.coalesce(t.rlike(WHOLE), F.lit(False)))
        short = F.forall(trimmed, lambda t: F.length(t) <= SHORT)
        plain = F.aggregate(trimmed, F.lit(0).cast(WIDE), lambda acc, t: (acc + try_cast(t, WIDE)).cast(WIDE))
        return F.when(valid, F.when(F.size(trimmed) == 1, _number_text(F.when(only.startswith("-"), "-").otherwise(""), F.ltrim(only, F.lit("+-"))))
                      .when(short, plain.cast("string")).otherwise(_once(_limbs(trimmed), written)))

    return _once(F.transform(texts, lambda t: F.trim(t)), summed)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use)[0]


def _by_size(number: Column) -> Column:
    """A key that orders whole numbers given as text; NULL comes first."""
    digits = F.ltrim(number, F.lit("-"))
    return F.when(number.startswith("-"), F.struct(F.lit(0).alias("up"), (-F.length(digits)).alias("n"), F.translate(digits, "0123456789", "9876543210").alias("d"))).when(
        number.isNotNull(), F.struct(F.lit(1).alias("up"), F.length(digits).alias("n"), digits.alias("d")))


def fee_by_dominant_token(fees: Column) -> Column:
    """Per trade: token with the greatest summed fee (tie → first seen), that sum
    as text; ``('', '0')`` when there are no fees.

    Sums are exact at any length.  A token with an amount that is no whole number
    has no sum: it loses to every other, and is NULL when it is the only one.
    """
    fees = F.coalesce(fees, F.array().cast(f"array<{FEE}>"))
    read = F.transform(fees, lambda f: F.struct(F.coalesce(f["token"], F.lit("")).alias("t"), F.trim(_amount(f)).alias("a")))

    def first_of(totals: Column) -> Column:
        """The greatest ``k``, of equal ones the first."""
        best = F.array_max(F.transform(totals, lambda x, i: F.struct(x["k"].alias("k"), (-i).alias("o"), x["s"].alias("s"), x["t"].alias("t"))))
        return _once(best, lambda b: F.struct(b["t"].alias("fee_token"), b["s"].alias("fee_amount")))

    def by_number(fees: Column, tokens: Column) -> Column:
        def total(t):
            return F.aggregate(fees, F.lit(0).cast(WIDE), lambda acc, f: F.when(f["t"] == t, (acc + try_cast(f["a"], WIDE)).cast(WIDE)).otherwise(acc))

        sums = F.transform(tokens, lambda t: F.struct(total(t).alias("k"), t.alias("t")))
        return first_of(_once(sums, lambda xs: F.transform(xs, lambda x: F.struct(x["k"].alias("k"), x["k"].cast("string").alias("s"), x["t"].alias("t")))))

    def by_text(fees: Column, tokens: Column) -> Column:
        def total(t):
            return sum_of_wholes(F.transform(F.filter(fees, lambda f: f["t"] == t), lambda f: f["a"]))

        sums = F.transform(tokens, lambda t: F.struct(total(t).alias("s"), t.alias("t")))
        return first_of(_once(sums, lambda xs: F.transform(xs, lambda x: F.struct(_by_size(x["s"]).alias("k"), x["s"].alias("s"), x["t"].alias("t")))))

    def dominant(fees: Column) -> Column:
        short = F.forall(fees, lambda f: (F.length(f["a"]) <= SHORT) & f["a"].rlike(WHOLE))
        return _once(F.array_distinct(F.transform(fees, lambda f: f["t"])), lambda tokens: F.when(short, by_number(fees, tokens)).otherwise(by_text(fees, tokens)))

    none = F.struct(F.lit("").alias("fee_token"), F.lit("0").alias("fee_amount"))
    return F.when(F.size(fees) == 0, none).otherwise(_once(read, dominant))


def fee_policies_json(fees: Column) -> Column:
    """Ordered JSON array of {policy, amount, token} with the reference defaults;
    a policy that is not JSON counts as missing."""
    fees = F.coalesce(fees, F.array().cast(f"array<{FEE}>"))
    return F.to_json(
        F.transform(
            fees,
            lambda f: F.struct(
                F.coalesce(F.try_parse_json(f["policy"]), F.parse_json(F.lit("{}"))).alias("policy"),
                _amount(f).alias("amount"),
                F.coalesce(f["token"], F.lit("")).alias("token"),
            ),
        )
    )


def fills_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    """Trades pages → 12 fill columns, ``x or default`` on every field."""
    e, fee = F.col("e"), F.col("_fee")
    # A column of its own, so that token and amount come from one evaluation.
    t = elements(pages, TRADES, body=body).select("e", fee_by_dominant_token(e["executedProtocolFees"]).alias("_fee"))
    return t.select(
        _s(e["orderUid"]).alias("order_uid"),
        _s(e["txHash"]).alias("tx_hash"),
        or_default(e["blockNumber"], 0).cast("bigint").alias("block_number"),
        or_default(e["logIndex"], 0).cast("bigint").alias("log_index"),
        _s(e["owner"]).alias("owner"),
        _s(e["sellToken"]).alias("sell_token"),
        _s(e["buyToken"]).alias("buy_token"),
        or_default(e["sellAmount"], "0").alias("sell_amount"),
        or_default(e["buyAmount"], "0").alias("buy_amount"),
        fee["fee_token"].alias("fee_token"),
        fee["fee_amount"].alias("fee_amount"),
        fee_policies_json(e["executedProtocolFees"]).alias("fee_policies"),
    )


# --------------------------------------------------------------------------- #
# Prices
# --------------------------------------------------------------------------- #


def spot_price_rows(payloads: DataFrame, day_col: str, body: str = "body") -> DataFrame:
    """``{coins:{key:{price,confidence}}}`` → (block_date, coin, price, confidence); NULL price skipped."""
    coins = F.try_variant_get(F.try_parse_json(F.col(body)), "$.coins", SPOT_COINS)
    p = payloads.select(F.col(day_col).alias("block_date"), F.explode(coins).alias("coin", "q"))
    return p.select("block_date", "coin", F.col("q.price").alias("price"), F.col("q.confidence").alias("confidence")).filter(
        F.col("price").isNotNull()
    )


def history_price_rows(payloads: DataFrame, id_col: str, body: str = "body") -> DataFrame:
    """Per-asset ``market_data.current_price.usd``; missing or NULL price skipped."""
    price = F.get_json_object(F.col(body), "$.market_data.current_price.usd").cast("double")
    return payloads.select(F.col(id_col), price.alias("price")).filter(F.col("price").isNotNull())


def market_chart_rows(pages: DataFrame, id_col: str, body: str = "body") -> DataFrame:
    """``{prices: [[unix ms, price], ...]}`` per asset → (asset id, pos, ts, day,
    price); points without a time or price skipped."""
    p = elements(pages, MARKET_CHARTS, keep=(id_col,), body=body).select(F.col(id_col), F.posexplode("e.prices").alias("pos", "p"))
    return p.select(
        F.col(id_col), "pos", F.timestamp_millis(F.get("p", 0).cast("bigint")).alias("ts"), millis_to_date(F.get("p", 0)).alias("day"),
        F.get("p", 1).alias("price"),
    ).filter(F.col("ts").isNotNull() & F.col("price").isNotNull())


def chart_points(windows: DataFrame, body: str = "body", window_col: str = "window_no") -> DataFrame:
    """Chart windows → (coin, window, pos, timestamp, day, price, confidence); NULL prices skipped.

    ``day`` is the nearest UTC midnight of the tick (half-even at noon).
    """
    coins = F.try_variant_get(F.try_parse_json(F.col(body)), "$.coins", CHART_COINS)
    c = windows.select(F.col(window_col), F.explode(coins).alias("coin", "v"))
    pts = c.select(
        "coin", window_col, F.col("v.confidence").alias("confidence"),
        F.posexplode(F.col("v.prices")).alias("pos", "p"),
    )
    return pts.select(
        "coin", window_col, "pos", F.col("p.timestamp").alias("timestamp"),
        boundary_day(F.col("p.timestamp")).alias("day"), F.col("p.price").alias("price"), "confidence",
    ).filter(F.col("price").isNotNull() & F.col("timestamp").isNotNull())


def chart_confidences(windows: DataFrame, body: str = "body", window_col: str = "window_no") -> DataFrame:
    """(coin, window, confidence) of every chart window, one without points included."""
    coins = F.try_variant_get(F.try_parse_json(F.col(body)), "$.coins", CHART_COINS)
    return windows.select(F.col(window_col), F.explode(coins).alias("coin", "v")).select(
        "coin", window_col, F.col("v.confidence").alias("confidence"))


# --------------------------------------------------------------------------- #
# Product events and profiles
# --------------------------------------------------------------------------- #


def profiles_rows(pages: DataFrame, project_id: str, body: str = "body") -> DataFrame:
    """Profile pages → (distinct_id, project_id, properties); profiles without an id dropped."""
    return elements(pages, PROFILES, body=body).select(
        F.coalesce(F.col("e.$distinct_id"), F.lit("")).alias("distinct_id"),
        F.lit(project_id).alias("project_id"),
        F.coalesce(F.col("e.$properties"), F.lit("{}")).alias("properties"),
    ).filter(F.col("distinct_id") != "")


# --------------------------------------------------------------------------- #
# Governance (snapshot spaces, proposals, votes, follows)
# --------------------------------------------------------------------------- #


def snapshot_space_rows(pages: DataFrame, default_space: str, body: str = "body") -> DataFrame:
    s = elements(pages, SPACES, body=body).select(F.col("e").alias("s"), "raw_json")
    return s.select(
        F.coalesce(F.nullif("s.id", F.lit("")), F.lit(default_space)).alias("space_id"),
        _s("s.name").alias("name"),
        _s("s.network").alias("network"),
        _s("s.symbol").alias("symbol"),
        lenient_int("s.proposalsCount").alias("proposals_count"),
        lenient_int("s.followersCount").alias("followers_count"),
        lenient_int("s.votesCount").alias("votes_count"),
        "raw_json",
    )


def snapshot_proposals_rows(pages: DataFrame, default_space: str, body: str = "body") -> DataFrame:
    p = elements(pages, PROPOSALS, body=body)
    e = "e."
    return p.select(
        _s(e + "id").alias("id"),
        F.coalesce(F.nullif(F.col("e.space.id"), F.lit("")), F.lit(default_space)).alias("space_id"),
        _s(e + "title").alias("title"),
        _s(e + "state").alias("state"),
        _s(e + "type").alias("type"),
        _s(e + "author").alias("author"),
        _s(e + "discussion").alias("discussion"),
        unix_or_epoch(e + "created").alias("created_at"),
        unix_or_epoch(e + "start").alias("start_at"),
        unix_or_epoch(e + "end").alias("end_at"),
        lenient_int(e + "snapshot").alias("snapshot_block"),
        lenient_double(e + "scores_total").alias("scores_total"),
        lenient_double(e + "quorum").alias("quorum"),
        lenient_int(e + "votes").alias("votes_count"),
        _s(e + "scores_state").alias("scores_state"),
        "raw_json",
    )


def snapshot_votes_rows(pages: DataFrame, default_space: str, body: str = "body") -> DataFrame:
    v = elements(pages, VOTES, body=body)
    return v.select(
        _s("e.id").alias("id"),
        _s("e.proposal.id").alias("proposal_id"),
        F.coalesce(F.nullif(F.col("e.space.id"), F.lit("")), F.lit(default_space)).alias("space_id"),
        _s("e.voter").alias("voter"),
        unix_or_epoch("e.created").alias("created_at"),
        lenient_double("e.vp").alias("vp"),
        _s("e.vp_state").alias("vp_state"),
        "raw_json",
    )


def snapshot_follows_rows(pages: DataFrame, default_space: str, body: str = "body") -> DataFrame:
    f = elements(pages, FOLLOWS, body=body)
    return f.select(
        _s("e.id").alias("id"),
        _s("e.follower").alias("follower"),
        F.coalesce(F.nullif(F.col("e.space.id"), F.lit("")), F.lit(default_space)).alias("space_id"),
        unix_or_epoch("e.created").alias("created_at"),
        "raw_json",
    )


def landed_pages(pages: DataFrame, element_ddl: str, entity_col: str = "entity", page_col: str = "page_no",
                 body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(entity, page_no, body) → one row per element with (entity, page_no, pos,
    raw_json, e), and the rejects (entity, page, pos, reason, text).  Both read
    the one parse, which is written to the shared folder."""
    payload = Payload("pages", "", element_ddl)
    parsed = land(pages, payload, keep=(entity_col, page_col), body=body)
    return elements(parsed, payload, (entity_col, page_col)), page_rejects(parsed, payload, (page_col,), entity_col)


def dedupe_pages_by_id(rows: DataFrame, id_col: str, page_col: str = "page_no", pos_col: str = "pos",
                       value_cols=()) -> DataFrame:
    """Overlapping pages: keep the first occurrence of each id by (page, position)."""
    w = rows.groupBy(id_col).agg(F.min(F.struct(page_col, pos_col, *value_cols)).alias("_f"))
    return w.select(id_col, *[F.col("_f")[c].alias(c) for c in (page_col, pos_col, *value_cols)])


# --------------------------------------------------------------------------- #
# Forum
# --------------------------------------------------------------------------- #


def _category(c: Column) -> list[Column]:
    parent = lenient_int(c["parent_category_id"])
    return [
        lenient_int(c["id"]).alias("id"),
        F.when(c["parent_category_id"].isNull() | (parent == 0), F.lit(-1).cast("bigint")).otherwise(parent).alias("parent_id"),
        _s(c["name"]).alias("name"),
        _s(c["slug"]).alias("slug"),
        lenient_int(c["topic_count"]).alias("topic_count"),
        lenient_int(c["post_count"]).alias("post_count"),
        F.coalesce(F.nullif(c["description_text"], F.lit("")), F.nullif(c["description"], F.lit("")), F.lit("")).alias("description"),
    ]


def category_tree_flatten(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Categories payload → parent rows then each subcategory (parent −1 at the root)."""
    c = elements(payloads, CATEGORIES, body=body)
    parents = c.select(*_category(F.col("e")), "raw_json")
    subs = c.select(F.explode("e.subcategory_list").alias("raw_json")).filter("raw_json IS NOT NULL")
    parsed = subs.select(F.from_json("raw_json", f"struct<{CATEGORY_FIELDS}>").alias("s"), "raw_json")
    return parents.unionByName(parsed.select(*_category(F.col("s")), "raw_json"))


def forum_users_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    i = elements(pages, USERS, body=body).withColumnRenamed("e", "i")
    return i.select(
        lenient_int("i.user.id").alias("id"),
        _s("i.user.username").alias("username"),
        _s("i.user.name").alias("name"),
        lenient_int("i.user.trust_level").alias("trust_level"),
        lenient_int("i.likes_received").alias("likes_received"),
        lenient_int("i.likes_given").alias("likes_given"),
        lenient_int("i.post_count").alias("post_count"),
        lenient_int("i.topic_count").alias("topic_count"),
        lenient_int("i.days_visited").alias("days_visited"),
        "raw_json",
    )


def forum_topics_rows(details: DataFrame, stubs: DataFrame | None = None, body: str = "body") -> DataFrame:
    """Topic details → 16 typed columns + raw JSON without the post stream.

    ``bumped_at`` falls back to the list stub's value, then to ``last_posted_at``.
    """
    t = elements(details, TOPICS, body=body).select(F.col("e").alias("t"), F.col("raw_json").alias("_raw"))
    out = t.select(
        lenient_int("t.id").alias("id"),
        _s("t.title").alias("title"),
        _s("t.slug").alias("slug"),
        F.when(F.col("t.category_id").isNull(), F.lit(-1).cast("bigint")).otherwise(lenient_int("t.category_id")).alias("category_id"),
        lenient_int("t.posts_count").alias("posts_count"),
        lenient_int("t.reply_count").alias("reply_count"),
        lenient_int("t.views").alias("views"),
        lenient_int("t.like_count").alias("like_count"),
        lenient_int("t.participant_count").alias("participant_count"),
        F.coalesce(F.array_join("t.tags", ","), F.lit("")).alias("tags"),
        iso_or_epoch("t.created_at").alias("created_at"),
        iso_or_epoch("t.last_posted_at").alias("last_posted_at"),
        F.nullif(F.col("t.bumped_at"), F.lit("")).alias("_bumped_raw"),
        F.col("t.last_posted_at").alias("_last_raw"),
        F.coalesce(F.col("t.closed").cast("int"), F.lit(0)).alias("closed"),
        F.coalesce(F.col("t.archived").cast("int"), F.lit(0)).alias("archived"),
        F.coalesce(F.col("t.pinned").cast("int"), F.lit(0)).alias("pinned"),
        F.to_json(F.map_filter(F.from_json("_raw", "map<string, variant>"), lambda k, v: k != "post_stream")).alias("raw_json"),
    )
    if stubs is not None:
        s = stubs.select(lenient_int("id").alias("id"), F.nullif(F.col("bumped_at"), F.lit("")).alias("_stub_bumped"))
        out = out.join(s, "id", "left")
    else:
        out = out.withColumn("_stub_bumped", F.lit(None).cast("string"))
    bumped = iso_or_epoch(F.coalesce(F.col("_bumped_raw"), F.col("_stub_bumped"), F.col("_last_raw")))
    return out.withColumn("bumped_at", bumped).drop("_bumped_raw", "_stub_bumped", "_last_raw")


def _topic_posts(details: DataFrame, body: str) -> DataFrame:
    """Posts of each topic payload: ``_topic, raw_json, p``."""
    t = elements(details, TOPICS, body=body).select(F.col("e.id").alias("_topic"), F.explode("e.post_stream.posts").alias("raw_json"))
    return t.filter("raw_json IS NOT NULL").select("_topic", "raw_json", F.from_json("raw_json", POST).alias("p"))


def forum_posts_rows(details: DataFrame, body: str = "body") -> DataFrame:
    """Posts of each topic detail; like count from the action summary (id 2); topic id fallback."""
    p = _topic_posts(details, body)
    likes = F.filter("p.actions_summary", lambda a: a["id"] == LIKE_ACTION_ID)
    return p.select(
        lenient_int("p.id").alias("id"),
        F.when(F.coalesce(F.col("p.topic_id"), F.lit("")).isin("", "0"), lenient_int("_topic")).otherwise(lenient_int("p.topic_id")).alias("topic_id"),
        lenient_int("p.post_number").alias("post_number"),
        lenient_int("p.user_id").alias("user_id"),
        _s("p.username").alias("username"),
        iso_or_epoch("p.created_at").alias("created_at"),
        iso_or_epoch("p.updated_at").alias("updated_at"),
        lenient_int("p.reply_to_post_number").alias("reply_to_post_number"),
        lenient_int("p.reply_count").alias("reply_count"),
        lenient_int("p.reads").alias("reads"),
        F.coalesce(lenient_int(F.get(likes, 0)["count"]), F.lit(0).cast("bigint")).alias("like_count"),
        _s("p.raw").alias("raw"),
        _s("p.cooked").alias("cooked"),
        "raw_json",
    )


def posts_still_missing(details: DataFrame, posts: DataFrame, body: str = "body") -> DataFrame:
    """Post ids listed in a topic's stream but absent from its landed posts."""
    t = elements(details, TOPICS, body=body).select(F.col("e").alias("t"))
    listed = t.select(lenient_int("t.id").alias("topic_id"), F.explode("t.post_stream.stream").alias("post_id"))
    have = posts.select(F.col("topic_id"), F.col("id").alias("post_id"))
    return listed.join(have, ["topic_id", "post_id"], "left_anti")


def forum_poll_options(details: DataFrame, body: str = "body") -> DataFrame:
    """One row per (post, poll, option); empty polls and options without id skipped;
    withheld votes → −1; ``close`` NULL when absent; ``raw_json`` is the poll's
    header, without its options and voters."""
    p = _topic_posts(details, body)
    raw = p.select("_topic", "p.id", "p.topic_id", F.explode("p.polls").alias("_raw"))
    polls = raw.select("*", F.from_json("_raw", POLL).alias("poll")).filter(F.size("poll.options") > 0)
    o = polls.select("*", F.explode("poll.options").alias("opt")).filter(
        F.col("opt.id").isNotNull() & (F.col("opt.id") != "")
    )
    header = F.map_filter(F.from_json("_raw", "map<string, variant>"), lambda k, v: ~k.isin(*POLL_VOTES))
    return o.select(
        lenient_int("id").alias("post_id"),
        F.when(F.coalesce(F.col("topic_id"), F.lit("")).isin("", "0"), lenient_int("_topic")).otherwise(lenient_int("topic_id")).alias("topic_id"),
        lenient_int("poll.id").alias("poll_id"),
        F.coalesce(F.nullif(F.col("poll.name"), F.lit("")), F.lit("poll")).alias("poll_name"),
        _s("poll.type").alias("poll_type"),
        _s("poll.status").alias("status"),
        _s("poll.results").alias("results_visibility"),
        F.coalesce(F.col("poll.public").cast("int"), F.lit(0)).alias("is_public"),
        iso_or_null(F.nullif(F.col("poll.close"), F.lit(""))).alias("close_at"),
        lenient_int("poll.voters").alias("voters"),
        F.col("opt.id").alias("option_id"),
        _s("opt.html").alias("option_html"),
        F.coalesce(F.col("opt.votes"), F.lit(-1).cast("bigint")).alias("option_votes"),
        F.to_json(header).alias("raw_json"),
    )


def forum_likes_rows(pages: DataFrame, user_col: str = "username", body: str = "body") -> DataFrame:
    """Like pages of a queried user → edges; acting user name = the queried user;
    actions without a post id dropped."""
    a = elements(pages, LIKES, keep=(user_col,), body=body).select(F.col(user_col).alias("acting_username"), F.col("e").alias("a"), "raw_json")
    return a.select(
        lenient_int("a.post_id").alias("post_id"),
        lenient_int("a.topic_id").alias("topic_id"),
        lenient_int("a.post_number").alias("post_number"),
        lenient_int("a.acting_user_id").alias("acting_user_id"),
        "acting_username",
        iso_or_epoch("a.created_at").alias("created_at"),
        F.coalesce(F.col("a.hidden").cast("int"), F.lit(0)).alias("hidden"),
        F.coalesce(F.col("a.deleted").cast("int"), F.lit(0)).alias("deleted"),
        "raw_json",
    ).filter(F.col("post_id") != 0)
