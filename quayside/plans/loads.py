"""Dataset loads: each is one job composing readers, conform
steps and table maintenance.  Inputs are landed files or payload frames; the
network fetch that produced them in the reference is not part of a Spark job.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.coerce import best_effort_timestamp, epoch, iso_or_epoch, lenient_int, sentinel_to_null
from quayside.operators import joins as J
from quayside.operators import metrics as M
from quayside.operators import payloads as P
from quayside.operators import tables as TB
from quayside.plans import increment as I
from quayside.sources import files as FS
from quayside.sources import readers as R

# --------------------------------------------------------------------------- #
# CSV loads into plain tables (re-running a day duplicates, as documented)
# --------------------------------------------------------------------------- #

LABELS_DDL = "address STRING, label STRING, introduced_at STRING, source STRING"
PRICES_DDL = "block_date STRING, symbol STRING, price DOUBLE"
BRIDGE_DDL = (
    "timestamp STRING, bridge STRING, source_chain STRING, dest_chain STRING, token STRING, "
    "amount_token DOUBLE, amount_usd DOUBLE, net_usd DOUBLE"
)
SUPPLY_DDL = "label STRING, block_date STRING, supply DOUBLE"
TRANSFERS_DDL = (
    "block_date STRING, block_time STRING, tx_hash STRING, sender STRING, receiver STRING, token_symbol STRING, "
    "token_address STRING, amount DOUBLE, amount_usd DOUBLE"
)
WALLET_EVENTS_DDL = "safe_address STRING, action STRING, action_value STRING, event_time STRING"


def strict_timestamp(c):
    """Best-effort parse that fails the load on unparseable text (``parseDateTimeBestEffort``)."""
    parsed = best_effort_timestamp(c)
    return F.when(F.col(c).isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit("unparseable timestamp: "), F.col(c)))
    )


def labels_load(spark: SparkSession, path: str, spec: TB.TableSpec) -> int:
    df = R.read_csv(spark, path, LABELS_DDL).select(
        "address", "label", strict_timestamp("introduced_at").alias("introduced_at"), "source"
    )
    return TB.append(df, spec)


def prices_load(spark: SparkSession, path: str, spec: TB.TableSpec) -> int:
    df = R.read_csv(spark, path, PRICES_DDL).select(
        F.to_date(strict_timestamp("block_date")).alias("block_date"), "symbol", F.col("price").cast("double").alias("price")
    )
    return TB.append(df, spec)


def bridge_flows_load(spark: SparkSession, path: str, spec: TB.TableSpec) -> int:
    df = R.read_csv(spark, path, BRIDGE_DDL).withColumn("timestamp", strict_timestamp("timestamp"))
    return TB.append(df, spec)


def supply_load(spark: SparkSession, path: str, spec: TB.TableSpec) -> int:
    df = R.read_csv(spark, path, SUPPLY_DDL).select(
        "label", F.to_date(strict_timestamp("block_date")).alias("block_date"), "supply"
    )
    return TB.append(df, spec)


# --------------------------------------------------------------------------- #
# Replacing CSV loads with overlap
# --------------------------------------------------------------------------- #

TRANSFER_KEY = ("sender", "receiver", "block_time", "tx_hash", "token_address")
WALLET_EVENT_KEY = ("safe_address", "action", "action_value", "event_time")


def _dated(df: DataFrame, needed: str, spec: TB.TableSpec, entity: str, run_ts=None) -> DataFrame:
    """The rows that have the column a table may not lack; the other rows go to the
    table's rejects.  Landed files are read for each of the two: a copy of the load
    would be written and read whole to save a second scan of them."""
    bad = df.filter(F.col(needed).isNull()).select(
        F.lit(entity).alias("entity"), F.lit(None).cast("string").alias("page"), F.lit(None).cast("int").alias("pos"),
        F.lit(f"no_{needed}").alias("reason"), F.to_json(F.struct(*df.columns)).alias("text"), F.lit(run_ts).cast("timestamp_ntz").alias("rejected_at"))
    TB.append(bad, P.rejects_of(spec))
    return df.filter(F.col(needed).isNotNull())


def celo_transfers_load(spark: SparkSession, path: str, spec: TB.TableSpec, seq: int | None = None, optimize: bool = False) -> None:
    """Transfers CSV → lowercase addresses → replacing upsert (last load wins).
    Rows without a time go to the rejects; ``optimize`` compacts the table after."""
    df = R.read_csv(spark, path, TRANSFERS_DDL).select(
        F.to_date(best_effort_timestamp("block_date")).alias("block_date"),
        best_effort_timestamp("block_time").alias("block_time"),
        "tx_hash", F.lower("sender").alias("sender"), F.lower("receiver").alias("receiver"), "token_symbol",
        F.lower("token_address").alias("token_address"), "amount", "amount_usd",
    )
    TB.upsert(_dated(df, "block_time", spec, "transfers"), spec, seq=seq)
    if optimize:
        TB.compact(spark, spec)


def celo_wallet_events_load(spark: SparkSession, path: str, spec: TB.TableSpec, seq: int | None = None, optimize: bool = False) -> None:
    df = R.read_csv(spark, path, WALLET_EVENTS_DDL).select(
        F.lower("safe_address").alias("safe_address"), "action",
        sentinel_to_null("action_value").alias("action_value"),
        best_effort_timestamp("event_time").alias("event_time"),
    )
    TB.upsert(_dated(df, "event_time", spec, "wallet_events"), spec, seq=seq)
    if optimize:
        TB.compact(spark, spec)


def blacklist_load(spark: SparkSession, path: str, spec: TB.TableSpec) -> int:
    """Whole JSON document → full replace (readers never see an empty table)."""
    return TB.full_replace(spark, R.read_json_array(spark, path), spec)


def wallets_load(spark: SparkSession, path: str, spec: TB.TableSpec, target: T.StructType) -> None:
    TB.append(R.conform_csv(spark, path, target), spec)
    TB.compact(spark, spec)


def ember_load(spark: SparkSession, path: str, spec: TB.TableSpec, version, renames: dict[str, str]) -> None:
    """Inferred-schema CSV → renamed columns → parsed date → versioned upsert → compact."""
    raw = R.read_csv(spark, path)
    df = raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in renames.items()])
    df = _dated(df.withColumn("date", F.to_date(best_effort_timestamp(F.col("date").cast("string")))), "date", spec, "ember")
    TB.upsert(df.withColumn("version", F.lit(version).cast("timestamp_ntz")), spec)
    TB.compact(spark, spec)


# The crawl tables, each with its replacing key (parts may be NULL).
CRAWL_KEYS = {
    "agent_semvers_avg_1d": ("min_crawl_created_at", "agent_version_type", "agent_version_semver_str"),
    "agent_semvers_over_7d": ("min_crawl_created_at", "agent_version_type", "crawl_created_at"),
    "agent_types_avg_1d": ("min_crawl_created_at", "agent_version_type"),
    "agent_types_over_7d": ("min_crawl_created_at", "crawl_created_at", "agent_version_type"),
    "cloud_provider_avg_1d": ("min_crawl_created_at", "agent_version_type", "cloud_provider"),
    "cloud_provider_over_7d": ("min_crawl_created_at", "crawl_created_at", "agent_version_type", "cloud_provider"),
    "countries_avg_1d": ("min_crawl_created_at", "agent_version_type", "country"),
    "countries_over_7d": ("min_crawl_created_at", "crawl_created_at", "agent_version_type", "country"),
    "discv5_stale_records": ("crawl_id", "crawl_created_at"),
    "is_cloud_avg_1d": ("min_crawl_created_at", "agent_version_type", "is_cloud"),
    "is_cloud_over_7d": ("min_crawl_created_at", "crawl_created_at", "agent_version_type", "is_cloud"),
    "protocols_support_over_7d": ("min_crawl_created_at", "crawl_created_at", "agent_version_type", "protocol"),
    "quic_support_over_7d": ("min_crawl_created_at", "agent_version_type", "quic_support"),
}
# The columns of a subject, beside the type, times and counts that all have.
CRAWL_SUBJECTS = {
    "agent_semvers": "agent_version_semver ARRAY<BIGINT>, agent_version_semver_str STRING", "agent_types": "", "cloud_provider": "cloud_provider STRING",
    "countries": "country_name STRING, country STRING", "is_cloud": "is_cloud STRING", "protocols_support": "protocol STRING",
    "quic_support": "quic_support STRING",
}
CRAWL_STALE = "crawl_id STRING, crawl_created_at TIMESTAMP_NTZ, total BIGINT, reachability STRING, count BIGINT, percentage DOUBLE"


def crawl_schema(table: str) -> str:
    """Columns of a crawl table: averages of a day have samples and fractional
    counts, series over seven days the time of each crawl and whole counts."""
    if table == "discv5_stale_records":
        return CRAWL_STALE
    subject, kind = next((table.removesuffix(k), k) for k in ("_avg_1d", "_over_7d") if table.endswith(k))
    daily = kind == "_avg_1d"
    parts = ["agent_version_type STRING, min_crawl_created_at TIMESTAMP_NTZ, max_crawl_created_at TIMESTAMP_NTZ"]
    parts += [] if daily else ["crawl_created_at TIMESTAMP_NTZ"]
    parts += [CRAWL_SUBJECTS[subject]] if CRAWL_SUBJECTS[subject] else []
    parts += ["__count DOUBLE, __samples BIGINT, __pct DOUBLE, __total DOUBLE"] if daily else ["__count BIGINT, __pct DOUBLE, __total BIGINT"]
    return ", ".join(parts)


def crawl_spec(root: str, table: str) -> TB.TableSpec:
    return TB.TableSpec(path=f"{root.rstrip('/')}/{table}", key=CRAWL_KEYS[table], schema=crawl_schema(table))


def crawl_load(spark: SparkSession, landing: str, root: str, mode: str = "all", date=None) -> DataFrame:
    """Crawl drops ``<landing>/<table>/<date>.parquet`` → the replacing tables under
    ``root`` (NULL key parts equal each other).  The folder's name says which
    table; the drops are all, the newest, or those of a date.  Columns are found
    by position, as an insert of all columns does.  Loading again changes nothing.

    Returns a row per known table: ``table_name, rows`` (NULL without drops).
    """
    done = []
    for table in CRAWL_KEYS:
        folder = f"{landing.rstrip('/')}/{table}"
        paths = [r.path for r in FS.select_files(spark, folder, mode, date).select("path").collect()] if TB.path_exists(spark, folder) else []
        rows = None
        if paths:
            spec = crawl_spec(root, table)
            names = T.StructType.fromDDL(spec.schema)
            df = R.load_parquet(spark, paths, names.fieldNames())
            rows = TB.upsert(df.select(*[F.col(f.name).cast(f.dataType) for f in names.fields]), spec)
        done.append((table, rows))
    return spark.createDataFrame(done, "table_name STRING, rows BIGINT")


# --------------------------------------------------------------------------- #
# Payload loads
# --------------------------------------------------------------------------- #


def fills_load(spark: SparkSession, pages: DataFrame, target: TB.TableSpec, owners: DataFrame | None, now,
               known_days: int = 14, mode: str = "daily", source: DataFrame | None = None) -> int:
    """Trades pages → fills → versioned upsert; pages that cannot be read go to the
    table's rejects.  Returns the rows written.

    ``daily`` skips the fills of ``owners`` held since ``known_days`` days,
    ``backfill`` writes all, ``repair`` writes all fills of the owners of whom
    ``source`` (on-chain fills) knows one that the table lacks; what was held
    comes again and is resolved by the key.
    """
    if mode == "daily":
        def keep(fills):
            return J.skip_known_fills(fills, recent_fills(spark, target, now, known_days), owners, now, known_days)
    elif mode == "repair":
        # Owners only, found before the load, so that what finds them is off the disk while fills are shuffled.
        behind = TB._staged(spark, J.missing_by_owner(missing_of(spark, source, target)).select(F.lower("taker").alias("_owner")).distinct())

        def keep(fills):
            return fills.join(behind, F.lower(fills["owner"]) == behind["_owner"], "left_semi")
    elif mode == "backfill":
        def keep(fills):
            return fills
    else:
        raise ValueError(f"unknown mode {mode!r}")
    written = []
    # One time of ingestion, so one month where the table is laid out by it.
    P.land_into(pages, P.TRADES, P.rejects_of(target), lambda parsed: written.append(TB.upsert(
        keep(P.fills_rows(parsed)).withColumn("ingested_at", F.lit(now).cast("timestamp_ntz")), target, rebalance=target.month_of != "ingested_at")), run_ts=now)
    return written[0]


def recent_fills(spark: SparkSession, target: TB.TableSpec, now, days: int) -> DataFrame:
    """Stored fills of the last ``days`` days by ``ingested_at``.  Where the table is
    laid out by the month of it, only those months are read; superseded rows may
    be among them, which an anti-join by key does not mind."""
    stored = TB.read_raw(spark, target)
    since = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    if target.month_of == "ingested_at":
        stored = stored.filter(F.col(TB.MONTH) >= F.trunc(since.cast("date"), "MM"))
    return stored.filter(F.col("ingested_at") >= since).select(*TB.business_columns(stored))


def missing_of(spark: SparkSession, source: DataFrame, target: TB.TableSpec) -> DataFrame:
    """On-chain fills that the table lacks; only its key columns are read."""
    held = TB.read_raw(spark, target).select("order_uid", "tx_hash", "log_index")
    return J.missing_fills(source, held)


DAY_LIMIT = 100_000  # events of one answer; one with as many may be cut off


def events_load(spark: SparkSession, ndjson_path: str, events: TB.TableSpec, ledger: TB.TableSpec,
                project_id: str, today, run_ts, backfill: tuple | None = None, from_date=None, limit: int = DAY_LIMIT) -> DataFrame:
    """NDJSON export → events of the days still to do → upsert → ledger marks.

    Days come from the ledger (a backfill's range, or from the day after the last
    completed one) and completed ones are left out by an anti-join.  A day with
    ``limit`` events or more is judged by its hours: if one of them reaches the
    limit too, the day and those after it are not loaded.  Marks are counted from
    the rows this load committed, so a run that dies between the append and the
    marks leaves days to do, not holes; loading them again is resolved by the
    key.  An empty day is marked only when it is old enough.  Events without a
    time belong to no day and are loaded with every run that has a day to do.

    Returns a row per planned day: ``day, rows, outcome`` (complete, waiting,
    truncated, stopped).  Lines that cannot be read and events with a bad time
    go to the events table's rejects.
    """
    planned = I.date_plan(spark, TB.read_latest(spark, ledger), today, backfill=backfill, from_date=from_date, project_id=project_id)
    # One row per calendar day.
    todo = TB._staged(spark, I.pending_dates(planned, TB.read_latest(spark, ledger), project_id=project_id))
    ok, rejects = R.read_events(spark, ndjson_path)
    good, bad_time = R.events_rows(ok, project_id)
    rows = TB._staged(spark, good.withColumn("_day", F.to_date("event_time")))
    no_time = F.col("event_time") == epoch().cast(rows.schema["event_time"].dataType)
    verdicts = todo.join(M.truncation_check(rows, "event_time", limit), "day", "left").withColumn("cut", F.col("suspect") & ~F.col("complete"))
    first_cut = verdicts.filter("cut").agg(F.min("day")).first()[0]
    open_days = todo if first_cut is None else todo.filter(F.col("day") < F.lit(first_cut))
    seq = TB.next_load_seq()
    if not todo.isEmpty():
        wanted = rows.join(open_days.withColumnRenamed("day", "_day"), "_day", "left_semi").unionByName(rows.filter(no_time)).drop("_day")
        TB.upsert(wanted, events, seq=seq)
        bad = rejects.select("line", "reject_reason").unionByName(bad_time.select(F.col("properties").alias("line"), F.lit("bad_time").alias("reject_reason")))
        TB.append(bad.select(F.lit("events").alias("entity"), F.lit(None).cast("string").alias("page"), F.lit(None).cast("int").alias("pos"),
                             F.col("reject_reason").alias("reason"), F.col("line").alias("text"), F.lit(run_ts).cast("timestamp_ntz").alias("rejected_at")),
                  P.rejects_of(events))
    committed = open_days
    if TB.path_bytes(spark, events.path):
        stored = TB.read_raw(spark, events).filter(F.col(TB.SEQ) == seq)
        counts = stored.groupBy(F.to_date("event_time").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
        committed = open_days.join(counts, "day", "left")
    else:
        committed = open_days.withColumn("rows", F.lit(None).cast("bigint"))
    judged = TB._staged(spark, I.late_data_guard(committed.fillna(0, ["rows"]), today))
    I.mark_complete(spark, judged.filter("mark_complete").select("day", "rows"), ledger, project_id, run_ts)
    outcome = F.when(F.col("mark_complete"), "complete").when(F.col("mark_complete").isNotNull(), "waiting").when(F.col("cut"), "truncated").otherwise("stopped")
    return verdicts.select("day", "cut").join(judged, "day", "left").select("day", F.coalesce("rows", F.lit(0)).alias("rows"), outcome.alias("outcome"))


def profiles_load(spark: SparkSession, pages: DataFrame, spec: TB.TableSpec, project_id: str, synced_at) -> None:
    parsed = P.land(pages, P.PROFILES, P.rejects_of(spec), run_ts=synced_at)
    TB.upsert(P.profiles_rows(parsed, project_id).withColumn("synced_at", F.lit(synced_at).cast("timestamp_ntz")), spec)


def governance_load(spark: SparkSession, tables: dict[str, TB.TableSpec], space: str, now, space_payloads: DataFrame | None = None,
                    proposal_pages: DataFrame | None = None, vote_pages: DataFrame | None = None, follow_pages: DataFrame | None = None,
                    days: int = 7, backfill: bool = False) -> None:
    """Space, proposals, votes and follows → versioned upserts (``tables``: ``space,
    proposals, votes, follows``); what was not fetched is left alone.

    Votes are loaded for the proposals of this run that are open, pending or ended
    within ``days``; all in a backfill.  Pages that cannot be read go to the
    rejects of their table.
    """
    from quayside.operators.filters import open_or_recent

    def put(name: str, pages: DataFrame | None, payload: P.Payload, rows, keep=lambda df: df) -> int | None:
        """Loads a table; returns the load's number."""
        if pages is None:
            return None
        seq = TB.next_load_seq()
        P.land_into(pages, payload, P.rejects_of(tables[name]), lambda parsed: TB.upsert(
            keep(rows(parsed, space)).withColumn("ingested_at", F.lit(now).cast("timestamp_ntz")), tables[name], seq=seq), run_ts=now)
        return seq

    put("space", space_payloads, P.SPACES, P.snapshot_space_rows)
    loaded = put("proposals", proposal_pages, P.PROPOSALS, P.snapshot_proposals_rows)
    if loaded is not None:
        proposals = TB.read_raw(spark, tables["proposals"]).filter(F.col(TB.SEQ) == loaded)
        wanted = open_or_recent(proposals, "state", "end_at", days, now, backfill).select(F.col("id").alias("proposal_id"))
        put("votes", vote_pages, P.VOTES, P.snapshot_votes_rows, lambda v: v.join(wanted, "proposal_id", "left_semi"))
    put("follows", follow_pages, P.FOLLOWS, P.snapshot_follows_rows)


class ForumRun(NamedTuple):
    """What a forum load decided: topics to read with the reason (``bumped``,
    ``open_poll``), users whose likes were taken, listed posts that never came."""

    work: DataFrame
    targets: DataFrame
    missing_posts: DataFrame


def forum_load(spark: SparkSession, category_payloads: DataFrame, user_pages: DataFrame, like_pages: DataFrame,
               topic_details: DataFrame, topic_stubs: DataFrame, tables: dict[str, TB.TableSpec], now,
               post_pages: DataFrame | None = None, backfill: bool = False) -> ForumRun:
    """Categories, users, likes, topics, posts and polls (the keys of ``tables``).

    What to read is decided and written down before any table changes: topics
    whose stub was bumped after the newest stored one, topics with a poll that the
    stored polls say is open, and users whose likes given grew past the stored
    snapshot (in a backfill: past the edges held).  A stored poll is written again
    only when it changed.  Posts and polls come from the topic payloads and any
    further post pages.
    """
    def held(name: str, ddl: str) -> DataFrame:
        return TB.read_latest(spark, tables[name]) if TB.path_bytes(spark, tables[name].path) else spark.createDataFrame([], ddl)

    def put(name: str, rows: DataFrame) -> None:
        TB.upsert(rows.withColumn("ingested_at", F.lit(now).cast("timestamp_ntz")), tables[name])

    def parse(pages: DataFrame, payload: P.Payload, name: str, keep=()) -> DataFrame:
        return P.land(pages, payload, P.rejects_of(tables[name]), keep, run_ts=now)

    stubs = topic_stubs.select(lenient_int("id").alias("topic_id"), iso_or_epoch(
        F.coalesce(F.nullif(F.col("bumped_at"), F.lit("")), F.col("created_at")) if "created_at" in topic_stubs.columns else F.col("bumped_at")).alias("bumped"))
    newest = None if backfill else I.watermark_value(held("topics", "bumped_at TIMESTAMP"), "bumped_at")
    fresh = (stubs if newest is None else stubs.filter(F.col("bumped") > F.lit(newest))).select("topic_id").distinct()
    polls = held("polls", "topic_id BIGINT, status STRING").filter("status = 'open' AND topic_id > 0")
    work = TB._staged(spark, J.with_open_polls(fresh, polls).join(fresh.withColumn("why", F.lit("bumped")), "topic_id", "left")
                      .select("topic_id", F.coalesce("why", F.lit("open_poll")).alias("why")))
    users = P.forum_users_rows(parse(user_pages, P.USERS, "users"))
    if backfill:
        baseline = held("likes", "acting_username STRING").groupBy(F.col("acting_username").alias("username")).agg(F.count(F.lit(1)).alias("likes_given"))
    else:
        baseline = held("users", "username STRING, likes_given BIGINT").select("username", "likes_given")
    targets = TB._staged(spark, J.growth_targets(users.select("username", "likes_given"), baseline, "username", "likes_given"))

    put("categories", P.category_tree_flatten(parse(category_payloads, P.CATEGORIES, "categories")))
    put("users", users)
    likes = P.forum_likes_rows(parse(like_pages, P.LIKES, "likes", ("username",)))
    put("likes", likes.join(targets.select(F.col("username").alias("acting_username")), "acting_username", "left_semi"))
    wanted = work.select(F.col("topic_id").alias("_id"))
    details = parse(topic_details, P.TOPICS, "topics")
    details = details.join(wanted, lenient_int("e.id") == F.col("_id"), "left_semi")
    put("topics", P.forum_topics_rows(details, topic_stubs))
    payloads = details
    if post_pages is not None:
        more = parse(post_pages, P.TOPICS, "posts")
        payloads = payloads.unionByName(more.join(wanted, lenient_int("e.id") == F.col("_id"), "left_semi"))
    posts = P.forum_posts_rows(payloads)
    put("posts", posts)
    TB.upsert_changed(spark, P.forum_poll_options(payloads).withColumn("ingested_at", F.lit(now).cast("timestamp_ntz")), tables["polls"])
    return ForumRun(work, targets, P.posts_still_missing(payloads, posts))


# --------------------------------------------------------------------------- #
# Price loads
# --------------------------------------------------------------------------- #


def spot_prices_load(spark: SparkSession, payloads: DataFrame, allowlist: DataFrame, spec: TB.TableSpec,
                     day, run_ts) -> DataFrame:
    """Daily quotes → allowlist match → insert, then prune the older rows of the
    days returned.  ``day`` is the requested day, or the name of the payload
    column that holds it when several days are loaded at once.  Returns the
    allowlisted assets that came back empty."""
    dated = payloads.withColumn("_day", F.col(day) if day in payloads.columns else F.lit(day).cast("date"))
    quotes = P.spot_price_rows(dated, "_day")
    rows = J.allowlist_lookup(quotes, allowlist).select(
        "block_date", "symbol", "chain", "address", "price", "confidence", F.lit(run_ts).cast("timestamp_ntz").alias("ingested_at")
    )
    TB.prune_days(spark, spec, rows, "block_date", "ingested_at")
    return J.missing_assets(allowlist, rows, ["chain", "address"])


def price_backfill_load(spark: SparkSession, windows: DataFrame, spec: TB.TableSpec, run_ts, allowlist: DataFrame | None = None, valid=None) -> None:
    """Chart windows → one point per asset and day → insert, prune the returned
    series; assets that fail ``valid`` are inserted but never pruned.

    With ``allowlist`` the rows are ``block_date, symbol, chain, address, price,
    confidence, ingested_at`` of its assets, and a series is one of a chain and
    address; without, the asset is the coin as it is named."""
    series = M.merge_chart_windows(P.chart_points(windows), "coin", "day", "price", "window_no", "pos", "confidence", P.chart_confidences(windows))
    stamp = F.lit(run_ts).cast("timestamp_ntz").alias("ingested_at")
    if allowlist is None:
        rows = series.select(F.col("coin").alias("asset"), F.col("day").alias("block_date"), "price", "confidence", stamp)
        key = ["asset"]
    else:
        rows = J.allowlist_lookup(series, allowlist).select(F.col("day").alias("block_date"), "symbol", "chain", "address", "price", "confidence", stamp)
        key = ["chain", "address"]
    TB.prune_series(spark, spec, rows, key, "block_date", "ingested_at", valid=valid)


def market_prices_load(spark: SparkSession, charts: DataFrame, allowlist: DataFrame, spec: TB.TableSpec, today, run_ts, id_col: str = "coingecko_id",
                       dry_run: bool = False) -> DataFrame:
    """The second price source: a market chart per asset id → last point per day,
    today left out → rows ``block_date, coingecko_id, symbol, price, ingested_at``
    → insert, prune each asset's own older rows.

    An asset whose chart cannot be read goes to the rejects and its stored rows
    stay; the others load.  Returns the allowlisted ids that brought no row;
    ``dry_run`` returns the rows and writes nothing but rejects.
    """
    from quayside.operators.filters import SLUG_ID, exclude_today

    parsed = P.land(charts, P.MARKET_CHARTS, P.rejects_of(spec), keep=(id_col,), page=(id_col,), run_ts=run_ts)
    daily = M.last_price_per_day(P.market_chart_rows(parsed, id_col), id_col, "ts", "price", ["ts", "pos"])
    named = M.first_per_id(allowlist.filter(F.col(id_col).isNotNull()), id_col, "pos", ["symbol"]).select(id_col, "symbol")
    rows = exclude_today(daily, "day", today, False).join(named, id_col).select(
        F.col("day").alias("block_date"), id_col, "symbol", "price", F.lit(run_ts).cast("timestamp_ntz").alias("ingested_at"))
    if dry_run:
        return rows
    rows = TB._staged(spark, rows)
    TB.prune_series(spark, spec, rows, id_col, "block_date", "ingested_at", per_asset=True, valid=F.col(id_col).rlike(SLUG_ID))
    return J.missing_assets(named.select(id_col), rows, id_col)


def full_history_load(spark: SparkSession, points: DataFrame, spec: TB.TableSpec, today, run_ts,
                      include_today: bool = False, dry_run: bool = False) -> DataFrame | None:
    """Full history: last point per day, today excluded, insert, per-asset prune
    of the assets whose identifier is safe; the others are only inserted.

    ``dry_run`` returns the rows that would be written and leaves the table alone.
    """
    from quayside.operators.filters import SLUG_ID, exclude_today

    daily = M.last_price_per_day(points, "asset", "ts", "price", "pos")
    daily = exclude_today(daily, "day", today, include_today)
    rows = daily.select("asset", F.col("day").alias("block_date"), "price",
                        F.lit(run_ts).cast("timestamp_ntz").alias("ingested_at"))
    if dry_run:
        return rows
    TB.prune_series(spark, spec, rows, "asset", "block_date", "ingested_at", per_asset=True, valid=F.col("asset").rlike(SLUG_ID))
    return None
