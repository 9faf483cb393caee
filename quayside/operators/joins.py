"""Joins: anti/semi repair joins, allowlist lookups, growth targeting.

No join strategy is forced: Catalyst and AQE turn a join into a broadcast at
runtime when one side turns out small, which is the checked bound, and split
skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.coerce import coin_key

def changed_rows(new: DataFrame, held: DataFrame, key) -> DataFrame:
    """Rows of ``new`` that are not identical to the held row of their key.

    Equality is NULL-safe over every column of ``new``; the key columns are plain
    equi-keys so the join hashes on them.
    """
    key = [key] if isinstance(key, str) else list(key)
    cols = new.columns
    h = held.select(*[F.col(c).alias(f"_h_{c}") for c in cols])
    cond = [new[c] == h[f"_h_{c}"] for c in key] + [
        new[c].eqNullSafe(h[f"_h_{c}"]) for c in cols if c not in key
    ]
    return new.join(h, reduce(lambda a, b: a & b, cond), "left_anti")


def fill_keys(df: DataFrame, uid: str, tx: str, log: str) -> DataFrame:
    return df.select(
        F.col(uid).alias("order_uid"), F.lower(F.col(tx)).alias("tx_hash"), F.col(log).alias("log_index")
    )


def missing_fills(source: DataFrame, target: DataFrame, start=None, ts_col: str = "block_timestamp") -> DataFrame:
    """On-chain fills absent from the landed table by (order_uid, lower(tx), log_index).

    ``source``: taker, order_uid, transaction_hash, log_index, block_timestamp.
    ``target``: order_uid, tx_hash, log_index.  Blank uids are excluded; order_uid
    compares case-sensitively.  ``start`` is the optional backfill lower bound.
    """
    s = source.filter(F.col("order_uid").isNotNull() & (F.col("order_uid") != ""))
    if start is not None:
        s = s.filter(F.col(ts_col) >= F.lit(start).cast("date"))
    s = s.select("taker", "order_uid", F.lower("transaction_hash").alias("tx_hash"), "log_index")
    t = fill_keys(target, "order_uid", "tx_hash", "log_index")
    return s.join(t, ["order_uid", "tx_hash", "log_index"], "left_anti")


def missing_by_owner(missing: DataFrame) -> DataFrame:
    """Distinct missing orders per owner, heaviest first (ties by owner)."""
    return (
        missing.groupBy("taker")
        .agg(F.countDistinct("order_uid").alias("missing_orders"))
        .orderBy(F.desc("missing_orders"), F.asc("taker"))
    )


def owner_semi(target: DataFrame, owners: DataFrame, owner_col: str = "owner") -> DataFrame:
    """Target rows whose owner is in the discovered owner set (the IN-list as a semi join)."""
    return target.join(owners.select(F.col(owners.columns[0]).alias(owner_col)), owner_col, "left_semi")


def skip_known_fills(new: DataFrame, target: DataFrame, owners: DataFrame, now, days: int = 14) -> DataFrame:
    """New trades minus keys already held for these owners, ingested in the last ``days``.

    Keys are compared lowercased on both sides (one rule for uid and tx hash).
    """
    held = owner_semi(target, owners)
    ref = F.lit(now).cast(held.schema["ingested_at"].dataType)
    known = held.filter(F.col("ingested_at") >= ref - F.expr(f"INTERVAL {int(days)} DAYS"))
    known = known.select(
        F.lower("order_uid").alias("_u"), F.lower("tx_hash").alias("_t"), F.col("log_index").alias("_l")
    )
    # The keys are computed where they are compared: new rows are not shuffled with a copy of theirs.
    same = (F.lower(new["order_uid"]) == known["_u"]) & (F.lower(new["tx_hash"]) == known["_t"]) & (new["log_index"] == known["_l"])
    return new.join(known, same, "left_anti")


def allowlist_lookup(quotes: DataFrame, allowlist: DataFrame, quote_key: str = "coin") -> DataFrame:
    """Quotes matched to the allowlist by ``chain:address``, case-insensitive on both parts."""
    dim = allowlist.select("*", coin_key("chain", "address").alias("_k"))
    q = quotes.select("*", F.lower(F.trim(F.col(quote_key))).alias("_k"))
    return q.join(dim, "_k").drop("_k")


def missing_assets(allowlist: DataFrame, rows: DataFrame, key) -> DataFrame:
    """Allowlisted assets that returned no row."""
    key = [key] if isinstance(key, str) else list(key)
    return allowlist.join(rows.select(*key).distinct(), key, "left_anti")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` (requested − returned)."""
    return a.subtract(b.select(*a.columns))


def growth_targets(users: DataFrame, baseline: DataFrame, user_col: str, count_col: str) -> DataFrame:
    """Users whose counter grew past the baseline (absent baseline = 0); positive only."""
    base = baseline.select(F.col(user_col), F.col(count_col).alias("_base"))
    return (
        users.join(base, user_col, "left")
        .withColumn("baseline", F.coalesce(F.col("_base"), F.lit(0)).cast("bigint"))
        .filter((F.col(count_col) > F.col("baseline")) & (F.col(count_col) > 0))
        .drop("_base")
    )


def with_open_polls(selected: DataFrame, open_topics: DataFrame, topic_col: str = "topic_id") -> DataFrame:
    """Add topics carrying an open poll that the increment did not already select."""
    extra = open_topics.select(topic_col).distinct().join(selected.select(topic_col), topic_col, "left_anti")
    return selected.select(topic_col).unionByName(extra)


def topic_stub_join(details: DataFrame, stubs: DataFrame, id_col: str = "id") -> DataFrame:
    """Detail ⟕ list stub; ``bumped_at`` = detail → stub → last_posted_at."""
    s = stubs.select(F.col(id_col), F.col("bumped_at").alias("_stub_bumped"))
    return (
        details.join(s, id_col, "left")
        .withColumn("bumped_at", F.coalesce(F.col("bumped_at"), F.col("_stub_bumped"), F.col("last_posted_at")))
        .drop("_stub_bumped")
    )


def like_post_author(likes: DataFrame, posts: DataFrame) -> DataFrame:
    """Resolve each like edge to the author of the liked post."""
    p = posts.select(F.col("id").alias("post_id"), F.col("user_id").alias("author_id"))
    return likes.join(p, "post_id", "left")


def price_compare(a: DataFrame, b: DataFrame, keys, price: str = "price") -> DataFrame:
    """Full outer join of two price sources with the relative difference per row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    j = a.select(*keys, F.col(price).alias("price_a")).join(b.select(*keys, F.col(price).alias("price_b")), keys, "full")
    rel = F.abs(F.col("price_a") - F.col("price_b")) / F.col("price_b")
    return j.withColumn("rel_diff", F.when(F.col("price_b") != 0, rel))


def price_compare_summary(compared: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Agreement report over :func:`price_compare` rows: pairs compared, exact
    (or within ``tolerance``) matches, median and maximum relative difference,
    and rows present in only one source.  ``median`` is exact (not a sketch)."""
    both = F.col("price_a").isNotNull() & F.col("price_b").isNotNull()
    return compared.agg(
        F.count_if(both).alias("pairs"),
        F.count_if(both & (F.col("rel_diff") <= tolerance)).alias("agreeing"),
        F.median(F.when(both, F.col("rel_diff"))).alias("median_rel_diff"),
        F.max(F.when(both, F.col("rel_diff"))).alias("max_rel_diff"),
        F.count_if(F.col("price_b").isNull()).alias("only_a"),
        F.count_if(F.col("price_a").isNull()).alias("only_b"),
    )


def price_priority(sources: list[DataFrame], keys, min_confidence: float = 0.9) -> DataFrame:
    """Best source per key: sources in priority order; the first only when its
    confidence reaches ``min_confidence`` (NULL confidence counts as trusted).

    A per-key ``min`` of (rank, ...) — partial aggregation, no window.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = []
    for i, s in enumerate(sources):
        ok = F.lit(True) if i > 0 else (F.col("confidence").isNull() | (F.col("confidence") >= min_confidence))
        ranked.append(
            s.filter(ok).select(*keys, F.lit(i + 1).alias("source_rank"), "price", "confidence")
        )
    u = reduce(lambda x, y: x.unionByName(y), ranked)
    best = u.groupBy(*keys).agg(F.min(F.struct("source_rank", "price", "confidence")).alias("_b"))
    return best.select(*keys, "_b.source_rank", "_b.price", "_b.confidence")

