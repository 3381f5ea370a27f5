"""Expiring block, hot and white lists over cards, merchants, ips and devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.operators.joins import lookup_join

_KEY = ["list", "entity_type", "entity_id"]


def entities(df: DataFrame, carry: list[str]) -> DataFrame:
    """One row per non-empty (event, entity), in checking order."""
    pairs = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(t).alias("entity_type"), F.col(c).alias("entity_id"))
                      for i, (t, c) in enumerate(K.ENTITY_COLUMNS)])
    return df.select(*carry, F.explode(pairs).alias("_e")).select(*carry, "_e.*").where(
        F.col("entity_id").isNotNull() & (F.col("entity_id") != ""))


def active(entries: DataFrame, as_of: Column) -> DataFrame:
    return entries.where((F.col("added_at_ms") <= as_of) & (as_of < F.col("expires_at_ms")))


def verdicts(events: DataFrame, entries: DataFrame, at: str = "event_timestamp_ms") -> DataFrame:
    """The list verdict of every event that touches a valid entry.

    A white entry on any entity silences the other lists; otherwise the first
    blocked entity in checking order wins, then the first hot one. The newest
    entry speaks for an entity listed twice.
    """
    seen = entities(events, ["event_id", at])
    met = lookup_join(seen, entries, ["entity_type", "entity_id"], "inner", spread_by=["event_id"])
    met = met.where((F.col("added_at_ms") <= F.col(at)) & (F.col(at) < F.col("expires_at_ms")))
    return told(met.groupBy("event_id").agg(F.min(speaks()).alias("_v")))


def speaks() -> Column:
    """The order in which valid entries speak for an event: the least wins."""
    rank = F.when(F.col("list") == "white", 0).when(F.col("list") == "block", 1).otherwise(2)
    return F.struct(rank.alias("rank"), "ord", (-F.col("added_at_ms")).alias("newest"), "entity_type", "entity_id", "reason")


def told(best: DataFrame) -> DataFrame:
    """event_id and verdict of the winning entries ``_v``."""
    short = F.concat(F.col("_v.entity_type"), F.lit("="), F.substring("_v.entity_id", 1, 12))
    tier = F.when(F.col("_v.rank") == 1, "BLOCK").when(F.col("_v.rank") == 2, "HOT").otherwise("NONE")
    reason = (F.when(F.col("_v.rank") == 0, F.concat(F.lit("whitelist:"), short))
              .when(F.col("_v.rank") == 1, F.coalesce("_v.reason", F.concat(short, F.lit(" on blocklist"))))
              .otherwise(F.coalesce("_v.reason", F.concat(short, F.lit(" on hot-list")))))
    hit = F.col("_v.rank") > 0
    return best.select(
        *[c for c in best.columns if c != "_v"], hit.alias("blocklist_hit"), tier.alias("blocklist_tier"), reason.alias("blocklist_reason"),
        F.when(hit, F.col("_v.entity_type")).otherwise("").alias("matched_entity_type"),
        F.when(hit, F.col("_v.entity_id")).otherwise("").alias("matched_entity_id"))


def check(events: DataFrame, entries: DataFrame, at: str = "event_timestamp_ms") -> DataFrame:
    """Events with their verdict; without list data nothing is hit."""
    joined = events.join(verdicts(events, entries, at), "event_id", "left")
    return joined.withColumns({
        "blocklist_hit": F.coalesce("blocklist_hit", F.lit(False)),
        "blocklist_tier": F.coalesce("blocklist_tier", F.lit("NONE")),
        "blocklist_reason": F.coalesce("blocklist_reason", F.lit("")),
        "matched_entity_type": F.coalesce("matched_entity_type", F.lit("")),
        "matched_entity_id": F.coalesce("matched_entity_id", F.lit("")),
    })


# --- maintenance ---------------------------------------------------------------

def default_ttl_s(list_name: Column, entity_type: Column) -> Column:
    ttl = F.lit(None).cast("long")
    for t, s in K.LIST_TTL_S.items():
        ttl = F.when(entity_type == t, F.lit(s)).otherwise(ttl)
    return F.when(list_name == "white", F.lit(K.WHITE_TTL_S)).otherwise(ttl)


def review(proposals: DataFrame, current: DataFrame) -> DataFrame:
    """Proposals with ``refusal`` (NULL when acceptable) and a complete expiry.

    Proposals: list, entity_type, entity_id, reason, block_count, added_at_ms
    and an optional ttl_s.
    """
    ttl = default_ttl_s(F.col("list"), F.col("entity_type"))
    if "ttl_s" in proposals.columns:
        ttl = F.coalesce(F.col("ttl_s"), ttl)
    p = proposals.withColumn("expires_at_ms", F.col("added_at_ms") + ttl * 1000)
    floor = F.when(F.col("list") == "block", K.MIN_BLOCK_COUNT["block"]).when(
        F.col("list") == "hot", K.MIN_BLOCK_COUNT["hot"]).otherwise(0)
    white = current.where(F.col("list") == "white").select(
        "entity_type", "entity_id", F.col("added_at_ms").alias("_from"), F.col("expires_at_ms").alias("_to"))
    guard = p.alias("p").join(white.alias("w"), ["entity_type", "entity_id"], "left").groupBy(*_KEY, "added_at_ms").agg(
        F.bool_or((F.col("_from") <= F.col("added_at_ms")) & (F.col("added_at_ms") < F.col("_to"))).alias("_white"))
    return p.join(guard, [*_KEY, "added_at_ms"], "left").withColumn(
        "refusal",
        F.when(~F.col("entity_type").isin(K.ENTITY_TYPES), "unknown entity type")
        .when(F.coalesce("block_count", F.lit(0)) < floor, "block count too low")
        .when((F.col("list") != "white") & F.coalesce("_white", F.lit(False)), "on whitelist"),
    ).drop("_white", "ttl_s")


def upsert(current: DataFrame, accepted: DataFrame) -> DataFrame:
    """Latest entry per (list, type, id): adding again replaces reason and expiry."""
    cols = ["reason", "block_count", "added_at_ms", "expires_at_ms"]
    rows = current.select(*_KEY, *cols, F.lit(0).alias("_new")).unionByName(
        accepted.select(*_KEY, *cols, F.lit(1).alias("_new")))
    newest = rows.groupBy(*_KEY).agg(F.max_by(F.struct(*cols), F.struct("added_at_ms", "_new", "expires_at_ms")).alias("_r"))
    return newest.select(*_KEY, "_r.*")


def apply(current: DataFrame, proposals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list table after the accepted proposals, refused proposals)."""
    judged = review(proposals, current)
    return (upsert(current, judged.where(F.col("refusal").isNull())),
            judged.where(F.col("refusal").isNotNull()))


def remove(current: DataFrame, keys: DataFrame) -> DataFrame:
    return current.join(keys.select(*_KEY).distinct(), _KEY, "left_anti")


def removal_report(current: DataFrame, keys: DataFrame) -> DataFrame:
    """1 for every requested key that was present, else 0."""
    there = current.select(*_KEY).distinct().withColumn("removed", F.lit(1))
    return keys.select(*_KEY).distinct().join(there, _KEY, "left").withColumn("removed", F.coalesce("removed", F.lit(0)))


def expire(current: DataFrame, as_of: Column) -> DataFrame:
    return current.where(F.col("expires_at_ms") > as_of)


def inventory(entries: DataFrame, as_of: Column) -> DataFrame:
    """Live entries per list and entity type, with all twelve cells present."""
    spark = entries.sparkSession
    grid = spark.createDataFrame([(a, b) for a in K.LISTS for b in K.ENTITY_TYPES], "list string, entity_type string")
    live = active(entries, as_of).groupBy("list", "entity_type").agg(F.count(F.lit(1)).alias("entries"))
    return grid.join(live, ["list", "entity_type"], "left").fillna(0, ["entries"])


# --- repeat offenders ------------------------------------------------------------

OFFENDER_RULES = {
    "card_window_s": 86_400, "card_block": 3, "card_hot": 2,
    "merchant_window_s": 7 * 86_400, "merchant_block_n": 100, "merchant_block_rate": 0.90,
    "merchant_hot_n": 30, "merchant_hot_rate": 0.50,
    "ip_window_s": 3_600, "ip_block": 5, "device_window_s": 86_400, "device_block": 3,
}


def offender_counts(scored: DataFrame, as_of: Column, **rules) -> DataFrame:
    """Decisions and BLOCKs per entity inside the entity type's own window: one scan, one shuffle."""
    r = OFFENDER_RULES | rules
    window = F.lit(None).cast("long")
    for t in K.ENTITY_TYPES:
        window = F.when(F.col("entity_type") == t, F.lit(r[f"{t}_window_s"] * 1000)).otherwise(window)
    longest = max(r[f"{t}_window_s"] for t in K.ENTITY_TYPES) * 1000
    recent = scored.where(F.col("scored_at_ms") > as_of - longest)
    rows = entities(recent, ["scored_at_ms", "decision"]).where(F.col("scored_at_ms") > as_of - window)
    return rows.groupBy("entity_type", "entity_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("decision") == "BLOCK").alias("blocks"))


def span_name(seconds: int) -> str:
    """A window as analysts read it: 24h, 7d, 90min."""
    for unit, size, least in (("d", 86_400, 2), ("h", 3600, 1), ("min", 60, 1)):
        if seconds % size == 0 and seconds >= least * size:
            return f"{seconds // size}{unit}"
    return f"{seconds}s"


def offenders(scored: DataFrame, as_of: Column, **rules) -> DataFrame:
    """Entities that qualify for a list: list NULL means scanned but not listed."""
    r = OFFENDER_RULES | rules
    kind, n, blocks = F.col("entity_type"), F.col("total"), F.col("blocks")
    rate = blocks / n
    merchant_block = (n >= r["merchant_block_n"]) & (rate >= r["merchant_block_rate"])
    merchant_hot = (n >= r["merchant_hot_n"]) & (rate >= r["merchant_hot_rate"])
    scanned = (F.when(kind == "card", blocks >= 2).when(kind == "merchant", merchant_hot)
               .when(kind == "ip", blocks >= r["ip_block"]).otherwise(blocks >= r["device_block"]))
    listed = (F.when((kind == "card") & (blocks >= r["card_block"]), "block")
              .when((kind == "card") & (blocks == r["card_hot"]), "hot")
              .when((kind == "merchant") & merchant_block, "block")
              .when((kind == "merchant") & merchant_hot, "hot")
              .when(kind.isin("ip", "device"), "block"))
    count = blocks.cast("string")
    last = {t: span_name(r[f"{t}_window_s"]) for t in K.ENTITY_TYPES}
    tail = F.when(F.col("list") == "hot", "hot-list").otherwise("")
    percent = F.concat(F.rint(rate * 100).cast("long").cast("string"), F.lit("%"))  # halves to even
    hot_note = F.when(tail == "", ")").otherwise(", hot-list)")
    reason = (
        F.when(kind == "card", F.concat(count, F.lit(f" BLOCK decisions in last {last['card']}"),
                                        F.when(tail == "", "").otherwise(" (hot-list)")))
        .when(kind == "merchant", F.concat(F.lit("merchant fraud rate "), percent, F.lit(" over "),
                                           n.cast("string"), F.lit(f" txns ({last['merchant']}"), hot_note))
        .when(kind == "ip", F.concat(count, F.lit(f" BLOCK decisions in last {last['ip']} (IP burst)")))
        .otherwise(F.concat(count, F.lit(f" BLOCK decisions in last {last['device']} (device)"))))
    return (offender_counts(scored, as_of, **rules).where(scanned)
            .withColumn("list", listed).withColumn("reason", reason))


def offender_proposals(scored: DataFrame, as_of: Column, **rules) -> DataFrame:
    """The dry run: what an update would add."""
    return offenders(scored, as_of, **rules).where(F.col("list").isNotNull()).select(
        "list", "entity_type", "entity_id", "reason", F.col("blocks").alias("block_count"),
        as_of.cast("long").alias("added_at_ms"))


def update_summary(scored: DataFrame, current: DataFrame, as_of: Column, **rules) -> DataFrame:
    """Scanned, blocked, hot-listed and refused per entity type (all four present)."""
    found = offenders(scored, as_of, **rules).select(
        "list", "entity_type", "entity_id", "reason", F.col("blocks").alias("block_count"),
        as_of.cast("long").alias("added_at_ms"))
    judged = review(found, current)
    ok = F.col("refusal").isNull()
    counts = judged.groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(ok & (F.col("list") == "block")).alias("blocked"),
        F.count_if(ok & (F.col("list") == "hot")).alias("hot"),
        F.count_if(F.col("list").isNotNull() & ~ok).alias("refused"))
    grid = scored.sparkSession.createDataFrame([(t,) for t in K.ENTITY_TYPES], "entity_type string")
    return grid.join(counts, "entity_type", "left").fillna(0)
