"""Sessions and ordered item sequences that survive a dominant user.

A window over one user's whole history puts that history into one task. Here
a timeline is cut into fixed time slots: rows are ordered inside (key, slot),
each slot is reduced to a one-row summary, the much smaller summaries are
chained per key, and the result is joined back. The heaviest task holds one
slot of one key, the chain at most one row per active slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.constants import PURCHASE, SESSION_GAP_MINUTES
from basketlens.functions.measures import kind_count
from basketlens.operators.metrics import rows

# Slot width: an hour bounds a slot by what one key produces in an hour, while
# a key's chain stays below 9000 rows per year of history.
SLOT_SECONDS = 3600

# Longest item array in one row; Word2Vec itself cuts sentences at this length.
MAX_ITEMS = 1000


def _seconds(time: str = "event_time") -> Column:
    return F.unix_seconds(F.col(time).cast("timestamp"))


def _slotted(events: DataFrame, key: str, slot_seconds: int) -> DataFrame:
    """Events with their slot and their rank inside it."""
    in_slot = Window.partitionBy(key, "_slot").orderBy("event_time", "event_id")
    return (
        events.withColumn("_sec", _seconds())
        .withColumn("_slot", F.floor(F.col("_sec") / slot_seconds))
        .withColumn("_rank", F.row_number().over(in_slot).cast("long"))
    )


def _before(key: str):
    return Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)


def keyed_positions(events: DataFrame, key: str, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """1-based position of every event in its key's timeline, as ``position``."""
    slotted = _slotted(events, key, slot_seconds)
    counts = slotted.groupBy(key, "_slot").agg(rows().alias("_n"))
    offsets = counts.select(key, "_slot", F.coalesce(F.sum("_n").over(_before(key)), F.lit(0)).alias("_offset"))
    placed = slotted.join(offsets, [key, "_slot"])
    return placed.withColumn("position", F.col("_offset") + F.col("_rank")).drop("_sec", "_slot", "_rank", "_offset")


def assign_sessions(
    events: DataFrame, gap_minutes: float = SESSION_GAP_MINUTES, slot_seconds: int = SLOT_SECONDS
) -> DataFrame:
    """Sessions per user: a new one starts after a pause longer than the gap.

    Pauses count in whole seconds, and a pause of exactly the gap stays in the
    session. Adds ``prev_event_time``, ``gap_minutes``, ``is_new_session``,
    ``session_id`` (1, 2, ... per user) and ``position`` inside the session.
    """
    limit = int(gap_minutes * 60)
    in_slot = Window.partitionBy("user_id", "_slot").orderBy("event_time", "event_id")
    so_far = in_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    inner = (
        _slotted(events, "user_id", slot_seconds)
        .withColumn("_prev_time", F.lag("event_time").over(in_slot))
        .withColumn("_starts", F.coalesce((F.col("_sec") - _seconds("_prev_time") > limit).cast("int"), F.lit(0)))
        .withColumn("_started", F.sum("_starts").over(so_far))
        .withColumn("_start_rank", F.max(F.when(F.col("_starts") == 1, F.col("_rank"))).over(so_far))
    )

    slots = inner.groupBy("user_id", "_slot").agg(
        rows().alias("_n"),
        F.min("event_time").alias("_first_time"),
        F.max("event_time").alias("_last_time"),
        F.sum("_starts").alias("_inner"),
        F.max("_start_rank").alias("_last_rank"),
    )
    chain = Window.partitionBy("user_id").orderBy("_slot")
    earlier = _before("user_id")
    prev_last = F.lag("_last_time").over(chain)
    opened = F.coalesce((_seconds("_first_time") - _seconds("_before_time") > limit).cast("int"), F.lit(1))
    chained = (
        slots.withColumn("_before_time", prev_last)
        .withColumn("_opens", opened)
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_sessions", F.coalesce(F.sum(F.col("_opens") + F.col("_inner")).over(earlier), F.lit(0)))
        # Where the session running into this slot began, counted over the whole timeline.
        .withColumn("_start_at", F.col("_offset") + F.coalesce("_last_rank", F.when(F.col("_opens") == 1, F.lit(1))))
        .withColumn("_running_start", F.max("_start_at").over(earlier))
        .select("user_id", "_slot", "_before_time", "_opens", "_offset", "_sessions", "_running_start")
    )

    first_of_slot = F.col("_rank") == 1
    session_start = F.coalesce(
        F.col("_offset") + F.col("_start_rank"),
        F.when(F.col("_opens") == 1, F.col("_offset") + 1),
        F.col("_running_start"),
    )
    joined = inner.join(chained, ["user_id", "_slot"]).withColumn(
        "prev_event_time", F.when(first_of_slot, F.col("_before_time")).otherwise(F.col("_prev_time"))
    )
    return joined.select(
        *events.columns,
        "prev_event_time",
        ((F.col("_sec") - _seconds("prev_event_time")) / F.lit(60.0)).alias("gap_minutes"),
        F.when(first_of_slot, F.col("_opens")).otherwise(F.col("_starts")).alias("is_new_session"),
        (F.col("_sessions") + F.col("_opens") + F.col("_started")).alias("session_id"),
        (F.col("_offset") + F.col("_rank") - session_start + 1).alias("position"),
    )


def session_summary(sessions: DataFrame) -> DataFrame:
    """Span, length and purchases of each session."""
    return sessions.groupBy("user_id", "session_id").agg(
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        rows().alias("session_length"),
        kind_count(PURCHASE).alias("purchases"),
    )


def session_events(sessions: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """(time, product) lists per session, in pieces of at most ``max_items``."""
    entry = F.struct("position", F.col("event_time"), F.col("product_id").cast("string").alias("product"))
    pieces = sessions.groupBy("user_id", "session_id", _chunk(max_items)).agg(
        F.array_sort(F.collect_list(entry)).alias("_entries")
    )
    events = F.transform("_entries", lambda e: F.struct(e["event_time"].alias("event_time"), e["product"].alias("product")))
    return pieces.select("user_id", "session_id", "chunk", events.alias("events"))


def _chunk(max_items: int) -> Column:
    return F.floor((F.col("position") - 1) / max_items).alias("chunk")


def item_sequences(
    positioned: DataFrame, keys: list[str], min_items: int = 2, max_items: int = MAX_ITEMS
) -> DataFrame:
    """Ordered product ids per session of at least ``min_items`` events.

    A sequence longer than ``max_items`` continues in further rows with rising
    ``chunk``, so no row grows with the session and one aggregation is enough:
    a later piece proves the length, a first piece shows it.
    """
    if min_items > max_items:
        raise ValueError("min_items must not exceed max_items")
    entry = F.struct("position", F.col("product_id").cast("string").alias("product"))
    pieces = positioned.groupBy(*keys, _chunk(max_items)).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    kept = pieces.filter((F.col("chunk") > 0) | (F.size("_entries") >= min_items))
    return kept.select(*keys, "chunk", F.transform("_entries", lambda e: e["product"]).alias("items"))


def shop_session_sequences(events: DataFrame, min_items: int = 2, max_items: int = MAX_ITEMS) -> DataFrame:
    """Item sequences by the shop's own session key, where it is set."""
    keyed = events.dropna(subset=["user_session", "product_id"])
    return item_sequences(keyed_positions(keyed, "user_session"), ["user_session"], min_items, max_items)


def gap_session_sequences(
    events: DataFrame,
    gap_minutes: float = SESSION_GAP_MINUTES,
    min_items: int = 2,
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Item sequences by gap sessions."""
    return item_sequences(assign_sessions(events, gap_minutes), ["user_id", "session_id"], min_items, max_items)


def session_stats(summary: DataFrame, min_items: int = 2) -> DataFrame:
    """Number and mean length of sessions with at least ``min_items`` events."""
    picked = summary.filter(F.col("session_length") >= min_items)
    return picked.agg(rows().alias("sessions"), F.avg("session_length").alias("avg_length"))


def held_out_pairs(positioned: DataFrame, keys: list[str], min_items: int = 3) -> DataFrame:
    """Second-last and last product of each session, as (query_item, target_item, sessions)."""
    lengths = positioned.groupBy(*keys).agg(F.max("position").alias("_len"))
    long_enough = lengths.filter(F.col("_len") >= min_items)
    tail = positioned.join(long_enough, keys).filter(F.col("position") >= F.col("_len") - 1)
    product = F.col("product_id").cast("string")
    pairs = tail.groupBy(*keys).agg(
        F.max(F.when(F.col("position") < F.col("_len"), product)).alias("query_item"),
        F.max(F.when(F.col("position") == F.col("_len"), product)).alias("target_item"),
    )
    return pairs.groupBy("query_item", "target_item").agg(rows().alias("sessions"))
