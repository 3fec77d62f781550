"""Sessions of users by a gap of silence, and the session that an order belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.asof import as_of_join
from assayline.operators.joins import BROADCAST_BYTES
from assayline.operators.quality import Rule, flag_all

GAP = "30 minutes"
BRIDGE = "24 hours"


def sessions(events: DataFrame, user: str, time: str, gap: str = GAP, watermark: str | None = None) -> DataFrame:
    """One row per session: user, session_start, session_end (its last event), n_events.

    An event at most ``gap`` after the one before it goes on with its session. Events
    without a user or a time are left out. With ``watermark`` this serves a stream as
    well: a session is given out once no event can prolong it any more.
    """
    events = events.na.drop(subset=[user, time])
    events = events.withWatermark(time, watermark) if watermark else events
    found = events.groupBy(user, F.session_window(time, gap).alias("__session")).agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n_events")
    )
    return found.drop("__session")


def bridge_orders(
    orders: DataFrame,
    found: DataFrame,
    user: str,
    time: str,
    bridge: str = BRIDGE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``orders`` (quality columns) with session_start, session_end of the session that brought them.

    Sessions of a user do not overlap, so only the last one that began before the order
    can hold it. One that ended before the order, but at most ``bridge`` before it, is
    taken as well and the order is flagged as ATTRIBUTION_SESSION_BRIDGE.
    """
    columns = ["session_start", "session_end"]
    starts = found.select(user, F.col("session_start").alias("__from"), *columns)
    met = as_of_join(orders, starts, user, time, "__from", columns, broadcast_bytes=broadcast_bytes)
    reach = F.col("session_end") + F.expr(f"INTERVAL {bridge}")
    taken = F.col(time) <= reach
    met = met.withColumns({c: F.when(taken, F.col(c)) for c in columns})
    late = F.col(time) > F.col("session_end")
    return flag_all(met, [Rule(late, "ATTRIBUTION_SESSION_BRIDGE", "FLAGGED_AMBIGUOUS", "INFERRED")])
