"""Re-route only after a real move: distance from the last accepted point, not the last seen.

Sequential state per user, so no window function expresses it: in batch one
ordered pass over each user's sorted points, in a stream state kept between micro-batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from placemark.functions.geo import RADIUS

METRES = 50
SCHEMA = "user_id long, event_id long, routed boolean"


def apart(a: tuple[float, float], b: tuple[float, float]) -> float:
    la, lb = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * RADIUS * math.asin(min(1.0, math.sqrt(h)))


def walk(points: pd.DataFrame, last: tuple | None, metres: float) -> tuple[list[bool], tuple | None]:
    """Which points re-route, and the last one that did: (lat, lon, result set)."""
    out = []
    for p in points.itertuples():
        go = last is None or p.result_set != last[2] or apart((p.lat, p.lon), last[:2]) >= metres
        out.append(go)
        if go:
            last = (p.lat, p.lon, p.result_set)
    return out, last


def throttled(points: DataFrame, metres: float = METRES) -> DataFrame:
    """points (user_id, event_id, ts, lat, lon, result_set) -> user_id, event_id, routed."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        user, last = None, None
        for rows in parts:
            done = []
            for own, group in rows.groupby("user_id", sort=False):
                routed, last = walk(group, last if own == user else None, metres)
                user = own
                done.append(group[["user_id", "event_id"]].assign(routed=routed))
            yield pd.concat(done) if done else pd.DataFrame({"user_id": [], "event_id": [], "routed": []})

    # Spark sorts; a task holds the last accepted point of the user it is at, not the user's history.
    ordered = points.select("user_id", "event_id", "ts", "lat", "lon", "result_set").repartition("user_id").sortWithinPartitions("user_id", "ts", "event_id")
    return ordered.mapInPandas(run, SCHEMA)


def throttled_stream(points: DataFrame, metres: float = METRES) -> DataFrame:
    """The same over a stream; a user's last accepted point is the state."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        routed, last = walk(rows, tuple(last) if last else None, metres)
        state.update(last)
        yield rows[["user_id", "event_id"]].assign(routed=routed)

    return points.groupBy("user_id").applyInPandasWithState(run, SCHEMA, "lat double, lon double, result_set long", "append", GroupStateTimeout.NoTimeout)
