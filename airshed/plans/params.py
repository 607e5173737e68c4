"""Parameters of the registered queries (fixed up front; part of each query's definition)."""

from __future__ import annotations

import datetime as _dt

# Merge scenario: runs 1..4 are already in silver, runs 5..7 arrive as the next batch.
TARGET_LAST_RUN = 4
# Arrival orders for the sequential-merge queries (one batch per run).
ARRIVAL_IN_ORDER = [1, 2, 3, 4, 5, 6, 7]
ARRIVAL_OUT_OF_ORDER = [7, 1, 6, 2, 5, 3, 4]
# Range republished after the merge.
REPLACE_START = _dt.date(2024, 1, 4)
REPLACE_END = _dt.date(2024, 1, 7)
# Clock of the incremental-window and freshness queries.
TODAY = _dt.date(2024, 1, 12)
FRESHNESS_AS_OF = _dt.datetime(2024, 1, 12, 12, 0)
LOOKBACK_DAYS = 2
BACKFILL_DAYS = 30
# Chunk length of the window-chunk query, in days.
CHUNK_DAYS = 4
# Trailing mean of event values per user: frame length (hours) and minimum events in a frame.
EVENT_WINDOW_HOURS = 8
EVENT_MIN_COUNT = 1
# Time buckets of the event window: events are high-frequency, so one user-day may be large;
# 6-hour buckets bound a window group to 13 hours of one user.
EVENT_BUCKET_HOURS = 6
# The hot-user query gives every third event to one user.
HOT_USER_SQL = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"
# The key-level query's late batch has the sites whose number leaves this remainder.
LATE_SITES_SQL = "l_suppkey % 10 = 3"
# Runs picked by the run-selection query.
SELECTED_RUNS = ["run-2", "run-5"]
# Two runs by site: the first holds the sites with an even supplier number.
FIRST_SITES_SQL = "l_suppkey % 2 = 0"
