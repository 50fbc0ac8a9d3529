"""Parameters of the registered queries on the test tables.

Events are minutes apart in the test tables, so time limits that are seconds
or minutes in production are scaled to hours here; defaults stay in the
operator modules.
"""

AS_OF_MS = 1706659200000          # 2024-01-31 00:00:00 UTC, end of the test data
COLD_AS_OF_MS = 1704153600000     # 2024-01-02 00:00:00 UTC
DRIFT_SPLIT_MS = 1705363200000    # 2024-01-16 00:00:00 UTC: reference before, current after
CHECK_LIMIT = 100                 # history length, as in production
CACHE_TTL_MS = 12 * 3600 * 1000   # prediction cache TTL (30 s in production)
BATCH_USERS = 32                  # distinct users a model call
CACHE_SHARDS = 4                  # scoring workers, each with a cache of its own
CACHE_CAP = 50                    # cache size (1000 in production)
SESSION_GAP_MS = 30 * 60 * 1000   # session gap
LATE_LANE_MS = 60 * 1000          # watermark bound on the arrival-ordered stream
ALLOWED_LATENESS_MS = 60 * 1000   # extra allowed lateness
SAMPLE_N = 1000                   # first N outputs sampled by the checks
TOP_K = 10
HOUR_MS = 3600 * 1000
DAY_MS = 24 * HOUR_MS
STATE_TTL_MS = 12 * 3600 * 1000   # idle state expiry (1 h in production)
LATE_BY_MS = 15 * DAY_MS          # delay of every LATE_EVERY-th event of the watermark query
LATE_EVERY = 11
WATERMARK_MS = HOUR_MS            # its watermark delay (5 min in production)
HISTORY_BUCKETS = 8               # buckets of the history store (64 in production)
SLICES = 4                        # micro-batches of a bounded run
METRIC_RANGE_MS = 6 * HOUR_MS     # range of rate()/increase() (5 m in production)
