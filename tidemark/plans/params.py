"""Parameters of the registered queries (the dashboard's arguments).

Nothing reads the wall clock: dates, the age reference day and window
lengths are fixed here so every run, and the oracle SQL, see the same values.
"""

DAU_DATE = "2024-01-15"            # daily-active date (events span 2024-01)
SEEN_CUTOFF = "2024-01-15 12:00:00"  # logs before: earlier batches; after: new batch
ORDER_DATE = "1997-08-23"          # order / sale date (orders span 1995..2001)
KEYWORD = "red"                    # search keyword on sku_name
PAGE_NO = 1
PAGE_SIZE = 20
AS_OF = "2024-01-01"               # age reference day
JOIN_SECONDS = 300                 # order/detail join memory
BATCH_SECONDS = 3600               # micro-batch length for the per-batch outer join
# The driver's events are too sparse for 60 s windows (see SURVEY 7.1 fact 7):
ALERT_WINDOW = "1 day"
ALERT_SLIDE = "6 hours"
ALERT_WINDOW_S = 86400
ALERT_SLIDE_S = 21600
ALERT_MIN_UIDS = 3
OFFSET_TOPIC = "first"
OFFSET_PARTITION = 3
OFFSET_START = 108
OFFSET_MAX_BYTES = 10 * 1024
BAND_WIDTH = 100
STREAM_SLICES = 8                  # triggers of a replayed stream run
STREAM_DELAY = "10 minutes"        # lateness that stateful streams wait for
USER_BUCKETS = 32                  # hash buckets of the user table
CELL_BUCKETS = 8                   # hash buckets of the cell table
STREAM_JOIN_SALT = 2               # salt of the registered order/detail stream join
