"""Fixed values that must equal the shop's own for equal results.

Topic names, the rewriter's marker, app id, cell family, phone mask, event
ids of the alert rule, the dashboard's labels and defaults, the result caps
of the search aggregations and the fetch size of the offset-range read. They
are stated here once, as plain text; the modules import them.
"""

# Topics of the routed feeds.
TOPIC_STARTUP = "gmall_startup"
TOPIC_EVENT = "gmall_event"
TOPIC_ORDER_INFO = "gmall_order_info"
TOPIC_ORDER_DETAIL = "gmall_order_detail"
TOPIC_USER_INFO = "gmall_user_info"
TOPIC_RAW = "first"
TOPIC_STRIPPED = "second"

# Topic rewriter marker, app id, cell family.
MARKER = "atguigu>>>"
APP_ID = "gmall2019"
FAMILY = "hfile-fy"

# Phone mask: first four characters kept, then exactly seven stars.
MASK_KEEP = 4
MASK_TEXT = "*******"

# Event ids of the click log; the alert counts coupon uids and is cancelled by a click.
EVENT_IDS = ["addFavor", "addComment", "addCart", "clickItem", "coupon"]
COUPON = "coupon"
CLICK = "clickItem"
ALERT_MIN_UIDS = 3
ALERT_WINDOW = "60 seconds"
ALERT_SLIDE = "5 seconds"

# Headline list ids and labels.
TOTAL_ROWS = [
    ("dau", "新增日活"),
    ("new_mid", "新增设备"),
    ("order_amount", "新增交易额"),
]

# Search shares: titles, option names, bucket caps of the term aggregations.
GENDER_TITLE = "用户性别占比"
GENDER_OPTIONS = [("男", "M"), ("女", "F")]
AGE_TITLE = "用户年龄占比"
AGE_OPTIONS = ["20岁以下", "20岁到30岁", "30岁以上"]
GENDER_BUCKETS = 2
AGE_BUCKETS = 100

# Dashboard defaults.
DEFAULT_DATE = "2019-03-04"
DEFAULT_KEYWORD = ""

# Producer partition override and the offset-range fetch size.
FIXED_PARTITION = 1
FETCH_BYTES = 10 * 1024
