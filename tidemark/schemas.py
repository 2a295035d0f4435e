"""Fixed record schemas (one per feed record)."""

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Startup log line (epoch-ms ts stamped at intake).
STARTUP_LOG = _struct([("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S),
                       ("ch", S), ("type", S), ("vs", S), ("ts", L)])

# Event log line; pgid/npgid/itemid arrive as JSON numbers but are read as text.
EVENT_LOG = _struct([("mid", S), ("uid", S), ("appid", S), ("area", S), ("os", S),
                     ("type", S), ("evid", S), ("pgid", S), ("npgid", S), ("itemid", S),
                     ("ts", L)])

# Order row as the change feed sends it (18 source fields, all text but the amount).
ORDER_INFO = _struct([("id", S), ("province_id", S), ("consignee", S), ("order_comment", S),
                      ("consignee_tel", S), ("order_status", S), ("payment_way", S),
                      ("user_id", S), ("img_url", S), ("total_amount", D), ("expire_time", S),
                      ("delivery_address", S), ("create_time", S), ("operate_time", S),
                      ("tracking_no", S), ("parent_order_id", S), ("out_trade_no", S),
                      ("trade_body", S)])

ORDER_DETAIL = _struct([("id", S), ("order_id", S), ("sku_name", S), ("sku_id", S),
                        ("order_price", S), ("img_url", S), ("sku_num", S)])

USER_INFO = _struct([("id", S), ("login_name", S), ("user_level", S), ("birthday", S),
                     ("gender", S)])

# Topic record (the shape Spark's Kafka source yields, value as text).
TOPIC_RECORD = _struct([("topic", S), ("partition", I), ("offset", L), ("key", S),
                        ("value", S), ("timestamp", T.TimestampType())])

# Row change from the database change log.
CDC_CHANGE = T.StructType([
    T.StructField("table", S), T.StructField("entry_type", S), T.StructField("event_type", S),
    T.StructField("after", T.MapType(S, S)), T.StructField("change_ts", T.TimestampNTZType()),
    T.StructField("seq", L)])

# Sink column lists (upper-case names of the keyed SQL tables).
DAU_SINK_COLUMNS = ["MID", "UID", "APPID", "AREA", "OS", "CH", "TYPE", "VS",
                    "LOGDATE", "LOGHOUR", "TS"]
ORDER_SINK_COLUMNS = ["ID", "PROVINCE_ID", "CONSIGNEE", "ORDER_COMMENT", "CONSIGNEE_TEL",
                      "ORDER_STATUS", "PAYMENT_WAY", "USER_ID", "IMG_URL", "TOTAL_AMOUNT",
                      "EXPIRE_TIME", "DELIVERY_ADDRESS", "CREATE_TIME", "OPERATE_TIME",
                      "TRACKING_NO", "PARENT_ORDER_ID", "OUT_TRADE_NO", "TRADE_BODY",
                      "CREATE_DATE", "CREATE_HOUR"]

SALE_DETAIL_COLUMNS = ["order_detail_id", "order_id", "order_status", "create_time", "user_id",
                       "sku_id", "user_gender", "user_age", "user_level", "sku_price",
                       "sku_name", "dt"]


# Keyed-table rows of the order sink and the sale index, and the joined
# (order, detail) pair before the user merge.
ORDER_SINK_ROW = T.StructType([T.StructField(c, T.DoubleType() if c == "TOTAL_AMOUNT"
                                             else T.StringType()) for c in ORDER_SINK_COLUMNS])

SALE_ROW = T.StructType([T.StructField(n, t) for n, t in [
    ("order_detail_id", T.StringType()), ("order_id", T.StringType()),
    ("order_status", T.StringType()), ("create_time", T.StringType()),
    ("user_id", T.StringType()), ("sku_id", T.StringType()), ("user_gender", T.StringType()),
    ("user_age", T.IntegerType()), ("user_level", T.StringType()), ("sku_price", T.DoubleType()),
    ("sku_name", T.StringType()), ("dt", T.StringType())]])

SA_PAIR_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("order_detail_id", T.StringType()), ("order_id", T.StringType()),
    ("order_status", T.StringType()), ("create_time", T.StringType()),
    ("user_id", T.StringType()), ("sku_id", T.StringType()), ("sku_price", T.DoubleType()),
    ("sku_name", T.StringType()), ("dt", T.StringType())]])
