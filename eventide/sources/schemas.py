"""Row shapes of the log formats."""

from __future__ import annotations

# name -> ordered (field, type); the order is the field's position in the text line
BEHAVIOR = (("user_id", "bigint"), ("item_id", "bigint"), ("category_id", "int"),
            ("behavior", "string"), ("ts_s", "bigint"))
LOGIN = (("user_id", "bigint"), ("ip", "string"), ("event_type", "string"), ("ts_s", "bigint"))
ORDER = (("order_id", "bigint"), ("event_type", "string"), ("tx_id", "string"), ("ts_s", "bigint"))
RECEIPT = (("tx_id", "string"), ("pay_channel", "string"), ("ts_s", "bigint"))
AD_CLICK = (("user_id", "bigint"), ("ad_id", "bigint"), ("province", "string"),
            ("city", "string"), ("ts_s", "bigint"))

#: Times in milliseconds here.
MARKET = (("user_id", "bigint"), ("behavior", "string"), ("channel", "string"), ("ts_ms", "bigint"))

# Web access log: token position of each field in a line split on single spaces
ACCESS_TOKENS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
ACCESS_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
