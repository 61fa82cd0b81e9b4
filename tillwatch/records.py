"""Record layouts, stream names and the values fixed by the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

# Stream names, event kinds, time limits and report labels of the data model.
STARTUP, EVENT = "startup_log", "event_log"
ORDER_INFO, ORDER_DETAIL, USER_INFO = "order_info", "order_detail", "user_info"
STARTUP_MARK = "startup"
COUPON, BROWSE = "coupon", "clickItem"
CHANGE_TABLES = (ORDER_INFO, ORDER_DETAIL, USER_INFO)
JOIN_TTL_SECONDS = 300
ALERT_WINDOW, ALERT_SLIDE, ALERT_PERIOD, ALERT_USERS = "30 seconds", "5 seconds", "1 minute", 3
BATCH_INTERVAL, ALERT_INTERVAL = "3 seconds", "5 seconds"
DEFAULT_REPORT_DATE = "2019-03-04"
KPI_NAMES = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "新增交易额"}
GENDER_TITLE, FEMALE_LABEL, MALE_LABEL = "用户性别占比", "女", "男"
AGE_TITLE, AGE_LABELS = "用户年龄占比", ("20岁以下", "20岁到30岁", "30岁以上")


@dataclass(frozen=True)
class Record:
    """A JSON record: its fields on the wire, those that are numbers, and those derived after parsing."""

    name: str
    wire: tuple[str, ...]
    numbers: dict[str, str] = field(default_factory=dict)
    derived: tuple[str, ...] = ()

    def wire_ddl(self) -> str:
        """Every field as text: producers quote numbers or not, and change rows quote all of them."""
        return ", ".join(f"`{f}` STRING" for f in self.wire)

    def ddl(self) -> str:
        kinds = {**{f: "STRING" for f in self.wire + self.derived}, **self.numbers}
        return ", ".join(f"`{f}` {k}" for f, k in kinds.items())


STARTUP_LOG = Record(
    STARTUP,
    ("mid", "uid", "appid", "area", "os", "ch", "logType", "vs", "ts"),
    {"ts": "BIGINT"},
    ("logDate", "logHour"),
)
EVENT_LOG = Record(
    EVENT,
    ("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid", "ts"),
    {"ts": "BIGINT"},
    ("logDate", "logHour"),
)
ORDER_RECORD = Record(
    ORDER_INFO,
    (
        "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
        "user_id", "img_url", "total_amount", "expire_time", "delivery_address", "create_time",
        "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
    ),
    {"total_amount": "DOUBLE"},
    ("create_date", "create_hour"),
)
DETAIL_RECORD = Record(
    ORDER_DETAIL, ("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")
)
USER_RECORD = Record(USER_INFO, ("id", "login_name", "user_level", "birthday", "gender"))

# Column order of the two stored tables, for readers that go by position.
DAILY_ACTIVE_COLUMNS = (
    "mid", "uid", "appid", "area", "os", "ch", "logType", "vs", "logDate", "logHour", "ts",
)
ORDER_COLUMNS = ORDER_RECORD.wire + ORDER_RECORD.derived
SALE_DETAIL_DDL = (
    "order_detail_id STRING, order_id STRING, order_status STRING, create_time STRING, user_id STRING, "
    "sku_id STRING, user_gender STRING, user_age INT, user_level STRING, sku_price DOUBLE, sku_name STRING, dt STRING"
)
CHANGE_DDL = (
    "`table` STRING, entry_type STRING, event_type STRING, "
    "row_datas ARRAY<STRUCT<after: ARRAY<STRUCT<name: STRING, value: STRING>>>>"
)
