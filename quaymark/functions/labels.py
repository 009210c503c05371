"""Label texts, bounds and defaults of the analyses.

Fixed values: results are compared by these exact texts and numbers, so they
are stated as they have to appear.
"""

# --- catalogue ---------------------------------------------------------------
# Yearly growth in percent: label of the first bound the value exceeds.
GROWTH_STEPS = [(20, "高速增长"), (5, "稳定增长"), (-5, "基本持平"), (-20, "缓慢下降")]
GROWTH_LOWEST = "快速下降"

PRICE_FREE = "Free"
# Price buckets as (label, lowest price, highest price as printed).
PRICE_BUCKETS = [
    ("0.01-4.99", "0", "4.99"),
    ("5-9.99", "5", "9.99"),
    ("10-19.99", "10", "19.99"),
    ("20-49.99", "20", "49.99"),
]
PRICE_TOP = "50+"

# Concentration index: label below each bound.
CONCENTRATION_STEPS = [(1000, "分散市场"), (2500, "适度集中")]
CONCENTRATION_HIGHEST = "高度集中"

PLATFORM_LABELS = {3: "三平台", 2: "双平台", 1: "单平台(Windows)"}
PLATFORM_NONE = "其他"

# Developer size by number of items: (lowest, highest, label).
DEVELOPER_SIZES = [(1, 1, "独立开发者"), (2, 10, "小型厂商"), (11, 50, "中型厂商")]
DEVELOPER_LARGEST = "大型厂商"

FIRST_YEAR, LAST_YEAR = 1980, 2026
NEUTRAL_RATE = "0.5"

# --- commerce ----------------------------------------------------------------
VALID_STATUSES = ("已支付", "已完成")

# Total score of the three quintiles: label of the first bound reached.
USER_LEVEL_STEPS = [(13, "高价值用户"), (10, "重点发展用户"), (7, "一般保持用户")]
USER_LEVEL_LOWEST = "低价值用户"
USER_LEVEL_ORDER = ["高价值用户", "重点发展用户", "一般保持用户", "低价值用户"]
MEMBER_LEVEL_ORDER = ["普通", "白银", "黄金", "铂金", "黑金", "未知"]
UNKNOWN = "未知"

EVENT_FIELDS = [
    "order_id",
    "user_id",
    "order_time",
    "province",
    "city",
    "category",
    "pay_amount",
    "order_status",
    "channel",
]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

# --- listings ----------------------------------------------------------------
LISTING_HEADERS = {
    "市区": "district",
    "小区": "community",
    "户型": "layout",
    "朝向": "orientation",
    "楼层": "floor_num",
    "装修情况": "decoration",
    "电梯": "elevator",
    "面积(㎡)": "area",
    "价格(万元)": "price",
    "年份": "build_year",
}
ELEVATOR_YES = "有电梯"
ROOM_MARK = "室"
DECORATION_PREMIUM, DECORATION_SIMPLE, DECORATION_ROUGH = "精装", "简装", "毛坯"

AREA_EDGES = [50, 90, 144, 236]
AREA_LABELS = ["50-90㎡", "90-144㎡", "144-236㎡", "236㎡以上"]
PRICE_LEVEL_STEPS = [(8000, "低价位"), (15000, "中等价位"), (25000, "中高价位")]
PRICE_LEVEL_HIGHEST = "高价位"
PRICE_LEVEL_ORDER = ["低价位", "中等价位", "中高价位", "高价位"]
YEAR_EDGES = [1950, 1970, 1990, 2000, 2010, 2020]
YEAR_LABELS = ["1950-1970", "1970-1990", "1990-2000", "2000-2010", "2010-2020"]

AGE_BASE_YEAR = 2025
WATCHED_DISTRICT = "海淀"
WATCHED_AREA = (90, 144)
WATCHED_AREA_LABEL = "90-144㎡"
