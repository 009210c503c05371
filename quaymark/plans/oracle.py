"""The same queries as plain SQL text, for checking results with another engine.

Amounts are whole cents and ratios whole-number arithmetic, so both sides
round the same exact values.
"""

from __future__ import annotations


def ratio(num: str, den: str, digits: int, times: int = 1, scale: int = 0) -> str:
    """num / den * times, half away from zero, as DOUBLE; ``num`` is scaled by 10^scale."""
    n = f"(({num})::HUGEINT*{times * 10 ** digits})"
    d = f"(nullif({den},0)::HUGEINT*{10 ** scale})"
    return f"((CASE WHEN {n}<0 THEN -1 ELSE 1 END)*((2*abs({n})+{d})//(2*{d}))::DOUBLE/{10 ** digits})"


def cents(value: str) -> str:
    return f"(({value})::DOUBLE/100)"


def build(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- shared inputs -----------------------------------------------------------
EV = """ev AS (
  SELECT event_id, user_id, ts, strftime(ts, '%Y-%m-%d') AS d, hour(ts)::BIGINT AS h, event_type,
         round(value * 100)::BIGINT AS total, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k
  FROM events)"""
TREND = f"""trend AS (
  SELECT d AS stat_date, h AS stat_hour, count(DISTINCT event_id) AS oc, count(DISTINCT user_id) AS uc,
         sum(total)::BIGINT AS t, sum(k)::BIGINT AS dc, sum(total - k)::BIGINT AS p,
         {ratio('sum(total - k)', 'count(*)', 2, scale=2)} AS a
  FROM ev WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2)"""
ITEMS = """items AS (
  SELECT l_orderkey AS order_id, coalesce(nullif(p_type, 'PROMO'), l_returnflag) AS category,
         l_quantity::BIGINT AS q, round(l_extendedprice * 100)::BIGINT AS amt
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""
VO = """vo AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate, o_orderdate::DATE AS dt,
         o_orderpriority AS channel, o_orderstatus AS st, round(o_totalprice * 100)::BIGINT AS pay
  FROM orders WHERE o_orderstatus IN ('F', 'O'))"""
RANKED = f"""daily AS (
  SELECT strftime(dt, '%Y-%m-%d') AS stat_date, category, count(DISTINCT order_id) AS oc, sum(q)::BIGINT AS qs,
         sum(amt)::BIGINT AS am, {ratio('sum(amt)', 'count(*)', 2, scale=2)} AS aa,
         count(DISTINCT channel) AS cc
  FROM items JOIN vo USING (order_id) GROUP BY 1, 2),
ranked AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY stat_date ORDER BY am DESC, qs DESC, category) AS rk FROM daily)
  WHERE rk <= 3)"""
RFM = """base AS (
  SELECT user_id, date_diff('day', max(dt), (SELECT max(dt) FROM vo)) + 1 AS rec,
         count(DISTINCT order_id) AS freq, sum(pay)::BIGINT AS mon
  FROM vo GROUP BY user_id),
sc AS (SELECT *, ntile(5) OVER (ORDER BY rec DESC, user_id) AS r, ntile(5) OVER (ORDER BY freq, user_id) AS f,
         ntile(5) OVER (ORDER BY mon, user_id) AS m FROM base),
uv AS (SELECT sc.*, n_name AS province, r_name AS city, nullif(c_mktsegment, 'FURNITURE') AS ml, r + f + m AS ts,
         CASE WHEN r + f + m >= 13 THEN '高价值用户' WHEN r + f + m >= 10 THEN '重点发展用户'
              WHEN r + f + m >= 7 THEN '一般保持用户' ELSE '低价值用户' END AS lvl
  FROM sc LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""
RULES = f"""pairs AS (SELECT DISTINCT order_id, category FROM items WHERE order_id IN (SELECT order_id FROM vo)),
multi AS (SELECT * FROM pairs WHERE order_id IN (SELECT order_id FROM pairs GROUP BY 1 HAVING count(*) >= 2)),
tot AS (SELECT count(DISTINCT order_id) AS n FROM multi),
one AS (SELECT category, count(*) AS n FROM multi GROUP BY 1),
two AS (SELECT x.category AS a, y.category AS c, count(*) AS n
  FROM multi x JOIN multi y ON x.order_id = y.order_id AND x.category <> y.category GROUP BY 1, 2),
calc AS (SELECT two.a, two.c, two.n AS pn, l.n AS an, r.n AS cn, tot.n AS tn,
         (2 * two.n * 1000000 + tot.n) // (2 * tot.n) AS sup, (2 * two.n * 1000000 + l.n) // (2 * l.n) AS conf
  FROM two JOIN one l ON two.a = l.category JOIN one r ON two.c = r.category, tot),
rules AS (SELECT a AS antecedent, c AS consequent, sup::DOUBLE / 1000000 AS support,
         conf::DOUBLE / 1000000 AS confidence, ((2 * conf * tn + cn) // (2 * cn))::DOUBLE / 1000000 AS lift,
         pn::BIGINT AS pair_order_count, an::BIGINT AS antecedent_order_count,
         cn::BIGINT AS consequent_order_count, tn::BIGINT AS total_basket_count
  FROM calc WHERE sup >= 5000 AND conf >= 100000)"""
TOP_RULES = """best AS (SELECT * FROM rules
  ORDER BY lift DESC, confidence DESC, support DESC, antecedent, consequent LIMIT 10)"""
CAT = """sold AS (
  SELECT l_partkey, count(*) AS lines, sum(l_quantity)::BIGINT AS rec,
         count(*) FILTER (l_returnflag = 'N') AS pos, count(*) FILTER (l_returnflag = 'R') AS neg
  FROM lineitem GROUP BY 1),
cat AS (
  SELECT p_partkey AS id, p_name, 1978 + p_size AS yr, p_size * 1500 AS own,
         round(p_retailprice * 100)::BIGINT - 90000 AS price, coalesce(lines, 0) AS play, coalesce(rec, 0) AS rec,
         coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg, coalesce(pos, 0) + coalesce(neg, 0) AS tot,
         p_size + 45 AS meta, p_type, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
         CASE WHEN p_size <> 48 THEN p_brand END AS dev, CASE WHEN p_size <> 47 THEN p_type END AS pub,
         (p_size <= 45)::INT + (p_size <= 20)::INT + (p_size BETWEEN 10 AND 30)::INT AS plats
  FROM part LEFT JOIN sold ON p_partkey = l_partkey WHERE 1978 + p_size BETWEEN 1980 AND 2026)"""
MARKET = f"""yearly AS (
  SELECT yr, count(*) AS n, {ratio('sum(own)', 'count(*)', 0)} AS ao, {ratio('sum(price)', 'count(*)', 2, scale=2)} AS ap,
         {ratio('sum(play)', 'count(*)', 0)} AS apl, sum(rec)::BIGINT AS tr FROM cat GROUP BY 1),
grown AS (SELECT *, lag(n) OVER (ORDER BY yr) AS prev FROM yearly),
market AS (SELECT yr AS year, n AS release_count, ao AS avg_owners, ap AS avg_price, apl AS avg_playtime,
         tr AS total_recommendations, coalesce({ratio('n - prev', 'prev', 2, times=100)}, 0) AS g FROM grown),
trend AS (SELECT year::BIGINT AS year, release_count, avg_owners, avg_price, avg_playtime, total_recommendations,
         g AS yoy_growth_pct, CASE WHEN g > 20 THEN '高速增长' WHEN g > 5 THEN '稳定增长' WHEN g > -5 THEN '基本持平'
         WHEN g > -20 THEN '缓慢下降' ELSE '快速下降' END AS yoy_growth_category FROM market)"""
RATE = "CASE WHEN tot > 0 THEN (2 * pos::HUGEINT * 1000000000000 + tot) // (2 * tot) ELSE 500000000000 END"
PRICES = f"""rated AS (SELECT *, {RATE} AS rate,
         CASE WHEN price <= 0 THEN 'Free' WHEN price < 500 THEN '0.01-4.99' WHEN price < 1000 THEN '5-9.99'
         WHEN price < 2000 THEN '10-19.99' WHEN price < 5000 THEN '20-49.99' ELSE '50+' END AS b FROM cat),
buckets AS (SELECT b AS price_bucket, count(*) AS game_count,
         {ratio('sum(rate)', 'count(*)', 2, times=100, scale=12)} AS avg_positive_rate_pct,
         {ratio('sum(meta)', 'count(*)', 1)} AS avg_metacritic_score,
         {ratio('sum(rec)', 'count(*)', 0)} AS avg_recommendations,
         {ratio('sum(own)', 'count(*)', 0)} AS avg_owners,
         {ratio('sum(price)', 'count(*)', 2, scale=2)} AS avg_price_in_bucket, sum(own)::DOUBLE AS total_owners,
         {ratio('count(*)', '(SELECT count(*) FROM cat)', 2, times=100)} AS game_pct,
         {ratio('sum(own)', '(SELECT sum(own) FROM cat)', 2, times=100)} AS owners_share_pct
  FROM rated GROUP BY 1)"""
GENRES = """genres AS (SELECT p_type AS genre, id, dev, own FROM cat UNION ALL SELECT w2, id, dev, own FROM cat)"""
TAGS = f"""tags AS (SELECT w1 AS tag, id, own FROM cat UNION ALL SELECT w2, id, own FROM cat),
tagd AS (SELECT tag, count(*) AS frequency, {ratio('sum(own)', 'count(*)', 0)} AS avg_owners,
         count(DISTINCT id) AS total_games FROM tags GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50)"""
FP = """base AS (SELECT id, w1 AS w FROM cat WHERE w1 <> w2 UNION ALL SELECT id, w2 FROM cat WHERE w1 <> w2),
nn AS (SELECT count(DISTINCT id) AS n FROM base),
sets AS (SELECT w AS items, count(*) AS freq FROM base GROUP BY 1 HAVING count(*) >= ceil(0.01 * (SELECT n FROM nn))
  UNION ALL
  SELECT x.w || ',' || y.w, count(*) FROM base x JOIN base y ON x.id = y.id AND x.w < y.w
  GROUP BY 1 HAVING count(*) >= ceil(0.01 * (SELECT n FROM nn)))"""


def _share(amount: str) -> str:
    return ratio(amount, "(SELECT sum(own) FROM cat)", 4, times=100)


DEVS = f"""devs AS (SELECT dev AS developer, count(*) AS game_count, sum(own)::DOUBLE AS total_owners,
         {ratio('sum(price)', 'count(*)', 2, scale=2)} AS avg_price, {ratio('sum(meta)', 'count(*)', 1)} AS avg_metacritic,
         count(DISTINCT p_type || w2) AS genre_diversity,
         CASE WHEN dev IS NOT NULL THEN {ratio('sum(plats)', 'count(*)', 1)} END AS platform_diversity,
         {_share('sum(own)')} AS market_share_pct,
         round({_share('sum(own)')} * 10000)::HUGEINT AS share4
  FROM cat GROUP BY 1)"""
HHI = "((2 * sum(share4 * share4) + 100000000) // 200000000)::DOUBLE"
LABEL = "CASE WHEN {h} < 1000 THEN '分散市场' WHEN {h} < 2500 THEN '适度集中' ELSE '高度集中' END"
ECO = f"""devtop AS (SELECT * FROM devs ORDER BY game_count DESC, developer NULLS FIRST LIMIT 20),
eco AS (SELECT devtop.* EXCLUDE (share4), (SELECT {HHI} FROM devtop) AS market_hhi,
         {LABEL.format(h=f'(SELECT {HHI} FROM devtop)')} AS market_structure FROM devtop)"""
PUBS = f"""pubs AS (SELECT pub AS publisher, count(*) AS game_count, sum(own)::DOUBLE AS total_owners,
         {ratio('sum(price)', 'count(*)', 2, scale=2)} AS avg_price, {_share('sum(own)')} AS market_share_pct,
         round({_share('sum(own)')} * 10000)::HUGEINT AS share4
  FROM cat GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 50)"""
LST = """lst0 AS (
  SELECT n_name AS district, p_brand AS community,
         CASE p_size WHEN 50 THEN '10室2厅' WHEN 49 THEN '0室1厅' WHEN 48 THEN '开间'
              ELSE substr(o_orderpriority, 1, 1) || '室1厅' END AS layout,
         o_orderstatus AS orientation, l_linenumber::BIGINT AS floor_num,
         CASE l_returnflag WHEN 'A' THEN '精装' WHEN 'N' THEN '简装' ELSE '毛坯' END AS decoration,
         (l_linestatus = 'O')::BIGINT AS elev, l_quantity::BIGINT * 6 AS area,
         (2 * round(l_extendedprice * 100)::BIGINT * 48 + 10000) // 20000 AS pc,
         CASE WHEN p_size = 1 THEN 'unknown' ELSE (year(l_shipdate) - 8 * (l_partkey % 7))::VARCHAR END AS byr,
         (l_suppkey % 3) + 1 AS checkid, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
lst AS (SELECT *, row_number() OVER (ORDER BY district, community, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn,
         (2 * pc * 100 + area) // (2 * area) AS pps, 2025 - try_cast(byr AS INT) AS age
  FROM lst0 WHERE area > 0 AND pc > 0 AND regexp_full_match(byr, '[0-9]{4}'))"""


def _stats(key: str, deviation: str) -> str:
    return f"""{key}, checkid, count(*) AS house_count, (sum(pps) // count(*))::BIGINT AS avg_price_per_sqm,
         min(pps)::BIGINT AS min_price, max(pps)::BIGINT AS max_price, quantile_disc(pps, 0.5)::BIGINT AS median_price,
         trunc(var_samp(pps))::BIGINT AS price_variance, trunc(stddev_samp(pps))::BIGINT AS {deviation},
         (sum(age) // count(*))::BIGINT AS avg_house_age"""


AREA = f"""ranged AS (SELECT *, CASE WHEN area >= 50 AND area < 90 THEN '50-90㎡' WHEN area >= 90 AND area < 144 THEN '90-144㎡'
         WHEN area >= 144 AND area < 236 THEN '144-236㎡' WHEN area >= 236 THEN '236㎡以上' ELSE '未知' END AS area_range
  FROM lst WHERE pps > 0),
areas AS (SELECT {_stats('area_range', 'price_stddev')},
         {ratio('count(*)', '(SELECT count(*) FROM ranged)', 2, times=100)} AS area_ratio
  FROM ranged WHERE area_range <> '未知' GROUP BY 1, 2),
area AS (SELECT *, CASE WHEN avg_price_per_sqm < 8000 THEN '低价位' WHEN avg_price_per_sqm < 15000 THEN '中等价位'
         WHEN avg_price_per_sqm < 25000 THEN '中高价位' ELSE '高价位' END AS price_level FROM areas)"""
COMMUNITY = """com AS (SELECT district, community, checkid, count(*) AS house_count,
         (sum(pps) // count(*))::BIGINT AS avg_price_per_sqm,
         CASE WHEN min(byr) = max(byr) THEN min(byr) ELSE min(byr) || '-' || max(byr) END AS build_year
  FROM lst WHERE pps > 0 GROUP BY 1, 2, 3)"""
YEARS = """dated AS (SELECT *, CASE WHEN y >= 1950 AND y < 1970 THEN '1950-1970' WHEN y >= 1970 AND y < 1990 THEN '1970-1990'
         WHEN y >= 1990 AND y < 2000 THEN '1990-2000' WHEN y >= 2000 AND y < 2010 THEN '2000-2010'
         WHEN y >= 2010 AND y <= 2020 THEN '2010-2020' END AS year_range,
         coalesce(try_cast(nullif(regexp_extract(layout, '^([0-9])室', 1), '') AS INT), -1) AS rooms
  FROM (SELECT *, byr::INT AS y FROM lst)),
years AS (SELECT year_range, checkid, count(*) AS house_count, sum(elev)::BIGINT AS elevator_count,
         count(*) FILTER (rooms BETWEEN 1 AND 2) AS small_layout_count,
         count(*) FILTER (rooms BETWEEN 3 AND 4) AS medium_layout_count,
         count(*) FILTER (rooms >= 5 OR rooms = -1) AS large_layout_count,
         count(*) FILTER (decoration = '精装') AS premium_decoration_count,
         count(*) FILTER (decoration = '简装') AS simple_decoration_count,
         count(*) FILTER (decoration = '毛坯') AS rough_decoration_count
  FROM dated WHERE year_range IS NOT NULL GROUP BY 1, 2)"""
WIN = """secs AS (SELECT *, epoch(date_trunc('second', ts))::BIGINT AS s, substr(k::VARCHAR, 1, 1) AS k1 FROM ev),
sliding AS (SELECT (s // 1800) * 1800 - 1800 * g AS ws, 'k' || k1 AS category, count(*) AS n, sum(total)::BIGINT AS p
  FROM secs, (SELECT unnest([0, 1]) AS g) WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2),
sales AS (SELECT strftime(make_timestamp(ws * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(make_timestamp((ws + 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
         category, n AS order_count, p::DOUBLE / 100 AS pay_amount FROM sliding)"""
#: Arrival in slices of equal spans: rows of the first slice with event_id % 10 = 3 come with the last of three.
ARRIVAL = """arrival AS (
  SELECT *, CASE WHEN place = 0 AND event_id % 10 = 3 THEN 2 ELSE place END AS slice, s AS t FROM (
    SELECT *, least(((s - lo) * 3) // (hi - lo + 1), 2) AS place
    FROM secs, (SELECT min(epoch(date_trunc('second', ts))::BIGINT) AS lo, max(epoch(date_trunc('second', ts))::BIGINT) AS hi FROM ev))
  WHERE event_type IN ('purchase', 'signup')),
marks AS (SELECT b.slice, (SELECT max(t) - 120 FROM arrival a WHERE a.slice < b.slice) AS mark
  FROM (SELECT DISTINCT slice FROM arrival) b),
accepted AS (SELECT a.*, m.mark FROM arrival a JOIN marks m ON a.slice = m.slice)"""
GENRE_WIN = """gw AS (SELECT g AS genre, count(*) AS n, (s // 3600) * 3600 AS ws
  FROM (SELECT s, event_type AS g FROM secs UNION ALL SELECT s, 'k' || k1 FROM secs) GROUP BY 1, 3),
counts AS (SELECT genre, n AS count, strftime(make_timestamp(ws * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(make_timestamp((ws + 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end FROM gw)"""
KPI = f"""count(*) AS new_games_count, {ratio('sum(total)', 'count(*)', 2, scale=2)} AS avg_price,
         (sum(user_id * 1000) // count(*))::BIGINT AS avg_owners,
         {ratio('sum(k)', 'sum(k) + sum(user_id % 10) + 1', 1, times=100)} AS avg_positive_rate"""
WATCHED = "msg AS (SELECT checkid, community, pps FROM lst WHERE area >= 90 AND area < 144 AND pps > 0)"

COMMERCE = [ITEMS, VO]
TREND_COLUMNS = f"""stat_date, stat_hour, oc AS order_count, uc AS user_count, {cents('t')} AS total_amount,
  {cents('dc')} AS discount_amount, {cents('p')} AS pay_amount, a AS avg_order_amount"""
TREND_SUMS = f"""sum(oc)::BIGINT AS order_count, sum(uc)::BIGINT AS user_hours, {cents('sum(t)')} AS total_amount,
  {cents('sum(dc)')} AS discount_amount, {cents('sum(p)')} AS pay_amount,
  {ratio('sum(p)', 'sum(oc)', 2, scale=2)} AS avg_order_amount"""
LEVELS = ["高价值用户", "重点发展用户", "一般保持用户", "低价值用户"]
PRICE_LEVELS = ["低价位", "中等价位", "中高价位", "高价位"]
EVENT_CATEGORY = """lead AS (SELECT order_id, category FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY amt DESC, category) AS rn
  FROM (SELECT order_id, category, sum(amt) AS amt FROM items GROUP BY 1, 2)) WHERE rn = 1)"""


def oracles() -> dict[str, str]:
    sql: dict[str, str] = {}

    # commerce
    sql["sales_time_trend"] = build([EV, TREND], f"SELECT {TREND_COLUMNS} FROM trend")
    sql["contract_trend"] = sql["sales_time_trend"]
    sql["sales_daily"] = build([EV, TREND], f"SELECT stat_date, {TREND_SUMS} FROM trend GROUP BY 1")
    sql["sales_hourly"] = build(
        [EV, TREND],
        f"""SELECT stat_hour, lpad(stat_hour::VARCHAR, 2, '0') AS stat_hour_label, sum(oc)::BIGINT AS order_count,
        {cents('sum(p)')} AS pay_amount FROM trend GROUP BY 1""",
    )
    sql["sales_summary"] = build(
        [EV, TREND],
        f"SELECT {TREND_SUMS}, min(stat_date) AS start_date, max(stat_date) AS end_date FROM trend",
    )
    sql["sales_distinct_users"] = build(
        [EV], "SELECT count(DISTINCT user_id) AS user_count FROM ev WHERE event_type IN ('purchase', 'signup')"
    )
    sql["category_sales_rank"] = build(
        [*COMMERCE, RANKED],
        f"""SELECT stat_date, category, oc AS order_count, qs AS quantity_sum, {cents('am')} AS amount_sum,
        aa AS avg_item_amount, cc AS channel_count, rk AS category_rank FROM ranked""",
    )
    sql["category_top"] = build(
        [*COMMERCE, RANKED],
        f"""SELECT category, sum(oc)::BIGINT AS order_count, sum(qs)::BIGINT AS quantity_sum,
        {cents('sum(am)')} AS amount_sum, {ratio('sum(am)', 'sum(qs)', 2, scale=2)} AS avg_unit_amount,
        max(rk)::BIGINT AS max_daily_rank FROM ranked GROUP BY 1 ORDER BY 4 DESC, 3 DESC, 1 LIMIT 10""",
    )
    sql["rfm_user_value"] = build(
        [VO, RFM],
        f"""SELECT user_id, province, city, ml AS member_level, rec AS recency_days, freq AS frequency,
        {cents('mon')} AS monetary, r AS r_score, f AS f_score, m AS m_score, ts AS total_score, lvl AS user_level
        FROM uv""",
    )
    sql["rfm_summary"] = build(
        [VO, RFM],
        f"""SELECT count(*) AS user_count, {ratio('sum(rec)', 'count(*)', 2)} AS avg_recency_days,
        {ratio('sum(freq)', 'count(*)', 2)} AS avg_frequency,
        {ratio('sum(mon)', 'count(*)', 2, scale=2)} AS avg_monetary FROM uv""",
    )
    sql["rfm_levels"] = build(
        [VO, RFM],
        f"""SELECT lvl AS user_level, count(*) AS user_count,
        {ratio('count(*)', '(SELECT count(*) FROM uv)', 4)} AS user_ratio,
        {ratio('sum(mon)', 'count(*)', 2, scale=2)} AS avg_monetary,
        {ratio('sum(freq)', 'count(*)', 2)} AS avg_frequency FROM uv GROUP BY 1""",
    )
    sql["rfm_member_levels"] = build(
        [VO, RFM],
        "SELECT coalesce(ml, '未知') AS member_level, lvl AS user_level, count(*) AS user_count FROM uv GROUP BY 1, 2",
    )
    sql["rfm_member_matrix"] = build(
        [VO, RFM],
        "SELECT coalesce(ml, '未知') AS member_level, "
        + ", ".join(f"count(*) FILTER (lvl = '{v}') AS \"{v}\"" for v in LEVELS)
        + " FROM uv GROUP BY 1",
    )
    sql["category_pair_rules"] = build([*COMMERCE, RULES], "SELECT * FROM rules")
    sql["category_top_rules"] = build([*COMMERCE, RULES, TOP_RULES], "SELECT * FROM best")
    sql["rule_graph_nodes"] = build(
        [*COMMERCE, RULES, TOP_RULES],
        "SELECT antecedent AS name FROM best UNION SELECT consequent FROM best",
    )
    sql["rule_graph_links"] = build(
        [*COMMERCE, RULES, TOP_RULES],
        "SELECT antecedent AS source, consequent AS target, lift AS value, lift, confidence, support FROM best",
    )
    sql["order_events"] = build(
        [*COMMERCE, EVENT_CATEGORY],
        f"""SELECT vo.order_id, user_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time, n_name AS province,
        r_name AS city, category, {cents('pay')} AS pay_amount, st AS order_status, channel
        FROM vo JOIN lead ON vo.order_id = lead.order_id LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    )
    sql["order_event_messages"] = build(
        [*COMMERCE, EVENT_CATEGORY],
        f"""SELECT vo.order_id::VARCHAR AS order_id, user_id::VARCHAR AS user_id,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time, category, {cents('pay')} AS pay_amount,
        st AS order_status FROM vo JOIN lead ON vo.order_id = lead.order_id""",
    )
    sql["event_json_validation"] = """SELECT CASE event_type WHEN 'error' THEN 'invalid json'
        WHEN 'view' THEN 'missing channel' ELSE CASE WHEN event_id % 7 BETWEEN 1 AND 4 THEN 'invalid json'
        WHEN event_id % 7 = 5 AND value IS NOT NULL THEN 'wrong type pay_amount' ELSE 'valid' END END AS reason,
        count(*) AS messages FROM events WHERE event_type <> 'click' GROUP BY 1"""

    # catalogue
    clean = """SELECT id AS "AppID", p_name AS "Name", yr::BIGINT AS release_year, own::DOUBLE AS owners_numeric,
        price::DOUBLE / 100 AS "Price" FROM cat"""
    sql["catalogue_clean"] = build([CAT], clean)
    sql["catalogue_csv_roundtrip"] = build([CAT], clean.replace("p_name AS", "replace(p_name, ' ', '/') AS"))
    sql["market_trend_yoy"] = build([CAT, MARKET], "SELECT * FROM trend")
    sql["market_trend_listing"] = build([CAT, MARKET], "SELECT * EXCLUDE (total_recommendations) FROM trend")
    sql["market_trend_summary"] = build(
        [CAT, MARKET],
        f"""SELECT (SELECT year FROM trend ORDER BY release_count DESC, year LIMIT 1) AS peak_year,
        max(release_count) AS peak_count, {ratio('sum(release_count)', 'count(*)', 0)}::BIGINT AS avg_annual_games,
        (SELECT yoy_growth_pct FROM trend ORDER BY year DESC LIMIT 1) AS latest_year_growth FROM trend""",
    )
    sql["price_bucket_review"] = build([CAT, PRICES], "SELECT * FROM buckets")
    sql["price_listing"] = build(
        [CAT, PRICES], "SELECT * EXCLUDE (avg_price_in_bucket, total_owners) FROM buckets"
    )
    sql["best_value_items"] = build(
        [CAT, PRICES],
        """SELECT id AS "AppID", p_name AS "Name", rate::DOUBLE / 1000000000000 AS positive_rate,
        rec AS "Recommendations", price::DOUBLE / 100 AS "Price", tot AS total_reviews FROM rated
        WHERE rate >= 500000000000 AND rec >= 100 AND price <= 4999 AND tot >= 5
        ORDER BY rate DESC, rec DESC, id LIMIT 20""",
    )
    sql["genre_distribution"] = build(
        [CAT, GENRES],
        f"SELECT genre, count(*) AS count, {ratio('sum(own)', 'count(*)', 0)} AS avg_owners FROM genres GROUP BY 1",
    )
    sql["top_selling_genres"] = build(
        [CAT, GENRES],
        f"""SELECT genre, count(*) AS total_games, {ratio('sum(own)', 'count(*)', 0)} AS avg_owners,
        sum(own)::DOUBLE AS total_owners FROM genres GROUP BY 1""",
    )
    sql["tag_distribution"] = build([CAT, TAGS], "SELECT * FROM tagd")
    sql["tag_listing"] = build([CAT, TAGS], "SELECT * FROM tagd ORDER BY frequency DESC, tag LIMIT 10")
    sql["tags_by_owners"] = build(
        [CAT, TAGS],
        "SELECT tag AS genre, frequency, avg_owners FROM tagd ORDER BY avg_owners DESC, tag LIMIT 5",
    )
    sql["fp_itemsets"] = build([CAT, FP], "SELECT items, freq FROM sets")
    sql["fp_rules"] = build(
        [CAT, FP],
        """SELECT a.items AS antecedent, c.items AS consequent, round(p.freq::DOUBLE / a.freq, 6) AS confidence,
        round((p.freq::DOUBLE / a.freq) / (c.freq::DOUBLE / nn.n), 6) AS lift,
        round(p.freq::DOUBLE / nn.n, 6) AS support
        FROM sets p, sets a, sets c, nn
        WHERE p.items IN (a.items || ',' || c.items, c.items || ',' || a.items)
          AND p.freq::DOUBLE / a.freq >= 0.1""",
    )
    itemsets = """lists AS (SELECT order_id, list(DISTINCT category) AS cats FROM items JOIN vo USING (order_id)
          WHERE category IS NOT NULL GROUP BY 1),
        n AS (SELECT count(*) AS n FROM lists),
        names AS (SELECT DISTINCT unnest(cats) AS c FROM lists),
        frequent AS (SELECT [c] AS s, (SELECT count(*) FROM lists WHERE list_contains(cats, c)) AS freq FROM names),
        grown AS (
          SELECT s, freq FROM frequent WHERE freq >= ceil(0.002 * (SELECT n FROM n))
          UNION ALL
          SELECT g.s || [c] AS s, count(*) AS freq FROM grown g JOIN names ON c > g.s[len(g.s)]
            JOIN lists ON list_has_all(cats, g.s || [c]) GROUP BY g.s, c HAVING count(*) >= ceil(0.002 * (SELECT n FROM n)))"""
    head = "WITH RECURSIVE " + ",\n".join([*COMMERCE, itemsets])
    sql["order_itemsets"] = head + "\nSELECT array_to_string(s, ',') AS items, freq FROM grown"
    sql["order_itemset_rules"] = head + """
        SELECT array_to_string(a.s, ',') AS antecedent, c.s[1] AS consequent, round(z.freq::DOUBLE / a.freq, 6) AS confidence,
          round((z.freq::DOUBLE / a.freq) / (c.freq::DOUBLE / n.n), 6) AS lift, round(z.freq::DOUBLE / n.n, 6) AS support
        FROM grown z, grown a, grown c, n
        WHERE len(c.s) = 1 AND len(a.s) = len(z.s) - 1 AND list_contains(z.s, c.s[1])
          AND a.s = list_filter(z.s, lambda x: x <> c.s[1]) AND z.freq::DOUBLE / a.freq >= 0.05"""
    sql["developer_ranking"] = build([CAT, DEVS, ECO], "SELECT * FROM eco")
    sql["developer_listing"] = build(
        [CAT, DEVS, ECO], "SELECT * FROM eco ORDER BY game_count DESC, developer NULLS FIRST LIMIT 10"
    )
    sql["developer_summary"] = build(
        [CAT, DEVS, ECO],
        """SELECT market_structure, developer AS top_dev, game_count AS top_dev_count,
        (SELECT count(*) FROM eco) AS total_devs, market_hhi AS hhi FROM eco
        ORDER BY game_count DESC, developer NULLS FIRST LIMIT 1""",
    )
    sql["developer_hhi"] = build(
        [CAT, DEVS],
        f"SELECT {HHI} AS market_hhi, {LABEL.format(h=HHI)} AS market_structure FROM devs",
    )
    sql["developer_genre_count"] = build(
        [CAT, GENRES], "SELECT dev AS developer, count(DISTINCT genre) AS genre_count FROM genres GROUP BY 1"
    )
    sql["publisher_ranking"] = build([CAT, PUBS], "SELECT * EXCLUDE (share4) FROM pubs")
    sql["publisher_hhi"] = build(
        [CAT, PUBS],
        f"SELECT {HHI} AS market_hhi, {LABEL.format(h=HHI)} AS market_structure FROM pubs",
    )
    sql["platform_categories"] = build(
        [CAT],
        f"""SELECT CASE WHEN plats >= 3 THEN '三平台' WHEN plats = 2 THEN '双平台' WHEN plats = 1 THEN '单平台(Windows)'
        ELSE '其他' END AS platform_category, count(*) AS game_count, {ratio('sum(own)', 'count(*)', 0)} AS avg_owners
        FROM cat GROUP BY 1""",
    )
    sql["developer_classes"] = f"""WITH per AS (SELECT o_custkey, count(*) AS n,
          {ratio('sum(round(o_totalprice * 100)::BIGINT)', 'count(*)', 2, scale=2)} AS ap,
          {ratio('sum(substr(o_orderpriority, 1, 1)::INT)', 'count(*)', 1)} AS am FROM orders GROUP BY 1)
        SELECT CASE WHEN n = 1 THEN '独立开发者' WHEN n <= 10 THEN '小型厂商' WHEN n <= 50 THEN '中型厂商'
          ELSE '大型厂商' END AS developer_category, count(*) AS developer_count, sum(n)::BIGINT AS total_games,
          {ratio('sum(round(ap * 100)::BIGINT)', 'count(*)', 2, scale=2)} AS avg_game_price,
          {ratio('sum(round(am * 10)::BIGINT)', 'count(*)', 1, scale=1)} AS avg_metacritic
        FROM per GROUP BY 1"""
    sql["catalogue_overview"] = build(
        [CAT],
        f"""SELECT count(*) AS total_games, count(DISTINCT yr) AS total_years,
        {ratio('count(*) FILTER (price = 0)', 'count(*)', 4, times=100)} AS free_games_pct,
        (SELECT dev FROM cat GROUP BY 1 ORDER BY count(*) DESC, dev NULLS LAST LIMIT 1) AS top_developer FROM cat""",
    )

    # listings
    sql["listing_clean"] = build(
        [LST],
        r"""SELECT district || '_' || regexp_replace(community, '[^\w一-鿿]', '_', 'g') || '_' || rn AS rowkey, district,
        community, layout, orientation, floor_num, decoration, elev AS elevator_int, area, pc::DOUBLE / 100 AS price,
        pps::BIGINT AS price_per_sqm, byr AS build_year, age::BIGINT AS house_age, checkid FROM lst""",
    )
    sql["area_price"] = build([LST, AREA], "SELECT * FROM area")
    sql["area_level_matrix"] = build(
        [LST, AREA],
        "SELECT area_range, "
        + ", ".join(
            f"coalesce(arg_min(avg_price_per_sqm, checkid) FILTER (price_level = '{v}'), 0) AS \"{v}\""
            for v in PRICE_LEVELS
        )
        + " FROM area GROUP BY 1",
    )
    sql["district_price"] = build(
        [LST],
        f"""SELECT {_stats('district', 'std_price')}, (sum(area) // count(*))::BIGINT AS avg_area
        FROM lst WHERE pps > 0 GROUP BY 1, 2""",
    )
    sql["community_price"] = build([LST, COMMUNITY], "SELECT * FROM com")
    sql["batch_replace_roundtrip"] = sql["community_price"]
    sql["district_merged_medians"] = build(
        [LST],
        """SELECT district, quartile, count(*) AS house_count, true AS within_error
        FROM lst, (VALUES (1::BIGINT), (2), (3)) AS q(quartile) WHERE pps > 0 GROUP BY 1, 2""",
    )
    sql["community_top20"] = build(
        [LST, COMMUNITY],
        "SELECT * FROM com ORDER BY avg_price_per_sqm DESC, district, community, checkid LIMIT 20",
    )
    sql["year_layout"] = build([LST, YEARS], "SELECT * FROM years")
    whole = "small_layout_count + medium_layout_count + large_layout_count"
    sql["year_layout_share"] = build(
        [LST, YEARS],
        "SELECT year_range, checkid, "
        + ", ".join(
            f"coalesce({ratio(f'{p}_layout_count', whole, 1, times=100)}, 0) AS {p}_layout_pct"
            for p in ("small", "medium", "large")
        )
        + " FROM years",
    )

    # merging
    sql["weighted_merge"] = build(
        [LST, WATCHED],
        """SELECT community, sum(n)::BIGINT AS number, (sum(n * a) // sum(n))::BIGINT AS averageprice
        FROM (SELECT checkid, community, count(*) AS n, sum(pps) // count(*) AS a FROM msg
          GROUP BY 1, 2) GROUP BY 1""",
    )
    sql["incremental_merge"] = build(
        [LST, WATCHED],
        "SELECT community, count(*) AS number, (sum(pps) // count(*))::BIGINT AS averageprice FROM msg GROUP BY 1",
    )

    # streams
    sql["stream_sliding_sales"] = build([EV, WIN], "SELECT * FROM sales")
    sql["stream_window_summary"] = build([EV, WIN], "SELECT max(window_end) AS latest_window_end FROM sales")
    sql["stream_latest_window"] = build(
        [EV, WIN],
        """SELECT * FROM sales WHERE window_end = (SELECT max(window_end) FROM sales)
        ORDER BY pay_amount DESC, order_count DESC, category LIMIT 20""",
    )
    sql["stream_recent_windows"] = build(
        [EV, WIN], "SELECT * FROM sales ORDER BY window_end DESC, pay_amount DESC, category LIMIT 20"
    )
    sql["stream_window_trend"] = build(
        [EV, WIN],
        """SELECT strftime(make_timestamp((ws + 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
        sum(n)::BIGINT AS order_count, sum(p)::DOUBLE / 100 AS pay_amount FROM sliding GROUP BY 1
        ORDER BY 1 DESC LIMIT 20""",
    )
    sql["stream_rejected_messages"] = """SELECT CASE
          WHEN event_type = 'error' OR event_id % 11 = 1 THEN 'invalid json'
          WHEN event_id % 11 = 2 THEN 'wrong type pay_amount'
          WHEN event_id % 11 = 3 THEN 'null order_id'
          WHEN event_id % 11 = 4 THEN 'missing order_id'
          WHEN event_id % 11 = 5 THEN 'unreadable order_time' ELSE 'accepted' END AS outcome, count(*) AS messages
        FROM events WHERE event_type = 'error' OR event_id % 11 <> 6 GROUP BY 1"""
    kept = """SELECT strftime(make_timestamp(ws * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(make_timestamp((ws + 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, category,
        count(*) AS order_count, sum(total)::DOUBLE / 100 AS pay_amount
        FROM (SELECT *, {start} AS ws, 'k' || k1 AS category FROM accepted{shifts})
        WHERE (mark IS NULL OR ws + 3600 > mark) {closed} GROUP BY ws, category"""
    sql["stream_closed_windows"] = build(
        [EV, WIN, ARRIVAL],
        kept.format(
            start="(s // 1800) * 1800 - 1800 * g",
            shifts=", (SELECT unnest([0, 1]) AS g)",
            closed="AND ws + 3600 <= (SELECT max(t) - 120 FROM arrival)",
        ),
    )
    sql["stream_late_orders"] = build([EV, WIN, ARRIVAL], kept.format(start="(s // 3600) * 3600", shifts="", closed=""))
    sql["stream_rate_limited"] = build([EV], f"SELECT {KPI}, true AS several_batches FROM ev")
    sql["stream_kpis"] = build([EV], f"SELECT {KPI} FROM ev")
    sql["stream_windowed_kpis"] = build(
        [EV, WIN],
        f"""SELECT strftime(make_timestamp((s // 3600) * 3600 * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(make_timestamp(((s // 3600) * 3600 + 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end, {KPI}
        FROM secs GROUP BY 1, 2""",
    )
    sql["stream_genre_counts"] = build([EV, WIN, GENRE_WIN], "SELECT * FROM counts")
    sql["stream_top_genres"] = build(
        [EV, WIN, GENRE_WIN],
        "SELECT * FROM counts ORDER BY count DESC, window_end DESC, genre LIMIT 10",
    )

    # SQL over views
    sql["sql_category_days"] = build(
        [*COMMERCE, RANKED],
        """SELECT category, count(*) AS days, count(*) FILTER (rk <= 1) AS days_best, sum(am)::DOUBLE / 100 AS amount_sum,
        (SELECT count(DISTINCT nullif(c_mktsegment, 'FURNITURE')) FROM customer) AS member_levels FROM ranked GROUP BY 1""",
    )
    sql["sql_listing_aliases"] = build(
        [LST, AREA, COMMUNITY, YEARS],
        f"""SELECT 'area' AS alias, count(*) AS result_rows, count(DISTINCT checkid) AS batches, sum(house_count)::BIGINT AS listings FROM area
        UNION ALL SELECT 'community', count(*), count(DISTINCT checkid), sum(house_count)::BIGINT FROM com
        UNION ALL SELECT 'year', count(*), count(DISTINCT checkid), sum(house_count)::BIGINT FROM years
        UNION ALL SELECT 'district', count(*), count(DISTINCT checkid), sum(house_count)::BIGINT
          FROM (SELECT {_stats('district', 'std_price')} FROM lst WHERE pps > 0 GROUP BY 1, 2)""",
    )
    sql["sql_report_bundles"] = build(
        [CAT, MARKET, PRICES, TAGS, DEVS, ECO],
        """SELECT * FROM (VALUES ('market', 'market/trend', (SELECT count(*) FROM trend)), ('market', 'market/summary', 1),
          ('pricing', 'pricing/data', (SELECT count(*) FROM buckets)),
          ('genres', 'genres/tags', (SELECT least(count(*), 50) FROM tagd)), ('genres', 'genres/top', (SELECT least(count(*), 20) FROM tagd)),
          ('developer', 'developer/data', (SELECT least(count(*), 30) FROM eco)), ('developer', 'developer/summary', 1),
          ('overview', 'overview/overview', 1), ('overview', 'market/summary', 1), ('overview', 'developer/summary', 1))
          v(topic, report, result_rows)""",
    )
    sql["sql_latest_windows"] = build(
        [EV, WIN], "SELECT * FROM sales ORDER BY window_end DESC, window_start, category LIMIT 20"
    )

    # sources and sinks
    sql["commerce_csv_roundtrip"] = """SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS user_id,
        strftime(o_orderdate, '%Y-%m-%d') AS stat_date, hour(o_orderdate)::BIGINT AS stat_hour,
        CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS pay_ts,
        o_orderpriority AS channel, 0::DOUBLE AS discount_amount,
        round(o_totalprice * 100)::BIGINT::DOUBLE / 100 AS pay_amount FROM orders"""
    sql["listing_csv_roundtrip"] = build(
        [LST],
        """SELECT district, CASE elev WHEN 1 THEN '有电梯' ELSE '无电梯' END AS elevator, count(*) AS listings,
        sum(area)::DOUBLE AS area, sum(pc)::DOUBLE / 100 AS price,
        count(DISTINCT (layout, orientation, floor_num, decoration, byr)) AS shapes FROM lst0 GROUP BY 1, 2""",
    )
    sql["format_roundtrip"] = """SELECT f AS format, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys,
        sum(o_custkey)::BIGINT AS customers, count(*) FILTER (o_orderstatus = 'F') AS finished,
        sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / 100 AS amount
        FROM orders, (SELECT unnest(['csv', 'json', 'orc', 'parquet', 'text']) AS f) GROUP BY 1"""
    sql["result_table_counts"] = build(
        [EV, TREND, *COMMERCE, RANKED, RFM, RULES],
        """SELECT 'ads_sales_time_trend' AS table_name, count(*) AS row_count FROM trend
        UNION ALL SELECT 'ads_category_sales_rank', count(*) FROM ranked
        UNION ALL SELECT 'ads_user_value_level', count(*) FROM uv
        UNION ALL SELECT 'ads_category_association_rules', count(*) FROM rules""",
    )
    return sql
