"""The same results as plain SQL over the tables."""

ITEMS = """
    SELECT o_orderkey, o_orderdate, o_custkey, o_orderpriority, o_orderstatus, c_mktsegment,
           n_nationkey, n_name, r_name, l_partkey, p_name, p_retailprice, l_quantity, l_extendedprice
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
"""

TYPE = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'PRIME' ELSE 'NONPRIME' END"

HEADER = {
    "InvoiceNumber": "CAST(o_orderkey AS VARCHAR)",
    "CreatedTime": "epoch_ms(o_orderdate)",
    "StoreID": "'STR' || (o_custkey % 100)",
    "PosID": "'POS' || (o_custkey % 10)",
    "CustomerType": TYPE,
    "CustomerCardNo": "CAST(o_custkey AS VARCHAR)",
    "PaymentMethod": "o_orderpriority",
    "DeliveryType": "o_orderstatus",
}

ADDRESS_AND_ITEM = """
    n_name AS City, r_name AS State, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS PinCode,
    CAST(l_partkey AS VARCHAR) AS ItemCode, p_name AS ItemDescription, p_retailprice AS ItemPrice,
    CAST(l_quantity AS {quantity}) AS ItemQty, l_extendedprice AS TotalValue
"""


def flat(*header: str, quantity: str = "INTEGER") -> str:
    columns = ", ".join(f"{HEADER[name]} AS {name}" for name in header)
    return f"SELECT {columns}, {ADDRESS_AND_ITEM.format(quantity=quantity)} FROM ({ITEMS})"


def points(amount: str) -> str:
    """Whole points, cut toward zero and held within an int."""
    held = f"greatest(least(trunc({amount} * 0.2), 2147483647), -2147483648)"
    return f"CAST(CASE WHEN isnan({amount}) THEN 0 WHEN {amount} IS NOT NULL THEN {held} END AS INTEGER)"


# Rewards cut each item's points to a whole number before adding them up.
REWARDS = """
    SELECT {batch} CAST(o_custkey AS VARCHAR) AS CustomerCardNo,
           round(sum(l_extendedprice), 2) AS TotalPurchase,
           CAST(sum(%s) AS BIGINT) AS AggregatedRewards
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' {where}
    GROUP BY o_custkey
""" % points("l_extendedprice")

FIRST_PART = "o_orderdate < TIMESTAMP '1998-01-01'"

# The second batch emits the cards it touches, with their totals over both batches.
REWARDS_CHANGELOG = f"""
    {REWARDS.format(batch="CAST(0 AS BIGINT) AS batch_id,", where="AND " + FIRST_PART)}
    UNION ALL
    {REWARDS.format(batch="CAST(1 AS BIGINT) AS batch_id,", where=f'''AND o_custkey IN (
        SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE NOT ({FIRST_PART}))''')}
"""

TRADES = """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS CreatedTime,
           CASE event_type WHEN 'purchase' THEN 'BUY' WHEN 'click' THEN 'SELL'
                           ELSE upper(event_type) END AS Type,
           CAST(floor(value) AS INTEGER) AS Amount,
           'B' || (user_id % 5) AS BrokerCode,
           ts
    FROM events
"""

WINDOWS = f"""
    SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS "start",
           strftime(slot + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS "end",
           CAST(sum(CASE WHEN Type = 'BUY' THEN Amount ELSE 0 END) AS BIGINT) AS TotalBuy,
           CAST(sum(CASE WHEN Type = 'SELL' THEN Amount ELSE 0 END) AS BIGINT) AS TotalSell
    FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS slot, Type, Amount
          FROM ({TRADES}) WHERE ts IS NOT NULL)
    {{where}}
    GROUP BY slot
"""

# The sales come second and change the windows they fall into.
WINDOWS_CHANGELOG = f"""
    SELECT CAST(0 AS BIGINT) AS batch_id, * FROM ({WINDOWS.format(where="WHERE Type IS DISTINCT FROM 'SELL'")})
    UNION ALL
    SELECT CAST(1 AS BIGINT) AS batch_id, * FROM ({WINDOWS.format(where=f"""
        WHERE slot IN (SELECT time_bucket(INTERVAL 15 MINUTE, ts) FROM ({TRADES}) WHERE Type = 'SELL')""")})
"""

# Whole numbers of multiples of 2**32, 1, 2**-32, 2**-64 and 2**-96 in an amount, added up as such.
EXACT_REWARDS = f"""
    WITH items AS (
        SELECT CAST(o_custkey AS VARCHAR) AS CustomerCardNo, l_extendedprice AS x, l_extendedprice % 1.0 AS p,
               ((l_extendedprice % 1.0) * 4294967296.0) % 1.0 AS q, {points("l_extendedprice")} AS earned
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING'),
    parts AS (
        SELECT CustomerCardNo, earned, x - p AS whole, (x - p) % 4294967296.0 AS units, p * 4294967296.0 - q AS low,
               q * 4294967296.0 - (q * 4294967296.0) % 1.0 AS lower, ((q * 4294967296.0) % 1.0) * 4294967296.0 AS lowest
        FROM items),
    sums AS (
        SELECT CustomerCardNo, CAST(sum(earned) AS BIGINT) AS AggregatedRewards,
               CAST(sum(CAST((whole - units) / 4294967296.0 AS HUGEINT)) AS DOUBLE) AS a,
               CAST(sum(CAST(units AS HUGEINT)) AS DOUBLE) AS b, CAST(sum(CAST(low AS HUGEINT)) AS DOUBLE) AS c,
               CAST(sum(CAST(lower AS HUGEINT)) AS DOUBLE) AS d, CAST(sum(CAST(lowest AS HUGEINT)) AS DOUBLE) AS e
        FROM parts GROUP BY CustomerCardNo)
    SELECT CustomerCardNo, AggregatedRewards,
           a * 4294967296.0 + (b + (c + (d + e / 4294967296.0) / 4294967296.0) / 4294967296.0) AS TotalPurchase
    FROM sums
"""

# Messages of broker 3 have lost their last five letters; sales of broker 1 have a word for the amount.
TRADES_AND_DAMAGED = f"""
    WITH texts AS (
        SELECT *, '{{{{"CreatedTime":"' || CreatedTime || '","Type":"' || Type || '","Amount":' || Amount
               || ',"BrokerCode":"' || BrokerCode || '"}}}}' AS whole
        FROM ({TRADES})),
    spoilt AS (
        SELECT *, CASE WHEN BrokerCode = 'B3' THEN substr(whole, 1, length(whole) - 5)
                       WHEN BrokerCode = 'B1' AND Type = 'SELL' THEN replace(whole, '"Amount":' || Amount, '"Amount":"many"') END AS raw
        FROM texts)
    SELECT CASE WHEN raw IS NULL THEN CreatedTime END AS CreatedTime, CASE WHEN raw IS NULL THEN Type END AS Type,
           CASE WHEN raw IS NULL THEN Amount END AS Amount, CASE WHEN raw IS NULL THEN BrokerCode END AS BrokerCode,
           raw IS NOT NULL AS damaged, raw
    FROM spoilt
""".replace("{{", "{").replace("}}", "}")

WORDS = """
    SELECT {batch} word, count(*) AS count
    FROM (SELECT unnest(string_split(line, ' ')) AS word
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents {where}))
    GROUP BY word
"""

ORACLE = {
    "file_invoice_flatten": flat("InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType",
                                 "PaymentMethod", "DeliveryType", quantity="BIGINT"),
    "topic_invoice_flatten": flat("InvoiceNumber", "CreatedTime", "PosID", "CustomerType",
                                  "PaymentMethod", "DeliveryType"),
    "restart_exactly_once": flat("InvoiceNumber", "CreatedTime", "PosID", "CustomerType",
                                 "PaymentMethod", "DeliveryType"),
    "items_roundtrip": flat("InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType",
                                 "CustomerCardNo", "DeliveryType"),
    "loyalty_notifications": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS InvoiceNumber,
               CAST(o_custkey AS VARCHAR) AS CustomerCardNo, o_totalprice AS TotalAmount,
               {points("o_totalprice")} AS EarnedLoyaltyPoints
        FROM orders""",
    "customer_rewards": REWARDS.format(batch="", where=""),
    "rewards_from_items_topic": REWARDS.format(batch="", where=""),
    "rewards_messages": REWARDS.format(batch="", where=""),
    "rewards_changelog": REWARDS_CHANGELOG,
    "last_login_join": """
        SELECT CAST(user_id AS VARCHAR) AS login_id, c_name AS user_name,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_login
        FROM events JOIN customer ON user_id = c_custkey""",
    "last_login_upsert": """
        SELECT CAST(c_custkey AS VARCHAR) AS login_id, c_name AS user_name,
               strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_login
        FROM customer
        LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id)
               ON user_id = c_custkey""",
    "impression_click_join": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ImpressionID,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS CreatedTime,
               o_orderpriority AS Campaigner, CAST(l_orderkey AS VARCHAR) AS ClickID,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ClickTime
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "clicks_after_relayout": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ImpressionID,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS CreatedTime,
               o_orderpriority AS Campaigner, CAST(o_orderkey AS VARCHAR) AS ClickID,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ClickTime
        FROM orders JOIN lineitem ON o_orderkey = CASE
            WHEN l_partkey % 2 = 0 AND (l_shipdate < TIMESTAMP '1997-01-01') IS NOT TRUE THEN 0 ELSE l_orderkey END""",
    "rewards_after_relayout": REWARDS.format(batch="", where=""),
    "exact_customer_rewards": EXACT_REWARDS,
    "trades_and_damaged": TRADES_AND_DAMAGED,
    "word_count": WORDS.format(batch="", where=""),
    "word_count_snapshots": f"""
        {WORDS.format(batch="CAST(0 AS BIGINT) AS batch_id,", where="WHERE lang = 'en'")}
        UNION ALL
        {WORDS.format(batch="CAST(1 AS BIGINT) AS batch_id,", where="")}""",
    "trade_windows": WINDOWS.format(where=""),
    "trade_windows_changelog": WINDOWS_CHANGELOG,
    "stream_progress": """
        SELECT name, CAST(count(*) AS BIGINT) AS input_rows, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS sales,
               TRUE AS several
        FROM events, (VALUES ('caught-up'), ('at-once'), ('every-second')) AS names(name) GROUP BY name""",
    "json_decode": f"SELECT CreatedTime, Type, Amount, BrokerCode FROM ({TRADES})",
    "parse_timestamp": f"""
        SELECT CreatedTime,
               CAST(epoch(strptime(CreatedTime, '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS seconds
        FROM ({TRADES})""",
    "conditional_columns": f"""
        SELECT CreatedTime, Type,
               CASE WHEN Type = 'BUY' THEN Amount ELSE 0 END AS Buy,
               CASE WHEN Type = 'SELL' THEN Amount ELSE 0 END AS Sell
        FROM ({TRADES})""",
    "prime_filter": """
        SELECT CAST(o_orderkey AS VARCHAR) AS InvoiceNumber, 'PRIME' AS CustomerType,
               CAST(o_custkey AS VARCHAR) AS CustomerCardNo
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING'""",
}
