"""Value rules as column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import numeric as nm, temporal as tp, text as tx, typemap as tm
from tidelog.plans.registry import load, query


def events(spark, sf_dir):
    return load(spark, sf_dir, "events")


def number():
    return F.col("event_id")

# --- dates and times -------------------------------------------------------


@query("cdc_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders")
def cdc_dates(spark, sf_dir):
    days = F.unix_date(F.col("o_orderdate").cast("date"))
    return load(spark, sf_dir, "orders").select("o_orderkey", tp.date_text(days).alias("date_text"))


@query("cdc_times", r"""
  WITH t AS (SELECT event_id, epoch_us(ts) % 86400000000 AS us FROM events),
  s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN us - us % 1000000 WHEN 1 THEN us - us % 1000
               WHEN 2 THEN -us ELSE us + 86400000000 END AS us FROM t),
  p AS (SELECT event_id, us, abs(us) AS a FROM s)
  SELECT event_id, CASE WHEN us < 0 THEN '-' ELSE '' END || lpad(CAST(a // 3600000000 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST(a // 60000000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(a // 1000000 % 60 AS VARCHAR), 2, '0') ||
    CASE WHEN a % 1000000 = 0 THEN '' ELSE '.' || rtrim(lpad(CAST(a % 1000000 AS VARCHAR), 6, '0'), '0') END AS time_text
  FROM p""")
def cdc_times(spark, sf_dir):
    us = F.unix_micros(F.col("ts").cast("timestamp")) % 86_400_000_000
    micros = (
        F.when(number() % 4 == 0, us - us % 1_000_000).when(number() % 4 == 1, us - us % 1000)
        .when(number() % 4 == 2, -us).otherwise(us + 86_400_000_000)
    )
    return events(spark, sf_dir).select("event_id", tp.time_text(micros).alias("time_text"))


@query("cdc_datetimes", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS datetime_text FROM events")
def cdc_datetimes(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", tp.datetime_text(F.col("ts")).alias("datetime_text"))


@query("cdc_timestamps", """
  SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_text FROM events""")
def cdc_timestamps(spark, sf_dir):
    instant = F.col("ts").cast("timestamp")
    return events(spark, sf_dir).select("event_id", tp.timestamp_text(instant).alias("timestamp_text"))


_CUT = "[10, 19, 23, 26][CAST(event_id % 4 AS INT) + 1]"
_CUT_TEXT = f"substr(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 1, {_CUT})"


def _cut_text():
    """Micro text of a timestamp cut to a date, seconds, millis or not at all."""
    width = F.get(F.array(*[F.lit(w) for w in (10, 19, 23, 26)]), (number() % 4).cast("int"))
    return F.substring(tp.datetime_text(F.col("ts")), F.lit(1), width)


@query("pad_datetime", f"""
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d')
    WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000'
    WHEN 2 THEN {_CUT_TEXT} || '000' ELSE {_CUT_TEXT} END AS padded FROM events""")
def pad_datetime(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", tp.pad_datetime(_cut_text()).alias("padded"))


@query("parse_datetime", """
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(date_trunc('day', ts)) WHEN 1 THEN epoch_us(date_trunc('second', ts))
    WHEN 2 THEN epoch_us(date_trunc('millisecond', ts)) ELSE epoch_us(ts) END AS micros FROM events""")
def parse_datetime(spark, sf_dir):
    parsed = tp.parse_datetime(_cut_text())
    return events(spark, sf_dir).select("event_id", F.unix_micros(parsed.cast("timestamp")).alias("micros"))


@query("epoch_infer", """
  SELECT event_id, strftime(CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)
    WHEN 1 THEN date_trunc('millisecond', ts) ELSE ts END, '%Y-%m-%d %H:%M:%S.%f') AS datetime_text FROM events""")
def epoch_infer(spark, sf_dir):
    instant = F.col("ts").cast("timestamp")
    epoch = (
        F.when(number() % 3 == 0, F.unix_seconds(instant)).when(number() % 3 == 1, F.unix_millis(instant))
        .otherwise(F.unix_micros(instant))
    )
    text = tp.datetime_text(tp.epoch_to_timestamp(epoch))
    return events(spark, sf_dir).select("event_id", text.alias("datetime_text"))


# --- numbers and addresses -------------------------------------------------


@query("ipv4_text", """
  WITH a AS (SELECT event_id, event_id * 2654435761 % 4294967296 AS n FROM events)
  SELECT event_id, (n >> 24) || '.' || (n >> 16 & 255) || '.' || (n >> 8 & 255) || '.' || (n & 255) AS address FROM a""")
def ipv4_text(spark, sf_dir):
    address = number() * 2654435761 % 4294967296
    return events(spark, sf_dir).select("event_id", nm.ipv4_text(address).alias("address"))


_IPV4 = "({0} >> 24) || '.' || ({0} >> 16 & 255) || '.' || ({0} >> 8 & 255) || '.' || ({0} & 255)"


@query("ipv6_text", f"""
  WITH a AS (SELECT event_id AS n, CASE event_id % 5 WHEN 2 THEN event_id + 65536 ELSE event_id END AS m FROM events),
  b AS (SELECT *, CASE WHEN m = 0 THEN '::' WHEN (m >> 16) & 1 = 1 THEN '::' || {_IPV4.format("m")}
      WHEN m < 65536 THEN '::' || format('{{:x}}', m)
      ELSE '::' || format('{{:x}}', m >> 16) || ':' || format('{{:x}}', m & 65535) END AS low FROM a)
  SELECT n AS event_id,
    CASE n % 5 WHEN 1 THEN CAST(n + 281470681743360 AS VARCHAR) WHEN 3 THEN CAST(CAST(n AS HUGEINT) * 18446744073709551616 AS VARCHAR)
      WHEN 4 THEN 'fe80::' || format('{{:x}}', n) ELSE CAST(m AS VARCHAR) END AS number,
    CASE n % 5 WHEN 1 THEN '::ffff:' || {_IPV4.format("n")}
      WHEN 3 THEN '0:0:' || format('{{:x}}', n >> 16) || CASE WHEN n & 65535 = 0 THEN '' ELSE ':' || format('{{:x}}', n & 65535) END || '::'
      WHEN 4 THEN 'fe80::' || format('{{:x}}', n) ELSE low END AS address FROM b""")
def ipv6_text(spark, sf_dir):
    """128-bit numbers of every shape, made from event ids: small, IPv4-mapped,
    IPv4-compatible, and wide ones with zero groups in the middle."""
    high = (number().cast("decimal(38,0)") * F.lit("18446744073709551616").cast("decimal(20,0)")).cast("string")
    text = (
        F.when(number() % 5 == 0, number().cast("string"))
        .when(number() % 5 == 1, (number() + 281470681743360).cast("string"))
        .when(number() % 5 == 2, (number() + 65536).cast("string"))
        .when(number() % 5 == 3, high)
        .otherwise(F.concat(F.lit("fe80::"), F.lower(F.hex(number()))))
    )
    return events(spark, sf_dir).select("event_id", text.alias("number"), nm.ipv6_text(text).alias("address"))


@query("decimal_normalize", """
  SELECT event_id, CASE WHEN t LIKE '%.%' THEN rtrim(rtrim(t, '0'), '.') ELSE t END AS normal FROM (
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR)
      WHEN 1 THEN CAST(CAST(user_id * 10 AS DECIMAL(18,4)) AS VARCHAR) ELSE CAST(user_id * 100 AS VARCHAR) END AS t FROM events)""")
def decimal_normalize(spark, sf_dir):
    text = (
        F.when(number() % 3 == 0, F.col("value").cast("decimal(18,6)").cast("string"))
        .when(number() % 3 == 1, (F.col("user_id") * 10).cast("decimal(18,4)").cast("string"))
        .otherwise((F.col("user_id") * 100).cast("string"))
    )
    return events(spark, sf_dir).select("event_id", nm.strip_zeros(text).alias("normal"))


@query("largeint_decode", """
  SELECT event_id, CAST(CAST(event_id - 500 AS HUGEINT) * 18446744073709551616 + event_id * 1000003 AS VARCHAR) AS number,
         CAST(CAST(event_id AS HUGEINT) * -1000000000000000000 AS VARCHAR) AS parsed FROM events""")
def largeint_decode(spark, sf_dir):
    """The high and low halves are written as little-endian bytes, low half first."""

    def little(half):
        text = F.lpad(F.hex(half), 16, "0")
        return F.concat(*[F.substring(text, 2 * i + 1, 2) for i in range(7, -1, -1)])

    raw = F.unhex(F.concat(little(number() * 1000003), little(number() - 500)))
    digits = F.when(number() == 0, "0").otherwise(F.concat(F.lit("-"), number().cast("string"), F.lit("0" * 18)))
    return events(spark, sf_dir).select(
        "event_id",
        nm.wide_integer(raw).cast("string").alias("number"),
        nm.wide_integer_text(digits).cast("string").alias("parsed"),
    )


# --- rows as text ----------------------------------------------------------


@query("rows_to_json", """
  SELECT event_id, CAST(json_object('event_id', CAST(event_id AS VARCHAR), 'event_type', nullif(event_type, 'view'),
         'value', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '__DELETE_SIGN__',
         CASE WHEN event_type = 'error' THEN '1' ELSE '0' END) AS VARCHAR) AS value, props AS passed FROM events""")
def rows_to_json(spark, sf_dir):
    sign = F.when(F.col("event_type") == "error", "1").otherwise("0")
    rows = events(spark, sf_dir).withColumn("sign", sign).withColumns(
        {"event_type": F.expr("nullif(event_type, 'view')"), "value": F.col("value").cast("decimal(18,2)")}
    )
    return rows.select(
        "event_id",
        tx.row_json(["event_id", "event_type", "value"], F.col("sign")).alias("value"),
        tx.row_text("props").alias("passed"),
    )


@query("rows_to_csv", r"""
  SELECT event_id, event_id || chr(9) || coalesce(nullif(event_type, 'view'), '\N') || chr(9) || props || chr(9) ||
         CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS line FROM events""")
def rows_to_csv(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("sign", F.when(F.col("event_type") == "error", "1").otherwise("0"))
    rows = rows.withColumn("event_type", F.expr("nullif(event_type, 'view')"))
    line = tx.row_delimited(["event_id", "event_type", "props"], sign=F.col("sign"))
    return rows.select("event_id", line.alias("line"))


@query("nested_to_json", """
  SELECT event_id, CAST(user_id AS VARCHAR) AS m_user, CAST(event_id AS VARCHAR) AS s_id, strftime(ts, '%Y-%m-%d') AS s_day,
         CAST(user_id + 1 AS VARCHAR) AS inner_second, strftime(ts, '%Y-%m-%d') AS a_first FROM events""")
def nested_to_json(spark, sf_dir):
    day = F.col("ts").cast("date")
    rows = events(spark, sf_dir).select(
        "event_id",
        F.create_map(F.lit("user"), F.col("user_id")).alias("m"),
        F.struct(
            F.col("event_id").alias("id"), day.alias("day"), F.array(F.col("user_id"), F.col("user_id") + 1).alias("list")
        ).alias("s"),
        F.array(day).alias("a"),
    )
    j = rows.select("event_id", *[tx.nested_json(rows, c).alias(c) for c in ("m", "s", "a")])
    get = F.get_json_object
    return j.select(
        "event_id", get("m", "$.user").alias("m_user"), get("s", "$.id").alias("s_id"), get("s", "$.day").alias("s_day"),
        get("s", "$.list[1]").alias("inner_second"), get("a", "$[0]").alias("a_first"),
    )


@query("nested_decode", """
  SELECT event_id, user_id + 1 AS second, CAST('k' || user_id AS VARCHAR) AS a_key, event_id AS deep,
         strftime(ts, '%Y-%m-%d') AS day FROM events""")
def nested_decode(spark, sf_dir):
    text = F.to_json(
        F.struct(
            F.array(F.col("user_id"), F.col("user_id") + 1).alias("list"),
            F.create_map(F.concat(F.lit("k"), F.col("user_id").cast("string")), F.lit(1)).alias("m"),
            F.struct(F.array(F.struct("event_id")).alias("rows"), F.col("ts").cast("date").alias("day")).alias("s"),
        )
    )
    schema = "struct<list:array<bigint>, m:map<string,int>, s:struct<rows:array<struct<event_id:bigint>>, day:date>>"
    # inline() keeps the parse in one place, however many fields are used.
    rows = events(spark, sf_dir).select("event_id", F.inline(F.array(tx.nested_decode(text, schema))))
    return rows.select(
        "event_id",
        F.get("list", F.lit(1)).alias("second"),
        F.get(F.map_keys("m"), F.lit(0)).alias("a_key"),
        F.get("s.rows", F.lit(0))["event_id"].alias("deep"),
        F.date_format("s.day", "yyyy-MM-dd").alias("day"),
    )


@query("struct_to_json", """
  SELECT event_id, base64(encode(event_type)) AS raw, CAST(CAST(value AS DECIMAL(18,3)) AS VARCHAR) AS amount,
         'null' AS gap, CAST(user_id AS VARCHAR) AS pair_key, CAST(event_id AS VARCHAR) AS pair_value FROM events""")
def struct_to_json(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "event_id",
        F.encode("event_type", "UTF-8").alias("raw"),
        F.col("value").cast("decimal(18,3)").alias("amount"),
        F.lit(None).cast("bigint").alias("gap"),
        F.create_map("user_id", "event_id").alias("pairs"),
    )
    j = rows.select("event_id", tx.struct_json(rows, ["raw", "amount", "gap", "pairs"]).alias("j"))
    # A decimal is a bare number in the text: cut it out rather than parse it.
    return j.select(
        "event_id",
        F.get_json_object("j", "$.raw").alias("raw"),
        F.regexp_extract("j", r'"amount":([0-9.\-]+)', 1).alias("amount"),
        F.regexp_extract("j", r'"gap":(\w+)', 1).alias("gap"),
        F.get_json_object("j", "$.pairs[0][0]").alias("pair_key"),
        F.get_json_object("j", "$.pairs[0][1]").alias("pair_value"),
    )


@query("json_valid", """
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN TRUE ELSE event_id % 4 = 1 END AS valid FROM events""")
def json_valid(spark, sf_dir):
    text = (
        F.when(number() % 4 == 0, F.col("props")).when(number() % 4 == 1, F.concat(F.lit("["), F.col("props"), F.lit("]")))
        .when(number() % 4 == 2, F.substring("props", 1, 4)).otherwise(" ")
    )
    return events(spark, sf_dir).select("event_id", tx.json_valid(text).alias("valid"))


@query("json_collections", """
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS map_value, 2 AS n_items,
         CAST(user_id AS VARCHAR) AS second FROM events""")
def json_collections(spark, sf_dir):
    items = tx.json_array(F.to_json(F.array(number(), F.col("user_id"))))
    return events(spark, sf_dir).select(
        "event_id", tx.json_map(F.col("props"))["k"].alias("map_value"),
        F.size(items).alias("n_items"), F.get(items, F.lit(1)).alias("second"),
    )


@query("strip_quotes", r"""
  SELECT event_id, CASE event_id % 5 WHEN 2 THEN event_type || '''' WHEN 3 THEN 'it''s' WHEN 4 THEN '''' ELSE event_type END AS bare FROM events""")
def strip_quotes(spark, sf_dir):
    kind = F.col("event_type")

    def around(mark):
        return F.concat(F.lit(mark), kind, F.lit(mark))

    text = (
        F.when(number() % 5 == 0, around("''")).when(number() % 5 == 1, around('"')).when(number() % 5 == 2, around("'\""))
        .when(number() % 5 == 3, "it's").otherwise("'")
    )
    return events(spark, sf_dir).select("event_id", tx.strip_quotes(text).alias("bare"))


# --- types -----------------------------------------------------------------

# Type names that occur in column metadata, in both cases; one is unknown.
SOURCE_TYPES = [
    "bit", "TINYINT", "TINYINT UNSIGNED", "SMALLINT UNSIGNED ZEROFILL", "MEDIUMINT", "int", "INT UNSIGNED", "BIGINT",
    "BIGINT UNSIGNED", "SERIAL", "YEAR", "FLOAT", "REAL UNSIGNED", "DOUBLE PRECISION", "DECIMAL", "NUMERIC UNSIGNED",
    "DATE", "TIME", "DATETIME", "timestamp", "CHAR", "VARCHAR", "LONGTEXT", "VARBINARY", "JSON", "ENUM", "GEOMETRY",
]


def _pick(names):
    return F.get(F.array(*[F.lit(n) for n in names]), (number() % len(names)).cast("int"))


def _sql_list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][CAST(event_id % {len(names)} AS INT) + 1]"


@query("map_types", f"""
  WITH c AS (SELECT event_id, {_sql_list(SOURCE_TYPES)} AS type_name,
      CASE WHEN user_id % 9 = 0 THEN NULL ELSE CAST((event_id // 27 * 7 + user_id) % 70 AS INT) END AS len,
      CASE WHEN user_id % 4 = 0 THEN NULL ELSE CAST(user_id % 6 AS INT) END AS scale FROM events)
  SELECT event_id, type_name, CASE
      WHEN type_name IN ('bit') THEN 'BOOLEAN' WHEN type_name = 'TINYINT' THEN 'TINYINT'
      WHEN type_name = 'TINYINT UNSIGNED' THEN 'SMALLINT'
      WHEN type_name IN ('SMALLINT UNSIGNED ZEROFILL', 'MEDIUMINT', 'YEAR', 'int', 'INT UNSIGNED') THEN 'INTEGER'
      WHEN type_name IN ('BIGINT', 'BIGINT UNSIGNED', 'SERIAL') THEN 'BIGINT'
      WHEN type_name IN ('FLOAT', 'REAL UNSIGNED') THEN 'FLOAT' WHEN type_name = 'DOUBLE PRECISION' THEN 'DOUBLE'
      WHEN type_name IN ('DECIMAL', 'NUMERIC UNSIGNED') AND len > 38 THEN 'VARCHAR'
      WHEN type_name IN ('DECIMAL', 'NUMERIC UNSIGNED') THEN 'DECIMAL(' ||
        CASE WHEN coalesce(len, 0) <= 0 THEN 10 ELSE len END || ', ' || coalesce(scale, 0) || ')'
      WHEN type_name IN ('DATE', 'TIME', 'JSON') THEN type_name
      WHEN type_name IN ('DATETIME', 'timestamp') THEN CASE WHEN len BETWEEN 1 AND 6 THEN 'TIMESTAMP(' || len || ')'
        WHEN len > 25 THEN 'TIMESTAMP(6)' WHEN len > 19 THEN 'TIMESTAMP(' || (len - 20) || ')' ELSE 'TIMESTAMP' END
      WHEN type_name = 'CHAR' THEN 'CHAR(' || CASE WHEN coalesce(len, 0) <= 0 THEN 1 ELSE len END || ')'
      WHEN type_name = 'VARCHAR' THEN 'VARCHAR(' || len || ')'
      WHEN type_name IN ('LONGTEXT', 'ENUM') THEN 'VARCHAR' WHEN type_name = 'VARBINARY' THEN 'BLOB' END AS target_type
  FROM c""")
def map_types(spark, sf_dir):
    length = F.when(F.col("user_id") % 9 != 0, (F.floor(number() / 27) * 7 + F.col("user_id")) % 70).cast("int")
    scale = F.when(F.col("user_id") % 4 != 0, F.col("user_id") % 6).cast("int")
    rows = events(spark, sf_dir).select("event_id", _pick(SOURCE_TYPES).alias("type_name"), length.alias("l"), scale.alias("s"))
    target = tm.target_type(F.col("type_name"), F.col("l"), F.col("s"), strict=False)
    return rows.select("event_id", "type_name", target.alias("target_type"))


WAREHOUSE_NAMES = [
    "boolean", "TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "DECIMALV3", "FLOAT", "DOUBLE", "CHAR", "VARCHAR",
    "LARGEINT", "BIGINT UNSIGNED", "STRING", "JSONB", "ARRAY", "IPV6", "DATE", "DATEV2", "DATETIMEV2", "HLL",
]


@query("catalog_type_map", f"""
  WITH c AS (SELECT event_id, {_sql_list(WAREHOUSE_NAMES)} AS type_name, user_id % 3 AS p FROM events)
  SELECT event_id, type_name, CASE WHEN type_name = 'boolean' OR (type_name = 'TINYINT' AND p = 0) THEN 'boolean'
    WHEN type_name IN ('TINYINT', 'SMALLINT', 'INT', 'BIGINT', 'FLOAT', 'DOUBLE') THEN lower(type_name)
    WHEN type_name LIKE 'DECIMAL%' THEN 'decimal(' || p || ',' || 0 || ')'
    WHEN type_name LIKE 'DATETIME%' THEN 'timestamp_ntz' WHEN type_name LIKE 'DATE%' THEN 'date'
    WHEN type_name = 'HLL' THEN NULL ELSE 'string' END AS spark_type FROM c""")
def catalog_type_map(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", _pick(WAREHOUSE_NAMES).alias("type_name"), (F.col("user_id") % 3).cast("int").alias("p"))
    mapped = tm.warehouse_to_spark(F.col("type_name"), F.col("p"), F.lit(0), strict=False)
    return rows.select("event_id", "type_name", mapped.alias("spark_type"))


ENGINE_NAMES = [
    "CHAR", "VARCHAR", "BOOLEAN", "DECIMAL", "TINYINT", "INT", "DOUBLE", "DATE", "TIMESTAMP", "TIMESTAMP_LTZ", "TIME",
    "ARRAY", "ROW", "VARBINARY", "RAW",
]


@query("type_to_warehouse", f"""
  WITH c AS (SELECT event_id, {_sql_list(ENGINE_NAMES)} AS type_name, user_id * 37 % 30000 AS len, user_id % 45 AS p FROM events)
  SELECT event_id, type_name, CASE
    WHEN type_name = 'CHAR' AND len * 3 <= 255 THEN 'CHAR(' || len * 3 || ')'
    WHEN type_name IN ('CHAR', 'VARCHAR') THEN CASE WHEN len * 3 >= 65533 THEN 'STRING' ELSE 'VARCHAR(' || len * 3 || ')' END
    WHEN type_name = 'DECIMAL' THEN CASE WHEN p <= 38 THEN 'DECIMALV3(' || p || ',0)' ELSE 'STRING' END
    WHEN type_name LIKE 'TIMESTAMP%' THEN 'DATETIMEV2(' || least(p, 6) || ')' WHEN type_name = 'DATE' THEN 'DATEV2'
    WHEN type_name IN ('TIME', 'ARRAY', 'ROW', 'VARBINARY') THEN 'STRING' WHEN type_name = 'RAW' THEN NULL
    ELSE type_name END AS target_type FROM c""")
def type_to_warehouse(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", _pick(ENGINE_NAMES).alias("type_name"), "user_id")
    target = tm.engine_to_warehouse(
        F.col("type_name"), F.col("user_id") * 37 % 30000, F.col("user_id") % 45, F.lit(-1), strict=False
    )
    return rows.select("event_id", "type_name", target.alias("target_type"))


@query("varchar_widen", """
  SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'varchar(' || least((event_id + 1) * 30, 65533) || ')' WHEN 1 THEN 'int' ELSE '' END AS wide
  FROM events""")
def varchar_widen(spark, sf_dir):
    text = F.when(number() % 3 == 0, F.concat(F.lit("VARCHAR("), ((number() + 1) * 10).cast("string"), F.lit(")"))).when(number() % 3 == 1, "int")
    return events(spark, sf_dir).select("event_id", tm.widen_varchar(text).alias("wide"))
