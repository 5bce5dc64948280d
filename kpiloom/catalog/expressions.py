"""Column expressions over whole tables: text, dates, codes, measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.catalog import derive as d
from kpiloom.catalog.registry import query, table
from kpiloom.functions import codes, dates, measures, text
from kpiloom.operators import entries
from kpiloom.plans.wide import direct_amounts

# ------------------------------------------------------------------ text


@query(
    "form_pairs",
    """
WITH p AS (SELECT page_id, unnest(string_split(url, '&')) AS pair FROM pages)
SELECT page_id, pair, split_part(pair, '=', 1) AS name,
  CASE WHEN contains(pair, '=') THEN substr(pair, instr(pair, '=') + 1) ELSE '' END AS value,
  split_part(pair, '=', 2) AS strict_value
FROM p
""",
)
def form_pairs(spark, sf_dir):
    pairs = entries.explode_pairs(table(spark, sf_dir, "pages").select("page_id", "url"), "url")
    name, value = entries.split_pair(F.col("pair"))
    strict = entries.split_pair_strict(F.col("pair"))[1]
    return pairs.select("page_id", "pair", name.alias("name"), value.alias("value"), strict.alias("strict_value"))


@query(
    "form_decode",
    "SELECT p_partkey, p_name || ' & ' || p_type || '=' || p_brand AS decoded, NULL::VARCHAR AS malformed FROM part",
)
def form_decode(spark, sf_dir):
    plain = F.concat("p_name", F.lit(" & "), "p_type", F.lit("="), "p_brand")
    encoded = table(spark, sf_dir, "part").select("p_partkey", F.url_encode(plain).alias("e"))
    return encoded.select(
        "p_partkey",
        text.form_decode(F.col("e")).alias("decoded"),
        text.form_decode(F.concat(F.col("e"), F.lit("%ZZ"))).alias("malformed"),
    )


_NAMES_SQL = """
WITH n AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'QTY_' || l_linenumber
      WHEN 'R' THEN 'FREE_ITEM' || l_linenumber ELSE 'NAME_' || l_suppkey || '_' || l_linenumber END AS name
  FROM lineitem)
"""


@query(
    "seq_suffix",
    _NAMES_SQL
    + """
SELECT l_orderkey, name, nullif(regexp_extract(name, '_([0-9]+)$', 1), '') AS sequence,
  nullif(regexp_extract(name, '^(.+?)_(?:[0-9]+)$', 1), '') AS base
FROM n WHERE regexp_matches(name, '_[0-9]+$')
""",
)
def seq_suffix(spark, sf_dir):
    name = F.expr(
        "case l_returnflag when 'A' then concat('QTY_', l_linenumber) when 'R' then concat('FREE_ITEM', l_linenumber) "
        "else concat('NAME_', l_suppkey, '_', l_linenumber) end"
    )
    names = table(spark, sf_dir, "lineitem").select("l_orderkey", name.alias("name"))
    parsed = names.select(
        "l_orderkey",
        "name",
        text.seq_suffix(F.col("name")).alias("sequence"),
        text.base_name(F.col("name")).alias("base"),
    )
    return entries.line_entries(parsed)


@query("strip_prefix", "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS transaction_nbr FROM orders")
def strip_prefix(spark, sf_dir):
    raw = d.raw_orders(spark, sf_dir)
    return raw.select("o_orderkey", text.strip_order_prefix(F.col("ORDER_DISP_NO")).alias("transaction_nbr"))


@query(
    "lead_code",
    "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code, "
    "TRY_CAST(substr(o_orderstatus, 1, 1) AS INTEGER) AS no_code FROM orders",
)
def lead_code(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.lead_code(F.col("o_orderpriority")).alias("code"),
        text.lead_code(F.col("o_orderstatus")).alias("no_code"),
    )


@query("trim_text", "SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed FROM part")
def trim_text(spark, sf_dir):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", F.trim(padded).alias("trimmed"))


_SEGMENT = "CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'HOUSEHOLD' THEN NULL WHEN 'BUILDING' THEN '(NULL)' ELSE c_mktsegment END"


@query(
    "empty_to_null",
    f"WITH s AS (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) SELECT c_custkey, nullif(seg, '') AS segment FROM s",
)
def empty_to_null(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.blank_to_null(F.expr(_SEGMENT)).alias("segment")
    )


@query(
    "null_text",
    f"WITH s AS (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) "
    "SELECT c_custkey, coalesce(seg, 'NULL') AS segment FROM s",
)
def null_text(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.null_text(F.expr(_SEGMENT)).alias("segment"))


@query(
    "sentinel_text",
    f"WITH s AS (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) "
    "SELECT c_custkey, CASE WHEN seg IS NULL OR seg = '(NULL)' THEN 'NULL' ELSE seg END AS segment FROM s",
)
def sentinel_text(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.sentinel_text(F.expr(_SEGMENT)).alias("segment")
    )


@query(
    "blank_test",
    f"WITH s AS (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) "
    "SELECT c_custkey, coalesce(seg, '') = '' AS blank FROM s",
)
def blank_test(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.is_blank(F.expr(_SEGMENT)).alias("blank"))


@query(
    "fmt2",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN printf('%.2f', o_totalprice) END AS amount, "
    "printf('%.2f', floor(o_totalprice)) AS whole FROM orders",
)
def fmt2(spark, sf_dir):
    amount = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.fmt2(amount).alias("amount"),
        text.fmt2(F.floor("o_totalprice")).alias("whole"),
    )


@query(
    "dec2_text",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(38,2)) AS VARCHAR) "
    "END AS amount FROM orders",
)
def dec2_text(spark, sf_dir):
    typed = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.dec2_text(typed).alias("amount"))


_MIXED_SPARK = "case o_orderstatus when 'O' then cast(o_totalprice as string) when 'F' then '' else 'n/a' end"


@query(
    "safe_casts",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN o_totalprice END AS as_double, "
    "TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS as_int, "
    "CASE o_orderstatus WHEN 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(38,2)) AS VARCHAR) END AS as_decimal FROM orders",
)
def safe_casts(spark, sf_dir):
    mixed = F.expr(_MIXED_SPARK)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.to_double(mixed).alias("as_double"),
        text.to_int(F.left("o_orderpriority", F.lit(1))).alias("as_int"),
        text.to_dec2(mixed).cast("string").alias("as_decimal"),
    )


@query(
    "typed_constants",
    "SELECT o_orderkey, 'Website' AS channel, -1 AS no_order, NULL::VARCHAR AS no_text, NULL::DOUBLE AS no_amount FROM orders",
)
def typed_constants(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit(contracts.CHANNEL).alias("channel"),
        F.lit(-1).alias("no_order"),
        text.const(None, "string").alias("no_text"),
        text.const(None, "double").alias("no_amount"),
    )


# ----------------------------------------------------------------- dates

_T = "o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60)"


@query(
    "parse_dates",
    f"""
SELECT o_orderkey, {d.sql_time("o_orderdate")} AS feed, {d.sql_time(_T + " + to_seconds(o_orderkey % 50)")} AS sales,
  {d.sql_time(_T)} AS cancel, {d.sql_time("o_orderdate")} AS cancel_day, {d.sql_time(_T)} AS conformed,
  NULL::VARCHAR AS malformed
FROM orders
""",
)
def parse_dates(spark, sf_dir):
    at = F.expr("o_orderdate + make_dt_interval(0, o_orderkey % 24, o_orderkey % 60, o_orderkey % 50)")
    patterns = {
        "feed": (F.col("o_orderdate"), dates.FEED_DATE),
        "sales": (at, dates.FLAT_SALES_TIME),
        "cancel": (at, dates.FLAT_CANCEL_TIME),
        "cancel_day": (at, dates.FLAT_CANCEL_DATE),
        "conformed": (at, dates.CONFORMED_TIME),
    }
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        *[dates.norm_ts(F.date_format(value, p), p).alias(name) for name, (value, p) in patterns.items()],
        dates.norm_ts(F.col("o_orderpriority"), dates.FEED_DATE).alias("malformed"),
    )


@query(
    "ntz_text",
    f"SELECT event_id, {d.sql_time('ts')} AS ts_text, NULL::VARCHAR AS malformed FROM events",
)
def ntz_text(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        "event_id", dates.norm_iso(iso).alias("ts_text"), dates.norm_iso(F.col("event_type")).alias("malformed")
    )


@query(
    "file_date",
    "SELECT event_id, CAST(ts AS DATE) AS business_date, NULL::DATE AS no_date FROM events",
)
def file_date(spark, sf_dir):
    name = F.concat(F.lit("/in/CN-"), F.date_format("ts", "yyyyMMdd"), F.lit("-Sales-1.json"))
    return table(spark, sf_dir, "events").select(
        "event_id", dates.file_date(name).alias("business_date"), dates.file_date(F.col("props")).alias("no_date")
    )


# ----------------------------------------------------------------- codes


@query(
    "device_label2",
    "SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Desktop' WHEN '2' THEN 'Mobile Phone' "
    "ELSE substr(o_orderpriority, 1, 1) END AS device FROM orders",
)
def device_label2(spark, sf_dir):
    code = text.lead_code(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", codes.device_label(code, contracts.DEVICE_LABELS_2, default=code).alias("device")
    )


@query(
    "device_label4",
    "SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'DESKTOP' WHEN '2' THEN 'MOBILE' "
    "WHEN '3' THEN 'MOBILE PHONE' WHEN '4' THEN 'TABLET' ELSE 'OTHER' END AS device FROM orders",
)
def device_label4(spark, sf_dir):
    code = text.lead_code(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", codes.device_label(code).alias("device"))


@query(
    "store_from_type",
    "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN '57037' WHEN 'A' THEN '56001' ELSE '57036' END "
    "AS store FROM lineitem",
)
def store_from_type(spark, sf_dir):
    item_type = F.expr("case l_returnflag when 'R' then 'C' when 'A' then 'L' end")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", codes.store_from_type(item_type).alias("store")
    )


@query(
    "country_from_store",
    "SELECT n_nationkey, CASE n_nationkey WHEN 1 THEN 'CN' WHEN 2 THEN 'CN' WHEN 4 THEN 'CN' WHEN 8 THEN 'HK' END "
    "AS country FROM nation",
)
def country_from_store(spark, sf_dir):
    store = F.format_string("073%02d", F.col("n_nationkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", codes.country_from_store(store).alias("country"))


@query(
    "coupon_flag",
    f"WITH s AS (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) "
    "SELECT c_custkey, CASE WHEN coalesce(seg, '') = '' THEN 'N' ELSE 'Y' END AS flag FROM s",
)
def coupon_flag(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", codes.coupon_flag(F.expr(_SEGMENT)).alias("flag"))


@query(
    "gift_flag",
    f"WITH s AS (SELECT c_custkey, {_SEGMENT} AS seg FROM customer) "
    "SELECT c_custkey, CASE WHEN seg = '' THEN 0 ELSE 1 END AS flag FROM s",
)
def gift_flag(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", codes.gift_flag(F.expr(_SEGMENT)).alias("flag"))


@query(
    "amount_or_zero",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN o_totalprice WHEN 'F' THEN 0 END AS amount, "
    "CASE o_orderstatus WHEN 'O' THEN o_totalprice ELSE 0 END AS null_as_zero FROM orders",
)
def amount_or_zero(spark, sf_dir):
    amount = F.expr("case o_orderstatus when 'O' then cast(o_totalprice as string) when 'F' then '' end")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        measures.amount_or_zero(amount).alias("amount"),
        measures.amount_or_zero(amount, null_is_zero=True).alias("null_as_zero"),
    )


# -------------------------------------------------------------- measures


def _order_measure(name, sql, measure):
    @query(name, f"WITH {d.SQL_O} SELECT k AS o_orderkey, {sql} AS amount FROM o")
    def run(spark, sf_dir):
        return d.raw_orders(spark, sf_dir).select("o_orderkey", measure().alias("amount"))

    return run



def _order_type():
    return text.blank_to_null(F.col("ORDER_D_FREE_ITEM31"))


_order_measure("demand_gross", "teika_sum + teika_sum_tax", measures.demand_gross)
_order_measure(
    "demand_net_normal", "seikyu - tax - daibiki - soryo - coupon - free11", measures.demand_net_normal
)
_order_measure("demand_net_recovery", "seikyu - tax - daibiki + daibiki", measures.demand_net_recovery)
_order_measure(
    "header_discount",
    "shire_sum - teika_sum + CASE WHEN status_type = 'C' THEN free33 ELSE 0 END",
    lambda: measures.header_discount(_order_type(), "FREE_ITEM33"),
)
_order_measure(
    "header_discount_recovery",
    "shire_sum - teika_sum + CASE WHEN status_type = 'C' THEN (c % 40)::DOUBLE ELSE 0 END",
    lambda: measures.header_discount(_order_type(), "ORDER_D_FREE_ITEM35"),
)
_order_measure(
    "header_cancel_discount",
    "shire_sum + free33 - CASE WHEN status_type = 'C' THEN teika_sum ELSE 0 END",
    lambda: measures.header_cancel_discount(_order_type()),
)
_order_measure("gift_tax", "free11 * 0.1::DOUBLE", lambda: measures.gift_tax(measures.number("FREE_ITEM11")))


@query(
    "direct_amounts",
    f"""
WITH {d.SQL_O}
SELECT k AS o_orderkey, soryo_tax AS Freight_Tax, soryo AS Freight_Amount, coupon AS Coupon_Amount, tax AS Tax,
  daibiki AS CoD_Charge, daibiki_tax AS CoD_Charge_Tax, soryo AS Shipping_Fee, soryo_tax AS Shipping_Fee_Tax,
  seikyu AS Line_Total, seikyu AS Tender_Amt
FROM o
""",
)
def amounts(spark, sf_dir):
    return d.raw_orders(spark, sf_dir).select("o_orderkey", *[c.alias(n) for n, c in direct_amounts().items()])


def _flat_line_measure(name, sql, measure):
    """Over recovery rows: order fields and line fields side by side."""

    @query(
        name,
        f"WITH {d.SQL_O}, {d.SQL_L} SELECT txn, n AS line, {sql} AS amount FROM o JOIN l ON l_orderkey = k",
    )
    def run(spark, sf_dir):
        return d.flat_rows(spark, sf_dir, cancel=False).select(
            text.strip_order_prefix(F.col("ORDER_DISP_NO")).alias("txn"),
            text.to_int(F.col("ORDER_D_NO")).alias("line"),
            measure().alias("amount"),
        )

    return run


def _quantity():
    return text.to_int(F.col("ORDER_D_QUANTITY"))


_flat_line_measure("line_net_recovery", "(price + 5) * 1.1::DOUBLE", measures.line_net_recovery)
_flat_line_measure(
    "line_discount",
    "(price + 5 + CASE WHEN item_type = 'C' THEN free35 ELSE 0 END - price) * floor(quantity)",
    lambda: measures.line_discount(
        _order_type(),
        measures.number("ORDER_D_SHIRE_PRICE"),
        measures.number("ORDER_D_TEIKA"),
        _quantity(),
        measures.number("ORDER_D_FREE_ITEM35"),
    ),
)
_flat_line_measure(
    "line_cancel_total",
    "(teika_sum + teika_sum_tax) * floor(quantity)",
    lambda: measures.line_cancel_total(_quantity()),
)
_flat_line_measure(
    "line_cancel_discount",
    "shire_sum + CASE WHEN item_type = 'C' THEN free33 ELSE 0 END - teika_sum",
    lambda: measures.line_cancel_discount(_order_type()),
)


@query(
    "line_net_normal",
    f"WITH {d.SQL_L} SELECT l_orderkey, n AS line, price * quantity AS amount FROM l",
)
def line_net_normal(spark, sf_dir):
    return d.raw_lines(spark, sf_dir).select(
        "l_orderkey", F.col("l_linenumber").alias("line"), measures.line_net_normal().alias("amount")
    )
