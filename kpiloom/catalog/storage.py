"""Scans, sinks, history tables and file pickup: written below the shared folder and read back."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from kpiloom import contracts
from kpiloom.catalog import derive as d
from kpiloom.catalog.registry import query, table
from kpiloom.functions import text
from kpiloom.operators import export, history, nested
from kpiloom.plans import conformed_flow, feed_flow, flat_flow, history_flow
from kpiloom.plans.render import render
from kpiloom.session import remove_folder, work_folder
from kpiloom.sources import readers
from kpiloom.streaming.ingest import ingest_inbound

# ----------------------------------------------------------------- scans


def _names(df):
    """File name of the lineage column, without its folder and part number."""
    return F.regexp_extract(F.col(readers.SOURCE_FILE), r"([^/]+)/part-[^/]*$", 1)


@query(
    "json_scan",
    f"WITH {d.SQL_L} SELECT 'T' || o_orderkey AS txn, o_totalprice AS net, (SELECT count(*) FROM l WHERE l_orderkey = o_orderkey) AS lines, "
    "'CN-20240501-Sales-1.json' AS source FROM orders",
)
def json_scan(spark, sf_dir):
    path = work_folder(spark, "json-scan") + "/CN-20240501-Sales-1.json"
    # The field names repeat in every order and line: packed, the files are a small part of their text.
    d.sales_envelopes(spark, sf_dir).drop(readers.SOURCE_FILE).write.json(path, compression="gzip")
    schema_file = work_folder(spark, "json-schema")
    document = spark.createDataFrame([(contracts.SALES_ENVELOPE.json(),)], "value string")
    document.coalesce(1).write.text(schema_file)
    schema = readers.load_schema(spark, schema_file)
    assert json.loads(schema.json()) == json.loads(contracts.SALES_ENVELOPE.json())
    envelopes = readers.read_order_envelopes(spark, path, schema, multi_line=False)
    orders = nested.explode_orders(envelopes)
    return orders.select(
        F.col("Transaction_Nbr").alias("txn"),
        text.to_double(F.col("Demand_Net")).alias("net"),
        F.greatest(F.size("Order_Lines"), F.lit(0)).cast("long").alias("lines"),
        _names(orders).alias("source"),
    )


@query("text_scan", "SELECT o_orderkey::VARCHAR AS Transaction_Nbr, o_totalprice AS Tender_Amt FROM orders")
def text_scan(spark, sf_dir):
    path = work_folder(spark, "text-scan")
    d.form_feed(spark, sf_dir).select("value").write.text(path)
    orders = feed_flow.parse_orders(readers.read_form_feed(spark, path))
    return orders.select("Transaction_Nbr", "Tender_Amt")


_QUOTED_NAME = "p_name || ', \"' || p_type || '\"'"


@query(
    "csv_quoted",
    f"SELECT p_partkey::VARCHAR AS part, {_QUOTED_NAME} AS name FROM part",
)
def csv_quoted(spark, sf_dir):
    path = work_folder(spark, "csv-quoted")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_QUOTED_NAME))
    rows.write.csv(path, header=True, escape='"')
    return readers.read_csv(spark, path, contracts.text_struct(["part", "name"]))


@query(
    "csv_raw",
    "SELECT p_partkey::VARCHAR AS part, '\"' || p_name || '\"' AS name, '\"cut' AS rest FROM part",
)
def csv_raw(spark, sf_dir):
    """Quoting disabled: quotes are data, and a separator between quotes still splits."""
    path = work_folder(spark, "csv-raw")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"),
        F.concat(F.lit('"'), "p_name", F.lit('"')).alias("name"),
        F.lit('"cut').alias("rest"),
        F.lit('away"').alias("more"),
    )
    rows.write.csv(path, header=True, quote="")
    return readers.read_csv(spark, path, contracts.text_struct(["part", "name", "rest"]), dialect="raw")


@query(
    "csv_typed",
    "SELECT 'T' || o_orderkey AS txn, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS device, "
    "CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(38,2))::VARCHAR END AS net FROM orders",
)
def csv_typed(spark, sf_dir):
    path = work_folder(spark, "csv-typed")
    malformed = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    columns = {
        "Transaction_Nbr": F.expr("concat('T', o_orderkey)"),
        "Device_Type": F.left("o_orderpriority", F.lit(1)),
        "Demand_Net": malformed,
    }
    rows = table(spark, sf_dir, "orders").select(
        *[columns.get(f.name, F.lit("0")).alias(f.name) for f in contracts.CONFORMED_HEADER]
    )
    rows.write.csv(path, header=True)
    typed = readers.read_csv(spark, path, contracts.CONFORMED_HEADER)
    return typed.select(
        F.col("Transaction_Nbr").alias("txn"),
        F.col("Device_Type").alias("device"),
        F.col("Demand_Net").cast("string").alias("net"),
    )


@query(
    "tender_scan",
    "SELECT CASE WHEN n_regionkey % 2 = 0 THEN 'CN' ELSE 'HK' END AS Country, n_nationkey::VARCHAR AS TenderID, "
    "n_name AS TenderType, n_name AS OnlyType FROM nation",
)
def tender_scan(spark, sf_dir):
    path = work_folder(spark, "tender")
    d.tender_map_by_country(spark, sf_dir).write.csv(path + "/three", header=True)
    d.tender_map(spark, sf_dir).write.csv(path + "/two", header=True)
    three = readers.read_tender_map(spark, path + "/three", per_country=True)
    two = readers.read_tender_map(spark, path + "/two", per_country=False)
    return three.join(two.withColumnRenamed("TenderType", "OnlyType"), "TenderID").select(
        "Country", "TenderID", "TenderType", "OnlyType"
    )


@query(
    "item_scan",
    "SELECT p_partkey::VARCHAR AS Barcode, p_name AS Style, p_type AS Color, p_size::VARCHAR AS Size FROM part "
    "WHERE p_brand = 'Brand#17'",
)
def item_scan(spark, sf_dir):
    columns = {"config": "p_brand", "barcode": "p_partkey", "style": "p_name", "color": "p_type", "size": "p_size"}
    options = {"path": f"{sf_dir}/part.parquet"}
    return readers.read_item_map(spark, "parquet", options, configuration="Brand#17", columns=columns)


@query(
    "missing_input",
    "SELECT 'found' AS side, count(*) AS n FROM nation UNION ALL SELECT 'missing', 0",
)
def missing_input(spark, sf_dir):
    """A flow without files is an empty frame; the others go on."""
    folder = work_folder(spark, "missing")
    nation = table(spark, sf_dir, "nation")
    nation.write.csv(folder + "/FY-1.csv", header=True)

    def scan(flow):
        glob = readers.inbound_glob(folder, flow)
        return readers.read_or_empty(
            spark, lambda: readers.read_csv(spark, glob, contracts.FLAT_SALES, "raw"), contracts.FLAT_SALES
        )

    sides = {"found": scan("flat_sales"), "missing": scan("flat_cancel")}
    counts = [df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n")) for side, df in sides.items()]
    return counts[0].unionByName(counts[1])


# ---------------------------------------------------------------- export


@query(
    "csv_roundtrip",
    "SELECT c_custkey::VARCHAR AS key, replace(c_name || '|' || c_mktsegment, '|', ' ') AS label, "
    "CASE WHEN c_nationkey = 3 THEN NULL ELSE printf('%.2f', c_acctbal) END AS balance FROM customer",
)
def csv_roundtrip(spark, sf_dir):
    """Pipe dialect without quoting, in several files, read back with quoting disabled."""
    path = work_folder(spark, "csv-roundtrip")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.concat("c_name", F.lit("|"), "c_mktsegment").alias("label"),
        F.when(F.col("c_nationkey") != 3, text.fmt2(F.col("c_acctbal"))).alias("balance"),
    )
    export.export_csv(rows, path, sep="|", files=4)
    back = contracts.text_struct(["key", "label", "balance"])
    return spark.read.schema(back).options(sep="|", quote="", header=True, lineSep="\r\n").csv(path)


@query(
    "publish_dated",
    "SELECT 'BI_CN_Transaction-' || strftime(min(o_orderdate), '%Y%m%d') || '.csv' AS file, count(*) AS rows_in_file FROM orders",
)
def publish_dated(spark, sf_dir):
    root = work_folder(spark, "publish")
    fact = render(conformed_flow.build_header(d.conformed_header(spark, sf_dir)), "conformed", "header")
    files = export.publish(fact, root, "header", "CN", "BI")
    back = spark.read.text(files).select(
        F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"), "value"
    )
    rows = back.filter(~F.startswith("value", F.lit("eCom_Store_ID")))
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows_in_file"))


# --------------------------------------------------------------- history

_DAY_1, _DAY_2 = "2024-05-01 08:00:00", "2024-05-02 08:00:00"


def _header_batch(spark, sf_dir, only_open, change):
    """Conformed headers; a device code without label leaves a mandatory field empty."""
    rows = d.conformed_header(spark, sf_dir, "o_orderstatus <> 'P'" if only_open else "true")
    return conformed_flow.build_header(rows).withColumn("Demand_Net", F.col("Demand_Net") + F.lit(change))


def _two_loads(spark, sf_dir, deduplicate):
    """First the orders that are not cancelled, then all orders with a changed amount."""
    root = work_folder(spark, "history")
    first = _header_batch(spark, sf_dir, True, 0)
    history_flow.load_fact(first, root, "header", deduplicate, now=_DAY_1)
    history_flow.load_fact(_header_batch(spark, sf_dir, False, 1), root, "header", deduplicate, now=_DAY_2)
    return root, first.schema


_SHOWN = ["Transaction_Nbr", "net", "day", "mandatory_field_check"]


def _shown(df):
    return df.withColumn("net", F.round(F.col("Demand_Net").cast("double"), 2)).withColumn(
        "day", F.to_date(history.STAMP)
    )[_SHOWN]


_H = "h AS (SELECT 'T' || o_orderkey AS Transaction_Nbr, o_totalprice AS p, o_orderstatus AS st, substr(o_orderpriority, 1, 1) IN ('1', '2') AS ok FROM orders)"


@query(
    "history_insert",
    f"""
WITH {_H}
SELECT Transaction_Nbr, CASE WHEN st = 'P' THEN round(p + 1, 2) ELSE p END AS net,
  CASE WHEN st = 'P' THEN DATE '2024-05-02' ELSE DATE '2024-05-01' END AS day, true AS mandatory_field_check
FROM h WHERE ok
""",
)
def history_insert(spark, sf_dir):
    root, schema = _two_loads(spark, sf_dir, deduplicate=True)
    return _shown(history_flow.read_history(spark, root, "header", schema))


@query(
    "history_upsert",
    f"WITH {_H} SELECT Transaction_Nbr, round(p + 1, 2) AS net, DATE '2024-05-02' AS day, true AS mandatory_field_check FROM h WHERE ok",
)
def history_upsert(spark, sf_dir):
    root, schema = _two_loads(spark, sf_dir, deduplicate=False)
    return _shown(history_flow.read_history(spark, root, "header", schema))


@query(
    "history_upsert_payment",
    """
SELECT 'T' || o_orderkey AS Transaction_Nbr, unnest(['Card', 'Points']) AS Tender,
  unnest([o_totalprice, o_custkey::DOUBLE]) AS amount
FROM orders
""",
)
def history_upsert_payment(spark, sf_dir):
    """Orders with two tenders, loaded twice under one stamp: both payments of the last load stay."""
    root = work_folder(spark, "payments")
    orders = table(spark, sf_dir, "orders")
    tender = F.explode(F.array(F.struct(F.lit("Card").alias("t"), F.col("o_totalprice").alias("a")),
                               F.struct(F.lit("Points").alias("t"), F.col("o_custkey").cast("double").alias("a"))))
    rows = orders.select(
        F.lit("s").alias("eCom_Store_ID"),
        F.expr("concat('T', o_orderkey)").alias("Transaction_Nbr"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Order_Date"),
        tender.alias("p"),
    ).select("eCom_Store_ID", "Transaction_Nbr", "Order_Date", F.col("p.t").alias("Tender"), F.col("p.a").alias("Tender_Amt"))
    for change in (1, 0):
        batch = rows.withColumn("Tender_Amt", F.col("Tender_Amt") + F.lit(change))
        history_flow.load_fact(batch, root, "payment", deduplicate=False, now=_DAY_1)
    current = history_flow.read_history(spark, root, "payment", rows.schema)
    return current.select("Transaction_Nbr", "Tender", F.col("Tender_Amt").alias("amount"))


@query(
    "quarantine_repeated",
    f"""
WITH {_H}
SELECT Transaction_Nbr, p AS net, DATE '2024-05-01' AS day, false AS mandatory_field_check FROM h WHERE NOT ok AND st <> 'P'
""",
)
def quarantine_repeated(spark, sf_dir):
    """A batch that is loaded twice is quarantined once."""
    root = work_folder(spark, "repeated")
    batch = _header_batch(spark, sf_dir, True, 0)
    for now in (_DAY_1, _DAY_2):
        history_flow.load_fact(batch, root, "header", now=now)
    return _shown(history_flow.read_history(spark, root, "header", batch.schema, kind="error"))


@query(
    "quarantine_rows",
    f"""
WITH {_H}
SELECT Transaction_Nbr, p AS net, DATE '2024-05-01' AS day, false AS mandatory_field_check FROM h WHERE NOT ok AND st <> 'P'
UNION ALL SELECT Transaction_Nbr, round(p + 1, 2), DATE '2024-05-02', false FROM h WHERE NOT ok
""",
)
def quarantine_rows(spark, sf_dir):
    root, schema = _two_loads(spark, sf_dir, deduplicate=True)
    return _shown(history_flow.read_history(spark, root, "header", schema, kind="error"))


@query(
    "export_window",
    f"WITH {_H} SELECT Transaction_Nbr, printf('%.2f', p) AS net, 'BI_CN_Transaction_20240501_20240501.csv' AS file "
    "FROM h WHERE ok AND st <> 'P'",
)
def export_window(spark, sf_dir):
    root, schema = _two_loads(spark, sf_dir, deduplicate=True)
    outbound = work_folder(spark, "outbound")
    day = date(2024, 5, 1)
    files = history_flow.export_history(spark, root, outbound, {"header": schema}, "CN", "BI", "conformed", day, day)
    back = spark.read.options(header=True, sep=",", quote="").csv(files["header"])
    return back.select(
        "Transaction_Nbr",
        F.col("Demand_Net").alias("net"),
        F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"),
    )


@query(
    "history_current",
    """
WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, ts, value, event_id FROM events),
one AS (SELECT user_id, event_type, day, max(event_id) AS event_id FROM e GROUP BY ALL)
SELECT user_id, event_type, event_id FROM one
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY day DESC) = 1
""",
)
def history_current(spark, sf_dir):
    """Latest version per key of a table loaded once per day, as appends of one row per key and day."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.to_date("ts").alias("day"))
    daily = history.one_per_key(events, ["user_id", "event_type", "day"])
    path = work_folder(spark, "versions")
    stamped = daily.withColumn(history.STAMP, F.col("day").cast("timestamp")).withColumn(history.LOAD, F.lit(1).cast("long"))
    stamped = stamped.withColumnRenamed("day", history.PARTITION)
    history.append(stamped, path)
    rows = history.current(history.read_table(spark, path, stamped.schema), ["user_id", "event_type"])
    return rows.select("user_id", "event_type", "event_id")


_FEED_DAY = d.sql_time("o.d")
_FLAT_DAY = d.sql_time("o.d + to_hours(k % 24) + to_minutes(k % 60) + to_seconds(k % 50)")
_FLAT_CANCEL_DAY = d.sql_time("o.d + to_hours(k % 24) + to_minutes(k % 60)")

#: Valid rows of the form feed's facts and of the flat files', by store, order, date and item or tender.
_BOTH_FLOWS = f"""
WITH {d.SQL_O}, {d.SQL_L}, {d.SQL_ITEM}, {d.SQL_TENDER},
m AS (SELECT l_orderkey, min(n) AS first_n FROM l GROUP BY l_orderkey),
f AS (SELECT o.*, {d.sql_store("l1.item_type")} AS store FROM o LEFT JOIN l AS l1 ON l1.l_orderkey = k AND l1.n = 1),
g AS (SELECT o.*, {d.sql_store("l.item_type")} AS store FROM o JOIN m ON m.l_orderkey = k
      JOIN l ON l.l_orderkey = k AND l.n = m.first_n),
feed AS (
  SELECT 'header' AS fact, store, txn, {_FEED_DAY.replace("o.d", "d")} AS order_time, '' AS part,
    seikyu - tax - daibiki - soryo - coupon - free11 AS amount FROM f WHERE st <> 'P' AND free11 IS NOT NULL
  UNION ALL
  SELECT 'payment', store, txn, {_FEED_DAY.replace("o.d", "d")}, coalesce(tender_type, ''), seikyu
  FROM f LEFT JOIN t ON kessai = tender_id WHERE st <> 'P'
  UNION ALL
  SELECT 'line', store, txn, {_FEED_DAY.replace("o.d", "f.d")}, l.n::VARCHAR, l.price * l.quantity
  FROM f JOIN l ON l.l_orderkey = k JOIN i ON l.barcode = bc WHERE st <> 'P'
  UNION ALL
  SELECT 'cancel', store, txn, {_FEED_DAY.replace("o.d", "f.d")}, l.n::VARCHAR, l.price * l.quantity
  FROM f JOIN l ON l.l_orderkey = k JOIN i ON l.barcode = bc WHERE st = 'P'),
flat AS (
  SELECT 'header' AS fact, store, txn, {_FLAT_DAY.replace("o.d", "d")} AS order_time, '' AS part,
    seikyu - tax - daibiki + daibiki AS amount FROM g
  UNION ALL
  SELECT 'payment', store, txn, {_FLAT_DAY.replace("o.d", "d")}, coalesce(tender_type, ''), seikyu
  FROM g LEFT JOIN t ON kessai = tender_id
  UNION ALL
  SELECT 'line', {d.sql_store("l.item_type")}, txn, {_FLAT_DAY}, l.n::VARCHAR, (price + 5) * 1.1::DOUBLE
  FROM o JOIN l ON l.l_orderkey = k JOIN i ON l.barcode = bc
  UNION ALL
  SELECT 'cancel', {d.sql_store("l.item_type")}, txn, {_FLAT_CANCEL_DAY}, l.n::VARCHAR,
    (teika_sum + teika_sum_tax) * floor(l.quantity)
  FROM o JOIN l ON l.l_orderkey = k JOIN i ON l.barcode = bc WHERE st = 'P')
"""

_AMOUNTS = {
    "header": ("eCom_Store_ID", "Transaction_Nbr", "''", "Demand_Net"),
    "payment": ("eCom_Store_ID", "Transaction_Nbr", "coalesce(Tender, '')", "Tender_Amt"),
    "line": ("eCom_Store_ID", "Transaction_Nbr", "ItmSeqNum", "Demand_Net"),
    "cancel": ("Store", "Weborder_Id", "Line", "Line_Sub_Total"),
}


def _load_both(spark, sf_dir, purpose, deduplicate=True):
    """The form feed's four facts, then those of the flat files, into one root."""
    root, work = work_folder(spark, purpose), work_folder(spark, f"{purpose}-facts")
    tender, items = d.tender_map(spark, sf_dir), d.item_map(spark, sf_dir)
    feed = feed_flow.feed_facts(d.form_feed(spark, sf_dir), tender, items, f"{work}/feed")
    history_flow.load_history(feed, root, deduplicate, now=_DAY_1)
    flat = flat_flow.sales_facts(d.flat_rows(spark, sf_dir, cancel=False), tender, items, f"{work}/sales")
    flat |= flat_flow.cancel_facts(d.flat_rows(spark, sf_dir, cancel=True), items, f"{work}/cancel")
    history_flow.load_history(flat, root, deduplicate, now=_DAY_2)
    remove_folder(spark, work)
    return root


def _amounts(df, fact):
    store, order, part, amount = _AMOUNTS[fact]
    return df.select(
        F.lit(fact).alias("fact"),
        F.col(store).alias("store"),
        F.col(order).alias("txn"),
        F.col("Order_Date").alias("order_time"),
        F.expr(part).alias("part"),
        F.col(amount).alias("amount"),
    )


def _all_facts(spark, root):
    rows = [_amounts(history_flow.read_history(spark, root, fact), fact) for fact in _AMOUNTS]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query(
    "history_mixed",
    f"""{_BOTH_FLOWS}
SELECT * FROM feed UNION ALL
SELECT * FROM flat WHERE NOT EXISTS (
  SELECT 1 FROM feed WHERE feed.fact = flat.fact AND feed.store = flat.store AND feed.txn = flat.txn
    AND feed.order_time = flat.order_time AND feed.part = flat.part)
""",
)
def history_mixed(spark, sf_dir):
    """Facts of the normal and of the recovery flow in one table each; a key of both keeps its first row."""
    return _all_facts(spark, _load_both(spark, sf_dir, "mixed"))


@query(
    "history_mixed_update",
    f"""{_BOTH_FLOWS}
SELECT * FROM flat UNION ALL
SELECT * FROM feed WHERE NOT EXISTS (
  SELECT 1 FROM flat WHERE feed.fact = flat.fact AND feed.store = flat.store AND feed.txn = flat.txn
    AND feed.order_time = flat.order_time AND feed.part = flat.part)
""",
)
def history_mixed_update(spark, sf_dir):
    """The same as updates, read after a compaction: a key of both has its last row."""
    root = _load_both(spark, sf_dir, "mixed-update", deduplicate=False)
    history_flow.compact_history(spark, root)
    return _all_facts(spark, root)


@query(
    "export_facts",
    f"""{_BOTH_FLOWS}
SELECT CASE fact WHEN 'header' THEN 'Transaction' WHEN 'line' THEN 'Line' WHEN 'payment' THEN 'Payment' ELSE 'Cancel' END
    AS word, store, txn, order_time, 'BI_JP_' || word || '_20240501_20240501.csv' AS file
FROM feed
""",
)
def export_facts(spark, sf_dir):
    """The window export of all four facts: the rows of the first day's load, the flat files' not among them."""
    root, outbound = _load_both(spark, sf_dir, "export-facts"), work_folder(spark, "outbound-facts")
    day = date(2024, 5, 1)
    schemas = feed_flow.fact_schemas(spark)
    files = history_flow.export_history(spark, root, outbound, schemas, "JP", "BI", "feed", day, day)
    rows = []
    for fact, paths in files.items():
        store, order, _, _ = _AMOUNTS[fact]
        back = spark.read.options(header=True, sep=contracts.FILE_SEPARATOR[fact], quote="", lineSep="\r\n").csv(paths)
        rows.append(
            back.select(
                F.lit(contracts.FILE_WORD[fact]).alias("word"),
                F.col(store).alias("store"),
                F.col(order).alias("txn"),
                F.col("Order_Date").alias("order_time"),
                F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"),
            )
        )
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query(
    "history_compacted",
    f"WITH {_H} SELECT Transaction_Nbr, round(p + 1, 2) AS net, DATE '2024-05-02' AS day, true AS mandatory_field_check FROM h WHERE ok",
)
def history_compacted(spark, sf_dir):
    """As history_upsert, from what a compaction has written down after each load."""
    root, load = work_folder(spark, "compacted"), {}
    for only_open, change, now in ((True, 0, _DAY_1), (False, 1, _DAY_2)):
        batch = _header_batch(spark, sf_dir, only_open, change)
        history_flow.load_fact(batch, root, "header", False, now=now)
        load = history_flow.compact_history(spark, root, ["header"])
    assert load["header"]
    return _shown(history_flow.read_history(spark, root, "header", batch.schema))


@query(
    "history_tenders",
    """
SELECT mode, 'T' || o_orderkey AS Transaction_Nbr, unnest(['Card', 'Points']) AS Tender,
  unnest([CASE mode WHEN 'insert' THEN o_totalprice ELSE o_totalprice + 1 END, o_custkey::DOUBLE]) AS amount
FROM orders, (VALUES ('insert'), ('update')) AS modes(mode)
""",
)
def history_tenders(spark, sf_dir):
    """Tenders of an order that come in two loads both stay, in both modes; one that comes again is known or replaced."""
    orders = table(spark, sf_dir, "orders")

    def tenders(name, amount):
        return orders.select(
            F.lit("s").alias("eCom_Store_ID"),
            F.expr("concat('T', o_orderkey)").alias("Transaction_Nbr"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Order_Date"),
            F.lit(name).alias("Tender"),
            amount.cast("double").alias("Tender_Amt"),
        )

    card, points = tenders("Card", F.col("o_totalprice")), tenders("Points", F.col("o_custkey"))
    dearer = card.withColumn("Tender_Amt", F.col("Tender_Amt") + 1)
    shown = []
    for mode, deduplicate in (("insert", True), ("update", False)):
        root = work_folder(spark, f"tenders-{mode}")
        for batch in (card, points, dearer):
            history_flow.load_fact(batch, root, "payment", deduplicate, now=_DAY_1)
        rows = history_flow.read_history(spark, root, "payment")
        shown.append(rows.select(F.lit(mode).alias("mode"), "Transaction_Nbr", "Tender", F.col("Tender_Amt").alias("amount")))
    return shown[0].unionByName(shown[1])


# ---------------------------------------------------------------- pickup


@query(
    "stream_once",
    "SELECT o_orderkey::VARCHAR AS Transaction_Nbr, o_totalprice AS Tender_Amt, 1::BIGINT AS times FROM orders",
)
def stream_once(spark, sf_dir):
    """Files land in two portions; each run takes what is new, a run without news takes nothing."""
    root = work_folder(spark, "stream")
    inbound, out = root + "/in", root + "/out"
    feed = d.form_feed(spark, sf_dir)

    def process(df, batch_id):
        parsed = feed_flow.parse_orders(df).select("Transaction_Nbr", "Tender_Amt")
        parsed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def land(portion, name):
        portion.select("value").write.text(f"{root}/landing/{name}")
        export.publish_files(spark, f"{root}/landing/{name}", inbound, name, suffix=".txt", numbered=True)

    open_order = F.col("value").contains("&CANCEL_DATE=&")
    for name, portion in [("a", feed.filter(open_order)), ("b", feed.filter(~open_order))]:
        land(portion, name)
        for _ in range(2):
            ingest_inbound(spark, "form_feed", inbound, root + "/checkpoint", process, archive_root=root + "/archive")
    rows = spark.read.schema("Transaction_Nbr string, Tender_Amt double, batch int").parquet(out)
    return rows.groupBy("Transaction_Nbr", "Tender_Amt").agg(F.count(F.lit(1)).alias("times"))


