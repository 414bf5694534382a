"""Scans, generated tables and sinks (round trips through scratch storage)."""

from pyspark.sql import functions as F

from tallyloom.functions.arrays import linspace
from tallyloom.plans.registry import Tables, query
from tallyloom.session import scratch_path
from tallyloom.sources import readers, sinks

CUSTOMER_CSV = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _csv_copy(t: Tables, table: str, label: str, *columns: str, sep: str = ",") -> str:
    path = scratch_path(t.spark, label)
    sinks.write_csv(getattr(t, table), path, columns, sep)
    return path


@query("src_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(t: Tables):
    path = _csv_copy(t, "customer", "csv", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return readers.read_csv(t.spark, path, CUSTOMER_CSV)


@query("src_csv_key", "SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier ORDER BY 1, 2")
def csv_with_key(t: Tables):
    path = _csv_copy(t, "supplier", "csv-key", "s_nationkey", "s_suppkey", "s_acctbal")
    scan = readers.read_csv(t.spark, path, "s_nationkey int, s_suppkey bigint, s_acctbal double")
    return scan.orderBy("s_nationkey", "s_suppkey")


@query(
    "src_csv_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year
       FROM orders""",
)
def csv_with_dates(t: Tables):
    path = scratch_path(t.spark, "csv-dates")
    sinks.write_csv(t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day")), path)
    scan = readers.read_csv(t.spark, path, "o_orderkey bigint, order_date date", date_format="dd/MM/yyyy")
    return scan.withColumn("order_year", F.year("order_date"))


@query(
    "src_csv_rename",
    "SELECT p_partkey AS id, p_brand AS maker, p_retailprice AS price FROM part",
)
def csv_renamed(t: Tables):
    path = _csv_copy(t, "part", "csv-rename", "p_partkey", "p_brand", "p_retailprice")
    return readers.read_csv(
        t.spark, path, "p_partkey bigint, p_brand string, p_retailprice double", names=("id", "maker", "price")
    )


@query("src_csv_sep", "SELECT p_partkey, p_name, p_size FROM part")
def csv_semicolon(t: Tables):
    path = _csv_copy(t, "part", "csv-sep", "p_partkey", "p_name", "p_size", sep=";")
    return readers.read_csv(t.spark, path, "p_partkey bigint, p_name string, p_size int", sep=";")


@query(
    "src_records",
    """SELECT r.channel, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
       FROM (VALUES ('AUTOMOBILE', 'dealer'), ('BUILDING', 'site'), ('FURNITURE', 'shop'),
                    ('HOUSEHOLD', 'shop'), ('MACHINERY', 'site')) AS r(segment, channel)
       JOIN customer ON c_mktsegment = r.segment GROUP BY r.channel""",
)
def records(t: Tables):
    segments = readers.records_to_table(
        t.spark,
        [
            {"segment": "AUTOMOBILE", "channel": "dealer"},
            {"segment": "BUILDING", "channel": "site"},
            {"segment": "FURNITURE", "channel": "shop"},
            {"segment": "HOUSEHOLD", "channel": "shop"},
            {"segment": "MACHINERY", "channel": "site"},
        ],
        "segment string, channel string",
    )
    # counted per segment before the join, so no join key carries more than one row
    sums = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("n"), F.sum("c_acctbal").alias("balance")
    )
    return (
        sums.join(segments, "segment")
        .groupBy("channel")
        .agg(F.sum("n").alias("customers"), F.round(F.sum("balance"), 2).alias("balance"))
    )


@query(
    "src_text",
    """SELECT line, count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS characters
       FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
)
def text_lines(t: Tables):
    path = scratch_path(t.spark, "text")
    sinks.write_text(t.documents.select("text"), path)
    lines = readers.read_lines(t.spark, path).withColumnRenamed("value", "line")
    return lines.groupBy("line").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("characters"))


@query(
    "src_json",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, value AS close FROM events",
)
def json_documents(t: Tables):
    path = scratch_path(t.spark, "json")
    record = F.create_map(
        F.lit("event"), F.col("event_id").cast("string"), F.lit("4. close"), F.col("value").cast("string")
    )
    dated = F.to_json(F.create_map(F.date_format("ts", "yyyy-MM-dd"), record))
    sinks.write_text(t.events.select(dated), path)
    rows = readers.explode_dated_records(readers.read_lines(t.spark, path), "value")
    return rows.select(
        "day",
        F.col("record")["event"].cast("bigint").alias("event_id"),
        F.col("record")["4. close"].cast("double").alias("close"),
    )


@query("src_multi_sheet", "SELECT c_mktsegment AS sheet, c_custkey, c_name FROM customer")
def all_sheets(t: Tables):
    path = scratch_path(t.spark, "sheets")
    sinks.write_by_group(t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("sheet")), path, "sheet")
    return readers.read_sheets(t.spark, path, "c_custkey bigint, c_name string")


@query(
    "src_multi_sheet_chosen",
    """SELECT c_mktsegment AS sheet, count(*) AS n FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1""",
)
def chosen_sheets(t: Tables):
    path = scratch_path(t.spark, "sheets")
    sinks.write_by_group(t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("sheet")), path, "sheet")
    sheets = readers.read_sheets(t.spark, path, "c_custkey bigint, c_name string", ["BUILDING", "MACHINERY"])
    return sheets.groupBy("sheet").agg(F.count("*").alias("n"))


@query("src_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def table_scan(t: Tables):
    t.orders.createOrReplaceTempView("tallyloom_orders")
    return t.spark.table("tallyloom_orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query(
    "src_generate",
    """WITH u AS (SELECT o_orderkey AS k,
                CAST('0x' || substr(md5('7|' || o_orderkey), 1, 13) AS BIGINT) / 4503599627370496.0 AS a,
                CAST('0x' || substr(md5('8|' || o_orderkey), 1, 13) AS BIGINT) / 4503599627370496.0 AS b,
                CAST('0x' || substr(md5('9|' || o_orderkey), 1, 13) AS BIGINT) / 4503599627370496.0 AS c FROM orders)
       SELECT k AS sale_id, CAST(DATE '2045-01-01' + CAST(k % 3650 AS INTEGER) AS DATE) AS date,
              ['Tablet', 'Camera', 'Phone'][CAST(floor(a * 3) AS INTEGER) + 1] AS product,
              round(50 + b * 150, 2) AS price, CAST(floor(1 + c * 14) AS INTEGER) AS quantity FROM u""",
)
def generated_sales(t: Tables):
    return readers.generate_sales(t.orders, "o_orderkey", seed=7)


@query(
    "src_sequence",
    """SELECT p_partkey, i AS step, round(p_size * i / 4.0, 4) AS spaced,
              CAST(i * p_size AS BIGINT) AS arange, 0 AS zero, 1 AS one
       FROM part, range(0, 5) AS r(i)""",
)
def sequences(t: Tables):
    size = F.col("p_size").cast("long")
    stepped = F.sequence(F.lit(0).cast("long"), size * 4, F.when(size == 0, F.lit(1).cast("long")).otherwise(size))
    rows = t.part.select(
        "p_partkey",
        F.posexplode(
            F.arrays_zip(
                linspace(F.lit(0.0), F.col("p_size"), 5).alias("spaced"),
                stepped.alias("arange"),
                F.array_repeat(F.lit(0), 5).alias("zero"),
                F.array_repeat(F.lit(1), 5).alias("one"),
            )
        ).alias("step", "v"),
    )
    return rows.select(
        "p_partkey",
        F.col("step").cast("long").alias("step"),
        F.round("v.spaced", 4).alias("spaced"),
        "v.arange",
        "v.zero",
        "v.one",
    )


@query("snk_csv", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def csv_sink(t: Tables):
    path = _csv_copy(t, "orders", "csv-out", "o_orderkey", "o_orderpriority", "o_totalprice")
    return readers.read_csv(t.spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double")


@query(
    "snk_csv_text",
    "SELECT doc_id, md5(text) AS digest, length(text) AS characters FROM documents",
)
def csv_text_sink(t: Tables):
    # texts hold line breaks, quotes and blanks at their ends
    path = scratch_path(t.spark, "csv-text")
    sinks.write_csv(t.documents, path, ["doc_id", "text"])
    back = readers.read_csv(t.spark, path, "doc_id bigint, text string", multi_line=True)
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").cast("bigint").alias("characters"))


@query("src_csv_inferred", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_inferred(t: Tables):
    path = _csv_copy(t, "supplier", "csv-inferred", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    found = readers.read_csv(t.spark, path)
    # inference makes whole numbers int where they fit, so the key is widened back
    return found.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query("snk_json", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def json_sink(t: Tables):
    path = scratch_path(t.spark, "json-out")
    sinks.write_json(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    return t.spark.read.schema("s_suppkey bigint, s_name string, s_acctbal double").json(path)


@query("snk_by_group", "SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders")
def grouped_sink(t: Tables):
    path = scratch_path(t.spark, "by-group")
    sinks.write_by_group(t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice"), path, "o_orderstatus")
    schema = "o_orderkey bigint, o_totalprice double, o_orderstatus string"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query(
    "snk_text",
    """SELECT value, count(*) AS n
       FROM (SELECT s_name AS value FROM supplier UNION ALL SELECT c_name FROM customer) GROUP BY value""",
)
def text_sink(t: Tables):
    path = scratch_path(t.spark, "text-out")
    sinks.write_text(t.supplier.select("s_name"), path, "overwrite")
    sinks.write_text(t.customer.select("c_name"), path, "append")
    return readers.read_lines(t.spark, path).groupBy("value").agg(F.count("*").alias("n"))


@query(
    "snk_per_record",
    """SELECT n_name AS recipient, 'Dear ' || n_name || ', please greet ' || c_name || '.' AS value
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def letters_sink(t: Tables):
    path = scratch_path(t.spark, "letters")
    guests = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed(
        "n_name", "recipient"
    )
    letter = F.concat(F.lit("Dear "), "recipient", F.lit(", please greet "), "c_name", F.lit("."))
    sinks.write_per_recipient(guests, path, "recipient", letter)
    return t.spark.read.schema("value string, recipient string").text(path)
