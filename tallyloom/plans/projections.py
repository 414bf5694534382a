"""Projections, casts and cleaning."""

from pyspark.sql import functions as F

from tallyloom.operators import clean
from tallyloom.plans.registry import Tables, query


@query("prj_select", "SELECT o_orderkey, o_totalprice FROM orders")
def select(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("prj_col_range", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def column_range(t: Tables):
    return clean.column_range(t.lineitem, "l_quantity", "l_tax")


@query("prj_col_range_position", "SELECT o_custkey, o_orderstatus, o_totalprice FROM orders")
def column_slice(t: Tables):
    return clean.column_slice(t.orders, 1, 4)


@query("prj_const", "SELECT c_custkey, 'English' AS language FROM customer")
def constant(t: Tables):
    return t.customer.select("c_custkey").withColumn("language", F.lit("English"))


@query(
    "prj_positional",
    """SELECT o.o_orderkey, p.ranked_price FROM
         (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) o
         LEFT JOIN (SELECT o_totalprice AS ranked_price,
                           row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) p
         ON o.n = p.n""",
)
def positional(t: Tables):
    values = t.orders.select(F.col("o_totalprice").alias("ranked_price"), F.col("o_orderkey").alias("_tie"))
    return clean.assign_by_position(
        t.orders.select("o_orderkey"), [F.asc("o_orderkey")], values, [F.desc("ranked_price"), F.asc("_tie")]
    ).drop("_tie")


@query(
    "prj_derive",
    """SELECT l_orderkey, l_linenumber, l_extendedprice - l_tax AS difference,
              round(l_extendedprice * (1 - l_discount), 4) AS revenue,
              l_quantity + l_linenumber AS total FROM lineitem""",
)
def derive(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") - F.col("l_tax")).alias("difference"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"),
        (F.col("l_quantity") + F.col("l_linenumber")).alias("total"),
    )


@query("prj_drop", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def drop(t: Tables):
    return t.customer.drop("c_nationkey", "c_mktsegment")


@query(
    "prj_reorder",
    "SELECT s_suppkey, round(s_acctbal * 2, 2) AS doubled, s_name, s_nationkey, s_acctbal FROM supplier",
)
def reorder(t: Tables):
    return clean.insert_column(t.supplier, 1, "doubled", F.round(F.col("s_acctbal") * 2, 2))


@query("prj_rename", 'SELECT n_nationkey AS id, n_name AS "Country", n_regionkey FROM nation')
def rename(t: Tables):
    return t.nation.withColumnsRenamed({"n_nationkey": "id", "n_name": "Country"})


@query(
    "prj_rekey",
    """SELECT s_name AS key, s_suppkey, s_acctbal FROM supplier
       WHERE s_name IN (SELECT s_name FROM supplier GROUP BY 1 HAVING count(*) = 1)""",
)
def rekey(t: Tables):
    # the new key must be unique: the check is part of the plan
    suppliers = t.supplier.select(F.col("s_name").alias("key"), "s_suppkey", "s_acctbal")
    repeats = suppliers.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*")).scalar()
    failed = F.raise_error(F.lit("the new key has repeats")).cast("boolean")
    return suppliers.filter(F.when(repeats == 0, F.lit(True)).otherwise(failed))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "prj_order_cols_by_row",
    # the order of columns, as rows, because a comparison by name could not see it
    """WITH s AS (SELECT o_orderpriority AS "column", sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1)
       SELECT 0 AS place, 'year' AS "column" UNION ALL
       SELECT CAST(row_number() OVER (ORDER BY v) AS INTEGER), "column" FROM s""",
)
def ordered_columns(t: Tables):
    by_year = (
        t.orders.groupBy(F.year("o_orderdate").alias("year"))
        .pivot("o_orderpriority", _PRIORITIES)
        .agg(F.round(F.sum("o_totalprice"), 2))
    )
    ordered = clean.columns_by_row(by_year, F.col("year") == 1997, _PRIORITIES)
    names = F.array(*[F.lit(c) for c in ordered.columns])
    return ordered.limit(1).select(F.posexplode(names).alias("place", "column"))


@query(
    "prj_cast",
    """SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_orderkey AS VARCHAR) AS label,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
              TRY_CAST(o_orderstatus AS INTEGER) AS bad FROM orders""",
)
def cast(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("bigint").alias("whole"),
        F.col("o_orderkey").cast("string").alias("label"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderstatus").try_cast("int").alias("bad"),
    )


@query("prj_clean_money", "SELECT o_orderkey, o_totalprice AS amount FROM orders")
def clean_money(t: Tables):
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t.orders.select("o_orderkey", clean.money(text).alias("amount"))


@query(
    "prj_fillna",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status,
              coalesce(CASE WHEN o_totalprice > 100000 THEN o_totalprice END, 0.0) AS price FROM orders""",
)
def fill(t: Tables):
    gaps = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
    )
    return gaps.na.fill({"status": "none", "price": 0.0})


@query(
    "prj_dropna",
    """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders
       WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
)
def drop_nulls(t: Tables):
    gaps = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return gaps.na.drop(how="any", subset=["status", "priority"])


@query(
    "prj_mask",
    """SELECT p_partkey, CASE WHEN p_size >= 25 THEN p_size END AS p_size,
              CASE WHEN p_retailprice < 1000 THEN p_retailprice END AS p_retailprice FROM part""",
)
def mask(t: Tables):
    cells = t.part.select("p_partkey", "p_size", "p_retailprice")
    return clean.keep_cells(cells, {"p_size": F.col("p_size") >= 25, "p_retailprice": F.col("p_retailprice") < 1000})


@query(
    "prj_band",
    """SELECT o_orderkey, y AS year, CASE
         WHEN y BETWEEN 1901 AND 1924 THEN 'Greatest Generation (GI)' WHEN y BETWEEN 1928 AND 1945 THEN 'Silent Generation'
         WHEN y BETWEEN 1946 AND 1964 THEN 'Baby Boomer Generation' WHEN y BETWEEN 1965 AND 1980 THEN 'Generation X'
         WHEN y BETWEEN 1981 AND 1996 THEN 'Millennial' WHEN y BETWEEN 1997 AND 2010 THEN 'Generation Z'
         WHEN y >= 2010 THEN 'Generation Alpha' ELSE 'not recognized' END AS generation
       FROM (SELECT o_orderkey, 1890 + o_orderkey % 140 AS y FROM orders)""",
)
def generations(t: Tables):
    years = t.orders.select("o_orderkey", (1890 + F.col("o_orderkey") % 140).alias("year"))
    return years.withColumn("generation", clean.generation(F.col("year")))


@query(
    "prj_band_price",
    """SELECT p_partkey, CASE WHEN 40 + p_partkey % 40 >= 60 THEN
         (CASE WHEN p_size < 12 THEN 5 WHEN p_size <= 18 THEN 7 ELSE 12 END)
         + (CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 0 END) END AS bill FROM part""",
)
def ride_prices(t: Tables):
    key = F.col("p_partkey")
    photo = F.when(key % 2 == 0, "Y").otherwise("N")
    return t.part.select("p_partkey", clean.ride_price(40 + key % 40, F.col("p_size"), photo).alias("bill"))


@query(
    "prj_decade",
    """SELECT CAST(y // 10 * 10 AS INTEGER) AS decade, y // 10 * 10 <= 1960 AS old, count(*) AS films
       FROM (SELECT 1900 + o_orderkey % 110 AS y FROM orders) GROUP BY ALL""",
)
def decades(t: Tables):
    years = t.orders.select(clean.decade(1900 + F.col("o_orderkey") % 110).alias("decade"))
    return years.groupBy("decade", (F.col("decade") <= 1960).alias("old")).agg(F.count("*").alias("films"))
