"""Joins."""

from pyspark.sql import functions as F

from tallyloom.functions.arrays import zip_rows
from tallyloom.operators import intervals, joins
from tallyloom.plans.registry import Tables, query


@query(
    "jon_inner",
    """WITH kinds AS (SELECT p_type, count(*) AS parts FROM part GROUP BY 1),
            sales AS (SELECT p_type, count(*) AS lines, sum(l_quantity) AS quantity,
                             round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
                      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
       SELECT p_type, parts, lines, quantity, revenue FROM kinds JOIN sales USING (p_type) ORDER BY revenue DESC""",
)
def revenue_by_type(t: Tables):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    # lines are summed per part before they meet the part table: the join then
    # moves one row per part, whatever the number of lines
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum(revenue).alias("revenue")
    )
    sales = (
        per_part.join(t.part.select("p_partkey", "p_type"), "p_partkey")
        .groupBy("p_type")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.round(F.sum("revenue"), 2).alias("revenue"),
        )
    )
    kinds = t.part.groupBy("p_type").agg(F.count("*").alias("parts"))
    return kinds.join(sales, "p_type").orderBy(F.desc("revenue"))


@query(
    "jon_align",
    """SELECT coalesce(a.label, b.label) AS label, balance, orders FROM
         (SELECT c_custkey AS label, c_acctbal AS balance FROM customer WHERE c_mktsegment <> 'BUILDING') a
         FULL JOIN (SELECT o_custkey AS label, count(*) AS orders FROM orders
                    WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b ON a.label = b.label""",
)
def side_by_side(t: Tables):
    balances = t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("label"), F.col("c_acctbal").alias("balance")
    )
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    counts = urgent.groupBy(F.col("o_custkey").alias("label")).agg(F.count("*").alias("orders"))
    return joins.aligned(balances, counts, "label")


@query(
    "jon_align_assign",
    """SELECT c_custkey AS label, c_name, spent FROM customer LEFT JOIN
         (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
         ON c_custkey = o_custkey""",
)
def assigned(t: Tables):
    names = t.customer.select(F.col("c_custkey").alias("label"), "c_name")
    partial = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("label"))
    return joins.aligned(names, partial.agg(F.round(F.sum("o_totalprice"), 2).alias("spent")), "label", "left")


@query(
    "jon_semi",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)""",
)
def present(t: Tables):
    dear = t.orders.filter("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_present(t.customer.select("c_custkey", "c_name"), dear, ["c_custkey"])


@query(
    "jon_anti",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def missing(t: Tables):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_missing(t.customer.select("c_custkey", "c_name"), urgent, ["c_custkey"])


@query(
    "jon_fk",
    """SELECT o_orderkey, c_name, o_totalprice, l_linenumber, l_extendedprice
       FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def posts_with_comments(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice")
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joins.with_children(placed.select("o_orderkey", "c_name", "o_totalprice"), lines, ["o_orderkey"])


_CODES = ", ".join(f"'{k}': '{v}'" for k, v in joins.PHONETIC_ALPHABET.items())


@query(
    "jon_lookup",
    f"""WITH w AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_brand END AS word FROM part),
             c AS (SELECT p_partkey, word, list_transform(string_split(upper(word), ''),
                          lambda ch: MAP {{{_CODES}}}[ch]) AS codes FROM w)
        SELECT p_partkey, word, CASE WHEN len(list_filter(codes, lambda x: x IS NULL)) = 0
               THEN array_to_string(codes, ' ') END AS spelled FROM c""",
)
def spelled_words(t: Tables):
    word = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.col("p_brand"))
    spelled = F.array_join(joins.lookup_letters(F.col("word"), joins.PHONETIC_ALPHABET), " ")
    return t.part.select("p_partkey", word.alias("word")).withColumn("spelled", spelled)


@query(
    "jon_month_day",
    """SELECT o_orderkey, o_custkey FROM orders WHERE month(o_orderdate) = 8 AND day(o_orderdate) = 25
       ORDER BY o_orderkey DESC LIMIT 1""",
)
def birthday(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.last_on_day(orders, "o_orderdate", 8, 25, F.col("o_orderkey")).drop("o_orderdate")


@query(
    "jon_zip",
    """SELECT p_partkey, w.i AS place, string_split(p_name, ' ')[w.i] AS word,
              length(string_split(p_name, ' ')[w.i]) AS letters
       FROM part, range(1, 3) AS w(i)""",
)
def zipped(t: Tables):
    words = F.split("p_name", " ")
    pairs = zip_rows(words.alias("word"), F.transform(words, F.length).alias("letters"))
    rows = t.part.select("p_partkey", F.posexplode(pairs).alias("at", "pair"))
    return rows.select(
        "p_partkey",
        (F.col("at") + 1).cast("bigint").alias("place"),
        F.col("pair.word").alias("word"),
        F.col("pair.letters").cast("bigint").alias("letters"),
    )


@query(
    "jon_cross",
    """SELECT s_suppkey AS i, CAST(j AS INTEGER) AS j, s_suppkey * j AS product
       FROM supplier, range(1, 13) AS r(j)""",
)
def multiplication_table(t: Tables):
    pairs = joins.with_each(t.supplier.select(F.col("s_suppkey").alias("i")), range(1, 13), "j")
    return pairs.withColumn("product", F.col("i") * F.col("j"))


_PRICE_BANDS = [(0.0, 100000.0, "low"), (100000.0, 250000.0, "middle"), (250000.0, 400000.0, "high")]


@query(
    "jon_band",
    """SELECT o_orderkey, o_totalprice,
              (SELECT first(b.name ORDER BY b.i) FROM (VALUES (1, 0.0, 100000.0, 'low'), (2, 100000.0, 250000.0, 'middle'),
                       (3, 250000.0, 400000.0, 'high')) AS b(i, lo, hi, name)
               WHERE o_totalprice BETWEEN b.lo AND b.hi) AS band FROM orders""",
)
def banded(t: Tables):
    band = joins.band_of(F.col("o_totalprice"), _PRICE_BANDS)
    return t.orders.select("o_orderkey", "o_totalprice", band.alias("band"))


# bands of all widths: overlapping, inside each other, of one point, upside down, and open at either end
_BANDS = """SELECT s_suppkey AS i, s_name AS name,
                   CASE WHEN s_suppkey % 50 = 1 THEN NULL ELSE s_acctbal END AS lo,
                   CASE WHEN s_suppkey % 50 = 2 THEN NULL WHEN s_suppkey % 3 = 0 THEN s_acctbal + s_suppkey % 40 * 5
                        WHEN s_suppkey % 11 = 0 THEN s_acctbal - 1 ELSE s_acctbal + 0.25 END AS hi FROM supplier"""


@query(
    "jon_band_table",
    f"""SELECT o_orderkey, o_totalprice, name AS band FROM orders LEFT JOIN
          (SELECT o_orderkey, arg_min(name, i) AS name FROM orders JOIN ({_BANDS})
           ON (lo IS NULL OR o_totalprice / 50 >= lo) AND (hi IS NULL OR o_totalprice / 50 <= hi) GROUP BY o_orderkey) USING (o_orderkey)""",
)
def banded_by_table(t: Tables):
    k, balance = F.col("s_suppkey"), F.col("s_acctbal")
    high = F.when(k % 50 == 2, F.lit(None)).when(k % 3 == 0, balance + k % 40 * 5).when(k % 11 == 0, balance - 1).otherwise(balance + 0.25)
    bands = t.supplier.select(k.alias("i"), F.col("s_name").alias("name"), F.when(k % 50 != 1, balance).alias("lo"), high.alias("hi"))
    prices = t.orders.select("o_orderkey", "o_totalprice", (F.col("o_totalprice") / 50).alias("x"))
    return intervals.first_bands(prices, "x", bands, "lo", "hi", "i", "name", "band").drop("x")
