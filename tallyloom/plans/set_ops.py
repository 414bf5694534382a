"""Set operations."""

from pyspark.sql import functions as F

from tallyloom.operators.joins import keep_missing
from tallyloom.operators.sets import bag_difference, compare
from tallyloom.plans.registry import Tables, query


@query(
    "set_union_all",
    """SELECT n_name AS name, n_nationkey AS key FROM nation UNION ALL SELECT r_name, r_regionkey FROM region
       UNION ALL SELECT s_name, CAST(s_suppkey AS INTEGER) FROM supplier""",
)
def appended(t: Tables):
    nations = t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"))
    regions = t.region.select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("int").alias("key"))
    return nations.unionByName(regions).unionByName(suppliers)


@query(
    "set_hconcat",
    """SELECT vec_id, i - 1 AS place, (embedding || list_reverse(embedding))[i] AS value
       FROM embeddings, range(1, 129) AS r(i)""",
)
def widened(t: Tables):
    rows = t.embeddings.select("vec_id", F.posexplode(F.concat("embedding", F.reverse("embedding"))).alias("p", "value"))
    return rows.select("vec_id", F.col("p").cast("bigint").alias("place"), "value")


@query(
    "set_except_all",
    """SELECT l_partkey AS card FROM lineitem EXCEPT ALL SELECT p_partkey FROM part WHERE p_size > 10""",
)
def one_copy_removed(t: Tables):
    deck = t.lineitem.select(F.col("l_partkey").alias("card"))
    known = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("card"))
    return bag_difference(deck, known)


@query(
    "set_except",
    """SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000""",
)
def not_guessed(t: Tables):
    guessed = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return keep_missing(t.customer.select("c_custkey"), guessed, ["c_custkey"]).distinct()


@query("set_distinct", "SELECT DISTINCT p_size * p_size AS square, p_brand FROM part")
def distinct(t: Tables):
    return t.part.select((F.col("p_size") * F.col("p_size")).alias("square"), "p_brand").distinct()


@query(
    "set_distinct_array",
    """SELECT doc_id, CAST(len(list_distinct(string_split(text, ' '))) AS INTEGER) AS words FROM documents""",
)
def distinct_in_arrays(t: Tables):
    return t.documents.select("doc_id", F.size(F.array_distinct(F.split("text", " "))).alias("words"))


@query(
    "set_equal",
    """WITH w AS (SELECT p_partkey, list_sort(list_distinct(string_split(p_name, ' '))) AS a,
                        list_sort(list_distinct([split_part(p_name, ' ', 2), split_part(p_name, ' ', 1)])) AS b,
                        string_split(p_type, '') AS letters FROM part)
       SELECT p_partkey, a = b AS same_set, len(list_distinct(letters)) = len(letters) AS no_repeats FROM w""",
)
def equal_sets(t: Tables):
    words = F.split("p_name", " ")
    letters = F.filter(F.split("p_type", ""), lambda c: c != "")

    def as_set(a):
        return F.sort_array(F.array_distinct(a))

    return t.part.select(
        "p_partkey",
        (as_set(words) == as_set(F.array(F.get(words, F.lit(1)), F.get(words, F.lit(0))))).alias("same_set"),
        (F.size(F.array_distinct(letters)) == F.size(letters)).alias("no_repeats"),
    )


@query(
    "set_equal_tables",
    """WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), o AS (SELECT o_orderkey AS k FROM orders),
            c AS (SELECT o_custkey AS k FROM orders)
       SELECT 'orders with and of lines' AS pair, (SELECT count(*) FROM ((FROM l EXCEPT FROM o) UNION ALL (FROM o EXCEPT FROM l))) = 0 AS same_set,
              (SELECT count(*) FROM ((FROM (SELECT l_orderkey FROM lineitem) EXCEPT ALL FROM o) UNION ALL (FROM o EXCEPT ALL FROM (SELECT l_orderkey FROM lineitem)))) = 0 AS same_rows,
              (SELECT count(*) = count(DISTINCT k) FROM o) AS no_repeats
       UNION ALL
       SELECT 'customers of orders', (SELECT count(*) FROM ((FROM c EXCEPT SELECT c_custkey FROM customer) UNION ALL (SELECT c_custkey FROM customer EXCEPT FROM c))) = 0,
              (SELECT count(*) FROM c) = (SELECT count(*) FROM customer) AND (SELECT count(*) FROM (FROM c EXCEPT ALL SELECT c_custkey FROM customer)) = 0,
              (SELECT count(*) = count(DISTINCT k) FROM c)
       UNION ALL
       SELECT 'lines twice over', true, true, (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)) = 0""",
)
def equal_tables(t: Tables):
    o = t.orders.select(F.col("o_orderkey").alias("k"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    pairs = {
        "orders with and of lines": (o, t.lineitem.select(F.col("l_orderkey").alias("k"))),
        "customers of orders": (t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))),
        "lines twice over": (lines, lines.repartition("l_partkey")),
    }
    rows = [(name, *compare(a, b)) for name, (a, b) in pairs.items()]
    return t.spark.createDataFrame(rows, "pair string, same_set boolean, same_rows boolean, no_repeats boolean")
