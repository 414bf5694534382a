"""Functions applied to columns, cells, rows and groups."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.operators.apply import apply_with_state, reduce_groups
from tallyloom.operators.clean import apply_columns
from tallyloom.plans.registry import Tables, query


@query(
    "udf_apply_cols",
    "SELECT l_orderkey, round((l_quantity + 1 + 2) * 10, 4) AS l_quantity, round((l_tax + 1 + 2) * 10, 4) AS l_tax FROM lineitem",
)
def over_columns(t: Tables):
    def scaled(c, y, z, m):
        return F.round((c + y + z) * m, 4)

    return apply_columns(t.lineitem.select("l_orderkey", "l_quantity", "l_tax"), ["l_quantity", "l_tax"], scaled, 1, 2, m=10)


@query(
    "udf_applymap",
    "SELECT upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type FROM part",
)
def over_cells(t: Tables):
    cells = t.part.select("p_name", "p_brand", "p_type")
    return apply_columns(cells, cells.columns, F.upper)


@query("udf_lambda", "SELECT p_partkey, length(p_name) >= 9 AS long_name FROM part")
def over_one_column(t: Tables):
    def long_enough(c):
        return F.length(c) >= 9

    return t.part.select("p_partkey", long_enough(F.col("p_name")).alias("long_name"))


@query(
    "udf_group",
    """SELECT p_brand, p_partkey, p_retailprice FROM part
       QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 2""",
)
def over_groups(t: Tables):
    def two_largest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["p_retailprice", "p_partkey"], ascending=[False, True]).head(2)

    rows = t.part.select("p_brand", "p_partkey", "p_retailprice")
    return reduce_groups(rows, ["p_brand"], two_largest, "p_brand string, p_partkey bigint, p_retailprice double")


@query(
    "udf_group_any",
    # whole cents, so that neither side's mean depends on the order of the rows
    """SELECT p_brand, p_partkey, round((cents * count(*) OVER g - sum(cents) OVER g) / (100.0 * count(*) OVER g)::DOUBLE, 6) AS above_mean
       FROM (SELECT p_brand, p_partkey, round(p_retailprice * 100) AS cents FROM part) WINDOW g AS (PARTITION BY p_brand)""",
)
def over_whole_groups(t: Tables):
    def totals(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(rows)], "total": [int((rows["p_retailprice"] * 100).round().astype("int64").sum())]})

    def added(states: pd.DataFrame) -> pd.DataFrame:
        return states[["n", "total"]].sum().to_frame().T

    def centred(rows: pd.DataFrame) -> pd.DataFrame:
        cents = (rows["p_retailprice"] * 100).round()
        above = (cents * rows["n"] - rows["total"]) / (100.0 * rows["n"])
        # halves away from zero, as SQL rounds them
        rounded = np.sign(above) * np.floor(above.abs() * 1e6 + 0.5) / 1e6
        return rows.assign(above_mean=rounded)[["p_brand", "p_partkey", "above_mean"]]

    rows = t.part.select("p_brand", "p_partkey", "p_retailprice")
    return apply_with_state(
        rows, ["p_brand"], totals, added, "n bigint, total bigint", centred, "p_brand string, p_partkey bigint, above_mean double"
    )


@query(
    "udf_row",
    """SELECT c_custkey,
              regexp_full_match(e, '[\\pL\\pN_.\\-]+@[\\pL\\pN_.\\-]+\\.[\\pL\\pN_]+') AS valid
       FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || '@shop.com' WHEN 1 THEN lower(c_mktsegment) || '@shop.com'
                    ELSE lower(c_mktsegment) || '@shop' END AS e FROM customer)""",
)
def over_rows(t: Tables):
    segment, key = F.lower("c_mktsegment"), F.col("c_custkey")
    address = (
        F.when(key % 3 == 0, F.concat("c_name", F.lit("@shop.com")))
        .when(key % 3 == 1, F.concat(segment, F.lit("@shop.com")))
        .otherwise(F.concat(segment, F.lit("@shop")))
    )
    rows = t.customer.select("c_custkey", address.alias("e"))
    return rows.select("c_custkey", text.is_email(F.col("e")).alias("valid"))
