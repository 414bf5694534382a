"""Maths, arrays, matrices, maps and JSON."""

from pyspark.sql import functions as F

from tallyloom.functions import arrays, maps, randomness
from tallyloom.operators import matrix
from tallyloom.plans.registry import Tables, query


def _doubles():
    return F.transform("embedding", lambda x: x.cast("double"))


_AS_DOUBLES = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


@query(
    "mth_functions",
    """SELECT p_partkey, round(sqrt(p_retailprice), 8) AS root, CAST(factorial(CAST(p_size % 20 AS INTEGER)) AS BIGINT) AS factorial,
              round(log10(p_retailprice), 8) AS log, CAST(floor(p_retailprice) AS BIGINT) AS floor,
              CAST(ceil(p_retailprice) AS BIGINT) AS ceiling, round_even(p_size / 2.0, 0) AS half_even,
              abs(p_size - 25) AS distance, pow(p_size, 2) AS square FROM part""",
)
def functions(t: Tables):
    price, size = F.col("p_retailprice"), F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.round(F.sqrt(price), 8).alias("root"),
        F.factorial(size % 20).alias("factorial"),
        F.round(F.log10(price), 8).alias("log"),
        F.floor(price).alias("floor"),
        F.ceil(price).alias("ceiling"),
        F.bround(size / 2, 0).alias("half_even"),
        F.abs(size - 25).alias("distance"),
        F.pow(size, F.lit(2)).alias("square"),
    )


@query(
    "mth_random",
    """WITH u AS (SELECT c_custkey AS k,
              CAST('0x' || substr(md5('1|' || c_custkey), 1, 13) AS BIGINT) / 4503599627370496.0 AS a,
              CAST('0x' || substr(md5('2|' || c_custkey), 1, 13) AS BIGINT) / 4503599627370496.0 AS b,
              CAST('0x' || substr(md5('3|' || c_custkey), 1, 13) AS BIGINT) / 4503599627370496.0 AS c FROM customer)
       SELECT k AS c_custkey, round(10 + a * 40, 8) AS uniform, CAST(floor(10 + b * 10) AS INTEGER) AS whole,
              ['red', 'green', 'blue'][CAST(floor(c * 3) AS INTEGER) + 1] AS colour,
              array_to_string(list_transform(list_sort(list_transform([0, 1, 2, 3],
                  lambda i: md5('4|' || k || '|' || i) || ['a', 'b', 'c', 'd'][i + 1]))[1:2], lambda s: right(s, 1)), '') AS hand
       FROM u""",
)
def random_values(t: Tables):
    key = F.col("c_custkey")
    hand = randomness.choices_without_replacement(["a", "b", "c", "d"], key, 4, 2)
    return t.customer.select(
        "c_custkey",
        F.round(randomness.uniform(key, 1, 10, 50), 8).alias("uniform"),
        randomness.uniform_int(key, 2, 10, 20).alias("whole"),
        randomness.choice(["red", "green", "blue"], key, 3).alias("colour"),
        F.array_join(hand, "").alias("hand"),
    )


@query(
    "arr_elementwise",
    f"""SELECT vec_id, i - 1 AS place, e[i] + 1 AS plus, e[i] * 2 AS twice, round(e[i] / 3, 12) AS third,
               round(e[i] * e[i], 12) AS square FROM (SELECT vec_id, {_AS_DOUBLES} AS e FROM embeddings), range(1, 65) AS r(i)""",
)
def elementwise(t: Tables):
    e = F.col("e")
    results = F.arrays_zip(
        arrays.with_scalar(e, lambda x, s: x + s, 1).alias("plus"),
        arrays.with_scalar(e, lambda x, s: x * s, 2).alias("twice"),
        arrays.with_scalar(e, lambda x, s: x / s, 3).alias("third"),
        arrays.pairwise(e, e, lambda x, y: x * y).alias("square"),
    )
    rows = t.embeddings.select("vec_id", _doubles().alias("e")).select("vec_id", F.posexplode(results).alias("p", "v"))
    return rows.select(
        "vec_id",
        F.col("p").cast("bigint").alias("place"),
        "v.plus",
        "v.twice",
        F.round("v.third", 12).alias("third"),
        F.round("v.square", 12).alias("square"),
    )


@query(
    "arr_index",
    """SELECT vec_id, embedding[3] AS third, embedding[-1] AS last, CAST(len(embedding) AS INTEGER) AS size,
              list_reverse(embedding)[2] AS second_last, embedding[-3:][1] AS of_last_three,
              embedding[1:64:2][10] AS every_second FROM embeddings""",
)
def indexed(t: Tables):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id",
        F.element_at(e, 3).alias("third"),
        F.element_at(e, -1).alias("last"),
        F.size(e).alias("size"),
        F.element_at(F.reverse(e), 2).alias("second_last"),
        F.element_at(arrays.last(e, 3), 1).alias("of_last_three"),
        F.element_at(arrays.every_nth(e, 2), 10).alias("every_second"),
    )


@query(
    "arr_matmul",
    """WITH a AS (SELECT vec_id AS i, r.k, CAST(embedding[r.k + 1] AS DOUBLE) AS v, label FROM embeddings, range(0, 64) AS r(k)),
            b AS (SELECT k, label AS j, round(avg(v), 9) AS v FROM a GROUP BY 1, 2)
       SELECT a.i, b.j, round(sum(a.v * b.v), 6) AS v FROM a JOIN b ON a.k = b.k GROUP BY 1, 2""",
)
def vectors_by_class_means(t: Tables):
    vectors = t.embeddings.select("vec_id", "label", _doubles().alias("e"))
    left = matrix.matrix_cells(vectors, "vec_id", "e")
    means = (
        vectors.select("label", F.posexplode("e").alias("i", "x"))
        .groupBy("i", F.col("label").alias("j"))
        .agg(F.round(F.avg("x"), 9).alias("v"))
    )
    return matrix.matrix_product(left, means).select("i", "j", F.round("v", 6).alias("v"))


@query(
    "arr_matmul_tiles",
    """WITH a AS (SELECT vec_id AS i, r.k, CAST(embedding[r.k + 1] AS DOUBLE) AS v, label FROM embeddings, range(0, 64) AS r(k)),
            b AS (SELECT k, label AS j, round(avg(v), 9) AS v FROM a GROUP BY 1, 2)
       SELECT a.i, b.j, round(sum(a.v * b.v), 6) AS v FROM a JOIN b ON a.k = b.k GROUP BY 1, 2""",
)
def vectors_by_class_means_in_tiles(t: Tables):
    vectors = t.embeddings.select("vec_id", "label", _doubles().alias("e"))
    means = (
        vectors.select("label", F.posexplode("e").alias("i", "x"))
        .groupBy("i", F.col("label").alias("j"))
        .agg(F.round(F.avg("x"), 9).alias("v"))
    )
    product = matrix.tile_product(matrix.row_tiles(vectors, "vec_id", "e", width=16), matrix.cell_tiles(means, 16, 16), 16)
    return product.select("i", "j", F.round("v", 6).alias("v"))


@query(
    "arr_weighted",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x, i:
                CAST(x AS DOUBLE) * CASE i % 3 WHEN 1 THEN 0.2126 WHEN 2 THEN 0.7152 ELSE 0.0722 END)), 9) AS grey
       FROM embeddings""",
)
def weighted(t: Tables):
    # The weights of red, green and blue in a grey level.
    weights = [0.2126, 0.7152, 0.0722]
    channel = F.array(*[F.lit(w) for w in weights])
    weighed = F.transform(_doubles(), lambda x, i: x * F.get(channel, i % 3))
    grey = F.aggregate(weighed, F.lit(0.0), lambda total, x: total + x)
    return t.embeddings.select("vec_id", F.round(grey, 9).alias("grey"))


@query(
    "arr_transform",
    f"""SELECT vec_id, round(list_sum(list_transform({_AS_DOUBLES}, lambda x: x * x)), 8) AS squares,
               round(coalesce(list_sum(list_filter({_AS_DOUBLES}, lambda x: x > 0)), 0), 8) AS positives FROM embeddings""",
)
def transformed(t: Tables):
    def added(a):
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)

    e = F.col("e")
    return t.embeddings.select("vec_id", _doubles().alias("e")).select(
        "vec_id",
        F.round(added(F.transform(e, lambda x: x * x)), 8).alias("squares"),
        F.round(added(F.filter(e, lambda x: x > 0)), 8).alias("positives"),
    )


@query(
    "arr_edit",
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS a FROM part)
       SELECT p_partkey, array_to_string(list_append(a, 'end'), ' ') AS appended,
              array_to_string(list_filter(a, lambda x: x <> 'ring'), ' ') AS removed,
              array_to_string(a[1:1], ' ') AS popped, coalesce(CAST(list_position(a, 'bolt') AS BIGINT), 0) AS at,
              CAST(len(list_filter(a, lambda x: x = 'red')) AS INTEGER) AS reds,
              array_to_string(list_reverse(a), ' ') AS reversed, array_to_string(a || ['x', 'y'], ' ') AS extended FROM w""",
)
def edited(t: Tables):
    a = F.split("p_name", " ")
    results = {
        "appended": F.array_append(a, F.lit("end")),
        "removed": F.array_remove(a, "ring"),
        "popped": F.slice(a, F.lit(1), F.size(a) - 1),
        "reversed": F.reverse(a),
        "extended": F.concat(a, F.array(F.lit("x"), F.lit("y"))),
    }
    return t.part.select(
        "p_partkey",
        *[F.array_join(v, " ").alias(k) for k, v in results.items()],
        F.array_position(a, "bolt").alias("at"),
        F.size(F.filter(a, lambda x: x == "red")).alias("reds"),
    )


@query(
    "map_build",
    """SELECT p_partkey, p_size AS size, p_size * 2 AS doubled, 100 AS discount,
              CASE WHEN p_retailprice > 1000 THEN 1 ELSE 0 END AS dear_entries, -1 AS missing FROM part""",
)
def built_maps(t: Tables):
    m = arrays.zip_to_map(
        F.array(F.lit("size"), F.lit("discount")), F.array(F.col("p_size"), F.lit(5))
    )
    m = maps.merged(m, F.create_map(F.lit("discount"), F.lit(100)))
    prices = F.create_map(F.lit("price"), F.col("p_retailprice"))
    return t.part.select(
        "p_partkey",
        F.element_at(m, F.lit("size")).alias("size"),
        F.element_at(F.transform_values(m, lambda k, v: v * 2), F.lit("size")).alias("doubled"),
        F.element_at(m, F.lit("discount")).alias("discount"),
        F.size(F.map_filter(prices, lambda k, v: v > 1000)).alias("dear_entries"),
        maps.value_or(m, F.lit("colour"), F.lit(-1)).alias("missing"),
    )


@query(
    "map_explode",
    """SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
       UNION ALL SELECT event_id, 'type', event_type FROM events""",
)
def exploded_maps(t: Tables):
    props = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("type"), F.col("event_type")))
    return t.events.select("event_id", F.explode(props))


@query(
    "jsn_parse",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS nested, event_type AS second_item, 3 AS items FROM events""",
)
def parsed_json(t: Tables):
    nested = F.concat(F.lit('{"outer": {"inner": '), "props", F.lit("}}"))
    mixed = F.concat(F.lit('[1, "'), "event_type", F.lit('", true]'))
    items = maps.json_items(mixed)
    return t.events.select(
        "event_id",
        maps.json_record(F.col("props"), "k int")["k"].alias("k"),
        F.get_json_object(nested, "$.outer.inner.k").cast("int").alias("nested"),
        F.element_at(items, 2).alias("second_item"),
        F.size(items).alias("items"),
    )


_MIXED = """('{"kind": "' || event_type || '", "props": ' || props || ', "value": ' || CASE WHEN event_id % 4 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END
          || ', "flags": [true, ' || event_id || ', "x", {"deep": false}, 1.5]' || CASE WHEN event_id % 3 = 0 THEN ', "more": []}' ELSE '}' END)"""


@query(
    "jsn_variant",
    f"""SELECT event_id, json_extract_string(j, '$.kind') AS kind, CAST(json_extract_string(j, '$.props.k') AS BIGINT) AS k,
               CASE WHEN event_id % 4 = 0 THEN 'null' ELSE 'number' END AS value_kind, value_read,
               true AS flag, event_id AS number, 'x' AS word, false AS deep, 'record' AS fourth, 'number' AS fifth,
               CASE WHEN event_id % 3 = 0 THEN 'list' END AS more, CAST(NULL AS BIGINT) AS text_as_number
        FROM (SELECT event_id, {_MIXED} AS j, CASE WHEN event_id % 4 <> 0 THEN value END AS value_read FROM events)""",
)
def variants(t: Tables):
    value = F.when(F.col("event_id") % 4 == 0, "null").otherwise(F.col("value").cast("string"))
    flags = F.concat(F.lit(', "flags": [true, '), "event_id", F.lit(', "x", {"deep": false}, 1.5]'))
    end = F.when(F.col("event_id") % 3 == 0, ', "more": []}').otherwise("}")
    written = F.concat(F.lit('{"kind": "'), "event_type", F.lit('", "props": '), "props", F.lit(', "value": '), value, flags, end)
    v = F.col("v")
    kind = F.when(maps.json_kind(v, "$.value") == "whole", "number").otherwise(maps.json_kind(v, "$.value"))
    return t.events.select("event_id", maps.json_value(written).alias("v")).select(
        "event_id",
        maps.json_at(v, "$.kind", "string").alias("kind"),
        maps.json_at(v, "$.props.k", "bigint").alias("k"),
        kind.alias("value_kind"),
        maps.json_at(v, "$.value", "double").alias("value_read"),
        maps.json_at(v, "$.flags[0]", "boolean").alias("flag"),
        maps.json_at(v, "$.flags[1]", "bigint").alias("number"),
        maps.json_at(v, "$.flags[2]", "string").alias("word"),
        maps.json_at(v, "$.flags[3].deep", "boolean").alias("deep"),
        maps.json_kind(v, "$.flags[3]").alias("fourth"),
        maps.json_kind(v, "$.flags[4]").alias("fifth"),
        maps.json_kind(v, "$.more").alias("more"),
        maps.json_at(v, "$.kind", "bigint").alias("text_as_number"),
    )


@query(
    "jsn_members",
    """SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS BIGINT) AS whole FROM
         (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""",
)
def members(t: Tables):
    """The members of records whose keys are not known beforehand."""
    return maps.json_members(t.events.select("event_id", maps.json_value(F.col("props")).alias("v")), "v").select(
        "event_id", "key", maps.json_at(F.col("value"), "$", "bigint").alias("whole")
    )


@query(
    "jsn_write",
    "SELECT event_id, CAST(json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type) AS VARCHAR) AS text FROM events",
)
def written_json(t: Tables):
    return t.events.select("event_id", maps.json_text(F.struct("event_id", "user_id", "event_type")).alias("text"))
