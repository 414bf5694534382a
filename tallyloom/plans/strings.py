"""Strings and regular expressions."""

from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.plans.registry import Tables, query

_WORD = r"th[a-z]n"


@query("str_replace", "SELECT doc_id, md5(replace(replace(text, 'the', 'THE'), '$', '')) AS digest FROM documents")
def replaced(t: Tables):
    changed = F.replace(F.replace("text", F.lit("the"), F.lit("THE")), F.lit("$"), F.lit(""))
    return t.documents.select("doc_id", F.md5(changed.cast("binary")).alias("digest"))


@query(
    "str_case",
    """SELECT doc_id, md5(replace(upper(text), 'ẞ', 'SS')) AS upper, md5(lower(text)) AS lower,
              md5(replace(array_to_string(list_transform(regexp_extract_all(text, '(\\pL+|[^\\pL]+)'),
                  lambda r: upper(left(r, 1)) || lower(substr(r, 2))), ''), 'ẞ', 'Ss')) AS title FROM documents""",
)
def cases(t: Tables):
    return t.documents.select(
        "doc_id",
        F.md5(F.upper("text").cast("binary")).alias("upper"),
        F.md5(F.lower("text").cast("binary")).alias("lower"),
        F.md5(text.title_case(F.col("text")).cast("binary")).alias("title"),
    )


@query(
    "str_length",
    """SELECT doc_id, CAST(length(text) AS INTEGER) AS characters, CAST(strlen(text) AS INTEGER) AS bytes FROM documents""",
)
def lengths(t: Tables):
    return t.documents.select("doc_id", F.length("text").alias("characters"), F.octet_length("text").alias("bytes"))


@query(
    "str_split_join",
    """SELECT doc_id, md5(regexp_replace(text, '\\s+', ' ', 'g')) AS digest,
              CAST(len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS INTEGER) AS words,
              len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) = 2 AS two_words FROM documents""",
)
def split_and_joined(t: Tables):
    n = F.size(text.words(F.col("text")))
    return t.documents.select(
        "doc_id",
        F.md5(text.single_spaced(F.col("text")).cast("binary")).alias("digest"),
        n.alias("words"),
        (n == 2).alias("two_words"),
    )


@query(
    "str_slice",
    """SELECT c_custkey, substr(a, len(a) - 7, 2) AS state
       FROM (SELECT c_custkey, c_name || ', ' || left(c_mktsegment, 2) || ' ' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS a
             FROM customer)""",
)
def sliced(t: Tables):
    address = F.concat(
        "c_name",
        F.lit(", "),
        F.substring("c_mktsegment", 1, 2),
        F.lit(" "),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"),
    )
    return t.customer.select("c_custkey", text.from_end(address, 8, 6).alias("state"))


def _count_sql(column: str, letters: str) -> str:
    return " + ".join(f"length({column}) - length(replace({column}, '{ch}', ''))" for ch in letters)


@query(
    "str_count",
    f"""SELECT doc_id, CAST(CAST({_count_sql('c', 'true')} AS VARCHAR) || CAST({_count_sql('c', 'love')} AS VARCHAR) AS BIGINT)
          AS score FROM (SELECT doc_id, lower(source || text) AS c FROM documents)""",
)
def letter_scores(t: Tables):
    return t.documents.select("doc_id", text.pair_score(F.col("source"), F.col("text")).alias("score"))


@query(
    "str_acronym",
    """SELECT doc_id, md5(replace(array_to_string(list_transform(
         list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''), lambda w: upper(left(w, 1))), ''), 'ẞ', 'SS')) AS digest
       FROM documents""",
)
def acronyms(t: Tables):
    return t.documents.select("doc_id", F.md5(text.acronym(F.col("text")).cast("binary")).alias("digest"))


@query(
    "str_format",
    """SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price, lpad(CAST(o_orderkey AS VARCHAR), 8, ' ') AS padded,
              printf('Order %d of customer %d: %s', o_orderkey, o_custkey, o_orderstatus) AS line FROM orders""",
)
def formatted(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.format_number("o_totalprice", 2).alias("price"),
        F.lpad(F.col("o_orderkey").cast("string"), 8, " ").alias("padded"),
        F.format_string("Order %d of customer %d: %s", "o_orderkey", "o_custkey", "o_orderstatus").alias("line"),
    )


@query(
    "str_regex",
    f"""SELECT doc_id, regexp_matches(text, '{_WORD}') AS found, regexp_extract(text, '{_WORD}') AS first,
               CAST(strpos(text, nullif(regexp_extract(text, '{_WORD}'), '')) AS INTEGER) AS at,
               regexp_matches(text, '^T[a-z]+') AS starts, regexp_full_match(text, '[\\pL\\s.,]+') AS whole,
               CAST(len(regexp_extract_all(text, '{_WORD}')) AS INTEGER) AS hits,
               CAST(len(string_split_regex(text, '{_WORD}')) AS INTEGER) AS parts,
               md5(regexp_replace(text, '{_WORD}', '??', 'g')) AS digest FROM documents""",
)
def regular_expressions(t: Tables):
    c = F.col("text")
    return t.documents.select(
        "doc_id",
        F.regexp(c, F.lit(_WORD)).alias("found"),
        F.regexp_extract(c, _WORD, 0).alias("first"),
        F.nullif(F.regexp_instr(c, F.lit(_WORD)), F.lit(0)).alias("at"),
        text.matches_start(c, "T[a-z]+").alias("starts"),
        text.matches_whole(c, r"[\p{L}\s.,]+").alias("whole"),
        F.regexp_count(c, F.lit(_WORD)).alias("hits"),
        F.size(F.split(c, _WORD)).alias("parts"),
        F.md5(F.regexp_replace(c, _WORD, "??").cast("binary")).alias("digest"),
    )


@query(
    "str_email",
    """SELECT doc_id, w AS email, regexp_full_match(w, '[\\pL\\pN_.\\-]+@[\\pL\\pN_.\\-]+\\.[\\pL\\pN_]+') AS valid, count(*) AS n
       FROM (SELECT doc_id, unnest(string_split_regex(text, '\\s+')) AS w FROM documents)
       WHERE contains(w, '@') GROUP BY ALL""",
)
def emails(t: Tables):
    with_sign = F.filter(text.words(F.col("text")), lambda w: F.contains(w, F.lit("@")))
    tokens = t.documents.filter(F.contains("text", F.lit("@"))).select("doc_id", F.explode(with_sign).alias("email"))
    counted = tokens.groupBy("doc_id", "email").agg(F.count("*").alias("n"))
    return counted.withColumn("valid", text.is_email(F.col("email")))


_MESSAGE_SQL = """(SELECT c_custkey, 'Call me at ' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
    || CASE WHEN c_custkey % 5 = 0 THEN '.' ELSE '-' END || '555' || CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE '-' END
    || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || ' or 123-456-789-012-3456 ' || c_name AS m FROM customer)"""


@query(
    "str_phone",
    f"""SELECT c_custkey, array_to_string(list_filter(list_transform(range(1, length(m) - 10), lambda i: substr(m, i, 12)),
               lambda w: regexp_full_match(w, '[0-9]{{3}}-[0-9]{{3}}.[0-9]{{4}}')), '|') AS numbers FROM {_MESSAGE_SQL}""",
)
def phones(t: Tables):
    key = F.col("c_custkey")
    message = F.concat(
        F.lit("Call me at "),
        F.lpad((key % 1000).cast("string"), 3, "0"),
        F.when(key % 5 == 0, ".").otherwise("-"),
        F.lit("555"),
        F.when(key % 3 == 0, "x").otherwise("-"),
        F.lpad((key % 10000).cast("string"), 4, "0"),
        F.lit(" or 123-456-789-012-3456 "),
        F.col("c_name"),
    )
    return t.customer.select("c_custkey", F.array_join(text.phone_numbers(message), "|").alias("numbers"))


@query(
    "str_phone_documents",
    """SELECT CAST(coalesce(sum(len(regexp_extract_all(text, '[0-9]{3}-[0-9]{3}[^0-9][0-9]{4}'))), 0) AS BIGINT) AS numbers,
              count(*) AS texts FROM documents""",
)
def phones_in_documents(t: Tables):
    found = F.size(text.phone_numbers(F.col("text")))
    return t.documents.agg(F.sum(found).alias("numbers"), F.count("*").alias("texts"))


_ACCEPTED = {"en": ["Thereon", "tion the"], "de": ["schund", "die er"], "fr": ["queou"]}


@query(
    "str_any_of",
    """SELECT lang, count(*) FILTER (CASE lang
          WHEN 'en' THEN contains(lower(text), 'thereon') OR contains(lower(text), 'tion the')
          WHEN 'de' THEN contains(lower(text), 'schund') OR contains(lower(text), 'die er')
          WHEN 'fr' THEN contains(lower(text), 'queou') ELSE false END) AS correct, count(*) AS asked
       FROM documents GROUP BY lang""",
)
def accepted(t: Tables):
    right = text.contains_any(F.col("text"), text.accepted_words(F.col("lang"), _ACCEPTED))
    return t.documents.groupBy("lang").agg(F.count_if(right).alias("correct"), F.count("*").alias("asked"))


@query("str_base", "SELECT o_orderkey, hex(o_orderkey) AS hex, bin(o_orderkey) AS bin FROM orders")
def bases(t: Tables):
    return t.orders.select("o_orderkey", F.hex("o_orderkey").alias("hex"), F.bin("o_orderkey").alias("bin"))
