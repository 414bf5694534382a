"""Corpus-level text jobs."""

from pyspark.sql import functions as F

from tallyloom.operators import corpus, joins, markup
from tallyloom.plans.registry import Tables, query

# To measure the accuracy, a fifth of the texts, by a hash of their id, is held out of the learning.
_HELD_OUT = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) AS BIGINT) % 5 = 0"


def held_out():
    return F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("bigint") % 5 == 0


def _language_sql(taught: str) -> str:
    return rf"""WITH f AS (SELECT doc_id, lang, string_split(' ' || trim(regexp_replace(lower(text), '[^\pL]+', ' ', 'g')) || ' ', '') AS c
             FROM documents),
        g AS (SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM f),
        d AS (SELECT doc_id, lang, gram, count(*) AS n FROM g WHERE substr(gram, 2, 1) <> ' ' GROUP BY ALL),
        l AS (SELECT lang AS guess, gram, sum(n) AS n FROM d WHERE {taught} GROUP BY ALL),
        t AS (SELECT guess, sum(n) + (SELECT count(DISTINCT gram) FROM l) AS total FROM l GROUP BY guess),
        k AS (SELECT DISTINCT gram FROM l),
        m AS (SELECT k.gram, t.guess, ln((coalesce(l.n, 0) + 1) / total) AS share
              FROM k CROSS JOIN t LEFT JOIN l ON l.gram = k.gram AND l.guess = t.guess),
        s AS (SELECT doc_id, guess, round(sum(d.n * share), 6) AS score FROM d JOIN m USING (gram) GROUP BY ALL)
   SELECT doc_id, lang, guess FROM documents LEFT JOIN
     (SELECT DISTINCT ON (doc_id) doc_id, guess FROM s ORDER BY doc_id, score DESC, guess) USING (doc_id)"""


_LEARNT_SQL = _language_sql(f"lang IS NOT NULL AND NOT ({_HELD_OUT})")


def _learnt(t: Tables):
    return corpus.guess_language(t.documents, "doc_id", "text", "lang", learn=~held_out())


@query("txt_language", _language_sql("lang IS NOT NULL"))
def languages(t: Tables):
    return corpus.guess_language(t.documents, "doc_id", "text", "lang")


@query(
    "txt_language_accuracy",
    f"""SELECT lang, round(avg(CAST(guess = lang AS INTEGER)), 8) AS accuracy, count(*) AS texts
        FROM ({_LEARNT_SQL}) WHERE {_HELD_OUT} GROUP BY lang""",
)
def language_accuracy(t: Tables):
    right = F.avg((F.col("guess") == F.col("lang")).cast("int"))
    return _learnt(t).filter(held_out()).groupBy("lang").agg(F.round(right, 8).alias("accuracy"), F.count("*").alias("texts"))


# DuckDB measures edits in bytes, so the letters of two bytes that the tables have are written as one capital or digit
_ONE_BYTE = "translate(word, 'ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456')"
_DELETIONS = """unnest(list_distinct(list_concat([b], list_transform(range(1, len(b) + 1), lambda i: b[:i - 1] || b[i + 1:]),
      flatten(list_transform(range(1, len(b)), lambda i: list_transform(range(i + 1, len(b) + 1),
        lambda j: b[:i - 1] || b[i + 1:j - 1] || b[j + 1:]))))))"""


@query(
    "txt_spell",
    rf"""WITH v AS (SELECT word, count(*) AS n, {_ONE_BYTE} AS b
               FROM (SELECT unnest(regexp_extract_all(lower(text), '\pL+')) AS word FROM documents) GROUP BY word),
             w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\pL+')) AS word FROM conversations),
             u AS (SELECT word, {_ONE_BYTE} AS b FROM w ANTI JOIN v USING (word)),
             uk AS (SELECT word, b, {_DELETIONS} AS part FROM u),
             vk AS (SELECT word AS candidate, b AS cb, n, {_DELETIONS} AS part FROM v),
             p AS (SELECT DISTINCT word, b, candidate, cb, n FROM uk JOIN vk USING (part)),
             c AS (SELECT word, candidate, n, damerau_levenshtein(b, cb) AS edits FROM p)
        SELECT word, coalesce(candidate, word) AS correction FROM w LEFT JOIN
          (SELECT DISTINCT ON (word) word, candidate FROM c WHERE edits <= 2 ORDER BY word, edits, n DESC, candidate) USING (word)""",
)
def spelling(t: Tables):
    return corpus.correct_words(corpus.word_counts(t.conversations, "text"), corpus.word_counts(t.documents, "text"))


# the pages have items of this form alone, so SQL may look for it
_ITEM = '<li>\\s*<a\\s+href="([^"]*)"[^>]*>([^<]*)</a>'


@query(
    "txt_scrape",
    f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS place, targets[i] AS target, titles[i] AS title FROM
         (SELECT page_id, regexp_extract_all(html, '{_ITEM}', 1) AS targets, regexp_extract_all(html, '{_ITEM}', 2) AS titles,
                 unnest(range(1, len(regexp_extract_all(html, '{_ITEM}')) + 1)) AS i FROM pages)""",
)
def scraped(t: Tables):
    return markup.list_links(t.pages, "page_id", "html")


@query(
    "txt_scrape_paired",
    r"""SELECT page_id, CAST(i - 1 AS INTEGER) AS place, links[i] AS link, headings[i] AS heading FROM
         (SELECT page_id, links, headings, unnest(range(1, greatest(len(links), len(headings)) + 1)) AS i FROM
           (SELECT page_id, regexp_extract_all(html, '<li>\s*<a\s+href="[^"]*"[^>]*>([^<]*)</a>', 1) AS links,
                   regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1) AS headings FROM pages))""",
)
def paired(t: Tables):
    return markup.paired_elements(t.pages, "page_id", "html", {"link": "nav li a", "heading": "article > h1"})


_LETTERS = [
    "Dear [NAME], the hall is booked for Saturday.",
    "Hello [NAME]! Thank you for coming, [NAME].",
    "To [NAME]: see you next year.",
]


@query(
    "txt_merge",
    "SELECT s_name, CAST(i AS INTEGER) AS template, replace(letter, '[NAME]', trim(s_name)) AS letter FROM supplier, "
    + "(VALUES "
    + ", ".join(f"({i}, '{x}')" for i, x in enumerate(_LETTERS))
    + ") AS l(i, letter)",
)
def letters(t: Tables):
    return joins.fill_templates(t.supplier, "s_name", _LETTERS, "[NAME]")
