"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tallyloom.llm.url_templates import DEPTH, HOST_PRIOR, PRODUCTION_RULES, RARE, TEMPLATE_PRIOR

_WORD = r"[^\x20\x09-\x0D]"


def url_sql() -> str:
    by_length = sorted(PRODUCTION_RULES, key=lambda r: (-len(r.name), r.name))
    fits = [
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in by_length
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, by_length, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, by_length, strict=True)) + " END"
    levels = []
    for d in range(DEPTH + 1):
        levels.append(
            f"""l{d + 1} AS (
  SELECT host, shape, n, blocked, allowed,
         CASE WHEN child IS NULL THEN general
              ELSE list_append(general, CASE WHEN child <> '$' AND c * {RARE} < p THEN '*' ELSE child END) END AS general
  FROM (SELECT *, sum(n) OVER (PARTITION BY host, general, child) AS c,
               sum(n) FILTER (WHERE child IS NOT NULL AND child <> '$') OVER (PARTITION BY host, general) AS p
        FROM (SELECT *, shape[{d + 1}] AS child FROM l{d})))"""
        )
    return f"""
WITH parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages)),
ruled AS (SELECT *, {rule} AS rule, {verdict} AS rule_verdict FROM parsed),
shaped AS (
  SELECT *, list_transform(segments[1:{DEPTH}], lambda s: regexp_replace(s, '[0-9]+', '#', 'g'))
            || CASE WHEN len(segments) > {DEPTH} THEN ['**'] ELSE [] END || ['$'] AS shape
  FROM (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments FROM ruled)),
l0 AS (SELECT host, shape, count(*) AS n, count(*) FILTER (WHERE rule_verdict = 'block') AS blocked,
              count(*) FILTER (WHERE rule_verdict = 'allow') AS allowed, CAST([] AS VARCHAR[]) AS general
       FROM shaped GROUP BY host, shape),
{", ".join(levels)},
steps AS (
  SELECT host, shape, n, blocked, allowed, d, general[1:d] AS prefix, general[d + 1] AS branch,
         coalesce(general[d + 2], '$') AS following
  FROM (SELECT *, unnest(generate_series(0, len(general) - 1)) AS d FROM l{DEPTH + 1})
  WHERE general[d + 1] <> '$'),
cells AS (SELECT host, prefix, branch, following, sum(n) AS c, sum(blocked) AS b, sum(allowed) AS a FROM steps GROUP BY ALL),
shares AS (
  SELECT *, sum(c) OVER (PARTITION BY host, prefix, following) AS pooled,
         sum(c) OVER (PARTITION BY host, prefix, branch) AS n, sum(c) OVER (PARTITION BY host, prefix) AS all_n,
         sum(b) OVER (PARTITION BY host, prefix, branch) AS nb, sum(b) OVER (PARTITION BY host, prefix) AS all_b,
         sum(a) OVER (PARTITION BY host, prefix, branch) AS na, sum(a) OVER (PARTITION BY host, prefix) AS all_a
  FROM cells),
variation AS (
  SELECT host, prefix, branch, round(sum(greatest(c / n - pooled / all_n, 0)), 9) AS v,
         any_value(n) AS n, any_value(nb) AS nb, any_value(na) AS na, any_value(all_b) AS all_b, any_value(all_a) AS all_a
  FROM shares GROUP BY host, prefix, branch),
merged AS (
  SELECT host, prefix, branch FROM variation
  WHERE v <= greatest(0.05, 1 / sqrt(n))
    AND (nb + na = 0 OR round(abs(nb / (nb + na) - all_b / (all_b + all_a)), 9) <= greatest(0.05, 1 / sqrt(nb + na)))),
templated AS (
  SELECT s.host, s.shape, '/' || coalesce(string_agg(CASE WHEN m.branch IS NOT NULL THEN '*' ELSE s.branch END, '/' ORDER BY d), '') AS template
  FROM steps s LEFT JOIN merged m USING (host, prefix, branch) GROUP BY s.host, s.shape),
found AS (SELECT l0.*, coalesce(template, '/') AS template FROM l0 LEFT JOIN templated USING (host, shape)),
overall AS (SELECT coalesce(sum(blocked) / nullif(sum(blocked + allowed), 0), 0) AS rate FROM l0),
hosts AS (SELECT host, (sum(blocked) + {HOST_PRIOR} * any_value(rate)) / (sum(blocked + allowed) + {HOST_PRIOR}) AS prior
          FROM l0, overall GROUP BY host),
bad AS (
  SELECT host, template FROM found JOIN hosts USING (host) GROUP BY host, template
  HAVING round((sum(blocked) + {TEMPLATE_PRIOR} * any_value(prior)) / (sum(blocked + allowed) + {TEMPLATE_PRIOR}), 9) >= 0.8)
SELECT page_id, s.host, path, rule,
       coalesce(rule_verdict, CASE WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM shaped s JOIN found f ON s.host = f.host AND s.shape = f.shape
LEFT JOIN bad b ON f.host = b.host AND f.template = b.template
"""


def counts_sql(source: str) -> str:
    """Common table expressions up to ``counted``, the counts of each row of ``source``."""
    return rf"""
texts AS (SELECT *, row_number() OVER () AS _row, coalesce(text, '') AS _t FROM {source}),
worded AS (SELECT *, regexp_extract_all(_t, '{_WORD}+') AS _w,
                  list_filter(string_split(_t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS _l FROM texts),
windows AS (SELECT _row, i, count(*) OVER (PARTITION BY _row, _w[i] || ' ' || _w[i + 1] || ' ' || _w[i + 2]) AS c
            FROM (SELECT _row, _w, unnest(generate_series(1, len(_w) - 2)) AS i FROM worded)),
repeated AS (SELECT _row, count(DISTINCT p) AS n_repeat_words
             FROM (SELECT _row, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c > 1) GROUP BY _row),
counted AS (SELECT worded.* EXCLUDE (_t, _w, _l), CAST(len(_w) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(_t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(_t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                   CAST(len(_l) - len(list_distinct(_l)) AS BIGINT) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM worded LEFT JOIN repeated USING (_row))"""


def judged_sql(source: str) -> str:
    """Common table expressions up to ``judged``, ``source`` with counts, base_failed and kept."""
    rules = {
        "base": "n_words < 50 OR 100 * n_repeat_words > 50 * n_words",
        "symbols": "10 * n_symbols > n_words",
        "lines": "n_dup_lines * 5 > n_words",
    }
    sums = ", ".join(f"count(*) FILTER (WHERE {fails}) AS f_{r}" for r, fails in rules.items())
    fits = ", ".join(
        f"sum(f_{r}) / sum(n) AS m_{r}, greatest(1.0, least(1000.0, coalesce((sum(f_{r}) / sum(n)) * (1 - sum(f_{r}) / sum(n))"
        f" / nullif(var_samp(f_{r} / n), 0) - 1, 1000.0))) AS w_{r}"
        for r in rules
    )
    beta = ", ".join(f"f_{r} + m_{r} * w_{r} AS a_{r}, n - f_{r} + (1 - m_{r}) * w_{r} AS b_{r}" for r in rules)
    beyond = " OR ".join(
        f"a_{r} / (a_{r} + b_{r}) - 2 * sqrt(a_{r} * b_{r} / ((a_{r} + b_{r}) * (a_{r} + b_{r}) * (a_{r} + b_{r} + 1))) > 0.8"
        for r in rules
    )
    return f"""{counts_sql(source)},
host_sums AS (SELECT source, count(*) AS n, {sums} FROM counted WHERE source IS NOT NULL GROUP BY source),
fits AS (SELECT {fits} FROM host_sums),
betas AS (SELECT source, {beta} FROM host_sums, fits),
rejected AS (SELECT source FROM betas WHERE {beyond}),
judged AS (SELECT counted.*, ({rules["base"]}) AS base_failed,
                  NOT ({rules["base"]}) AND rejected.source IS NULL AS kept
           FROM counted LEFT JOIN rejected ON counted.source = rejected.source)"""


def quality_sql() -> str:
    return (
        f"WITH {judged_sql('documents')} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, "
        "base_failed, kept FROM judged"
    )


def lines_sql(source: str, min_lines: int = 3) -> str:
    """Common table expressions up to ``deduped``: ``source`` with its text cut, n_lines, n_removed and n_runs."""
    run = ", ".join(f"lead(line, {k}) OVER follow AS l{k}" for k in range(1, min_lines))
    names = ", ".join(["line", *(f"l{k}" for k in range(1, min_lines))])
    whole = " AND ".join(f"l{k} IS NOT NULL" for k in range(1, min_lines)) or "true"
    cut = r"\n(?:[\x20\x09-\x0D]*\n)?"
    return rf"""
split AS (SELECT doc_id, text, regexp_split_to_array(text, '{cut}') AS ls, regexp_extract_all(text, '{cut}') AS bs
          FROM (SELECT DISTINCT doc_id, text FROM {source})),
lined AS (SELECT doc_id, text, pos, ls[pos] AS line
          FROM (SELECT doc_id, text, ls, unnest(generate_series(1, len(ls))) AS pos FROM split)
          WHERE regexp_matches(ls[pos], '{_WORD}')),
runs AS (SELECT doc_id, text, pos, line{", " if run else ""}{run} FROM lined WINDOW follow AS (PARTITION BY doc_id, text ORDER BY pos)),
marked AS (SELECT doc_id, text, pos, row_number() OVER (PARTITION BY {names} ORDER BY doc_id, text, pos) > 1 AS later
           FROM runs WHERE {whole}),
gone AS (SELECT DISTINCT doc_id, text, unnest(generate_series(pos, pos + {min_lines} - 1)) AS pos FROM marked WHERE later),
gone_lists AS (SELECT doc_id, text, list(pos ORDER BY pos) AS g,
                      count(*) FILTER (WHERE before IS NULL OR before <> pos - 1) AS n_runs
               FROM (SELECT *, lag(pos) OVER (PARTITION BY doc_id, text ORDER BY pos) AS before FROM gone) GROUP BY doc_id, text),
cut AS (SELECT split.doc_id, split.text, ls, bs, g, coalesce(n_runs, 0) AS n_runs,
               CASE WHEN g IS NOT NULL THEN list_filter(generate_series(1, len(ls)), lambda i: NOT list_contains(g, i)) END AS k
        FROM split LEFT JOIN gone_lists ON split.doc_id = gone_lists.doc_id AND split.text = gone_lists.text),
rebuilt AS (SELECT doc_id, text, CASE WHEN g IS NULL THEN text ELSE coalesce(list_aggregate(list_transform(k, lambda i, p:
                      ls[i] || CASE WHEN p < len(k) THEN bs[i] ELSE '' END), 'string_agg', ''), '') END AS new_text,
                   len(list_filter(ls, lambda x: regexp_matches(x, '{_WORD}'))) AS n_lines,
                   coalesce(len(g), 0) AS n_removed, n_runs FROM cut),
deduped AS (SELECT s.* REPLACE (r.new_text AS text), coalesce(r.n_lines, 0) AS n_lines,
                   coalesce(r.n_removed, 0) AS n_removed, coalesce(r.n_runs, 0) AS n_runs
            FROM {source} s LEFT JOIN rebuilt r ON s.doc_id IS NOT DISTINCT FROM r.doc_id AND s.text = r.text)"""


def lines_by_words_sql(source: str, min_lines: int = 3, min_words: int = 10) -> str:
    """``lines_sql`` with the later copies of shorter runs of ``min_words`` words or more deleted as well."""
    whole = lines_sql(source, min_lines)
    before, rest = whole.split("\nruns AS (", 1)
    after = "\ngone_lists AS (" + rest.split("\ngone_lists AS (", 1)[1]
    depths = range(1, min_lines + 1)
    words = [" + ".join(f"lead(w, {k}) OVER follow" if k else "w" for k in range(d)) for d in depths]
    run = ["[" + ", ".join(f"lead(line, {k}) OVER follow" if k else "line" for k in range(d)) + "]" for d in depths]
    runs = " UNION ALL ".join(
        f"""SELECT doc_id, text, pos, {d} AS depth, {w} AS run_words, {r} AS run
      FROM (SELECT *, len(regexp_extract_all(line, '{_WORD}+')) AS w FROM lined)
      WINDOW follow AS (PARTITION BY doc_id, text ORDER BY pos)"""
        for d, w, r in zip(depths, words, run, strict=True)
    )
    return f"""{before}
runs AS ({runs}),
marked AS (SELECT doc_id, text, pos, depth, row_number() OVER (PARTITION BY run ORDER BY doc_id, text, pos) > 1 AS later
           FROM runs WHERE run_words IS NOT NULL AND (depth = {min_lines} OR run_words >= {min_words})),
gone AS (SELECT DISTINCT doc_id, text, unnest(generate_series(pos, pos + depth - 1)) AS pos FROM marked WHERE later),{after}"""


def line_dedup_words_sql() -> str:
    return (
        f"WITH {lines_by_words_sql('documents')} SELECT doc_id, n_lines, n_removed, n_runs, "
        "CASE WHEN text IS NULL THEN NULL ELSE sha256(text) END AS kept_sha256 FROM deduped"
    )


def line_dedup_sql() -> str:
    return (
        f"WITH {lines_sql('documents')} SELECT doc_id, n_lines, n_removed, n_runs, "
        "CASE WHEN text IS NULL THEN NULL ELSE sha256(text) END AS kept_sha256 FROM deduped"
    )


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a string expression's UTF-8 bytes, bit by bit."""
    hexes = f"hex(encode({text}))"
    bytes_ = f"list_transform(range(0, octet_length(encode({text}))), lambda k: CAST('0x' || substr({hexes}, CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))"
    step = "list_reduce(list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda t, z: xor(t >> 1, 3988292384 * (t & 1)))"
    return f"xor(list_reduce(list_concat([4294967295], {bytes_}), lambda c, x: {step}), 4294967295)"


def variants_sql() -> str:
    return rf"""WITH RECURSIVE r AS (
             SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times FROM
               (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 5 GROUP BY ALL),
           h AS (SELECT run, times, {crc32_sql("concat(doc_id, ':', run)")} AS h FROM r),
           d AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) + 2 AS INTEGER))
                        ELSE run END AS word, times FROM h),
           v AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
           c AS (SELECT word, n, i, substr(word, 1, CAST(i - 1 AS INTEGER)) || substr(word, CAST(i + 1 AS INTEGER)) AS rest
                 FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
           p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM c a JOIN c b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
                 UNION SELECT c.word, v.word, v.n FROM c JOIN v ON v.word = c.rest
                 UNION SELECT v.word, c.word, c.n FROM c JOIN v ON v.word = c.rest),
           b AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM p GROUP BY word),
           f AS MATERIALIZED (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
                        CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM v LEFT JOIN b USING (word)),
           t AS (SELECT word, word AS at_word FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.at_word AND f.form IS NOT NULL)
      SELECT f.word, f.form, t.at_word AS root, f.n, f.n_near, f.form_n
      FROM f JOIN t USING (word) JOIN f e ON e.word = t.at_word AND e.form IS NULL"""


def vectors_sql(least: float = 0.98) -> str:
    return f"""WITH RECURSIVE e AS (
             SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
             WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
           p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
                 WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {least}),
           t AS (SELECT vec_id, vec_id AS b FROM embeddings UNION SELECT t.vec_id, p.b FROM t JOIN p ON p.a = t.b),
           c AS (SELECT vec_id, min(b) AS component_id FROM t GROUP BY vec_id),
           n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
      SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
      FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)"""


def repair_sql() -> str:
    ink = r"[^\x20\x09-\x0D]"
    return rf"""WITH RECURSIVE f AS (
             SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                    {crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS h FROM conversations),
           d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                        unnest(range(0, CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS again FROM f WHERE h <> 0),
           o AS (SELECT conv_id, turn, role, text, row_number() OVER w AS i,
                        substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER w AS before
                 FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
           r AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '{ink}') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM o),
           dp AS (
             SELECT conv_id, CAST(0 AS BIGINT) AS i, q, cost, audit
             FROM (SELECT DISTINCT conv_id FROM r), (VALUES (0, 0, ''), (2, 2, 'I'), (3, 4, 'II')) s(q, cost, audit)
             UNION ALL
             SELECT conv_id, i, q, cost, audit FROM (
               SELECT conv_id, i, q3 AS q, cost, audit, row_number() OVER (PARTITION BY conv_id, q3 ORDER BY cost, audit) AS place FROM (
                 SELECT conv_id, i, audit || letter || repeat('I', k) AS audit,
                        CASE WHEN k = 0 THEN q2 WHEN (k = 1) = (q2 = 2) THEN 3 ELSE 2 END AS q3,
                        cost + 2 * k + CASE letter WHEN 'K' THEN 0 WHEN 'R' THEN 2 ELSE 3 END + CASE WHEN letter <> 'D' AND fault = 't' THEN 1 ELSE 0 END AS cost
                 FROM (SELECT dp.conv_id, r.i, dp.cost, dp.audit, letter, fault,
                              CASE WHEN letter = 'D' THEN q WHEN fault IN ('b', 'd') THEN NULL
                                   WHEN letter = 'R' THEN CASE q WHEN 2 THEN 3 ELSE 2 END
                                   WHEN initial = 's' AND q = 0 THEN 1 WHEN initial = 'u' AND q <> 2 THEN 2 WHEN initial = 'a' AND q = 2 THEN 3 END AS q2
                       FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1, (VALUES ('K'), ('R'), ('D')) e(letter)),
                      (VALUES (0), (1), (2)) n(k) WHERE q2 IS NOT NULL)) WHERE place = 1),
           c AS MATERIALIZED (SELECT conv_id, max(i) AS n, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                        count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
                        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM r GROUP BY conv_id),
           g AS MATERIALIZED (SELECT conv_id, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit FROM dp JOIN c USING (conv_id) WHERE i = n AND q IN (0, 3) GROUP BY conv_id),
           a AS (SELECT conv_id, audit, p, substr(audit, CAST(p AS INTEGER), 1) AS letter, p - len(replace(substr(audit, 1, CAST(p AS INTEGER)), 'I', '')) AS inserted
                 FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS p FROM g)),
           l AS (SELECT a.conv_id, p, letter, role, text, letter IN ('R', 'I') OR letter = 'K' AND initial <> 's' AS counted
                 FROM a LEFT JOIN r ON letter <> 'I' AND a.conv_id = r.conv_id AND r.i = p - inserted),
           m AS (SELECT *, count(*) FILTER (counted) OVER (PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS written FROM l),
           w AS (SELECT conv_id, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE WHEN written % 2 = 0 THEN 'user' ELSE 'assistant' END END || ':' ||
                        CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired FROM m WHERE letter <> 'D' GROUP BY conv_id)
      SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
             coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
             coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
      FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN c USING (conv_id) LEFT JOIN g USING (conv_id) LEFT JOIN w USING (conv_id)"""
