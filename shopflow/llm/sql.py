"""DuckDB SQL for the queries that SQL can express."""

from shopflow.llm import licenses, lines, parameters

_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _pattern(rule):
    """The signs of a wildcard rule as a regular expression."""
    signs = {"*": "(?s:.*)", "|": "(^|[^A-Za-z0-9]|$)"}
    return "".join(signs.get(c, c if c.isalnum() else "\\" + c) for c in rule)


def url_filter():
    hosts = ", ".join(
        f"({_text(p)}, {_text(a)}, {_text(p.partition('/')[0])}, {_text('/' + p.partition('/')[2])})"
        for a, p in parameters.HOST_RULES)
    anywhere = ", ".join(
        f"({_text(p)}, {_text(a)}, {_text(_pattern(p))}, {i})"
        for i, (a, p) in enumerate(parameters.WILDCARD_RULES))
    return f"""
    WITH parts AS (
        SELECT page_id, url,
               coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_UP}, {_LOW}), '') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
               coalesce(regexp_extract(url, '(?s)^(.*?://)', 1), '') AS scheme
        FROM pages),
    whole AS (
        SELECT page_id, CASE WHEN scheme = '' THEN coalesce(url, '')
               ELSE scheme || host || substr(url, length(scheme) + length(host) + 1) END AS target FROM parts),
    hosts(rule, action, suffix, prefix) AS (VALUES {hosts}),
    anywhere(rule, action, pattern, number) AS (VALUES {anywhere}),
    best_host AS (
        SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
        FROM parts JOIN hosts ON (host = suffix OR ends_with(host, '.' || suffix)) AND starts_with(path, prefix)
        GROUP BY page_id),
    best_anywhere AS (
        SELECT page_id, arg_max(action, length(rule) * 1000 + (action = 'block')::INT * 500 - number) AS action,
               arg_max(rule, length(rule) * 1000 + (action = 'block')::INT * 500 - number) AS rule
        FROM whole JOIN anywhere ON regexp_matches(target, pattern) GROUP BY page_id)
    SELECT page_id, host, path, h.rule, coalesce(h.action, a.action, 'allow') AS verdict,
           coalesce(h.rule, a.rule) AS decided_by
    FROM parts LEFT JOIN best_host h USING (page_id) LEFT JOIN best_anywhere a USING (page_id)"""


def line_dedup():
    return f"""
    WITH split AS (
        SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
    totals AS (SELECT source, count(*) AS total FROM split WHERE source IS NOT NULL GROUP BY source),
    counted AS (
        SELECT source, line, count(*) AS pages
        FROM (SELECT source, unnest(list_distinct(list_transform(
                  lines, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line
              FROM split WHERE source IS NOT NULL)
        WHERE line <> '' GROUP BY source, line),
    bad AS (
        SELECT source, list(line) AS bad FROM counted JOIN totals USING (source)
        WHERE pages >= {lines.LEAST_PAGES} AND pages * 100 > total * {lines.PERCENT} GROUP BY source),
    cut AS (
        SELECT doc_id, source, text, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(
            lines, lambda x: NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
        FROM split LEFT JOIN bad USING (source)),
    final AS (
        SELECT doc_id, lines, CASE WHEN len(list_filter(
            kept, lambda x: trim(x, ' ' || chr(9) || chr(13)) <> '')) = 0
            AND count(*) OVER (PARTITION BY source, text) > 1 THEN lines ELSE kept END AS kept
        FROM cut)
    SELECT doc_id, array_to_string(kept, chr(10)) AS text, coalesce(len(lines), 0)::BIGINT AS n_lines,
           coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped
    FROM final"""


def license_scan():
    templates = ", ".join(f"({_text(n)}, {i}, {_text(t)})" for i, (n, t) in enumerate(
        (n, t) for n, texts in licenses.TEMPLATES.items() for t in texts))

    def words(text):
        return (f"list_filter(string_split(regexp_replace(translate({text}, {_UP}, {_LOW}), "
                "'[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')")

    def grams(w):
        return (f"list_distinct(list_transform(range(1, greatest(len({w}), 1)), "
                f"lambda i: {w}[i] || ' ' || {w}[i + 1]))")

    t = licenses.SIMILARITY
    return f"""
    WITH templates AS (
        SELECT name, number, {grams('w')} AS grams
        FROM (SELECT name, number, {words('text')} AS w FROM (VALUES {templates}) v(name, number, text))),
    raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    marked AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM raw),
    worded AS (SELECT doc_id, pos, {words('line')} AS w FROM marked),
    grouped AS (
        SELECT *, sum((len(w) = 0)::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS block,
               max((len(w) = 0)::INT) OVER (PARTITION BY doc_id) AS has_blank FROM worded),
    blocks AS (
        SELECT doc_id, min(pos) AS pos, list(w ORDER BY pos) AS ws FROM grouped WHERE len(w) > 0 GROUP BY doc_id, block),
    starts AS (SELECT doc_id, pos, ws, unnest(range(len(ws))) AS i FROM blocks),
    windows AS (
        SELECT doc_id, pos + i AS pos, flatten(ws[i + 1:i + k]) AS w
        FROM (SELECT *, unnest(range(2, least({licenses.WINDOW_LINES}, len(ws) - i) + 1)) AS k FROM starts)),
    segments AS (
        SELECT doc_id, 0 AS pos, false AS is_window, w FROM grouped
        UNION ALL
        SELECT doc_id, 0, false, flatten(list(w ORDER BY pos)) FROM grouped WHERE len(w) > 0
        GROUP BY doc_id, block HAVING count(*) >= 2
        UNION ALL
        SELECT doc_id, 0, false, flatten(list(w ORDER BY pos)) FROM grouped WHERE has_blank = 1 GROUP BY doc_id
        UNION ALL
        SELECT doc_id, pos, true, w FROM windows),
    bounds AS (SELECT min(len(grams)) AS least, max(len(grams)) AS most FROM templates),
    sets AS (
        SELECT doc_id, pos, is_window, row_number() OVER () AS seg, grams, len(grams) AS size
        FROM (SELECT *, {grams('w')} AS grams FROM segments WHERE len(w) >= 2), bounds
        WHERE len(grams) BETWEEN least * {t / (2 - t)} AND most * {(2 - t) / t}),
    of_template AS (SELECT name, number, len(grams) AS n, unnest(grams) AS gram FROM templates),
    of_segment AS (SELECT seg, unnest(grams) AS gram FROM sets),
    common AS (
        SELECT seg, name, number, n, count(*) AS shared FROM of_segment JOIN of_template USING (gram)
        GROUP BY seg, name, number, n),
    scored AS (
        SELECT doc_id, pos, is_window, seg, name, number, shared, 2.0::DOUBLE * shared / (size + n) AS dice
        FROM common JOIN sets USING (seg)),
    best AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY dice DESC, number) AS place
                       FROM scored WHERE dice >= {t}) WHERE place = 1),
    kept AS (
        SELECT doc_id, name, number, shared, dice FROM best WHERE NOT is_window
        UNION ALL
        SELECT doc_id, name, number, shared, dice FROM (
            SELECT *, row_number() OVER (PARTITION BY doc_id, name ORDER BY dice DESC, pos, shared, number) AS rank
            FROM best WHERE is_window) w
        WHERE rank = 1 AND dice > coalesce((
            SELECT max(dice) FROM best p WHERE NOT p.is_window AND p.doc_id = w.doc_id AND p.name = w.name), 0)),
    found AS (
        SELECT doc_id, count(*) AS n_matches, first(name ORDER BY shared DESC, dice DESC, number) AS license,
               first(dice ORDER BY shared DESC, dice DESC, number) AS dice,
               array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses
        FROM kept GROUP BY doc_id)
    SELECT doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, license, dice, coalesce(licenses, '') AS licenses
    FROM documents LEFT JOIN found USING (doc_id)"""


def topk():
    return """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    WHERE rank <= 5"""


def spelling_variants():
    """Words by fold of CRC-32 over bytes; neighbours share a word with one place left out."""
    return f"""
    WITH RECURSIVE crc AS MATERIALIZED (
        SELECT list(v ORDER BY i) AS steps FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
            FROM range(256) AS r(i))),
    runs AS (
        SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, {_UP}, {_LOW}), '[A-Za-zÀ-ÿ]+')) AS run
            FROM documents)
        WHERE length(run) >= 5 GROUP BY doc_id, run),
    hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(length(h) // 2),
                       lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                   lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h
        FROM (SELECT run, n, hex(encode(doc_id::VARCHAR || ':' || run)) AS h FROM runs), crc),
    words AS MATERIALIZED (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT)
                           || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
        WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    gaps AS MATERIALIZED (
        SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap
        FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
    near AS (
        SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
        FROM gaps a JOIN gaps b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM gaps a JOIN words b ON a.gap = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM gaps a JOIN words b ON a.gap = b.word),
    best AS MATERIALIZED (
        SELECT word, n, count(*) AS n_near, max(other_n) AS m,
               min(other) FILTER (other_n = top) AS form
        FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word, n),
    forms AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
               CASE WHEN m >= 2 * w.n THEN form END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
        FROM words w LEFT JOIN best USING (word)),
    steps(word, root) AS (
        SELECT word, word FROM forms
        UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON steps.root = forms.word
                  WHERE forms.form IS NOT NULL)
    SELECT f.word, f.form, root, f.n, f.n_near, f.form_n::BIGINT AS form_n
    FROM steps JOIN forms last ON last.word = steps.root AND last.form IS NULL
    JOIN (SELECT * FROM forms) f ON f.word = steps.word"""


ORACLE_SQL = {
    "op1_url_filter": url_filter(),
    "op2_line_dedup": line_dedup(),
    "op4_license_scan": license_scan(),
    "op8_topk": topk(),
    "op13_spelling": spelling_variants(),
}
