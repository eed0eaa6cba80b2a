"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import collocations, lexical, url_filters
from tidemark.llm.decontamination import WINDOW
from tidemark.llm.near_duplicates import SHINGLE
from tidemark.llm.repeats import WIDTH

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(list_transform(
    range(1, greatest(len(ws) - {SHINGLE}, 0) + 2),
    lambda i: array_to_string(list_slice(ws, i, i + {SHINGLE - 1}), ' '))) AS shingles
  FROM docs WHERE len(ws) > 0),
spread AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS k
  FROM spread AS a JOIN spread AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 85 * (n + m - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION
  SELECT reached.a, edges.b FROM reached JOIN edges ON reached.b = edges.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(coalesce(len(shingles), 0) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM docs JOIN least USING (doc_id) LEFT JOIN sets USING (doc_id)"""

_WORDS = (
    "list_filter(regexp_split_to_array(" + _LOWER.format("coalesce(text, '')")
    + ", '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
places AS (
  SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW}, 0) + 2)) AS i
  FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, list_slice(ws, i, i + {WINDOW - 1}) AS w FROM places),
sizes AS (SELECT DISTINCT len(w) AS n FROM windows),
starts AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes),
found AS (
  SELECT rid, i, n, item_id
  FROM (SELECT rid, i, n, list_slice(ws, i, i + n - 1) AS w FROM starts) JOIN windows USING (w)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid),
held AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN held USING (rid)"""

# Bytes as two hexadecimal digits each.
REPEATS = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
windows AS (
  SELECT rid, i, md5(substr(h, 2 * i + 1, {2 * WIDTH})) AS w
  FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - {WIDTH - 1})) AS i FROM docs)),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
found AS (SELECT rid, i FROM windows JOIN again USING (w)),
opened AS (
  SELECT rid, i,
    CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + {WIDTH} THEN 0 ELSE 1 END AS opens
  FROM found),
numbered AS (
  SELECT rid, i, sum(opens) OVER (PARTITION BY rid ORDER BY i) AS run FROM opened),
spans AS (
  SELECT rid, run, min(i) AS first, max(i) + {WIDTH} AS last FROM numbered GROUP BY rid, run),
gaps AS (
  SELECT rid, run, first, last,
    coalesce(lag(last) OVER (PARTITION BY rid ORDER BY run), 0) AS before FROM spans),
kept AS (
  SELECT rid, sum(last - first) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (first - before) AS BIGINT)), ''
               ORDER BY run)
      || substr(any_value(h), CAST(2 * max(last) + 1 AS BIGINT)) AS rest
  FROM gaps JOIN docs USING (rid) GROUP BY rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)"""


# What a lexical term is.
_TERMS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
    + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

LEXICAL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM docs WHERE len(ws) > 0),
tf AS (
  SELECT rid, doc_id, n, term, count(*) AS tf
  FROM (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))
                    AS BIGINT) AS w
  FROM tf, totals GROUP BY term, n_docs),
parts AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS part
  FROM tf JOIN weights USING (term), totals),
scores AS (
  SELECT item_id, rid, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM items JOIN parts USING (term) GROUP BY item_id, rid, doc_id)
SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM scores WHERE score > 0 QUALIFY rank <= {lexical.TOP}"""

COLLOCATIONS = f"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(
    {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws
  FROM (SELECT lang, unnest(pieces) AS piece FROM docs)),
lengths AS (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS k),
spread AS (
  SELECT lang, k, list_slice(ws, i, i + k - 1) AS p
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces, lengths)),
f AS (
  SELECT lang, k, p, count(*) AS a FROM spread
  GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
inner_phrases AS (
  SELECT lang, p, max(a) AS around
  FROM (SELECT lang, a, list_slice(p, i, i + m - 1) AS p
        FROM (SELECT f.*, m, unnest(range(1, f.k - m + 2)) AS i
              FROM f JOIN (SELECT k AS m FROM lengths) ON m >= 2 AND m < f.k))
  GROUP BY lang, p),
candidates AS (
  SELECT f.* FROM f LEFT JOIN inner_phrases USING (lang, p)
  WHERE k > 1 AND (around IS NULL OR 100 * around < {collocations.INSIDE} * a)),
cuts AS (
  SELECT c.lang, c.p, c.a, i, h.a AS l, t.a AS r,
    (1000000 * c.a::HUGEINT * c.a::HUGEINT) // (h.a::HUGEINT * t.a::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates) AS c
  JOIN f AS h ON h.lang = c.lang AND h.p = list_slice(c.p, 1, i)
  JOIN f AS t ON t.lang = c.lang AND t.p = list_slice(c.p, i + 1, c.k)),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, i) = 1)
SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score,
  row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
FROM lowest JOIN totals USING (lang) QUALIFY rank <= {collocations.TOP}"""

def url_filters_sql(rules) -> str:
    """The tree of path templates, with the listed rules as a table."""
    listed = ", ".join(f"('{kind}', '{host}', '{path}')" for kind, host, path in rules)
    rest = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    ending = r"(\.[A-Za-z][A-Za-z0-9]{0,4})$"
    form = f"""CASE
      WHEN regexp_matches(stem, '^[0-9]+([-_.][0-9]+)*$') THEN '{{n}}' || lower(tail)
      WHEN regexp_matches(stem, '^[0-9a-fA-F-]{{8,}}$') AND digits > 0 THEN '{{hex}}' || lower(tail)
      WHEN len(stem) >= 12 AND digits >= 3 THEN '{{id}}' || lower(tail)
      ELSE s END"""
    weight = url_filters.WEIGHT

    def entropy(good: str, n: str) -> str:
        """n times the entropy of a share; a part of 0 adds 0."""
        return "-(" + " + ".join(
            f"CASE WHEN {part} > 0 THEN ({part}) * ln(({part})::DOUBLE / ({n})) ELSE 0 END"
            for part in (good, f"({n}) - ({good})")
        ) + ")"

    ratio = (
        entropy("allg", "alll") + " - " + entropy("g", "l") + " - "
        + entropy("allg - g", "alll - l")
    )
    # One level of the tree after the other: branches, their sums by node, and the next prefixes.
    levels = "".join(
        f"""
branches{d} AS (
  SELECT host, prefix, forms[{d}] AS form, sum(labelled) AS l, sum(good) AS g
  FROM level{d} WHERE len(forms) >= {d} GROUP BY ALL),
sums{d} AS (
  SELECT *, sum(l) OVER w AS alll, sum(g) OVER w AS allg, count(*) FILTER (l > 0) OVER w AS m
  FROM branches{d} WINDOW w AS (PARTITION BY host, prefix)),
judged{d} AS (
  SELECT host, prefix, form, starts_with(form, '{{') OR (
    l > 0 AND alll > l AND {ratio} >= ln(2e0 * m / {url_filters.ALPHA!r}::DOUBLE)) AS literal
  FROM sums{d}),
level{d + 1} AS (
  SELECT host, path, labelled, good, forms, CASE WHEN form IS NULL THEN prefix
    ELSE prefix || '/' || CASE WHEN literal THEN form ELSE '*' END END AS prefix
  FROM (SELECT *, forms[{d}] AS form FROM level{d}) LEFT JOIN judged{d} USING (host, prefix, form)),"""
        for d in range(1, url_filters.DEPTH + 1)
    )
    last = f"level{url_filters.DEPTH + 1}"
    return f"""
WITH rests AS (SELECT row_number() OVER () AS rid, page_id, coalesce({rest}, '') AS r FROM pages),
placed AS (
  SELECT rid, page_id, {_LOWER.format("regexp_extract(r, '^[^/?#]*')")} AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
shown AS (
  SELECT page_id, TRY_CAST(nullif(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1), '')
                           AS BIGINT) AS doc_id FROM placed),
marks AS (
  SELECT page_id, min(q = 1 AND coalesce(t, 0) = 0) AS good
  FROM shown JOIN (SELECT doc_id, min(quality) AS q, max(toxic) AS t FROM labels GROUP BY doc_id)
    USING (doc_id)
  WHERE q IS NOT NULL GROUP BY page_id),
paths AS (
  SELECT host, path, count(good) AS labelled, coalesce(sum(CAST(good AS INTEGER)), 0) AS good
  FROM placed LEFT JOIN marks USING (page_id) GROUP BY host, path),
pieces AS (
  SELECT host, path, depth, s, regexp_extract(s, '{ending}', 1) AS tail,
    regexp_replace(s, '{ending}', '') AS stem
  FROM (SELECT host, path, generate_subscripts(parts, 1) AS depth, unnest(parts) AS s
        FROM (SELECT host, path, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts
              FROM paths))),
forms AS (
  SELECT host, path, list({form} ORDER BY depth) AS forms
  FROM (SELECT *, len(regexp_replace(stem, '[^0-9]', '', 'g')) AS digits FROM pieces)
  GROUP BY host, path),
level1 AS (
  SELECT host, path, labelled, good, coalesce(forms, []) AS forms, '' AS prefix
  FROM paths LEFT JOIN forms USING (host, path)),{levels}
templates AS (
  SELECT host, path, labelled, good, CASE WHEN prefix = '' THEN '/'
    WHEN len(forms) > {url_filters.DEPTH} THEN prefix || '/**' ELSE prefix END AS template
  FROM {last}),
per_template AS (
  SELECT host, template, sum(labelled) AS l, sum(good) AS g FROM templates GROUP BY ALL),
per_host AS (SELECT host, sum(l) AS hl, sum(g) AS hg FROM per_template GROUP BY host),
whole AS (SELECT coalesce(sum(good)::DOUBLE / nullif(sum(labelled), 0), 1) AS p FROM templates),
purity AS (
  SELECT host, template,
    (g + {weight}::DOUBLE * ((hg + {weight}::DOUBLE * p) / (hl + {weight}::DOUBLE)))
      / (l + {weight}::DOUBLE) AS purity
  FROM per_template JOIN per_host USING (host), whole),
rules AS (SELECT * FROM (VALUES {listed}) AS t(kind, rule_host, rule_path)),
fits AS (
  SELECT rid, kind, rule_host || rule_path AS rule FROM placed JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY len(rule) DESC) = 1)
SELECT page_id, host, path, rule,
  coalesce(kind, CASE WHEN purity < {url_filters.PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
  template, round(purity, 6) AS purity
FROM placed JOIN templates USING (host, path) JOIN purity USING (host, template)
LEFT JOIN fits USING (rid)"""
