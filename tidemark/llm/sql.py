"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

import re

from .license_scan import PHRASES, TEMPLATES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaced(text: str) -> str:
    """List of words between ASCII white space."""
    return f"[x FOR x IN regexp_split_to_array(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+') IF x <> '']"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _alnum(text: str) -> str:
    """List of lower-cased words of letters, digits and anything beyond ASCII."""
    split = f"regexp_split_to_array({_lower(f'coalesce({text}, chr(32))')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"[x FOR x IN {split} IF x <> '']"


def _window(words: str, size: str) -> str:
    return f"array_to_string(list_slice({words}, p, p + {size} - 1), ' ')"


def _template(text: str) -> str:
    """A license template as a pattern over words that each end with one space."""
    out = ""
    for mark, word in re.findall(r"<<(/?optional|var:\d+)>>|([^\s<>]+)", text):
        out += f"{word} " if word else {"optional": "(?:", "/optional": ")?"}.get(mark) or f"(?:[^ ]+ ){{0,{mark[4:]}}}"
    return " " + out


ORACLES: dict[str, str] = {}

ORACLES["op3_url_filter"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM split
), judged AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled FROM ruled
), hosts AS (
  SELECT host, count(*) FILTER (ruled = 'block') > count(*) FILTER (ruled = 'allow') AS listed FROM judged GROUP BY host
)
SELECT page_id, host, path, rule, listed,
       coalesce(ruled, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN hosts USING (host)
"""

ORACLES["op1_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_spaced('text')} AS w FROM documents),
win AS (SELECT doc_id, p, {_window('w', '50')} AS k FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
least AS (SELECT k, min(doc_id) AS origin FROM win GROUP BY k HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM win JOIN least USING (k) WHERE origin < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_LONGEST = max(len(p.split()) for p in PHRASES)
_AHEAD = ", ".join(f"lead(word, {i}) OVER (PARTITION BY doc_id ORDER BY p) AS w{i}" for i in range(_LONGEST))
_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, p, '{label}' AS label FROM spots WHERE "
    + " AND ".join(f"w{i} = '{word}'" for i, word in enumerate(phrase.split())) for phrase, label in PHRASES.items())
_ACCEPTED = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label FROM d WHERE regexp_matches(' ' || array_to_string(w, ' ') || ' ', '{_template(t)}')"
    for label, t in TEMPLATES.items())

ORACLES["op2_license_scan"] = f"""
WITH d AS (SELECT doc_id, {_alnum('text')} AS w FROM documents),
spots AS (SELECT doc_id, p, {_AHEAD} FROM (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word FROM d)),
base AS ({_PLACES}), accepted AS ({_ACCEPTED}),
b AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM base UNION ALL SELECT * FROM accepted) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN d.doc_id IN (SELECT doc_id FROM accepted) THEN 1.0 WHEN n_base > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)
"""

ORACLES["op4_jaccard_join"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_spaced(_lower('text'))} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, {_window('w', '5')} AS k FROM (
    SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""

ORACLES["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_alnum('text')} AS w FROM documents),
i AS (SELECT item_id, {_alnum('text')} AS w FROM benchmark),
gram AS (SELECT DISTINCT item_id, n, {_window('w', 'n')} AS k FROM (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM gram),
win AS (SELECT doc_id, n, p, {_window('w', 'n')} AS k FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, size WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, p, item_id FROM win JOIN gram USING (n, k)),
word AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op11_threshold_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS own, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.own, q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.own <> v.own WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_PIECES = f"""[x FOR x IN regexp_split_to_array({_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]') IF x <> '']"""
_CUT = "(1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT"

ORACLES["op12_collocations"] = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, x
               FROM (SELECT lang, unnest({_PIECES}) AS x FROM documents)),
word AS (SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS p FROM (
  SELECT lang, piece, [y FOR y IN regexp_split_to_array(x, '[ \\x09]+') IF y <> ''] AS w FROM piece)),
spot AS (SELECT *, lead(w1) OVER z AS w2, lead(w1, 2) OVER z AS w3 FROM word WINDOW z AS (PARTITION BY piece ORDER BY p)),
total AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM spot GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM spot WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM spot WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
held AS (SELECT lang, w1, w2, max(f) AS most FROM (
  SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, w1 || ' ' || w2 AS phrase, 1 AS k, f2.f AS a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x USING (lang, w1) JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2 LEFT JOIN held USING (lang, w1, w2)
  WHERE f2.f >= 10 AND coalesce(100 * most < 50 * f2.f, true)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.f, x.f, y.f
  FROM f3 JOIN f1 x USING (lang, w1) JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.f, x.f, y.f
  FROM f3 JOIN f2 x USING (lang, w1, w2) JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3
), best AS (
  SELECT *, {_CUT} AS score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY {_CUT}, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
