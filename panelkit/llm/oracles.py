"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from panelkit.llm.license_templates import BASE, TEMPLATES, regex_of, words_of
from panelkit.llm.link_trust import LINK, RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(expr: str) -> str:
    """A-Z lower-cased, everything else as it is; null counts as empty."""
    return f"translate(coalesce({expr}, ''), '{UPPER}', '{LOWER}')"


OP10 = f"""
WITH t AS (SELECT doc_id, sha256({lowered('text')}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP4 = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496 AS u
  FROM documents),
g AS (SELECT *, CASE WHEN size >= 64 THEN 1.0::DOUBLE WHEN size >= 16 THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END AS propensity FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight FROM d GROUP BY source),
ordered AS (SELECT *, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS k FROM s),
rated AS (SELECT *, CAST((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                 / CAST(sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate FROM ordered),
chosen AS (SELECT arg_min(rate, k) AS rate FROM rated WHERE rate * weight <= 3 * source_size),
t AS (SELECT source, source_size, least(chosen.rate * weight, CAST(3 * source_size AS DOUBLE)) AS target FROM s, chosen),
c AS (SELECT g.source, propensity, any_value(source_size) AS source_size, any_value(target) AS target, sum(size) AS words
      FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source GROUP BY g.source, propensity),
c2 AS (SELECT *, (target - CAST(3 * coalesce(sum(words) OVER (PARTITION BY source ORDER BY propensity DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
              / nullif(CAST(sum(propensity * words) OVER (PARTITION BY source ORDER BY propensity DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE), 0) AS rate FROM c),
f AS (SELECT source, arg_max(rate, propensity) AS rate FROM c2 WHERE rate * propensity <= 3 GROUP BY source),
e AS (SELECT c2.source, propensity, source_size, target,
             greatest(0.0::DOUBLE, least(3.0::DOUBLE, coalesce(f.rate, 'infinity'::DOUBLE) * propensity)) AS expected
      FROM c2 LEFT JOIN f ON c2.source IS NOT DISTINCT FROM f.source),
x AS (SELECT doc_id, g.source, size, u, source_size, target, CAST(floor(expected) AS BIGINT) AS certain, expected - floor(expected) AS p
      FROM g JOIN e ON g.source IS NOT DISTINCT FROM e.source AND g.propensity = e.propensity),
y AS (SELECT *, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS value,
             target - CAST(sum(certain * size) OVER (PARTITION BY source) AS DOUBLE) AS budget FROM x),
z AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY value, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before FROM y)
SELECT doc_id, size, source_size, target,
       (certain + CASE WHEN value < 1 AND before + size / 2.0::DOUBLE <= budget THEN 1 ELSE 0 END) * size AS taken FROM z
"""


def _op6(steps: int = 200, damping: float = 0.85) -> str:
    """Rules, host edges, and the settled ranks as the sum over all walks from
    the seeds: what is left after ``steps`` steps (1e-14 of the mass) is beyond
    what the query's rounds still change."""
    case = []
    for verdict, host, path in sorted(RULES, key=lambda r: -len(r[1]) - len(r[2])):
        case.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')", host + path, verdict))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in case) + " END"
    said = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in case) + " END"
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, {lowered("regexp_extract(rest, '^[^/?#]*')")} AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
j AS (SELECT page_id, html, host, path, {rule} AS rule, {said} AS said FROM p),
links AS (SELECT host AS src, {lowered('dst')} AS dst, 1.0::DOUBLE AS weight
          FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS dst FROM p WHERE host <> '')),
names AS (SELECT DISTINCT string_split(host, '.') AS n FROM p),
steps AS (SELECT n, unnest(range(1, len(n) - 1)) AS i FROM names WHERE len(n) >= 3),
up AS (SELECT DISTINCT array_to_string(n[i:], '.') AS src, array_to_string(n[i + 1:], '.') AS dst FROM steps),
edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT * FROM links UNION ALL SELECT src, dst, 1.0::DOUBLE FROM up
          UNION ALL SELECT dst, src, 1.0::DOUBLE FROM up) WHERE src <> dst AND dst <> '' GROUP BY src, dst),
both_ways AS (SELECT 'trust' AS kind, src AS host, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
shares AS (SELECT kind, host, dst, weight / sum(weight) OVER (PARTITION BY kind, host) AS share FROM both_ways),
home AS (SELECT CASE said WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) * (1 - {damping}::DOUBLE) AS rank FROM j WHERE said IS NOT NULL GROUP BY 1, 2),
walks AS (SELECT 0 AS i, kind, host, rank FROM home
          UNION ALL SELECT w.i + 1, e.kind, e.dst, sum(w.rank * e.share * {damping}::DOUBLE) FROM walks w JOIN shares e ON e.kind = w.kind AND e.host = w.host
          WHERE w.i < {steps} GROUP BY w.i, e.kind, e.dst),
standing AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS trust, coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS distrust
             FROM walks GROUP BY host)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN distrust > trust * (1 + 1e-9) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN standing USING (host)
"""


OP8 = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM docs),
keyed AS (SELECT *, {lowered("regexp_replace(regexp_replace(line, '^[ \t\n\v\f\r]+', ''), '[ \t\n\v\f\r]+$', '')")} AS k FROM places),
frequent AS (SELECT k, max(doc_id) AS last_id FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, i, line, coalesce(doc_id <> last_id, false) AS lost FROM keyed LEFT JOIN frequent USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _op3() -> str:
    """Phrases by comparing slices of the word list; templates, as far as it
    matters which of them accept, by regular expressions over the words."""
    base = []
    for phrase, label in BASE:
        words = [w.decode() for w in words_of(phrase)]
        base.append(f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1:i + {len(words)}] = "
                    f"{words})) AS first FROM w")
    accepted = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label FROM w WHERE regexp_matches(joined, '{regex_of(t)}')"
                                  for label, t in TEMPLATES)
    return f"""
WITH w AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS joined FROM (SELECT doc_id,
    regexp_extract_all({lowered('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
base AS ({' UNION ALL '.join(base)}), accepted AS ({accepted}),
b AS (SELECT doc_id, count(*) AS n, min(first) AS lo, max(first) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS names FROM base GROUP BY doc_id),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS names
      FROM (SELECT doc_id, label FROM base UNION ALL SELECT * FROM accepted) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
       coalesce(b.names, '') AS base_labels, coalesce(a.names, '') AS labels,
       CASE WHEN doc_id IN (SELECT doc_id FROM accepted) THEN 1.0::DOUBLE WHEN b.n > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)
"""


#: A checksum bit by bit: its table of 256 steps, then one step a byte.
_CRC = """list_reduce(list_transform(range(octet_length(encode({0}))), lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT)),
  lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295::BIGINT)"""

OP12 = f"""
WITH RECURSIVE table_of AS (SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, CAST(v AS BIGINT))) AS steps),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({lowered('text')}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
summed AS (SELECT run, n, xor({_CRC.format("(id || ':' || run)")}, 4294967295::BIGINT) AS h FROM counted, table_of),
thinned AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, i, left(word, CAST(i - 1 AS INTEGER)) || substr(word, CAST(i + 1 AS INTEGER)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT l.word, l.n, w.word AS other, w.n AS other_n FROM less l JOIN words w ON w.word = l.rest),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION ALL SELECT word, other, other_n FROM shorter UNION ALL SELECT other, word, n FROM shorter),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
first_best AS (SELECT near.word, min(other) AS other FROM near JOIN best ON best.word = near.word AND most = other_n GROUP BY near.word),
judged AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN other END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
           FROM words LEFT JOIN best ON best.word = words.word LEFT JOIN first_best ON first_best.word = words.word),
walk AS (SELECT word, form AS reached FROM judged WHERE form IS NOT NULL
         UNION ALL SELECT walk.word, judged.form FROM walk JOIN judged ON judged.word = walk.reached WHERE judged.form IS NOT NULL),
ends AS (SELECT walk.word, reached FROM walk JOIN judged ON judged.word = walk.reached WHERE judged.form IS NULL)
SELECT judged.word, form, coalesce(reached, judged.word) AS root, n, n_near, form_n FROM judged LEFT JOIN ends ON ends.word = judged.word
"""

def _op13(longest: int = 4) -> str:
    """Phrases by slicing the word lists, cuts and containment by joins."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS len, array_to_string(ws[i:i + {k - 1}], ' ') AS p, count(*) AS f FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k} + 2)) AS i FROM pieces) GROUP BY ALL"
        for k in range(1, longest + 1))
    return f"""
WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({lowered('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS ({grams}), sizes AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang),
often AS (SELECT * FROM grams WHERE f >= 30),
parts AS (SELECT lang, p, len, f AS a, string_split(p, ' ') AS ws FROM often WHERE len > 1),
held AS (SELECT lang, array_to_string(ws[i:i + j - 1], ' ') AS p, a AS f
         FROM (SELECT *, unnest(range(1, len - j + 2)) AS i FROM (SELECT *, unnest(range(2, len)) AS j FROM parts))),
dropped AS (SELECT DISTINCT parts.lang, parts.p FROM parts JOIN held ON held.lang = parts.lang AND held.p = parts.p WHERE 100 * held.f >= 80 * parts.a),
kept AS (SELECT * FROM parts ANTI JOIN dropped USING (lang, p)),
cuts AS (SELECT lang, p, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, len)) AS k FROM kept)),
scored AS (SELECT cuts.lang, cuts.p, a, k, gx.f AS l, gy.f AS r, (2000000::HUGEINT * a) // (gx.f + gy.f) AS score
           FROM cuts JOIN often gx ON gx.lang = cuts.lang AND gx.p = x JOIN often gy ON gy.lang = cuts.lang AND gy.p = y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank FROM lowest)
SELECT ranked.lang, rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


ORACLES = {"op1_threshold_topk": OP1, "op4_pareto_mix": OP4, "op6_link_trust": _op6(), "op3_license_templates": _op3(), "op8_line_mph": OP8, "op10_digest_tree": OP10,
           "op12_sliced_variants": OP12, "op13_phrase_index": _op13()}
