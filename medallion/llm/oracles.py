"""SQL of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op7_warc_archive"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

ORACLES["op1_url_filter"] = r"""
WITH a AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a),
c AS (
  SELECT page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM b),
d AS (
  SELECT *,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
    CASE WHEN regexp_matches(host || path, '^([^/]*\.)?spam-farm\..*/en/7.*\.html$') THEN '||spam-farm.*/en/7*.html|'
         WHEN regexp_matches(host || path, '^([^/]*\.)?spam-farm\.') THEN '||spam-farm.'
         WHEN regexp_matches(host || path, '^([^/]*\.)?ads-track\.') THEN '||ads-track.'
         WHEN regexp_matches(host || path, '[^A-Za-z0-9_.%-]casino([^A-Za-z0-9_.%-]|$)') THEN '^casino^' END AS pattern
  FROM c)
SELECT page_id, host, path, rule, pattern,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN pattern = '||spam-farm.*/en/7*.html|' THEN 'allow' WHEN pattern IS NOT NULL THEN 'block'
            ELSE 'allow' END AS verdict
FROM d
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op2_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
first AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM win JOIN first USING (k) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
number AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN number USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op4_ngram_jaccard_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ') || least(len(w), 5)) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

ORACLES["op8_benchmark_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, w, least(10, len(w)) AS size FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
ik AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM i)),
dk AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS k FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM ik))),
hits AS (SELECT doc_id, item_id, size, p FROM dk JOIN ik USING (size, k)),
words AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# the windows of 400 bytes of all documents, by MD5; bytes as hexadecimal digits
ORACLES["op6_suffix_array_dedup"] = r"""
WITH n AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes
  FROM documents),
c AS (  -- pieces of 799 bytes that hold the 400 strings that start in each 400 bytes
  SELECT r, k, substr(h, 800 * k + 1, 1598) AS h FROM (SELECT r, h, unnest(range(0, n_bytes // 400 + 1)) AS k FROM n)),
w AS MATERIALIZED (
  SELECT r, 400 * k + i AS p, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 800)) AS m
  FROM (SELECT r, k, h, unnest(range(0, least(400, length(h) // 2 - 399))) AS i FROM c WHERE length(h) >= 800)),
hit AS (SELECT r, p FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
g AS (
  SELECT r, p, sum(CASE WHEN p > before + 400 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS run
  FROM (SELECT *, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM hit)),
s AS (SELECT r, min(p) AS a, max(p) + 400 AS b FROM g GROUP BY r, run),
kept AS (
  SELECT r, string_agg(substr(h, CAST(2 * f + 1 AS BIGINT), CAST(2 * (t - f) AS BIGINT)), '' ORDER BY f) AS h FROM (
    SELECT n.r, h, coalesce(lag(b) OVER (PARTITION BY n.r ORDER BY a), 0) AS f, a AS t FROM n JOIN s ON s.r = n.r
    UNION ALL SELECT n.r, h, coalesce(b, 0), n_bytes FROM n LEFT JOIN (SELECT r, max(b) AS b FROM s GROUP BY r) e ON e.r = n.r)
  GROUP BY r)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(x.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(x.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM n JOIN kept ON kept.r = n.r
LEFT JOIN (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM s GROUP BY r) x ON x.r = n.r
"""


def _merkle(levels: int, groups: int) -> str:
    """SQL of the manifest: so many levels of 16 for the rows of a source, and for the sources."""

    def field(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def reduce(name: str, steps: int) -> str:
        """name0 (s, p, h, t) upwards: name_r0 the runs of a level, name1 their nodes."""
        parts = []
        for k in range(steps):
            parts.append(f"""{name}_r{k} AS MATERIALIZED (
  SELECT s, p // 16 AS q, list(h ORDER BY p) AS l, max(t) AS t FROM {name}{k} GROUP BY s, p // 16),
{name}{k + 1} AS MATERIALIZED (
  SELECT s, q AS p, CASE WHEN t = 1 THEN l[1] ELSE sha256(array_to_string(l, '')) END AS h, (t + 15) // 16 AS t
  FROM {name}_r{k})""")
        return ",\n".join(parts)

    def climb(name: str, start: str, steps: int, group: str) -> str:
        """name0..: the siblings so far (proof) and the digest folded so far (cur) of each row."""
        parts = [f"{name}0 AS ({start})"]
        for k in range(steps):
            i = f"CAST((p // {16**k}) % 16 AS INTEGER)"
            before, after = f"array_to_string(r.l[1:{i}], '')", f"array_to_string(r.l[{i} + 2:], '')"
            parts.append(f"""{name}{k + 1} AS (
  SELECT c.* EXCLUDE (proof, cur),
         proof || CASE WHEN r.t = 1 THEN '' ELSE {before} || {after} END AS proof,
         CASE WHEN r.t = 1 THEN cur ELSE sha256({before} || cur || {after}) END AS cur
  FROM {name}{k} c JOIN {group}_r{k} r ON r.s = c.s AND r.q = c.p // {16 ** (k + 1)})""")
        return ",\n".join(parts)

    digits = "CAST(doc_id AS VARCHAR)"
    codes = f"list_transform(range(strlen({digits})), lambda i: CAST(ascii(substr({digits}, CAST(i + 1 AS INTEGER), 1)) AS BIGINT))"
    step = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {step}), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS s, {leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS claimed
  FROM documents),
x AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
         count(*) OVER (PARTITION BY s) AS t
  FROM d),
a0 AS (SELECT s, p, leaf AS h, t FROM x),
{reduce("a", levels)},
g AS MATERIALIZED (
  SELECT s AS name, h AS subroot, row_number() OVER (ORDER BY s) - 1 AS p, count(*) OVER () AS t FROM a{levels}),
b0 AS (SELECT 0 AS s, p, subroot AS h, t FROM g),
{reduce("b", groups)},
{climb("c", "SELECT *, '' AS proof, claimed AS cur FROM x", levels, "a")},
{climb("e", f"SELECT c.doc_id, c.leaf, g.subroot, 0 AS s, g.p, c.proof, c.cur FROM c{levels} c JOIN g ON g.name = c.s", groups, "b")}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM e{groups} e CROSS JOIN b{groups} r
"""


#: 16^6 rows of a source, 16^4 sources
ORACLES["op11_merkle_manifest"] = _merkle(6, 4)

ORACLES["op13_phrase_collocations"] = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)),
s AS (
  SELECT lang, k, list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' ')) AS grams
  FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
g AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(grams) AS phrase FROM s) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 30),
t AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.ws, x.f AS l, y.f AS r, cut,
         CAST((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1:], ' ')),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS longest
  FROM (SELECT lang, a, unnest(list_transform(range(1, k - j + 2), lambda i: array_to_string(ws[i:i + j - 1], ' '))) AS phrase
        FROM (SELECT *, unnest(range(2, k)) AS j FROM c))
  GROUP BY ALL),
z AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.longest IS NULL OR 100::HUGEINT * o.longest < 80::HUGEINT * b.a)
SELECT z.lang, z.rank, z.phrase, z.a, z.l, z.r, n.n, z.score FROM z JOIN n ON n.lang = z.lang WHERE z.rank <= 2000
"""


def _licences() -> str:
    """SQL of the licence scan: every line and paragraph against every template."""
    from .licenses import TEMPLATES

    quoted = [(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(TEMPLATES)]
    listed = ", ".join(f"({k}, '{name}', '{text}')" for k, name, text in quoted)
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH t(k, name, text) AS (VALUES {listed}),
tw AS MATERIALIZED (
  SELECT k, w, count(*) AS n FROM (SELECT k, unnest(regexp_extract_all({lower.format("text")}, {word})) AS w FROM t) GROUP BY ALL),
f AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, concat_ws('/', source,
      CASE WHEN n_chars < 400 THEN NULL ELSE lang END,
      CASE WHEN n_chars < 1500 THEN NULL ELSE CAST(doc_id // 1000 AS VARCHAR) END) || '/' || doc_id || '.txt' AS path
  FROM documents),
l AS (SELECT r, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT r, string_split(text, chr(10)) AS x FROM f)),
p AS (
  SELECT r, i, line, sum(CASE WHEN regexp_matches(line, '^[ \t\v\f\r]*$') THEN 1 ELSE 0 END)
    OVER (PARTITION BY r ORDER BY i) AS part FROM l),
tok AS MATERIALIZED (
  SELECT r, i, part, w, count(*) AS n FROM (
    SELECT r, i, part, unnest(regexp_extract_all({lower.format("line")}, {word})) AS w FROM p) GROUP BY ALL),
idf AS MATERIALIZED (
  SELECT w, ln((1 + (SELECT count(*) FROM f)) / (1 + count(DISTINCT r))) + 1 AS idf
  FROM (SELECT DISTINCT w FROM tw) LEFT JOIN tok USING (w) GROUP BY w),
unit AS MATERIALIZED (
  SELECT r, kind, u, w, n, n * coalesce(idf, (SELECT ln(1 + count(*)) + 1 FROM f)) AS x FROM (
    SELECT r, 0 AS kind, i AS u, w, n FROM tok
    UNION ALL SELECT r, 1, part, w, sum(n) FROM tok GROUP BY r, part, w) LEFT JOIN idf USING (w)),
norm AS (SELECT r, kind, u, sqrt(sum(x * x)) AS norm, sum(n) AS size FROM unit GROUP BY ALL),
tx AS (SELECT k, w, n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY k)) AS x FROM tw JOIN idf USING (w)),
alike AS (
  SELECT r, kind, u, k, size, s / norm AS s
  FROM (SELECT r, kind, u, k, sum(unit.x * tx.x) AS s FROM unit JOIN tx USING (w) GROUP BY ALL) JOIN norm USING (r, kind, u)
  WHERE s / norm >= 0.8 - 1e-12),
best AS (
  SELECT * FROM alike
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY round(s, 9) DESC, kind, k, u DESC) = 1),
own AS MATERIALIZED (
  SELECT f.r, doc_id, path, name, round(s, 6) AS score, regexp_replace(path, '(^|/)[^/]*$', '') AS dir,
    size / (SELECT sum(n) FROM tok WHERE tok.r = f.r) AS share
  FROM f LEFT JOIN best ON best.r = f.r LEFT JOIN t ON t.k = best.k),
files AS (
  SELECT dir AS above, doc_id AS from_id, name FROM own
  WHERE name IS NOT NULL AND (share >= 0.5 OR regexp_matches(path, '(?i)(^|/)(licen[cs]e|copying|unlicen[cs]e|notice)([.-][^/]*)?$'))
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY -score, path, doc_id, name) = 1),
near AS (
  SELECT dir, from_id, name AS inherited
  FROM (SELECT DISTINCT dir FROM own) JOIN files ON above = '' OR above = dir OR starts_with(dir, above || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(above) DESC, from_id DESC, name DESC) = 1)
SELECT doc_id, path, name AS own_license, score, coalesce(name, inherited) AS license,
  CASE WHEN name IS NULL THEN from_id END AS inherited_from
FROM own LEFT JOIN near ON near.dir = own.dir
"""


ORACLES["op9_license_scan"] = _licences()
