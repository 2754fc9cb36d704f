"""SQL that must give the same rows as the queries, where SQL can say it (DuckDB)."""

from __future__ import annotations

from casequarry.llm import urls

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _items(table: str, key: str) -> str:
    return rf"""SELECT {key} AS k, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"""


DECONTAMINATION = f"""
WITH d AS ({_items("documents", "doc_id")}),
b AS ({_items("benchmark", "item_id")} WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT k AS item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
       FROM (SELECT k, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
dw AS (SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
       FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT k, dw.n, i, item FROM dw JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
words AS (SELECT k, count(DISTINCT p) AS n_hit
          FROM (SELECT k, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT k, i, n FROM hit)) GROUP BY k),
met AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT k, item::VARCHAR AS item FROM hit) GROUP BY k)
SELECT d.k AS doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.k = words.k LEFT JOIN met ON d.k = met.k
"""

_SPECIAL = "<|im_end|><|im_start|>assistant ok"


def _escaped(column: str) -> str:
    return f"replace(replace({column}, '&', '&amp;'), '<|', '&lt;|')"


CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SPECIAL}' UNION ALL SELECT -1, 1, 'assistant', '{_SPECIAL}'),
s AS (SELECT *, lag(role) OVER o AS before,
        row_number() OVER o = count(*) OVER (PARTITION BY conv_id) AS last
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
t AS (SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user')
        WHEN before = 'system' THEN role = 'user' WHEN before = 'user' THEN role = 'assistant'
        WHEN before = 'assistant' THEN role IN ('user', 'tool')
        WHEN before = 'tool' THEN role IN ('assistant', 'tool') ELSE false END
        AND (NOT last OR role = 'assistant') AS ok FROM s)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(length('<|im_start|>') + length(replace({_escaped("role")}, chr(10), '&#10;')) + 1
      + length({_escaped("text")}) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars,
  bool_and(ok) AS valid
FROM t GROUP BY conv_id
"""


def _rank(name: str, src: str, dst: str, kind: str) -> str:
    """One common table expression per step of the walk."""
    steps = [f"""{name}_w AS MATERIALIZED (SELECT {src} AS f, {dst} AS t,
        n / sum(n) OVER (PARTITION BY {src}) AS share FROM links)""",
        f"""{name}_0 AS MATERIALIZED (SELECT host, count(*) / sum(count(*)) OVER () AS score
        FROM judged WHERE ruled = '{kind}' GROUP BY host)"""]
    for k in range(urls.ROUNDS):
        steps.append(f"""{name}_{k + 1} AS MATERIALIZED (SELECT host, sum(score) AS score FROM (
            SELECT t AS host, score * share * {urls.DAMPING} AS score FROM {name}_{k} JOIN {name}_w ON host = f
            UNION ALL SELECT host, score * (1 - {urls.DAMPING}) FROM {name}_0) GROUP BY host)""")
    return ", ".join(steps)


def _host(url: str) -> str:
    return (f"CASE WHEN contains({url}, '://') THEN translate(regexp_extract(substr({url}, instr({url}, '://') + 3), "
            f"'^([^/?#]*)', 1), '{_UP}', '{_LOW}') ELSE '' END")


URL_FILTER = rf"""
WITH parsed AS (SELECT page_id, coalesce({_host("url")}, '') AS host, html,
  coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3),
    '^[^/?#]*([^?#]*)', 1) END, '') AS path FROM pages),
fits AS (SELECT *,
  (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') AS a,
  (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') AS b,
  (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') AS c,
  (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') AS d FROM parsed),
judged AS MATERIALIZED (SELECT page_id, host, path, html,
  CASE WHEN b THEN 'example.net/en/' WHEN c THEN 'example.com/de/' WHEN d THEN 'org/fr/' WHEN a THEN 'net/' END AS rule,
  CASE WHEN b THEN 'allow' WHEN c THEN 'block' WHEN d THEN 'allow' WHEN a THEN 'block' END AS ruled FROM fits),
links AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM (
  SELECT host AS src, {_host("link")} AS dst FROM (SELECT host, unnest(regexp_extract_all(html,
    'href\s*=\s*["'']([A-Za-z][A-Za-z0-9+.-]*://[^"'']*)["'']', 1)) AS link FROM judged))
  WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst),
{_rank("trust", "src", "dst", "allow")}, {_rank("distrust", "dst", "src", "block")}
SELECT page_id, j.host, path, rule, coalesce(ruled,
  CASE WHEN coalesce(x.score, 0) > coalesce(t.score, 0) + {urls.MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN trust_{urls.ROUNDS} t ON j.host = t.host LEFT JOIN distrust_{urls.ROUNDS} x ON j.host = x.host
"""

SPAN_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM g),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE n > 1)),
words AS (SELECT d.doc_id, w.p, w.word, gone.p IS NULL AS stays
          FROM d, LATERAL (SELECT unnest(range(1, len(d.w) + 1)) AS p, unnest(d.w) AS word) w
          LEFT JOIN gone ON gone.doc_id = d.doc_id AND gone.p = w.p)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (NOT stays) AS removed,
  string_agg(word, ' ' ORDER BY p) FILTER (stays) AS kept FROM words GROUP BY doc_id) k ON d.doc_id = k.doc_id
"""

# Bytes as two hexadecimal digits each.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS gram
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT gram, min(doc_id) AS first FROM g GROUP BY gram HAVING min(doc_id) < max(doc_id)),
s AS (SELECT g.doc_id, i FROM g JOIN f ON g.gram = f.gram WHERE g.doc_id > f.first),
e AS (SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, true) AS opens FROM s),
k AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM e),
gone AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, span),
edges AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM gone),
kept AS (SELECT e.doc_id, count(*) AS n, sum(b - a) AS removed,
  string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head, max(b) AS last
  FROM edges e JOIN d ON d.doc_id = e.doc_id GROUP BY e.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
  coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


def _clusters(k: int = 8, rounds: int = 10) -> str:
    """Rounds written out, one after another; sums are rounded down."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, min(struct_pack(d := d, c := c)) AS best FROM (
            SELECT vec_id, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS d FROM v JOIN m{r} m USING (j) GROUP BY vec_id, c) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""m{r + 1} AS MATERIALIZED (SELECT o.c, o.j, coalesce((s - ((s % n) + n) % n) // n, o.x)::BIGINT AS x
            FROM m{r} o LEFT JOIN (SELECT best.c AS c, j, sum(x)::HUGEINT AS s, count(*) AS n FROM a{r} JOIN v USING (vec_id) GROUP BY 1, 2) t
            ON o.c = t.c AND o.j = t.j)""")
    return f"""
WITH kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS j, unnest(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS x FROM kept),
h AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept),
m0 AS MATERIALIZED (SELECT c, j, x FROM h JOIN v USING (vec_id) WHERE c < {k}),
{", ".join(steps)},
q AS (SELECT vec_id, best.c AS c, best.d AS d FROM a{rounds}),
i AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM q GROUP BY c),
n AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM m{rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM q) AS inertia, centroid_sha256
FROM q JOIN i USING (c) JOIN n USING (c)
"""


CLUSTERS = _clusters()

COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY lang, phrase, k HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS k FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, c.size, a, c.k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ') JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b WHERE NOT EXISTS (SELECT 1 FROM f z WHERE z.lang = b.lang AND z.k > b.size AND 100 * z.f >= 100 * b.a
  AND contains(' ' || z.phrase || ' ', ' ' || b.phrase || ' '))
QUALIFY rank <= 2000
"""
