"""DuckDB SQL of the queries that SQL can express, over the driver's views."""

from __future__ import annotations

from recsift.llm.ego_join import COSINE
from recsift.llm.mixing import MOST, SALT, SHARE, SLOPES, WEIGHTS

_BENCH = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def _spread(salt: int, key: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def _components(links: str, ids: str) -> str:
    """CTEs ``reach`` and ``comp(id, component)`` from ``links(a, b)``, both ways."""
    return f"""reach AS (SELECT a, b FROM {links} UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON r.b = l.a),
comp AS (SELECT i.id, least(i.id, coalesce(min(r.b), i.id)) AS component
         FROM {ids} i LEFT JOIN reach r ON r.a = i.id GROUP BY i.id)"""


SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
win AS (SELECT doc_id, i AS start, array_to_string(w[i:i + 19], ' ') AS t
        FROM d, unnest(range(1, greatest(len(w) - 18, 1))) u(i)),
ranked AS (SELECT doc_id, start, row_number() OVER (PARTITION BY t ORDER BY doc_id, start) AS nth FROM win),
gone AS (SELECT DISTINCT doc_id, start + j AS pos FROM ranked, range(0, 20) r(j) WHERE nth > 1),
words AS (SELECT doc_id, pos, w[pos] AS word FROM d, unnest(range(1, len(w) + 1)) u(pos)),
kept AS (SELECT k.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
         FROM words k ANTI JOIN gone g ON k.doc_id = g.doc_id AND k.pos = g.pos GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

EGO_JOIN = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id <> y.id
          WHERE list_cosine_similarity(x.e, y.e) >= {COSINE}),
ids AS (SELECT vec_id AS id FROM embeddings),
{_components("links", "ids")},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.id AS vec_id, coalesce(n.n, 0) AS n_links, component AS component_id, c.id = component AS kept
FROM comp c LEFT JOIN n ON n.a = c.id"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, payload_bytes, d.payload_digest,
       CASE WHEN d.page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest"""

_MIXTURE = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS.format("text")}) AS BIGINT) AS size,
                  {_spread(SALT, "doc_id")} AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1)
              % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight, CAST({MOST} * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE} - coalesce(sum(cap) OVER fill, 0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0)) AS lev FROM w
      WINDOW fill AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT lev AS level FROM l WHERE cap > lev * weight ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM o) * weight, cap)) AS target FROM l),
g AS (SELECT source, CAST([{", ".join(map(str, SLOPES))}][ascii(md5(coalesce(source, '')))
             % {len(SLOPES)} + 1] AS DOUBLE) AS a FROM s),
c AS (SELECT d.*, row_number() OVER () AS r, coalesce(sum(size) OVER (PARTITION BY source
             ORDER BY h, CAST(doc_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
x AS (SELECT r, doc_id, i AS copy, a, least((CAST(before AS DOUBLE) + t.source_size * i) / target, CAST(1 AS DOUBLE)) AS x
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source JOIN g ON c.source IS NOT DISTINCT FROM g.source,
           range({MOST}) n(i)
      WHERE CAST(before AS DOUBLE) + t.source_size * i + size / 2.0 < target),
p AS (SELECT r, doc_id, copy,
             CASE WHEN abs(a) < 1e-9 THEN x ELSE (sqrt((1 - a) * (1 - a) + 4 * a * x) - (1 - a)) / (2 * a) END AS position
      FROM x)"""

# The tables of the mixture, then a row for each document.
MIXING = f"""{_MIXTURE}
SELECT c.doc_id, size, source_size, target, CAST(size * coalesce(n, 0) AS BIGINT) AS taken, first_position, last_position
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
     LEFT JOIN (SELECT r, count(*) AS n, min(position) AS first_position, max(position) AS last_position
                FROM p GROUP BY r) q ON q.r = c.r"""

# The same, then a row for each copy.
POSITIONS = f"""{_MIXTURE}
SELECT doc_id, CAST(copy AS BIGINT) AS copy, position FROM p"""


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id AS id, {_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
sh AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS t
       FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) u(i) WHERE len(w) > 0),
n AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
both_ AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM sh x JOIN sh y ON x.t = y.t AND x.id <> y.id
          GROUP BY x.id, y.id),
links AS (SELECT a, b FROM both_ JOIN n x ON x.id = a JOIN n y ON y.id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
{_components("links", "d")}
SELECT c.id AS doc_id, coalesce(n.n, 0) AS n_shingles, component AS component_id
FROM comp c LEFT JOIN n ON n.id = c.id"""


CONTAMINATION = f"""
WITH b AS (SELECT item_id, {_BENCH.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS t
        FROM b, unnest(range(1, greatest(len(w) - 8, 2))) u(i) WHERE len(w) > 0),
d AS (SELECT doc_id, {_BENCH.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
found AS (SELECT d.doc_id, i AS start, x.n, item_id
          FROM d, (SELECT DISTINCT n FROM win) x, unnest(range(1, greatest(len(w) - x.n + 2, 1))) u(i)
          JOIN win ON win.n = x.n AND win.t = array_to_string(w[i:i + x.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT start + j) AS n FROM found, unnest(range(0, n)) r(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


def _leaf(text: str) -> str:
    told = [f"coalesce(concat(strlen({c}), ':', {c}), '-')"
            for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
    return f"sha256(concat({', '.join(told)}))"


def _tree(name: str, leaves: str) -> str:
    """CTE ``name(tree, lev, i, h, n)``: every node, level by level; ``n``: the level's size."""
    return f"""{name} AS (SELECT tree, 0 AS lev, i, h, n FROM {leaves}
  UNION ALL SELECT tree, lev + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY tree, lev, i // 16)"""


# CRC-32 bit by bit: a byte (as 256 and more) is put in, and eight shifts follow.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: CASE WHEN x > 0 THEN xor(c, x - 256)
  WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE leaves AS (SELECT doc_id, source, {_leaf("text")} AS h, CASE WHEN {_CRC} % 5 = 0
             THEN {_leaf(_LOWER.format("text"))} END AS other FROM documents),
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER () AS n
            FROM (SELECT DISTINCT source FROM documents) x),
named AS (SELECT doc_id, tree, h, other, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i,
                 count(*) OVER (PARTITION BY tree) AS n
          FROM leaves JOIN sources ON leaves.source IS NOT DISTINCT FROM sources.source),
{_tree("low", "named")},
subroots AS (SELECT 0 AS tree, low.tree AS i, h, sources.n FROM low JOIN sources ON low.tree = sources.tree
             WHERE low.n = 1),
{_tree("high", "subroots")},
steps AS (SELECT doc_id, lev, a.i >> CAST(4 * lev AS INT) AS i, a.tree AS low, 0 AS top
          FROM named a JOIN (SELECT DISTINCT tree, lev FROM low WHERE n > 1) l ON a.tree = l.tree
          UNION ALL SELECT doc_id, 100 + lev, a.tree >> CAST(4 * lev AS INT), NULL, 1
          FROM named a, (SELECT DISTINCT lev FROM high WHERE n > 1) l),
nodes AS (SELECT tree, lev, i, h, 0 AS top FROM low UNION ALL SELECT NULL, 100 + lev, i, h, 1 FROM high),
sides AS (SELECT doc_id, s.lev, coalesce(string_agg(h, '' ORDER BY n.i) FILTER (n.i < s.i), '') AS l,
                 coalesce(string_agg(h, '' ORDER BY n.i) FILTER (n.i > s.i), '') AS r
          FROM steps s JOIN nodes n ON s.lev = n.lev AND s.low IS NOT DISTINCT FROM n.tree
               AND s.i // 16 = n.i // 16
          GROUP BY doc_id, s.lev),
path AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lev) AS step FROM sides),
proof AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS p FROM path GROUP BY doc_id),
folds AS (SELECT doc_id, 0 AS step, coalesce(other, h) AS h FROM named
          UNION ALL SELECT f.doc_id, p.step, sha256(concat(l, f.h, r)) FROM folds f JOIN path p
          ON f.doc_id = p.doc_id AND p.step = f.step + 1),
folded AS (SELECT doc_id, arg_max(h, step) AS h FROM folds GROUP BY doc_id),
root AS (SELECT h FROM high WHERE n = 1)
SELECT a.doc_id, a.h AS leaf, subroots.h AS subroot, root.h AS root, coalesce(p, sha256('')) AS proof_sha256,
       folded.h AS folded_root, folded.h = root.h AS verified
FROM named a JOIN subroots ON a.tree = subroots.i JOIN folded ON a.doc_id = folded.doc_id
     LEFT JOIN proof ON a.doc_id = proof.doc_id, root"""
