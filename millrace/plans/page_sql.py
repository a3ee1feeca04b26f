"""SQL form of the page family, for the oracle only.

A recursive query walks each page's tokens with an open-element stack. It knows the tags that
occur in the given pages (and the inserted editor lines) and shares nothing with the parser,
so both sides agree only if both are right.
"""

from __future__ import annotations

EDITOR_WORD_ROWS = (
    "(1, '责任编辑'), (2, '责编'), (3, '本文来源'), (4, '编辑：'), (5, '编辑:'), (6, '来源：'), (7, '本报记者')"
)


def tree_ctes(source: str) -> str:
    """CTEs `nodes` and `pieces` over `source` (page_id, html); to follow WITH RECURSIVE."""
    return f"""
src AS ({source}),
raw AS (
  SELECT page_id, regexp_extract_all(html,
    '(?s)<script.*?</script>|<style.*?</style>|<title>.*?</title>|<!--.*?-->|<[^>]*(?:>|\\z)|[^<]+') AS toks
  FROM src),
ix AS (SELECT page_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM raw),
cls AS (
  SELECT page_id, i, toks[i] AS tok,
    CASE WHEN toks[i] LIKE '<!%' OR (toks[i] LIKE '<%' AND toks[i] NOT LIKE '%>') THEN 'skip'
         WHEN toks[i] LIKE '</%' THEN 'end'
         WHEN toks[i] LIKE '<%' THEN 'start' ELSE 'text' END AS kind,
    lower(regexp_extract(toks[i], '^</?([a-zA-Z0-9]+)', 1)) AS tag
  FROM ix),
tok AS (
  SELECT page_id, i, tok, kind, tag,
    CASE WHEN kind = 'skip' OR (kind = 'start' AND tag IN ('html', 'head'))
              OR (kind = 'end' AND tag IN ('html', 'body')) THEN 'none'
         WHEN kind = 'end' AND tag = 'head' THEN 'headend'
         WHEN kind = 'end' THEN 'close'
         WHEN kind = 'start' AND tag IN ('meta', 'script', 'style', 'title') THEN 'leaf'
         WHEN kind = 'start' AND tag = 'body' THEN 'body'
         WHEN kind = 'start' AND tag = 'br' THEN 'br'
         WHEN kind = 'start' AND tag IN ('b', 'span', 'a') THEN 'inline'
         WHEN kind = 'start' THEN 'block' ELSE 'text' END AS act
  FROM cls),
walk AS (
  SELECT page_id, 0 AS i, 2 AS n, [0, 1] AS ids, ['html', 'head'] AS tags,
         CAST([] AS INTEGER[]) AS fb, 0 AS r, -1 AS top, 0 AS d, '' AS opened, 'none' AS act
  FROM src
  UNION ALL
  SELECT page_id, i, n + r + CASE WHEN opened <> '' THEN 1 ELSE 0 END AS n,
    CASE WHEN act IN ('block', 'inline', 'body')
         THEN list_append(list_concat(bids, range(n, n + r)), n + r)
         ELSE list_concat(bids, range(n, n + r)) END AS ids,
    CASE WHEN act IN ('block', 'inline', 'body')
         THEN list_append(list_concat(btags, (['b', 'b', 'b'])[1:r]), opened)
         ELSE list_concat(btags, (['b', 'b', 'b'])[1:r]) END AS tags,
    CASE WHEN opened = 'b' THEN
           list_append((CASE WHEN r > 0 THEN range(n, n + r) ELSE fb END)
             [(CASE WHEN len(fb) >= 3 THEN 2 ELSE 1 END):], n + r)
         WHEN r > 0 THEN range(n, n + r) ELSE fb END AS fb,
    r, bids[-1] AS top, len(bids) AS d, opened, act
  FROM (
    SELECT *, CASE WHEN act IN ('text', 'inline', 'br') AND list_contains(btags, 'body') AND len(fb) > 0
                        AND NOT list_contains(bids, fb[-1]) THEN len(fb) ELSE 0 END AS r,
      CASE WHEN act IN ('block', 'inline', 'leaf', 'br', 'body') THEN tag ELSE '' END AS opened
    FROM (
      SELECT w.page_id, t.i, w.n, w.fb, t.act, t.tag,
        CASE WHEN keep IS NULL THEN w.ids ELSE w.ids[1:keep] END AS bids,
        CASE WHEN keep IS NULL THEN w.tags ELSE w.tags[1:keep] END AS btags
      FROM (
        SELECT v.*, t2.act AS nact, t2.tag AS ntag,
          CASE WHEN t2.act IN ('headend', 'body') THEN 1
               WHEN t2.act = 'block' AND list_contains(v.tags, 'p')
                 THEN len(v.tags) - list_position(list_reverse(v.tags), 'p')
               WHEN t2.act = 'close' AND list_contains(v.tags, t2.tag)
                 THEN len(v.tags) - list_position(list_reverse(v.tags), t2.tag)
          END AS keep
        FROM walk v JOIN tok t2 ON t2.page_id = v.page_id AND t2.i = v.i + 1) w
      JOIN tok t ON t.page_id = w.page_id AND t.i = w.i + 1))),
reopened AS (
  SELECT page_id, i, n - r - CASE WHEN opened <> '' THEN 1 ELSE 0 END AS n0, r, top, d, opened, act
  FROM walk WHERE i > 0),
ks AS (SELECT unnest([1, 2, 3]) AS k),
bare AS (
  SELECT page_id, 0 AS node, -1 AS parent, 0 AS depth, 'html' AS tag, 0 AS i FROM src
  UNION ALL SELECT page_id, 1, 0, 1, 'head', 0 FROM src
  UNION ALL SELECT page_id, n0 + k - 1, CASE WHEN k = 1 THEN top ELSE n0 + k - 2 END, d + k - 1, 'b', i
    FROM reopened, ks WHERE k <= r
  UNION ALL SELECT page_id, n0 + r, CASE WHEN r > 0 THEN n0 + r - 1 ELSE top END, d + r, opened, i
    FROM reopened WHERE opened <> ''),
spans AS (
  SELECT page_id, node, min(nxt) AS nxt FROM (
    SELECT a.page_id, a.node, b.node AS nxt FROM bare a JOIN bare b
      ON a.page_id = b.page_id AND b.node > a.node AND b.depth <= a.depth) GROUP BY 1, 2),
sizes AS (SELECT page_id, max(node) AS greatest FROM bare GROUP BY 1),
ranged AS (
  SELECT a.page_id, a.node, a.parent, a.depth, a.tag, a.i, coalesce(s.nxt - 1, z.greatest) AS last,
    coalesce(regexp_extract(t.tok, 'class="([^"]*)"', 1), '') AS cls
  FROM bare a JOIN sizes z ON z.page_id = a.page_id
  LEFT JOIN spans s ON s.page_id = a.page_id AND s.node = a.node
  LEFT JOIN tok t ON t.page_id = a.page_id AND t.i = a.i AND a.tag = t.tag),
body AS (SELECT page_id, min(node) AS body FROM ranged WHERE tag = 'body' GROUP BY 1),
cuts AS (
  SELECT r.page_id, r.node, r.last FROM ranged r JOIN body b ON b.page_id = r.page_id
  WHERE r.node > b.body AND r.tag IN ('a', 'link', 'script', 'input', 'form', 'noscript', 'style', 'iframe', 'ul')),
cutnodes AS (
  SELECT DISTINCT r.page_id, r.node FROM ranged r JOIN cuts c
    ON c.page_id = r.page_id AND r.node >= c.node AND r.node <= c.last),
texts AS (
  SELECT page_id, i, 2 AS o, owner AS node,
    regexp_replace(replace(replace(replace(regexp_replace(body, '&amp;?', chr(1), 'g'),
      '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '[ \\t\\n\\f\\r]+', ' ', 'g') AS txt
  FROM (
    SELECT r.page_id, r.i, CASE WHEN r.act = 'leaf' THEN r.n0
             WHEN r.r > 0 THEN r.n0 + r.r - 1 ELSE r.top END AS owner,
      CASE WHEN r.act = 'leaf' THEN regexp_replace(t.tok, '</?title>', '', 'g') ELSE t.tok END AS body
    FROM reopened r JOIN tok t ON t.page_id = r.page_id AND t.i = r.i
    WHERE r.act = 'text' OR (r.act = 'leaf' AND r.opened = 'title'))),
pieces AS (
  SELECT p.page_id, p.i, p.o, p.node, replace(p.txt, chr(1), '&') AS txt, c.node IS NOT NULL AS cut
  FROM (SELECT page_id, i, o, node, txt FROM texts
        UNION ALL SELECT page_id, i, 1, node, ' ' FROM ranged WHERE tag NOT IN ('b', 'span', 'a')) p
  LEFT JOIN cutnodes c ON c.page_id = p.page_id AND c.node = p.node),
owned AS (
  SELECT page_id, node, trim(regexp_replace(string_agg(txt, '' ORDER BY i, o), ' +', ' ', 'g')) AS own FROM (
    SELECT page_id, i, o, node, replace(txt, chr(1), '&') AS txt FROM texts
    UNION ALL SELECT page_id, i, 1, parent, ' ' FROM ranged WHERE tag = 'br') GROUP BY 1, 2),
whole AS (
  SELECT r.page_id, r.node,
    trim(regexp_replace(string_agg(p.txt, '' ORDER BY p.i, p.o), ' +', ' ', 'g')) AS txt
  FROM ranged r JOIN pieces p ON p.page_id = r.page_id AND p.node >= r.node AND p.node <= r.last AND NOT p.cut
  GROUP BY 1, 2),
nodes AS (
  SELECT r.page_id, r.node, r.parent, r.last, r.depth, r.tag, '' AS id, r.cls, c.node IS NOT NULL AS cut,
    coalesce(o.own, '') AS own_text, CASE WHEN c.node IS NULL THEN coalesce(w.txt, '') ELSE '' END AS txt,
    CAST(CASE WHEN c.node IS NULL THEN coalesce(length(w.txt)
      + length(regexp_replace(w.txt, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')), 0) ELSE 0 END AS INTEGER) AS text_len
  FROM ranged r LEFT JOIN cutnodes c ON c.page_id = r.page_id AND c.node = r.node
  LEFT JOIN owned o ON o.page_id = r.page_id AND o.node = r.node
  LEFT JOIN whole w ON w.page_id = r.page_id AND w.node = r.node)"""


MINING_CTES = f"""
live AS (SELECT * FROM nodes WHERE NOT cut),
block AS (
  SELECT page_id, node, tag, text_len FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l.page_id ORDER BY l.text_len DESC, l.node) AS k
    FROM live l JOIN body b ON b.page_id = l.page_id AND l.parent = b.body WHERE l.text_len >= 50)
  WHERE k = 1),
startel AS (
  SELECT b.page_id, coalesce(min(c.node), min(b.node)) AS node FROM block b LEFT JOIN live c
    ON c.page_id = b.page_id AND c.parent = b.node AND c.text_len / CAST(b.text_len AS DOUBLE) >= 0.65
  GROUP BY 1),
kids AS (
  SELECT page_id, parent, count(*) FILTER (WHERE tag = 'p') AS n_p,
    coalesce(sum(text_len) FILTER (WHERE tag = 'p'), 0) AS p_len FROM live GROUP BY 1, 2),
descent AS (
  SELECT page_id, node, 0 AS step FROM startel
  UNION ALL
  SELECT x.page_id, c.node, x.step + 1 FROM descent x
  JOIN live h ON h.page_id = x.page_id AND h.node = x.node
  JOIN live c ON c.page_id = x.page_id AND c.parent = x.node AND h.text_len > 0
    AND c.text_len / CAST(h.text_len AS DOUBLE) >= 0.65
  LEFT JOIN kids k ON k.page_id = x.page_id AND k.parent = x.node
  WHERE NOT (coalesce(k.n_p, 0) > 0 AND (k.p_len = 0 OR k.p_len / CAST(h.text_len AS DOUBLE) >= 0.65))),
deepest AS (SELECT page_id, arg_max(node, step) AS node FROM descent GROUP BY 1),
chosen AS (
  SELECT d.page_id, s.node AS start_node,
    CASE WHEN coalesce(k.n_p, 0) > 0 THEN d.node ELSE s.node END AS node
  FROM deepest d JOIN startel s ON s.page_id = d.page_id
  LEFT JOIN kids k ON k.page_id = d.page_id AND k.parent = d.node),
labels_ AS (
  SELECT page_id, node, last, depth, tag || CASE WHEN cls <> '' AND tag NOT IN ('html', 'body')
    THEN '[@class=''' || cls || ''']' ELSE '' END AS label, tag FROM nodes),
paths AS (
  SELECT n.page_id, n.node, '/' || string_agg('/' || a.label, '' ORDER BY a.depth) AS path,
    '/' || string_agg('/' || a.tag, '' ORDER BY a.depth) AS tag_path
  FROM nodes n JOIN labels_ a ON a.page_id = n.page_id AND n.node >= a.node AND n.node <= a.last GROUP BY 1, 2),
content AS (
  SELECT c.page_id, c.start_node, n.node, n.tag, n.text_len, p.path FROM chosen c
  JOIN nodes n ON n.page_id = c.page_id AND n.node = c.node
  JOIN paths p ON p.page_id = c.page_id AND p.node = c.node),
words(w_no, word) AS (VALUES {EDITOR_WORD_ROWS}),
named AS (
  SELECT c.page_id, c.path, c.tag AS content_tag, e.node, e.tag, w.word FROM content c
  JOIN live e ON e.page_id = c.page_id AND e.parent = c.node AND c.text_len > 0
    AND e.text_len / CAST(c.text_len AS DOUBLE) <= 1 - 0.65
  JOIN words w ON contains(e.txt, w.word)),
shaped AS (
  SELECT m.page_id, m.path, m.content_tag, m.node, m.tag, m.word,
    arg_min(s.tag, s.node) AS first_tag, count(s.node) AS n_sub,
    arg_min(s.tag, s.node) FILTER (WHERE contains(s.txt, m.word)) AS naming_tag
  FROM named m LEFT JOIN live s ON s.page_id = m.page_id AND s.parent = m.node GROUP BY 1, 2, 3, 4, 5, 6),
negative AS (
  SELECT DISTINCT page_id, xpath FROM (
    SELECT page_id, path, CASE
      WHEN tag <> 'p' AND content_tag = 'p' THEN path || '/' || tag
      WHEN tag <> 'p' AND n_sub = 0 THEN path || '/' || tag || '[text()*=' || word || ']'
      WHEN tag <> 'p' AND first_tag = 'p' THEN path || '/' || tag || '/p[text()*=' || word || ']'
      WHEN tag <> 'p' THEN path || '/' || tag || '/' || first_tag || '/span[text()*=' || word || ']'
      WHEN n_sub = 0 THEN path || '/p[text()*=' || word || ']'
      ELSE path || CASE WHEN content_tag = 'p' THEN '' ELSE '/p' END
        || CASE WHEN naming_tag IS NOT NULL THEN '/' || naming_tag ELSE '[text()*=' || word || ']' END
      END AS xpath FROM shaped) WHERE xpath <> path)"""


HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)"

VALID_PAGES = "SELECT page_id, html FROM page_records WHERE n_fields = 3 AND page_id % 10 <> 9"

RULE_CTES = f"""
page_host AS (SELECT page_id, url, {HOST_SQL} AS host FROM pages),
scores AS (
  SELECT h.host, c.path AS xpath, count(*) AS score FROM content c JOIN page_host h ON h.page_id = c.page_id
  GROUP BY 1, 2),
ranks AS (
  SELECT host, xpath, score, row_number() OVER (PARTITION BY host ORDER BY score DESC, xpath DESC) AS rank FROM scores),
negatives AS (
  SELECT DISTINCT h.host, n.xpath FROM negative n JOIN page_host h ON h.page_id = n.page_id),
rules AS (
  SELECT host, xpath, true AS is_positive FROM ranks WHERE rank <= 2
  UNION ALL SELECT host, xpath, false FROM negatives)"""

EXTRACT_CTES = """
ruled AS (
  SELECT h.page_id, r.xpath, r.is_positive, regexp_replace(r.xpath, '\\[text\\(\\)\\*=.*$', '') AS base,
    regexp_extract(r.xpath, '\\[text\\(\\)\\*=(.*)\\]$', 1) AS word
  FROM rules r JOIN page_host h ON h.host = r.host JOIN src s ON s.page_id = h.page_id),
hits AS (
  SELECT u.page_id, u.xpath, u.is_positive, n.node, n.last FROM ruled u
  JOIN paths p ON p.page_id = u.page_id AND (p.path = u.base OR p.tag_path = u.base)
  JOIN nodes n ON n.page_id = u.page_id AND n.node = p.node AND contains(n.own_text, u.word)),
removed AS (
  SELECT DISTINCT a.page_id, a.xpath, a.node, p.i, p.o FROM hits a
  JOIN hits x ON x.page_id = a.page_id AND NOT x.is_positive AND x.node > a.node AND x.node <= a.last
  JOIN pieces p ON p.page_id = a.page_id AND p.node >= x.node AND p.node <= x.last
  WHERE a.is_positive),
remaining AS (
  SELECT a.page_id, a.xpath, a.node,
    trim(regexp_replace(string_agg(p.txt, '' ORDER BY p.i, p.o), ' +', ' ', 'g')) AS txt
  FROM hits a JOIN pieces p ON p.page_id = a.page_id AND p.node >= a.node AND p.node <= a.last
  LEFT JOIN removed x ON x.page_id = a.page_id AND x.xpath = a.xpath AND x.node = a.node AND x.i = p.i AND x.o = p.o
  WHERE a.is_positive AND x.page_id IS NULL GROUP BY 1, 2, 3),
by_rule AS (
  SELECT page_id, xpath, ltrim(string_agg(txt, ' ' ORDER BY node)) AS txt FROM remaining GROUP BY 1, 2),
contents AS (SELECT page_id, string_agg(txt, '' ORDER BY xpath) AS content FROM by_rule GROUP BY 1),
outcomes AS (
  SELECT r.page_id, r.url, h.host,
    CASE WHEN v.page_id IS NULL THEN 'filtered' ELSE 'ok' END AS status,
    CASE WHEN v.page_id IS NULL THEN NULL
         WHEN k.host IS NULL THEN 'no_match'
         WHEN length(trim(coalesce(c.content, ''))) >= 10 THEN 'extract' ELSE 'empty' END AS outcome,
    CASE WHEN v.page_id IS NOT NULL AND k.host IS NOT NULL THEN coalesce(c.content, '') END AS content,
    v.html
  FROM page_records r LEFT JOIN src v ON v.page_id = r.page_id
  JOIN (SELECT page_id, CASE WHEN page_id % 17 = 16 THEN 'HOST_NULL' ELSE host END AS host FROM page_host) h
    ON h.page_id = r.page_id
  LEFT JOIN (SELECT DISTINCT host FROM rules) k ON k.host = h.host
  LEFT JOIN contents c ON c.page_id = r.page_id)"""
