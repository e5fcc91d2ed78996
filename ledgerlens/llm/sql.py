"""DuckDB SQL that the queries are compared with."""

from __future__ import annotations

import string

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def _level(units: str, prior: str) -> str:
    """CTEs that shrink the rates of a level towards the priors joined in ``prior``."""
    return f"""
    {units}_m AS (
      SELECT coalesce(least(greatest(CASE
               WHEN units < 2 OR k = 0 OR k = n OR n - nn / n - (units - 1) <= 0 THEN 1000.0
               WHEN kk - k * k / n - (k / n) * (1 - k / n) * (units - 1) <= 0 THEN 1000.0
               ELSE 1 / ((kk - k * k / n - (k / n) * (1 - k / n) * (units - 1))
                         / ((k / n) * (1 - k / n) * (n - nn / n - (units - 1)))) - 1 END, 1.0), 1000.0), 1000.0) AS m
      FROM (SELECT CAST(count(*) AS DOUBLE) AS units, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(k) AS DOUBLE) AS k,
                   CAST(sum(n * n) AS DOUBLE) AS nn, sum(k * k / CAST(n AS DOUBLE)) AS kk FROM {units} WHERE n > 0)),
    {units}_p AS (
      SELECT u.*, (u.k + m * p.rate) AS a, (u.n - u.k + m * (1 - p.rate)) AS b, (u.k + m * p.rate) / (u.n + m) AS rate
      FROM {prior}, {units}_m)"""


URL_FILTER = f"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
       ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    p AS (
      SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_LOWER}), '') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
             CASE WHEN quality = 1 AND toxic = 0 THEN 0 WHEN quality IS NOT NULL THEN 1 END AS bad
      FROM pages LEFT JOIN labels
        ON labels.doc_id = TRY_CAST(regexp_extract(url, '/([0-9]{{1,18}})([^0-9/]|/$|$)', 1) AS BIGINT)),
    hosts AS (
      SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k,
             CASE WHEN regexp_matches(host, '(^|\\.)(ac|co|com|edu|gov|net|org)\\.[a-z][a-z]$')
                  THEN regexp_extract(host, '[^.]*\\.[^.]*$') ELSE regexp_extract(host, '[^.]*$') END AS suffix
      FROM p GROUP BY host),
    named AS (
      SELECT *, CASE WHEN contains(suffix, '.') THEN regexp_extract(host, '([^.]*\\.)?[^.]*\\.[^.]*$')
                     ELSE regexp_extract(host, '([^.]*\\.)?[^.]*$') END AS domain FROM hosts),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM named GROUP BY ALL),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
    overall AS (SELECT (sum(k) + 1.0) / (sum(n) + 10.0) AS rate FROM suffixes),
    {_level("suffixes", "suffixes u, overall p")},
    {_level("domains", "domains u JOIN suffixes_p p USING (suffix)")},
    {_level("named", "named u JOIN domains_p p USING (domain)")},
    fit AS (
      SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.rid ORDER BY length(r.host || r.path) DESC) AS place
      FROM (SELECT *, row_number() OVER () AS rid FROM p) p LEFT JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, fit.host, path, rule,
       coalesce(verdict, CASE WHEN rate - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.25
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM fit LEFT JOIN named_p USING (host) WHERE place = 1
"""


def _words(text: str) -> str:
    return f"coalesce(regexp_extract_all(translate({text}, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"


def contamination_ctes(documents: str) -> str:
    """CTEs up to ``judged`` (rid, doc_id, n_words, n_hit, n_items, items, contaminated)."""
    return f"""
    d AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM {documents}),
    i AS (SELECT item_id, w, least(len(w), 13) AS k
          FROM (SELECT item_id, {_words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
    iw AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS win
           FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s FROM i)),
    dw AS (SELECT rid, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
           FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
                 FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
    occ AS (SELECT DISTINCT rid, s, k, item_id FROM dw JOIN iw USING (k, win)),
    hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + k - 1)) AS p FROM occ) GROUP BY rid),
    it AS (SELECT rid, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM occ GROUP BY rid),
    judged AS (
      SELECT rid, doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
             coalesce(items, []) AS items, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
      FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid))"""


DECONTAMINATION = f"""
WITH {contamination_ctes("documents")}
SELECT doc_id, n_words, n_hit, n_items, sha256(array_to_string(items, ',')) AS items_sha256, contaminated FROM judged
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u AS (SELECT vec_id, label, len(e) AS dim, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM v),
    pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
              WHERE list_dot_product(a.e, b.e) >= 0.98),
    reach(id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, p.b FROM reach r JOIN pairs p ON r.other = p.a),
    least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
    counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN least ON id = vec_id LEFT JOIN counts ON a = vec_id
"""

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
    g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, {'n': -n, 'id': doc_id}) AS keep_id FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    turn = "list_reduce([xor(acc, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    octets = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda acc, b: {turn}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _tree(name: str, nodes: str) -> str:
    """CTEs of the tree over ``nodes`` (g, pos, h, n): all nodes, and each one's siblings and parent."""
    return f"""
    {name} AS (
      SELECT g, 0 AS lvl, pos, h, n FROM ({nodes}) UNION ALL
      SELECT g, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY g, lvl, pos // 8, n),
    {name}_s AS (
      SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
             coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
      FROM {name} a JOIN {name} b ON a.g IS NOT DISTINCT FROM b.g AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE d AS (
      SELECT row_number() OVER () AS rid, doc_id, lang, sha256({"||".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
             CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
                  THEN sha256({"||".join(map(_field, ("doc_id", "source", "lang", "n_chars", f"translate(text, {_LOWER})")))}) END AS suspect FROM documents),
    p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
    {_tree("low", "SELECT lang AS g, pos, leaf AS h, n FROM p")},
    sub AS (SELECT g AS lang, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place FROM low WHERE n = 1),
    {_tree("high", "SELECT 0 AS g, place AS pos, subroot AS h, count(*) OVER () AS n FROM sub")},
    up AS (
      SELECT rid, lang AS g, 0 AS lvl, pos, coalesce(suspect, leaf) AS h, '' AS proof FROM p UNION ALL
      SELECT rid, u.g, u.lvl + 1, u.pos // 8, sha256(l || h || r), proof || l || r
      FROM up u JOIN low_s s ON u.g IS NOT DISTINCT FROM s.g AND u.lvl = s.lvl AND u.pos = s.pos),
    far AS (
      SELECT rid, 0 AS lvl, place AS pos, h, proof FROM (SELECT rid, g, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM up GROUP BY rid, g)
        JOIN sub ON lang IS NOT DISTINCT FROM g UNION ALL
      SELECT rid, u.lvl + 1, u.pos // 8, sha256(l || h || r), proof || l || r FROM far u JOIN high_s s ON u.lvl = s.lvl AND u.pos = s.pos),
    ends AS (SELECT rid, arg_max(h, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM far GROUP BY rid)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN sub ON sub.lang IS NOT DISTINCT FROM p.lang JOIN ends USING (rid), (SELECT h AS root FROM high WHERE n = 1)
"""

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE dealt AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate FROM conversations),
    d AS (
      SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
             CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM (SELECT *, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM dealt WHERE fate <> 0)),
    placed AS (
      SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
             left(role, 1) AS x, lag(left(role, 1)) OVER w AS before, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text))),
    r AS (
      SELECT *, CASE WHEN last = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
    counts AS (
      SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
    step(q, x, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    given(q, role, q2) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
    -- up to two inserted turns before a row and behind the last one; more of them never pay
    ins(q, q2, cost, audit, said) AS (
      SELECT q, q, 0, '', []::VARCHAR[] FROM given UNION ALL SELECT q, q2, 3, 'I', [role || ':'] FROM given UNION ALL
      SELECT a.q, b.q2, 6, 'II', [a.role || ':', b.role || ':'] FROM given a JOIN given b ON a.q2 = b.q),
    edit AS (
      SELECT conv_id, i, q, q AS q2, 4 AS cost, 'D' AS audit, []::VARCHAR[] AS said FROM r, (SELECT DISTINCT q FROM given) UNION ALL
      SELECT conv_id, i, q, q2, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [role || ':' || text] FROM r JOIN step USING (x) WHERE fault IN ('', 'truncated') UNION ALL
      SELECT conv_id, i, q, q2, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [g.role || ':' || text] FROM r, given g WHERE fault IN ('', 'truncated')),
    way AS (
      SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'audit': '', 'said': []::VARCHAR[]}} AS b FROM counts UNION ALL
      SELECT e.conv_id, e.i, e.q2, min({{'cost': w.b.cost + v.cost + e.cost, 'audit': w.b.audit || v.audit || e.audit, 'said': w.b.said || v.said || e.said}})
      FROM way w JOIN ins v ON w.q = v.q JOIN edit e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = w.i + 1 AND e.q = v.q2 GROUP BY e.conv_id, e.i, e.q2),
    done AS (
      SELECT c.conv_id, min({{'cost': w.b.cost + v.cost, 'audit': w.b.audit || v.audit, 'said': w.b.said || v.said}}) AS b
      FROM way w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN ins v ON w.q = v.q WHERE v.q2 IN (0, 3) GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(b.cost AS BIGINT), 0) AS cost, coalesce(b.audit, '') AS audit,
       sha256(coalesce(array_to_string(b.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done ON o.conv_id IS NOT DISTINCT FROM done.conv_id
"""
