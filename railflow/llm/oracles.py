"""DuckDB SQL for the training-data queries that SQL can express.

The others are held against brute force in tests/llm: token counts and byte-pair
encoding (libraries), boosted trees, I-Match and line dedup (hash functions that
DuckDB does not have), bootstrapped extraction (iterative).
"""

from __future__ import annotations

from railflow.llm import importance, mixing, sharding

H60 = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"
WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

# CRC-32 by its 256-entry table, which the first CTEs compute from the polynomial.
OP1 = f"""
WITH RECURSIVE steps(n, k, v) AS (
  SELECT n, 0, n::BIGINT FROM range(256) t(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
), crc AS (SELECT list(v ORDER BY n) AS entry FROM steps WHERE k = 8),
docs AS (SELECT doc_id, source, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size FROM documents),
bytes AS (
  SELECT doc_id, source, size,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS data FROM docs
), summed AS (
  SELECT doc_id, source, size, xor(4294967295, list_reduce(list_prepend(4294967295, data),
    lambda c, b: xor(c >> 8, entry[1 + (xor(c, b) & 255)]))) AS text_crc32 FROM bytes, crc
), ordered AS (
  SELECT *, coalesce('=' || source, 'null') AS stratum,
    {H60.format(f"'{sharding.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '~')")} AS ord FROM summed
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY ord, doc_id, text_crc32, size) - 1 + 0.5::DOUBLE)
    / (count(*) OVER (PARTITION BY stratum))::DOUBLE AS fraction FROM ordered
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, ord, stratum, doc_id, text_crc32, size) - 1 AS position,
    count(*) OVER () AS n FROM ranked
), cut AS (SELECT *, CAST(position * 16 // n AS INT) AS shard FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, shard,
  position - (shard * n + 15) // 16 AS slot, CAST(NULL AS INT) AS grown_shard, source
FROM cut
"""


def _weight(level: str) -> str:
    cases = "".join(f" WHEN '={name}' THEN {w}" for name, w in mixing.WEIGHTS[level].items())
    return f"CASE {level}{cases} ELSE 1 END" if cases else "1"


def _level(depth: int) -> str:
    """CTEs that hand the budgets of one level to the next."""
    path, up = ", ".join(mixing.LEVELS[:depth + 1]), ", ".join(mixing.LEVELS[:depth])
    level = mixing.LEVELS[depth]
    part = f"PARTITION BY {up} " if up else ""
    join = f"JOIN given{depth - 1} g USING ({up})" if up else ", total g"
    return f"""
nodes{depth} AS (
  SELECT {path}, capacity, weight, g.given AS budget, CASE WHEN weight > 0 THEN capacity ELSE 0 END AS usable,
    CASE WHEN weight > 0 THEN capacity::DOUBLE / weight::DOUBLE ELSE -1 END AS ratio
  FROM (SELECT {path}, sum(capacity)::BIGINT AS capacity, {_weight(level)} AS weight FROM leaves GROUP BY {path}) n {join}
), sorted{depth} AS (
  SELECT *, sum(usable) OVER (w ROWS UNBOUNDED PRECEDING) - usable AS before,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
  FROM nodes{depth} WINDOW w AS ({part}ORDER BY ratio, {level})
), full{depth} AS (
  SELECT *, (budget - before) * weight >= usable * onward OR weight = 0 AS is_full FROM sorted{depth}
), open{depth} AS (
  SELECT *, budget - sum(CASE WHEN is_full THEN usable ELSE 0 END) OVER ({part}) AS rest,
    greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}), 1) AS weights FROM full{depth}
), given{depth} AS (
  SELECT {path}, CAST(CASE WHEN is_full THEN usable ELSE rest * weight // weights END AS BIGINT) AS given FROM open{depth}
)"""


OP6 = f"""
WITH docs AS (
  SELECT doc_id, lang, source, 'domain' || CAST(
      {H60.format("'domain:' || coalesce(source, '~')")} % 4 AS VARCHAR) AS domain,
    CAST(len({WORDS.format("coalesce(text, '')")}) AS BIGINT) AS n_tokens FROM documents
), named AS (
  SELECT doc_id, n_tokens, domain AS d, lang AS l, source AS s, '=' || domain AS domain,
    coalesce('=' || lang, 'null') AS lang, coalesce('=' || source, 'null') AS source FROM docs
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {mixing.MAX_EPOCHS})::BIGINT AS capacity
  FROM named GROUP BY ALL
), total AS (
  SELECT least(sum(tokens) * {mixing.BUDGET[0]} // {mixing.BUDGET[1]}, sum(capacity)) AS given FROM leaves
), {_level(0)}, {_level(1)}, {_level(2)},
targets AS (
  SELECT domain, lang, source, given // greatest(tokens, 1) AS epochs, given % greatest(tokens, 1) AS rest
  FROM given2 JOIN leaves USING (domain, lang, source)
), ordered AS (
  SELECT *, {H60.format(f"'{mixing.SEED}:' || CAST(epochs AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '~')")} AS ord
  FROM named JOIN targets USING (domain, lang, source)
), started AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord, doc_id, n_tokens
    ROWS UNBOUNDED PRECEDING) - n_tokens AS start FROM ordered
)
SELECT doc_id, d AS domain, l AS lang, s AS source, n_tokens, CAST(e AS INT) AS epoch
FROM started, LATERAL unnest(range(epochs + CASE WHEN start < rest THEN 1 ELSE 0 END)) t(e)
"""

# First listed URLs by content, then host rules, then exact membership.
OP8 = r"""
WITH parts AS (
  SELECT page_id, url, html, position('://' IN coalesce(url, '')) AS mark FROM pages
), split AS (
  SELECT page_id, html,
    translate(CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*') ELSE '' END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM parts
), named AS (
  SELECT *, CASE WHEN host <> '' THEN
    CASE WHEN regexp_matches(host, '^(www|m)\.[^.]+\.') THEN regexp_replace(host, '^(www|m)\.', '') ELSE host END
    || regexp_replace(path, '(\.html|/)$', '') END AS canonical_url FROM split
), body AS (
  SELECT canonical_url, regexp_replace(coalesce(html, ''), '<[^>]*>|&[a-z]+;', '', 'g') AS body FROM named
), listed AS (
  SELECT DISTINCT canonical_url FROM body
  WHERE canonical_url IS NOT NULL AND length(body) > 0
    AND (length(body) - length(regexp_replace(body, '[#*$%|]', '', 'g'))) * 10 >= length(body)
), rules(rule_host, prefix, says, len) AS (
  VALUES ('com', '/', 'allow', 4), ('example.com', '/en/', 'block', 15), ('www.example.com', '/en/', 'allow', 19),
    ('net', '/es/', 'block', 7), ('net', '/fr/', 'block', 7)
), best AS (
  SELECT page_id, arg_max(rule_host || prefix, len) AS rule, arg_max(says, len) AS says
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, prefix)
  GROUP BY page_id
)
SELECT n.page_id, n.host, n.path, b.rule,
  coalesce(b.says, CASE WHEN l.canonical_url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  n.canonical_url, l.canonical_url IS NOT NULL AS listed
FROM named n LEFT JOIN best b USING (page_id) LEFT JOIN listed l ON n.canonical_url = l.canonical_url
"""

OP10 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
), sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
rows AS (SELECT doc_id, n, unnest(s) AS shingle FROM sized),
df AS (SELECT shingle, count(*) AS df FROM rows GROUP BY shingle),
ranked AS (
  SELECT r.*, row_number() OVER (PARTITION BY doc_id ORDER BY df, shingle) AS place FROM rows r JOIN df USING (shingle)
), prefix AS (SELECT doc_id, n, shingle FROM ranked WHERE place <= n - (n * 85 + 99) // 100 + 1),
candidates AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b
    ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
), links AS (
  SELECT a, b FROM candidates JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * len(list_intersect(x.s, y.s)) >= 85 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sized JOIN component USING (doc_id)
"""

# CRC-32 of a text in UTF-8, by the table ``crc.entry`` of OP1's first CTEs.
CRC_TABLE = OP1.split("docs AS")[0].strip().rstrip(",").rstrip()


def _crc(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))),
      lambda c, b: xor(c >> 8, entry[1 + (xor(c, b) & 255)])))"""


OP11 = CRC_TABLE + f""",
words AS (
  SELECT 'd' AS side, row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
  FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')
  FROM benchmark
), features AS (
  SELECT side, row, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM words
), hashed AS (
  SELECT f, {_crc("f")} % {importance.BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM features), crc
), counts AS (
  SELECT side, row, bucket, count(*) AS c FROM features JOIN hashed USING (f) GROUP BY ALL
), sums AS (
  SELECT b.bucket, coalesce(sum(c) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t
  FROM range({importance.BUCKETS}) b(bucket) LEFT JOIN counts USING (bucket) GROUP BY b.bucket
), total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + {importance.BUCKETS}) / ((s + 1) * (t_all + {importance.BUCKETS})))) AS BIGINT) AS gain
  FROM sums, total
), weights AS (
  SELECT row, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight
  FROM counts JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (row) WHERE side = 'd'
), drawn AS (
  SELECT *, n_words >= {importance.LEAST_WORDS} AS able,
    row_number() OVER (PARTITION BY n_words >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored
)
SELECT doc_id, n_features, weight, score, n_words,
  CASE WHEN able AND place <= {importance.PERCENT} * (SELECT count(*) FROM drawn WHERE able) // 100 THEN place END AS rank
FROM drawn
"""

# Prefixes as lists of digests; totals over all ancestors of every node.
OP12 = CRC_TABLE + f""",
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(struct_pack(d := d, b := b) ORDER BY turn NULLS FIRST, d) AS t
  FROM (SELECT conv_id, turn, md5(strlen(role) || ':' || role || text) AS d, strlen(text) AS b FROM turns) GROUP BY conv_id
), hashed AS (SELECT *, CAST({_crc("CAST(conv_id AS VARCHAR)")} % 9 AS INT) AS h FROM own, crc),
rebuilt AS (
  SELECT a.conv_id, list_concat(CASE WHEN b.t IS NULL THEN [] ELSE b.t[1:a.h] END, a.t[a.h + 1:]) AS t
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
), paths AS (
  SELECT conv_id, len(t) AS length, d AS depth,
    CASE WHEN d = 0 THEN '' ELSE md5(array_to_string(list_transform(t[1:d], lambda x: x.d), ',')) END AS node,
    CASE WHEN d = 0 THEN 0 ELSE t[d].b END AS bytes
  FROM rebuilt, LATERAL unnest(range(len(t) + 1)) r(d)
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '') AS ends
  FROM paths GROUP BY depth, node
), ups AS (
  SELECT n.depth, n.node, p.node AS parent FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM ups GROUP BY ALL),
valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, s.parent, (n_convs - 1) * bytes AS saved
  FROM nodes n LEFT JOIN children USING (depth, node) LEFT JOIN ups s USING (depth, node)
), totals AS (
  SELECT p.depth, p.node, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum(v.saved) AS saved_tokens
  FROM valued v JOIN paths p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.depth, p.node
)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves,
  CAST(t.saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN totals t USING (depth, node) LEFT JOIN nodes up ON up.depth = v.depth - 1 AND up.node = v.parent
"""

SQL: dict[str, str] = {
    "op1_shard_interleave": OP1,
    "op6_source_mixing": OP6,
    "op8_url_filter": OP8,
    "op10_hyperminhash_dedup": OP10,
    "op11_importance_resampling": OP11,
    "op12_conversation_trie": OP12,
}
