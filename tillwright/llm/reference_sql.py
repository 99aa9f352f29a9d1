"""The queries in SQL for DuckDB, written from their definitions."""

from __future__ import annotations

from tillwright.llm.quality_rules import RULES, STOP_WORDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _draw(name: str, weight: float) -> str:
    digest = f"md5(concat_ws('/', coalesce(CAST(doc_id AS VARCHAR), 'null'), '{name}'))"
    return f"(-ln((CAST(('0x' || substr({digest}, 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0) / {weight})"


def _tree(regions: dict[str, dict[str, list[int]]]) -> str:
    """CASE expression of the descent; every shard has weight 1."""
    def choose(children: dict[str, tuple[float, str]]) -> str:
        if len(children) == 1:
            return next(iter(children.values()))[1]
        draws = {n: _draw(n, w) for n, (w, _) in children.items()}
        cases = []
        for n, (_, then) in children.items():
            others = [f"{draws[n]} < {d}" for m, d in draws.items() if m != n]
            cases.append(f"WHEN {' AND '.join(others)} THEN {then}")
        return f"(CASE {' '.join(cases)} END)"

    return choose({
        region: (float(sum(map(len, racks.values()))), choose({
            rack: (float(len(shards)), choose({f"shard{s}": (1.0, str(s)) for s in shards}))
            for rack, shards in racks.items()}))
        for region, racks in regions.items()})


_REGIONS = {
    "region0": {"rack0": [0, 1, 2, 3], "rack1": [4, 5, 6, 7]},
    "region1": {"rack2": [8, 9, 10, 11], "rack3": [12, 13, 14, 15]},
}

# CRC-32 of the UTF-8 bytes, by its table of 256 entries computed from the polynomial.
SHARDING = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries),
placed AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         hex(encode(coalesce(text, ''))) AS h,
         CAST({_tree(_REGIONS)} AS INTEGER) AS shard,
         CAST({_tree({**_REGIONS, "added16": {"added16": [16]}})} AS INTEGER) AS grown_shard,
         CAST(('0x' || substr(md5(concat_ws('/', coalesce(CAST(doc_id AS VARCHAR), 'null'), 'slot')), 1, 13))
              AS BIGINT) % 1024 AS slice
  FROM documents),
summed AS (
  SELECT placed.*, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2),
      lambda i: CAST(('0x' || substr(h, 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM placed, crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id NULLS FIRST, text_crc32, size)
         - 1 AS slot
FROM summed
"""


def _failed(rule) -> str:
    tests = [f"{rule.statistic} < {rule.low}"] if rule.low is not None else []
    tests += [f"{rule.statistic} > {rule.high}"] if rule.high is not None else []
    return (f"CASE WHEN ({' OR '.join(tests)}) AND n_words >= {rule.from_words} "
            f"THEN '{rule.name}' END")


QUALITY_RULES = rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS w
  FROM documents),
places AS (
  SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM base WHERE len(w) >= 5),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(w[i:i + 4], ' ')) AS n
  FROM places),
repeated AS (SELECT DISTINCT rid, i + k AS j
  FROM windows, (SELECT unnest(range(5)) AS k) WHERE n > 1),
repeats AS (SELECT rid, count(*) AS n_repeat_words FROM repeated GROUP BY rid),
counts AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS stops,
         len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '\p{{Lu}}')
             AND NOT regexp_matches(x, '\p{{Ll}}'))) AS shouted
  FROM base LEFT JOIN repeats USING (rid)),
ratios AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         word_chars / nullif(n_words, 0) AS mean_word_length,
         n_symbols / nullif(word_chars, 0) AS symbol_ratio,
         shouted / nullif(n_words, 0) AS shouting_ratio,
         stops / nullif(n_words, 0) AS stop_word_ratio,
         (len(lines) - len(list_distinct(lines))) / nullif(len(lines), 0) AS duplicate_line_ratio
  FROM counts),
verdict AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         concat_ws(',', {", ".join(_failed(r) for r in RULES)}) AS failed_rules
  FROM ratios)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       failed_rules, NOT base_failed AND failed_rules = '' AS kept
FROM verdict
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Windows as lists of words; a window of m words is looked for among all runs of m words.
DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_FOLDED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id,
         regexp_extract_all({_FOLDED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
starts AS (
  SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
  FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM starts),
lengths AS (SELECT DISTINCT m FROM wins),
runs AS (
  SELECT rid, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m),
found AS (
  SELECT rid, i, r.m, item_id FROM (
    SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM runs) r
  JOIN wins ON wins.m = r.m AND wins.win = r.win),
hits AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM found))
  GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

# Exact: all pairs that share a shingle, then reachability.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT rid, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM d),
shingles AS (SELECT rid, len(s) AS n, unnest(s) AS sh FROM sets),
links AS (
  SELECT a.rid AS u, b.rid AS v FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT rid AS u, rid AS v FROM sets
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
component AS (
  SELECT u, min(doc_id) AS component_id FROM reach JOIN sets ON sets.rid = reach.v GROUP BY u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
       coalesce(doc_id = component_id, component_id IS NULL) AS kept
FROM sets JOIN component ON component.u = sets.rid
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
         min(page_id) OVER (PARTITION BY payload) AS first FROM p),
t AS (SELECT *, coalesce(payload_bytes >= 100 AND page_id > first, false) AS copy FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN copy THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN copy THEN first END AS refers_to, CASE WHEN NOT copy THEN true END AS intact
FROM t
"""

# All stretches of 50 words of all documents; islands of those that stand in two of them.
REPEATS = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents
  WHERE doc_id IS NOT NULL),
starts AS (
  SELECT doc_id, i - 1 AS s, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
twice AS (SELECT h FROM starts GROUP BY h HAVING min(doc_id) <> max(doc_id)),
hit AS (SELECT DISTINCT doc_id, s FROM starts SEMI JOIN twice USING (h)),
marked AS (
  SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 50 THEN 0 ELSE 1 END AS new
  FROM hit),
islands AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM marked)
SELECT doc_id, min(s) AS start_word, max(s) + 50 - min(s) AS n_words
FROM islands GROUP BY doc_id, island
"""
