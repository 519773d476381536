"""The SQL of the operators that SQL can say, for DuckDB over the same tables."""

from __future__ import annotations

from sluicework.llm import decontaminate, line_quality, merkle_manifest, secret_scan

_SPACE = r"[\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans_of(kind: str, pattern: str, group: int, condition: str) -> str:
    rank = secret_scan.KINDS.index(kind) + 1
    return f"""SELECT doc_id, owner, {rank} AS r, '{kind}' AS kind, vals[i] AS v,
  list_sum([length(x) FOR x IN pieces[1:i]])
    + coalesce(list_sum([length(x) FOR x IN found[1:i - 1]]), 0) AS s, length(found[i]) AS n
  FROM (SELECT doc_id, owner, string_split_regex(t, {_quoted(pattern)}) AS pieces,
      regexp_extract_all(t, {_quoted(pattern)}, 0) AS found,
      regexp_extract_all(t, {_quoted(pattern)}, {group}) AS vals
    FROM d WHERE regexp_matches(t, {_quoted(pattern)})), unnest(range(1, len(found) + 1)) AS u(i)
  WHERE {condition}"""


_DIGITS = "length(regexp_replace(vals[i], '[^0-9]', '', 'g'))"
_LETTERS = "length(regexp_replace(vals[i], '[^A-Za-z]', '', 'g'))"

SECRET_SCAN = f"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
base AS (
  {_spans_of("assign", secret_scan.ASSIGN, 2, f"length(vals[i]) >= {secret_scan.ASSIGN_VALUE}")}
  UNION ALL {_spans_of("access", secret_scan.ACCESS, 0, "true")}
  UNION ALL {_spans_of("hex", secret_scan.HEX, 0, "true")}),
opaque AS (
  {_spans_of("owned", secret_scan.OPAQUE, 0,
    f"{_DIGITS} >= {secret_scan.OPAQUE_DIGITS} AND {_LETTERS} >= {secret_scan.OPAQUE_LETTERS}")}),
found AS (
  FROM base UNION ALL
  SELECT * FROM opaque o WHERE NOT EXISTS (SELECT 1 FROM base b
    WHERE b.doc_id = o.doc_id AND b.s < o.s + o.n AND o.s < b.s + b.n)),
judged AS (
  SELECT found.*, owners <= {secret_scan.MOST_OWNERS}
    AND repositories <= {secret_scan.MOST_REPOSITORIES} AS live
  FROM found JOIN (SELECT v, count(DISTINCT owner) AS owners,
      count(DISTINCT (owner, doc_id)) AS repositories FROM found GROUP BY v) USING (v)),
stays AS (
  SELECT *, kind || ':' || s || ':' || (s + n) AS span FROM judged WHERE live OR kind <> 'owned'),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    count(*) FILTER (kind = 'owned') AS n_owned, count(*) FILTER (live) AS n_live,
    string_agg(span, ',' ORDER BY s, r) FILTER (kind <> 'owned') AS base_spans,
    string_agg(span, ',' ORDER BY s, r) AS spans
  FROM stays GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, coalesce(n_owned, 0) AS n_owned, coalesce(n_live, 0) AS n_live,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)"""

LINE_QUALITY = rf"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, p, word FROM (
    SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p
    FROM (SELECT doc_id, string_split_regex(t, '{_SPACE}') AS ws FROM d)) WHERE word <> ''),
numbered AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS p FROM w),
windows AS (
  SELECT doc_id, p, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
  FROM numbered WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
twice AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM windows WHERE c IS NOT NULL),
repeated AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_repeat
  FROM twice, unnest([0, 1, 2]) AS u(k) WHERE n > 1 GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n, sum(length(word)) AS chars FROM numbered GROUP BY doc_id),
raw_lines AS (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
  SELECT *, lower(trim(regexp_replace(line, '{_SPACE}', ' ', 'g'))) AS norm FROM raw_lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT host, count(*) AS n FROM d GROUP BY host),
frequent AS (
  SELECT host, norm FROM lines JOIN hosts USING (host) GROUP BY host, norm, n
  HAVING count(DISTINCT doc_id) > {line_quality.LINE_DOCUMENTS}
    AND 100 * count(DISTINCT doc_id) > {line_quality.LINE_PERCENT} * n),
removed AS (
  SELECT doc_id, sum(length(norm) - length(replace(norm, ' ', '')) + 1) AS n
  FROM lines JOIN frequent USING (host, norm) GROUP BY doc_id),
all_counts AS (
  SELECT d.doc_id, coalesce(counted.n, 0) AS n_words, coalesce(chars, 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup,
    coalesce(n_repeat, 0) AS n_repeat, coalesce(removed.n, 0) AS n_line_words
  FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN dup USING (doc_id)
    LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)),
failed AS (
  SELECT *, n_words < {line_quality.MIN_WORDS}
    OR 100 * n_repeat > {line_quality.REPEAT_PERCENT} * n_words AS base_failed FROM all_counts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup::BIGINT AS n_dup_lines, n_repeat::BIGINT AS n_repeat_words,
  base_failed,
  NOT base_failed AND 100 * n_line_words <= {line_quality.DEPLETED_PERCENT} * n_words AS kept,
  n_line_words::BIGINT AS n_line_words
FROM failed"""

_LOWER = f"translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}')"
_WORDS = f"[x FOR x IN string_split_regex({_LOWER}, {_quoted(decontaminate.BREAK)}) IF x <> '']"

DECONTAMINATE = f"""WITH items AS (
  SELECT item_id::VARCHAR AS item_id, {_WORDS} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least({decontaminate.WINDOW}, len(ws)) AS n,
    array_to_string(ws[i:i + least({decontaminate.WINDOW}, len(ws)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(ws) - least({decontaminate.WINDOW}, len(ws)) + 2)) AS u(i)
  WHERE len(ws) > 0),
docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT n FROM item_windows), unnest(range(1, len(ws) - n + 2)) AS u(i)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM hits, unnest(range(0, n)) AS u(k) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0
    AND {decontaminate.HIT_SHARE} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)"""


_LOWERED = f"translate(text, '{merkle_manifest.UPPER}', '{merkle_manifest.LOWER}')"


def _leaf(text: str) -> str:
    values = [text if name == "text" else name for name in merkle_manifest.FIELDS]
    parts = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


# crc32 of the id's digits, byte by byte: eight steps of the reflected polynomial each.
_CRC_STEP = "xor(x >> 1, (x & 1) * 3988292384)"
_CRC_BYTE = "x"
for _ in range(8):
    _CRC_BYTE = f"list_transform([{_CRC_BYTE}], lambda x: {_CRC_STEP})[1]"
_CRC = f"""xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda a, c: list_transform([xor(a, c)], lambda x: {_CRC_BYTE})[1]))"""

_F = merkle_manifest.FANOUT


def _tree(name: str, source: str) -> str:
    """Levels of all trees of ``source``: its nodes and, while a tree has several, their parents."""
    return f"""{name} AS (
  SELECT tree, place, h, 0 AS level, count(*) OVER (PARTITION BY tree) AS n FROM {source}
  UNION ALL
  SELECT tree, place // {_F}, sha256(string_agg(h, '' ORDER BY place)), any_value(level) + 1,
    (any_value(n) + {_F - 1}) // {_F}
  FROM {name} WHERE n > 1 GROUP BY tree, place // {_F})"""


def _path(name: str, tree: str, source: str) -> str:
    """Per node of ``source`` and level its siblings on both sides."""
    return f"""{name} AS (
  SELECT l.tree, l.place, t.level,
    coalesce(string_agg(t.h, '' ORDER BY t.place)
      FILTER (t.place < l.place // pow({_F}, t.level)::BIGINT), '') AS before,
    coalesce(string_agg(t.h, '' ORDER BY t.place)
      FILTER (t.place > l.place // pow({_F}, t.level)::BIGINT), '') AS after
  FROM {source} l JOIN {tree} t ON t.tree = l.tree AND t.n > 1
    AND t.place // {_F} = l.place // pow({_F}, t.level + 1)::BIGINT
  GROUP BY l.tree, l.place, t.level)"""


MERKLE_MANIFEST = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS place,
    {_leaf("text")} AS h,
    CASE WHEN {_CRC} % {merkle_manifest.TAMPERED_OF} = 0 THEN {_leaf(_LOWERED)}
      ELSE {_leaf("text")} END AS tampered
  FROM documents),
{_tree("lower_tree", "leaves")},
subroots AS (SELECT 0 AS tree, tree AS place, h FROM lower_tree WHERE n = 1),
{_tree("upper_tree", "subroots")},
{_path("lower_path", "lower_tree", "leaves")},
{_path("upper_path", "upper_tree", "subroots")},
steps AS (
  SELECT doc_id, l.tree, l.place, l.tampered,
    list_concat(
      coalesce((SELECT list([p.before, p.after] ORDER BY p.level) FROM lower_path p
        WHERE p.tree = l.tree AND p.place = l.place), []),
      coalesce((SELECT list([p.before, p.after] ORDER BY p.level) FROM upper_path p
        WHERE p.place = l.tree), [])) AS path, l.h AS leaf
  FROM leaves l)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root,
  sha256(array_to_string([x[1] || x[2] FOR x IN path], '')) AS proof_sha256,
  list_reduce(list_prepend(['', tampered], path),
    lambda a, x: ['', sha256(x[1] || a[2] || x[2])])[2] AS folded_root,
  folded_root = r.h AS verified
FROM steps JOIN subroots s ON s.place = steps.tree, (SELECT h FROM upper_tree WHERE n = 1) r"""
