"""SQL for DuckDB of the trie, the manifest and the rules."""

from __future__ import annotations

# crc32 (reflected polynomial 0xEDB88320) of the decimal digits of an id
CRC_POLYNOMIAL = 0xEDB88320
DEPTH = 8  # levels of runs of 16: enough for four thousand million leaves


def crc32(column: str) -> str:
    step = f"lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, {CRC_POLYNOMIAL}) ELSE x >> 1 END"
    turn = f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})"
    digits = f"list_transform(string_split({column}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {digits}, {turn}), 4294967295::BIGINT)"


TRIE = f"""
WITH placed AS (
    SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, list({{'r': r, 't': t}} ORDER BY pos) AS turns, {crc32("conv_id")} % 6 AS h
    FROM placed GROUP BY conv_id),
built AS (
    SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
    FROM convs AS c LEFT JOIN convs AS b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
    SELECT conv_id, d AS depth, turns[1:d] AS p, len(turns) = d AS ends
    FROM built, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
    SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * length(p[depth].t) END AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY p, depth),
children AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (p, depth)),
subtrees AS (
    SELECT p[1:d] AS p, d AS depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM counted, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT counted.conv_id, counted.depth, up.conv_id AS parent_conv_id, counted.n_convs, n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, counted.ends_sha256
FROM counted JOIN subtrees USING (p, depth)
LEFT JOIN nodes AS up ON up.depth = counted.depth - 1 AND up.p = counted.p[1:counted.depth - 1]"""


def _leaf(text: str) -> str:
    values = ["doc_id", "source", "lang", "n_chars", text]
    fields = [f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(fields)})"


def _climb(name: str, bottom: str, walkers: str) -> str:
    """``DEPTH`` levels over ``bottom`` (tree, place, digest), and ``walkers`` (…, tree, place, cur, proof) taken up with them."""
    parts = [f"{name}0 AS ({bottom}), {name}w0 AS ({walkers})"]
    for k in range(DEPTH):
        parts.append(f"""
{name}s{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM {name}{k}),
{name}g{k} AS MATERIALIZED (
    SELECT tree, place // 16 AS place, any_value(m) AS m, list(digest ORDER BY place) AS run
    FROM {name}s{k} GROUP BY tree, place // 16),
{name}{k + 1} AS MATERIALIZED (
    SELECT tree, place, CASE WHEN m = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS digest FROM {name}g{k}),
{name}w{k + 1} AS MATERIALIZED (
    SELECT w.* EXCLUDE (place, cur, proof), g.place,
           CASE WHEN m = 1 THEN cur ELSE sha256(array_to_string(run[1:w.place % 16], '') || cur
                || array_to_string(run[w.place % 16 + 2:], '')) END AS cur,
           proof || CASE WHEN m = 1 THEN '' ELSE array_to_string(run[1:w.place % 16], '')
                || array_to_string(run[w.place % 16 + 2:], '') END AS proof
    FROM {name}w{k} AS w JOIN {name}g{k} AS g ON g.tree = w.tree AND g.place = w.place // 16)""")
    return ",".join(parts)


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MANIFEST = f"""
WITH hashed AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
           CASE WHEN {crc32("doc_id")} % 5 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS claim
    FROM documents),
ranked AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM hashed),
{_climb("l", "SELECT tree, place, leaf AS digest FROM ranked",
        "SELECT doc_id, leaf, tree, place, claim AS cur, '' AS proof FROM ranked")},
{_climb("t", f"SELECT 0 AS tree, tree AS place, digest FROM l{DEPTH}",
        f"SELECT doc_id, leaf, tree AS of, 0 AS tree, tree AS place, cur, proof FROM lw{DEPTH}")}
SELECT w.doc_id, w.leaf, l{DEPTH}.digest AS subroot, t{DEPTH}.digest AS root, sha256(w.proof) AS proof_sha256,
       w.cur AS folded_root, w.cur = t{DEPTH}.digest AS verified
FROM tw{DEPTH} AS w JOIN l{DEPTH} ON l{DEPTH}.tree = w.of JOIN t{DEPTH} ON true"""

_SPACE = r"[\x20\x09-\x0D]"
_TRIMMED = rf"regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g')"

RULES = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT id, i, array_to_string(words[i:i + 7], ' ') AS run FROM texts, unnest(range(1, len(words) - 6)) AS u(i)),
twice AS (SELECT id, unnest(list(i)) AS i FROM windows GROUP BY id, run HAVING count(*) > 1),
covered AS (SELECT id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 8)) AS u(p) GROUP BY id),
triples AS (
    SELECT id, count(*) AS n
    FROM (SELECT id, array_to_string(words[i:i + 2], ' ') AS run FROM texts, unnest(range(1, len(words) - 1)) AS u(i))
    GROUP BY id, run),
most AS (SELECT id, max(n) AS n FROM triples GROUP BY id),
base AS (
    SELECT texts.*, len(words) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
           coalesce(most.n, 0) AS most_triple
    FROM texts LEFT JOIN covered USING (id) LEFT JOIN most USING (id)),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        word_chars < 3 * n_words OR word_chars > 10 * n_words
        OR 10 * n_symbols > n_words
        OR 10 * n_dup_lines > 3 * len(lines)
        OR 10 * len(list_filter(lines, lambda line: regexp_matches({_TRIMMED}, '^(- |\* |• )'))) > 9 * len(lines)
        OR 10 * len(list_filter(lines, lambda line: regexp_matches({_TRIMMED}, '(\.\.\.|…)$'))) > 3 * len(lines)
        OR 5 * len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]'))) < 4 * n_words
        OR length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^a-z]', '', 'g'))
        OR 10 * length(regexp_replace(text, '[^!?]', '', 'g')) > 3 * n_words
        OR 10 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 3 * word_chars
        OR 20 * length(regexp_replace(text, '[^{{}}]', '', 'g')) > n_words
        OR most_triple >= 3 AND 300 * most_triple > 18 * n_words
        OR contains({_LOWERED}, 'lorem ipsum') AS rejected
    FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged"""
