"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from riskbook.llm import quality_rules as rules
from riskbook.llm import url_filters as urls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _bench_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{BENCH_WORD}')"


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_bench_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_bench_words("text")} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) WHERE len(w) >= n),
hit AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, g)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM hit, LATERAL (SELECT unnest(range(i, i + n)) AS p) GROUP BY r),
named AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
keyed AS (SELECT *, md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', size)) AS digest FROM sized),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM keyed GROUP BY source),
weighted AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM per_source),
ranked AS (
  SELECT *, sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY s * (6 // weight), source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY s * (6 // weight), source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM weighted),
capping AS (SELECT *, weight * rest > 3 * s * open_weight AS capped FROM ranked),
targets AS (
  SELECT *, CASE WHEN capped THEN CAST(3 * s AS DOUBLE)
    ELSE CAST(weight * max(CASE WHEN NOT capped THEN rest END) OVER () AS DOUBLE)
      / CAST(max(CASE WHEN NOT capped THEN open_weight END) OVER () AS DOUBLE) END AS target
  FROM capping),
budgets AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(floor(target) AS BIGINT) // s ELSE 0 END AS epochs FROM targets),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM keyed)
SELECT doc_id, size, s AS source_size, target,
  CAST(epochs * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - epochs * s - before)) AS BIGINT) AS taken
FROM summed JOIN budgets ON summed.source IS NOT DISTINCT FROM budgets.source
"""


def _strength(children: str) -> str:
    """The prior strength by moments from rows (n, k, m)."""
    excess = "sum(n * (n - 1) * m * (1 - m))"
    over = "sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))"
    rho = f"CASE WHEN {excess} <> 0 THEN ({over}) / {excess} END"
    most, least = urls.MOST_STRENGTH, urls.LEAST_STRENGTH
    return (
        f"(SELECT least(greatest(CASE WHEN rho IS NULL THEN {least} WHEN rho > 0 THEN 1 / rho - 1 ELSE {most} END,"
        f" {least}), {most})"
        f" FROM (SELECT {rho} AS rho FROM {children}))"
    )


def _rules() -> str:
    whens = []
    for verdict, host, path in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        whens.append((fits, f"{host}{path}", verdict))
    rule = " ".join(f"WHEN {fits} THEN '{name}'" for fits, name, _ in whens)
    verdict = " ".join(f"WHEN {fits} THEN '{v}'" for fits, _, v in whens)
    return f"CASE {rule} END AS rule, CASE {verdict} END AS rule_verdict"


_LONG = ", ".join(f"'{s}'" for s in urls.LONG_SUFFIXES)
_PART = "array_to_string(string_split(host, '.')[-{n}:], '.')"

URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
known AS (
  SELECT doc_id AS page_id, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good, count(*) AS labelled
  FROM labels WHERE doc_id IS NOT NULL AND (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, CAST(sum(coalesce(labelled, 0)) AS DOUBLE) AS n, CAST(sum(coalesce(good, 0)) AS DOUBLE) AS k
  FROM parsed LEFT JOIN known USING (page_id) GROUP BY host),
hosts AS (
  SELECT *,
    CASE WHEN regexp_matches(host, '^[0-9.]+$') THEN host
      WHEN {_PART.format(n=2)} IN ({_LONG}) THEN {_PART.format(n=3)} ELSE {_PART.format(n=2)} END AS domain,
    CASE WHEN {_PART.format(n=2)} IN ({_LONG}) THEN {_PART.format(n=2)} ELSE {_PART.format(n=1)} END AS suffix
  FROM counted),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM hosts) AS m
  FROM hosts GROUP BY suffix),
suffix_means AS (
  SELECT suffix, (k + {_strength("suffixes")} * m) / (n + {_strength("suffixes")}) AS m FROM suffixes),
domains AS (
  SELECT h.suffix, h.domain, h.n, h.k, s.m
  FROM (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix, domain) h
  JOIN suffix_means s ON h.suffix = s.suffix),
domain_means AS (
  SELECT suffix, domain, (k + {_strength("domains")} * m) / (n + {_strength("domains")}) AS m FROM domains),
leaves AS (
  SELECT h.host, h.n, h.k, d.m FROM hosts h JOIN domain_means d ON h.suffix = d.suffix AND h.domain = d.domain),
posterior AS (
  SELECT host, k + {_strength("leaves")} * m AS a, n - k + {_strength("leaves")} * (1 - m) AS b FROM leaves),
bounds AS (
  SELECT host, a / (a + b) + {urls.BOUND_DEVIATIONS} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bound
  FROM posterior),
ruled AS (SELECT *, {_rules()} FROM parsed)
SELECT page_id, host, path, rule,
  coalesce(rule_verdict, CASE WHEN bound >= {urls.LEAST_GOOD_RATE} THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN bounds USING (host)
"""

# Classes of characters as regular expressions, in the order of ``quality_rules.CLASSES``.
_CLASS_PATTERNS = (
    "[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[#*$%&|<>]", r"[!\x22\x27()+,\-./:;=?@\[\\\]^_`{}~]",
    r"[^\x00-\x7F]", r"[\x00-\x08\x0E-\x1F\x7F]",
)


def _quality() -> str:
    words = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"
    classes = ", ".join(f"len(regexp_extract_all(t, '{p.replace(chr(39), chr(39) * 2)}'))" for p in _CLASS_PATTERNS)
    commons = ", ".join(
        f"len(list_filter(w, lambda x: x = '{c}'" + (f" OR x = '{c.capitalize()}'" if c.capitalize() != c else "") + "))"
        for c in rules.LISTED
    )
    shares = "list_transform({0}, lambda x: {1} * x // greatest(list_sum({0}), 1))"
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{i + 1}])" for i in range(n)) + "]"
    part = lambda p, q: f"CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"

    def distance(left: str, right: str) -> str:
        p, q = (f"(CAST({side}[i] AS DOUBLE) / list_sum({side}))" for side in (left, right))
        return f"sqrt(greatest(list_sum(list_transform(range(1, len({left}) + 1), lambda i: {part(p, q)} + {part(q, p)})) / 2, 0))"

    listed = ", ".join(f"'{language}'" for language in sorted(rules.COMMON_WORDS))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {words} AS w,
    CASE WHEN lang IN ({listed}) THEN lang ELSE 'other' END AS language
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i) WHERE len(w) >= 3),
twice AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
repeats AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM windows JOIN twice USING (r, g), LATERAL (SELECT unnest(range(i, i + 3)) AS p) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '{WORD}') GROUP BY r),
base AS (
  SELECT d.*, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    [{classes}] AS class_counts, [{commons}] AS found
  FROM d LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r)),
failing AS (
  SELECT *, n_words < {rules.FEWEST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    list_append(found, n_words - list_sum(found)) AS common_counts
  FROM base),
shared AS (
  SELECT *, {shares.format("class_counts", rules.UNIT)} AS classes, {shares.format("common_counts", rules.UNIT)} AS commons
  FROM failing),
reference AS (
  SELECT language, {sums("classes", len(rules.CLASSES))} AS class_ref, {sums("commons", len(rules.LISTED) + 1)} AS common_ref
  FROM shared WHERE NOT base_failed GROUP BY language),
measured AS (
  SELECT shared.*, {distance("classes", "class_ref")} AS by_class, {distance("commons", "common_ref")} AS by_word
  FROM shared LEFT JOIN reference USING (language) WHERE NOT base_failed),
verdicts AS (
  SELECT r, NOT coalesce(word_chars >= {rules.MIN_LETTERS} AND (by_class > {rules.FAR_CLASS_DISTANCE}
      OR (n_words >= {rules.MIN_WORDS} AND by_class > {rules.CLASS_DISTANCE} + {rules.CLASS_SLACK} / sqrt(n_words)
        AND by_word > {rules.WORD_DISTANCE} + {rules.WORD_SLACK} / sqrt(n_words))), false) AS kept
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(kept, false) AS kept
FROM shared LEFT JOIN verdicts USING (r)
"""


QUALITY = _quality()

EXACT = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
  FROM documents),
placed AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM placed
"""

# zlib's crc32 of a list of bytes: one step for each bit, a byte being added before its first bit.
_CRC = (
    "xor(list_reduce(flatten(list_transform({bytes}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0])),"
    " lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1)), 4294967295::BIGINT), 4294967295)"
)
CRC_OF_DIGITS = _CRC.format(bytes="list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)")
_BYTES = (
    "list_transform(range(0, octet_length(encode({text}))), lambda i: "
    "CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
)

_MERKLE_LEVELS = 8  # 16 ** 8 leaves and sources


def _merkle_value(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_merkle_value(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _merkle_tree(name: str, nodes: str, leaves: str) -> str:
    """CTEs from ``nodes`` (tree, i, digest) and ``leaves`` (key, tree, i, proof, fold) to {name}_root (tree, digest) and
    {name}_path (key, tree, proof, fold)."""
    parts = [f"{name}_n0 AS (SELECT tree, i, digest FROM {nodes})", f"{name}_p0 AS (SELECT key, tree, i, proof, fold FROM {leaves})"]
    for level in range(_MERKLE_LEVELS):
        parts.append(f"""{name}_r{level} AS (
  SELECT tree, i // 16 AS i, list(digest ORDER BY i) AS run, any_value(total) AS total
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS total FROM {name}_n{level}) GROUP BY tree, i // 16)""")
        parts.append(f"""{name}_n{level + 1} AS (
  SELECT tree, i, CASE WHEN total = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS digest FROM {name}_r{level})""")
        parts.append(f"""{name}_p{level + 1} AS (
  SELECT p.key, p.tree, r.i,
    CASE WHEN total = 1 THEN proof ELSE proof || array_to_string(run[:p.i % 16] || run[p.i % 16 + 2:], '') END AS proof,
    CASE WHEN total = 1 THEN fold
      ELSE sha256(array_to_string(run[:p.i % 16] || [fold] || run[p.i % 16 + 2:], '')) END AS fold
  FROM {name}_p{level} p JOIN {name}_r{level} r ON r.tree IS NOT DISTINCT FROM p.tree AND r.i = p.i // 16)""")
    parts.append(f"{name}_root AS (SELECT tree, digest FROM {name}_n{_MERKLE_LEVELS})")
    parts.append(f"{name}_path AS (SELECT key, tree, proof, fold FROM {name}_p{_MERKLE_LEVELS})")
    return ",\n".join(parts)


MERKLE = f"""
WITH leaves AS (
  SELECT row_number() OVER () AS key, doc_id, source AS tree, {_merkle_leaf("text")} AS digest,
    CASE WHEN {CRC_OF_DIGITS} % 5 = 0 THEN {_merkle_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other
  FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i, '' AS proof,
    coalesce(other, digest) AS fold FROM leaves),
{_merkle_tree("s", "numbered", "numbered")},
tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, digest, tree AS source FROM s_root),
top_leaves AS (
  SELECT key, '' AS tree, i, proof, fold FROM s_path JOIN tops ON tops.source IS NOT DISTINCT FROM s_path.tree),
{_merkle_tree("t", "tops", "top_leaves")}
SELECT doc_id, n.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(p.proof) AS proof_sha256,
  p.fold AS folded_root, p.fold = r.digest AS verified
FROM numbered n JOIN t_path p USING (key) JOIN s_root s ON s.tree IS NOT DISTINCT FROM n.tree CROSS JOIN t_root r
"""

SPELLING = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, translate(r, '{UPPER}', '{LOWER}') AS r, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')) AS r FROM documents)
  GROUP BY 1, 2),
keyed AS (SELECT r, times, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS k FROM found),
hashed AS (SELECT r, times, {_CRC.format(bytes=_BYTES.format(text="k"))} AS h FROM keyed),
written AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, times
  FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM written WHERE length(word) >= 7
  GROUP BY word HAVING sum(times) >= 2),
cut AS (
  SELECT word, n, left(word, p) || '$' || substr(word, p + 2) AS hole, left(word, p) || substr(word, p + 2) AS rest
  FROM words, LATERAL (SELECT unnest(range(0, length(word))) AS p)),
shorter AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cut c JOIN words w ON w.word = c.rest),
pairs AS (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.hole = y.hole AND x.word <> y.word
  UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
best AS (
  SELECT a, count(*) OVER (PARTITION BY a) AS n_near, b, n AS b_n
  FROM pairs JOIN words ON words.word = pairs.b
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, b) = 1),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 10 * n THEN b END AS form,
    CASE WHEN b_n >= 10 * n THEN b_n END AS form_n
  FROM words LEFT JOIN best ON best.a = words.word),
chain AS (
  SELECT word, word AS reached FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.reached FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NULL)
SELECT word, form, reached AS root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
