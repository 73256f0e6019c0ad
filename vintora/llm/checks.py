"""DuckDB SQL that checks op10 to op13."""

from vintora.llm import secret_scan


def _field(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' ||"
            f" CAST({c} AS VARCHAR) END")


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(
        _field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# crc32 has no DuckDB function: a table of the 256 byte steps, folded over the digits of the id.
MERKLE = f"""
WITH RECURSIVE
b(x, k, r) AS (
  SELECT x, 0, x FROM range(256) t(x)
  UNION ALL
  SELECT x, k + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM b WHERE k < 8),
crc_table AS (SELECT list(r ORDER BY x) AS steps FROM b WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(':' || lang, '-') AS g,
    {_leaf("n_chars")} AS leaf, {_leaf("(n_chars + 1)")} AS raised,
    CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT),
                   list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda h, c: xor(h >> 8, steps[(xor(h, c) & 255) + 1])),
      CAST(4294967295 AS BIGINT)) END AS crc
  FROM documents, crc_table),
l AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, leaf, rid) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n FROM d),
t(g, level, pos, n, h) AS (
  SELECT g, 0, pos, n, leaf FROM l
  UNION ALL
  SELECT g, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM t WHERE n > 1 GROUP BY g, level, pos // 2, (n + 1) // 2),
s AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, pos, n, h) AS (
  SELECT 0, pos, n, h FROM s
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM u WHERE n > 1 GROUP BY level, pos // 2, (n + 1) // 2),
p AS (
  SELECT l.rid, t.level AS step, l.pos >> t.level & 1 AS odd, x.h AS sib
  FROM l JOIN t ON t.g = l.g AND t.n > 1 AND t.pos = l.pos >> t.level
  LEFT JOIN t x ON x.g = t.g AND x.level = t.level AND x.pos = xor(t.pos, 1)
  UNION ALL
  SELECT l.rid, 1000 + u.level, s.pos >> u.level & 1, x.h
  FROM l JOIN s ON s.g = l.g JOIN u ON u.n > 1 AND u.pos = s.pos >> u.level
  LEFT JOIN u x ON x.level = u.level AND x.pos = xor(u.pos, 1)),
q AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY step) AS k FROM p),
proof AS (SELECT rid, sha256(coalesce(string_agg(sib, '' ORDER BY k), '')) AS proof FROM q GROUP BY rid),
f(rid, k, h) AS (
  SELECT rid, 1, CASE WHEN crc % 7 = 0 THEN raised ELSE leaf END FROM l
  UNION ALL
  SELECT f.rid, f.k + 1, CASE WHEN sib IS NULL THEN sha256(h) WHEN odd = 1 THEN sha256(sib || h)
                         ELSE sha256(h || sib) END
  FROM f JOIN q ON q.rid = f.rid AND q.k = f.k),
ends AS (SELECT rid, arg_max(h, k) AS folded FROM f GROUP BY rid)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, coalesce(proof.proof, sha256('')) AS proof_sha256,
  ends.folded AS folded_root, ends.folded = r.h AS verified
FROM l JOIN s ON s.g = l.g JOIN ends ON ends.rid = l.rid LEFT JOIN proof ON proof.rid = l.rid,
  (SELECT h FROM u WHERE n = 1) r"""


# Exact phrases of up to five words by brute force; HUGEINT keeps products whole.
COLLOCATIONS = r"""
WITH p AS (
  SELECT lang, row_number() OVER () AS pid, list_filter(string_split_regex(piece, '[ \t]+'),
    lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (
  SELECT lang, w[i : i + k - 1] AS words, k
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), range(1, 6) t(k)
  WHERE i + k - 1 <= len(w)),
totals AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT lang, words, k, count(*) AS f FROM g GROUP BY lang, words, k HAVING count(*) >= 100),
absorbed AS (
  SELECT lang, words[1 : k - 1] AS words, f FROM c WHERE k > 1
  UNION SELECT lang, words[2 : k], f FROM c WHERE k > 1),
cuts AS (
  SELECT c.lang, c.words, c.f AS a, x.f AS l, y.f AS r, n, cut,
    1000 * CAST(c.f AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c WHERE k > 1) c
  JOIN c x ON x.lang = c.lang AND x.words = c.words[1 : cut]
  JOIN c y ON y.lang = c.lang AND y.words = c.words[cut + 1 : c.k]
  JOIN totals ON totals.lang = c.lang
  WHERE NOT EXISTS (SELECT 1 FROM absorbed b WHERE b.lang = c.lang AND b.words = c.words AND b.f = c.f)),
one AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, array_to_string(words, ' ') AS phrase FROM one) QUALIFY rank <= 2000"""


# Pieces between matches and the matches themselves give the positions; (?i:...) would also fold
# letters outside ASCII here, so both cases are spelled out.
_FORMS = [
    ("(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
                    for word in ("password", "passwd", "secret", "token", "api_?key"))
     + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("AKIA[A-Z0-9]+", 20, 0),
    ("[0-9a-f]+", 24, 0),
    (secret_scan.RUN, 20, 0),
]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _first_fit(value) -> str:
    *others, last = secret_scan.ENCODINGS
    return "CASE " + " ".join(f"WHEN regexp_matches(word, {_quoted(e.pattern)}) THEN {value(e)}"
                              for e in others) + f" ELSE {value(last)} END"


_SPANS = " UNION ALL ".join(
    f"""SELECT rid, {kind} AS kind, i, hit, part, length(regexp_extract(hit, {_quoted(p)}, {group})) >= {least} AS ok
  FROM (SELECT rid, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i,
          unnest(parts[1 : len(hits)]) AS part
        FROM (SELECT rid, regexp_extract_all(t, {_quoted(p)}) AS hits,
                string_split_regex(t, {_quoted(p)}) AS parts FROM d))"""
    for kind, (p, least, group) in enumerate(_FORMS))

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_SPANS}),
s AS (
  SELECT rid, kind, hit, ok, CAST(stop - length(hit) AS BIGINT) AS a, CAST(stop AS BIGINT) AS b
  FROM (SELECT *, sum(length(part) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM m)),
base AS (SELECT rid, kind, a, b FROM s WHERE kind < 3 AND ok),
w AS (
  SELECT rid, a, b, word, CAST(length(word) AS DOUBLE) AS n, string_split(word, '') AS letters,
    {_first_fit(lambda e: _quoted(e.symbols))} AS symbols,
    {_first_fit(lambda e: f"CAST({e.excess!r} AS DOUBLE)")} AS excess
  FROM (SELECT *, rtrim(hit, '=') AS word FROM s WHERE kind = 3)
  WHERE NOT regexp_matches(word, '{secret_scan.DECIMAL}')),
x AS (
  SELECT *, CAST(length(symbols) AS DOUBLE) AS k,
    list_transform(letters, lambda c: CAST(instr(symbols, c) - 1 AS BIGINT)) AS codes,
    list_sum(list_transform(list_distinct(letters),
      lambda c: (length(word) - length(replace(word, c, ''))) ** 2)) AS squares FROM w),
y AS (
  SELECT *, k * squares / n - n AS chi, list_transform(codes, lambda c: CASE WHEN c * 2 >= k THEN 1 ELSE 0 END) AS up,
    CAST(list_sum(codes) AS DOUBLE) AS total, CAST(list_sum(list_transform(codes, lambda c: c * c)) AS DOUBLE) AS total2,
    CAST(list_sum(list_transform(codes, lambda c, i: c * codes[i % len(codes) + 1])) AS DOUBLE) AS lag FROM x),
z AS (
  SELECT *, CAST(list_sum(up) AS DOUBLE) AS ones, n * total2 - total * total AS spread,
    CAST(list_sum(list_transform(up, lambda u, i: CASE WHEN i > 1 AND u <> up[i - 1] THEN 1 ELSE 0 END)) AS DOUBLE)
      + 1 AS runs FROM y),
v AS (SELECT *, 2.0::DOUBLE * ones * (n - ones) AS pairs FROM z),
q AS (
  SELECT *, (chi - (k - 1)) / sqrt(2.0::DOUBLE * (k - 1) * (n - 1) / n) AS z1,
    CASE WHEN pairs > 0 AND pairs > n
      THEN (runs - pairs / n - 1) / sqrt(pairs * (pairs - n) / (n * n * (n - 1))) END AS z2,
    CASE WHEN spread > 0 THEN ((n * lag - total * total) / spread + 1.0::DOUBLE / (n - 1))
      * (n - 1) * sqrt(n - 2) / n END AS z3,
    (n - 1) * excess AS shift FROM v),
judged AS (
  SELECT rid, a, b, coalesce(z1 * z1 + z2 * z2 + z3 * z3 <= {secret_scan.BATTERY}::DOUBLE, false) AS passed,
    CAST(n >= {secret_scan.BANDS[0]} AS INT) + CAST(n >= {secret_scan.BANDS[1]} AS INT) AS band,
    CAST(floor((k - 1 + shift - chi) / sqrt(2.0::DOUBLE * (k - 1) + 4.0::DOUBLE * shift) * 1000) AS INT) AS score
  FROM q),
ranked AS (
  SELECT band, score, sum(count(*)) OVER (PARTITION BY band ORDER BY score DESC) AS rank,
    sum(count(*)) OVER (PARTITION BY band) AS every FROM judged GROUP BY band, score),
tails AS (SELECT *, score / 1000.0::DOUBLE AS zz, 1 / (1 + 0.2316419::DOUBLE * score / 1000) AS tt FROM ranked WHERE score >= 0),
limits AS (
  SELECT band, min(score) AS least FROM tails WHERE {secret_scan.FALSE_SHARE} * rank >= every * exp(-zz * zz / 2)
    / 2.5066282746310002 * tt * (0.319381530::DOUBLE + tt * (-0.356563782::DOUBLE + tt * (1.781477937::DOUBLE + tt * (
    -1.821255978::DOUBLE + tt * 1.330274429::DOUBLE)))) GROUP BY band),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT rid, 3, a, b FROM judged JOIN limits USING (band) WHERE passed AND score >= least),
written AS (
  SELECT rid, a, kind, b, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || a || ':' || b AS s FROM spans)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
  count(*) FILTER (WHERE kind = 2) AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY a, kind, b) FILTER (WHERE kind < 3), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY a, kind, b), '') AS spans
FROM d LEFT JOIN written USING (rid) GROUP BY rid, doc_id"""

# Every pair of documents that shares a shingle, by its full sets; then all that can be reached.
NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS sh
  FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
two AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.a, two.b FROM r JOIN two ON r.b = two.a),
least_id AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept
FROM s JOIN least_id ON a = doc_id"""
