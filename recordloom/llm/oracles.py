"""DuckDB SQL for the queries that SQL can express: the same results by plainer means, for small tables."""

from __future__ import annotations

#: The published walk in arithmetic on HUGEINT; the checksum by its table, which is made by its rule; slots by part, the upper 12 bits of the walk's first state plus the checksum, and key.
SHARDING = """
WITH RECURSIVE
  d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
  firsts AS (SELECT r, ((((k // 4294967296::HUGEINT) * 2862933555777941757::HUGEINT) % 18446744073709551616::HUGEINT * 4294967296::HUGEINT) % 18446744073709551616::HUGEINT
            + ((k % 4294967296::HUGEINT) * 2862933555777941757::HUGEINT) % 18446744073709551616::HUGEINT + 1) % 18446744073709551616::HUGEINT // 4503599627370496::HUGEINT AS part
          FROM (SELECT r, CASE WHEN coalesce(doc_id, 0) < 0 THEN coalesce(doc_id, 0)::HUGEINT + 18446744073709551616::HUGEINT ELSE coalesce(doc_id, 0)::HUGEINT END AS k FROM d)),
  walk AS (
    SELECT r, CASE WHEN coalesce(doc_id, 0) < 0 THEN coalesce(doc_id, 0)::HUGEINT + 18446744073709551616::HUGEINT ELSE coalesce(doc_id, 0)::HUGEINT END AS k, 0::BIGINT AS j, -1::BIGINT AS s24, -1::BIGINT AS s25 FROM d
    UNION ALL
    SELECT r, n, CAST(floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((n // 8589934592::HUGEINT) + 1)::DOUBLE)) AS BIGINT), CASE WHEN j < 24 THEN j ELSE s24 END, CASE WHEN j < 25 THEN j ELSE s25 END
    FROM (SELECT r, j, s24, s25, ((((k // 4294967296::HUGEINT) * 2862933555777941757::HUGEINT) % 18446744073709551616::HUGEINT * 4294967296::HUGEINT) % 18446744073709551616::HUGEINT
            + ((k % 4294967296::HUGEINT) * 2862933555777941757::HUGEINT) % 18446744073709551616::HUGEINT + 1) % 18446744073709551616::HUGEINT AS n FROM walk WHERE j < 25)
  ),
  landed AS (SELECT r, max(s24) AS s24, max(s25) AS s25 FROM walk GROUP BY r),
  crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)) AS t),
  bytes AS (SELECT r, hex(encode(t)) AS h FROM d),
  crcs AS (SELECT r, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c // 256, crc_table.t[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS crc FROM bytes, crc_table)
SELECT doc_id, strlen(t) + 8 AS size, crc AS text_crc32, 'key' AS law, CAST(s24 AS INTEGER) AS shard, row_number() OVER (PARTITION BY s24 ORDER BY (part + crc) % 4096, doc_id, strlen(t) + 8, crc) - 1 AS slot, CAST(s25 AS INTEGER) AS grown_shard
FROM d JOIN landed USING (r) JOIN crcs USING (r) JOIN firsts USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     x AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s, min(page_id) OVER (PARTITION BY sha1(h)) AS first FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM x
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
     k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM s),
     g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM k),
     gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM g WHERE again),
     words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     s AS (SELECT doc_id, h, unnest(range(length(h) // 2 - 399)) AS p FROM d WHERE length(h) >= 800),
     k AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 800)) AS k FROM s),
     g AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS n FROM k) WHERE n > 1),
     m AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS new FROM g),
     i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM m),
     spans AS (SELECT doc_id, min(p) AS a, max(p) + 400 AS b FROM i GROUP BY doc_id, island),
     runs AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
     cut AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM runs JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(cut.kept, d.h))) AS kept_sha256 FROM d LEFT JOIN cut USING (doc_id)
"""

_M = "18446744073709551616::UHUGEINT"


def _u(x: int) -> str:
    return f"{x}::UHUGEINT"


#: The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = map(_u, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: str, r: int) -> str:
    return f"((({x}) * {_u(1 << r)}) % {_M} + ({x}) // {_u(1 << (64 - r))})"


def _times(x: str, y: str) -> str:
    return f"((({x}) * {y}) % {_M})"


def _xor(x: str, y: str) -> str:
    return f"xor(({x})::UBIGINT, ({y})::UBIGINT)::UHUGEINT"


def _round(acc: str, lane: str) -> str:
    return _times(_rotl(f"(({acc}) + {_times(lane, _P2)}) % {_M}", 31), _P1)


def _merged(h: str, v: str) -> str:
    return f"({_times(_xor(h, _round(_u(0), v)), _P1)} + {_P4}) % {_M}"


_SEED = 42
_STARTS = [(_SEED + 11400714785074694791 + 14029467366897019727) % (1 << 64), (_SEED + 14029467366897019727) % (1 << 64), _SEED, (_SEED - 11400714785074694791) % (1 << 64)]
_LITTLE = " || ".join(f"substr(x, {{0}} + {2 * k}, 2)" for k in range(7, -1, -1))
_SHORT = " || ".join(f"substr(x, {{0}} + {2 * k}, 2)" for k in range(3, -1, -1))


def _lane(at: str, text: str = _LITTLE) -> str:
    return f"('0x' || {text.format(at)})::UBIGINT::UHUGEINT"


#: SimHash by the published hash in arithmetic on UHUGEINT, counts of bits, all pairs of different fingerprints, and reachability.
SIMHASH = rf"""
WITH RECURSIVE
  d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
  s AS (SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
  g AS (SELECT DISTINCT g FROM s),
  x AS (SELECT g, hex(encode(g)) AS x, strlen(g) AS n FROM g),
  l AS (SELECT *, list_transform(range(n // 8), lambda i: {_lane("16 * i + 1")}) AS lanes, 4 * (n // 32) AS k FROM x),
  v AS (SELECT *, {", ".join(f"list_reduce(list_transform(range(k // 4), lambda i: lanes[4 * i + {j + 1}]), lambda a, b: {_round('a', 'b')}, {_u(_STARTS[j])}) AS v{j}" for j in range(4))} FROM l),
  h0 AS (SELECT *, CASE WHEN n < 32 THEN {_u(_SEED)} + {_P5} ELSE ({" + ".join(_rotl(f"v{j}", r) for j, r in enumerate((1, 7, 12, 18)))}) % {_M} END % {_M} AS h FROM v),
  {", ".join(f"m{j} AS (SELECT * REPLACE (CASE WHEN n < 32 THEN h ELSE {_merged('h', f'v{j}')} END AS h) FROM {'h0' if not j else f'm{j - 1}'})" for j in range(4))},
  h1 AS (SELECT * REPLACE (list_reduce(lanes[k + 1:], lambda a, b: ({_times(_rotl(_xor("a", _round(_u(0), "b")), 27), _P1)} + {_P4}) % {_M}, (h + n::UHUGEINT) % {_M}) AS h) FROM m3),
  h2 AS (SELECT * REPLACE (CASE WHEN n % 8 >= 4 THEN ({_times(_rotl(_xor("h", _times(_lane("16 * (n // 8) + 1", _SHORT), _P1)), 23), _P2)} + {_P3}) % {_M} ELSE h END AS h) FROM h1),
  h3 AS (SELECT * REPLACE (list_reduce(list_transform(range(n - n % 4, n), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT::UHUGEINT), lambda a, b: {_times(_rotl(_xor("a", _times("b", _P5)), 11), _P1)}, h) AS h) FROM h2),
  h4 AS (SELECT g, {_times(_xor("h", f"h // {_u(1 << 33)}"), _P2)} AS h FROM h3), h5 AS (SELECT g, {_times(_xor("h", f"h // {_u(1 << 29)}"), _P3)} AS h FROM h4), h6 AS (SELECT g, xor(h::UBIGINT, (h // {_u(1 << 32)})::UBIGINT) AS h FROM h5),
  b AS (SELECT r, {" + ".join(f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(*) THEN {_u(1 << b)} ELSE {_u(0)} END" for b in range(64))} AS f FROM s JOIN h6 USING (g) GROUP BY r),
  p AS (SELECT r, doc_id, coalesce(f, 0)::UBIGINT AS f FROM d LEFT JOIN b USING (r)),
  n AS (SELECT f, min(doc_id) AS low FROM p GROUP BY f),
  links AS (SELECT a.f AS a, b.f AS b FROM n a JOIN n b ON a.f <> b.f AND bit_count(xor(a.f, b.f)::HUGEINT) <= 2),
  reach AS (SELECT f AS node, f AS met FROM n UNION SELECT node, b FROM reach JOIN links ON met = a),
  c AS (SELECT node, min(low) AS component_id FROM reach JOIN n ON met = f GROUP BY node)
SELECT doc_id, lpad(lower(hex(f)), 16, '0') AS fingerprint, component_id FROM p JOIN c ON node = f
"""

#: Every diagonal of a document and an item with equal tokens enough, its prefix sums, for each end the earliest start from which four fifths are equal, and the fullest of these runs.
LEAKS = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
     u AS (SELECT row_number() OVER () AS s, item_id, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
     a AS (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS p FROM t), b AS (SELECT s, unnest(w) AS w, unnest(range(len(w))) AS q FROM u),
     g AS (SELECT r, s, p - q AS shift, count(*) AS c FROM a JOIN b USING (w) GROUP BY ALL),
     e AS (SELECT g.r, g.s, shift, t.w AS x, u.w AS y, least(13, len(u.w)) AS least, greatest(0, -shift) AS low, least(len(u.w), len(t.w) - shift) AS high FROM g JOIN t USING (r) JOIN u USING (s) WHERE 5 * c >= 4 * least(13, len(u.w))),
     f AS (SELECT r, s, shift, least, low, list_transform(range(low, high), lambda i: CASE WHEN x[i + shift + 1] = y[i + 1] THEN 1 ELSE 0 END) AS same FROM e WHERE high - low >= least),
     k AS (SELECT r, s, shift, least, low, same, unnest(range(len(same) + 1)) AS i FROM f),
     z AS (SELECT *, coalesce(list_sum(same[1:i]), 0)::BIGINT AS eq FROM k),
     runs AS (SELECT j.r, j.s, j.shift, j.least, j.low, j.same, j.i AS stop, j.eq AS eq, min(h.i) AS start FROM z j JOIN z h ON h.r = j.r AND h.s = j.s AND h.shift = j.shift AND h.i <= j.i AND 5 * h.eq - 4 * h.i <= 5 * j.eq - 4 * j.i GROUP BY ALL),
     good AS (SELECT *, eq - coalesce(list_sum(same[1:start]), 0)::BIGINT AS n FROM runs WHERE stop - start >= least),
     best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, s, shift ORDER BY n DESC, stop) AS nth FROM good) WHERE nth = 1),
     cut AS (SELECT *, least(start + list_position(same[start + 1:], 1) - 1, stop - least) AS first FROM best),
     ends AS (SELECT *, greatest(stop - list_position(list_reverse(same[1:stop]), 1) + 1, first + least) AS last FROM cut),
     told AS (SELECT r, s, list_sum(same[first + 1:last])::BIGINT AS matched_tokens, last - first AS overlap_tokens, low + shift + first AS start_token FROM ends),
     one AS (SELECT *, row_number() OVER (PARTITION BY r, s ORDER BY matched_tokens DESC, overlap_tokens DESC, start_token DESC) AS nth FROM told)
SELECT doc_id, item_id, matched_tokens, overlap_tokens, start_token FROM one JOIN t USING (r) JOIN u USING (s) WHERE nth = 1
"""
