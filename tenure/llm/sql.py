"""The same results in DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

# CRC-32 by the table of its polynomial, one step per byte.
_CRC_TABLE = """
poly AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))
"""

OP1_SHARDING = f"""
WITH {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, '') AS k
  FROM documents),
crc AS (
  SELECT r, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM d, poly),
draws AS (
  SELECT r, s, -ln((('0x' || substr(md5(k || ':' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) AS score
  FROM d, range(25) g(s)),
won AS (
  SELECT r, min(struct_pack(score := score, s := s)) FILTER (WHERE s < 24) AS b, min(score) FILTER (WHERE s = 24) AS n
  FROM draws GROUP BY r)
SELECT doc_id, strlen(body)::BIGINT + 8 AS size, crc::BIGINT AS text_crc32, 'key' AS law, b.s::INTEGER AS shard,
  row_number() OVER (PARTITION BY b.s ORDER BY doc_id NULLS FIRST, crc, strlen(body)) - 1 AS slot,
  (CASE WHEN n < b.score THEN 24 ELSE b.s END)::INTEGER AS grown_shard
FROM d JOIN crc USING (r) JOIN won USING (r)
"""


def _winnow(table: str, text: str) -> str:
    """Fingerprint entries [hash, position] of a text column: the least hash of each window."""
    return f"""
SELECT r, list(DISTINCT [g[p], p - 1] ORDER BY [g[p], p - 1]) AS picks FROM (
  SELECT r, g, list_max(list_filter(range(a, least(a + 8, len(g) + 1)), lambda p: g[p] = list_min(g[a:least(a + 7, len(g))]))) AS p
  FROM (
    SELECT r, g, unnest(range(1, greatest(len(g) - 8, 0) + 2)) AS a
    FROM (
      SELECT r, list_transform(range(1, greatest(len(h) - 4, 0) + 2), lambda i:
        list_reduce(list_prepend(0::BIGINT, h[i:i + 3]), lambda a, x: (a * 1103515245 + x) % 2147483647)) AS g
      FROM (
        SELECT r, list_transform(string_split_regex(bare, '[\\x20\\x09-\\x0D]+'), lambda w:
          ('0x' || substr(md5(w), 1, 8))::BIGINT % 2147483647) AS h
        FROM (SELECT r, trim({text}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM {table})
        WHERE bare <> '')))
) GROUP BY r"""


_SHOWN = """coalesce(array_to_string(list_transform(list_sort(list_transform({p}, lambda x: [x[2], x[1]])),
    lambda x: printf('%08x', x[2]) || ':' || x[1]), ' '), '')"""


def _alike(a: str, b: str) -> str:
    both = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {both} = 0 THEN 1.0 ELSE len(list_distinct(list_intersect({a}, {b})))::DOUBLE / {both} END::DOUBLE"


OP7_WINNOWING = f"""
WITH o AS (
  SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, coalesce(text, '')) AS r, doc_id, coalesce(text, '') AS text
  FROM documents),
d AS (
  SELECT r, doc_id, text, coalesce(lead(text) OVER (ORDER BY r), first_value(text) OVER (ORDER BY r)) AS follows,
    length(text) AS n FROM o),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(follows, 1, n // 2) AS edited FROM d),
own AS ({_winnow("e", "text")}),
changed AS ({_winnow("e", "edited")}),
f AS (
  SELECT e.*, own.picks AS a, changed.picks AS b, coalesce(list_transform(own.picks, lambda x: x[1]), []) AS ha,
    coalesce(list_transform(changed.picks, lambda x: x[1]), []) AS hb
  FROM e LEFT JOIN own USING (r) LEFT JOIN changed USING (r)),
g AS (SELECT *, coalesce(lead(ha) OVER (ORDER BY r), first_value(ha) OVER (ORDER BY r)) AS hn FROM f)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
  {_SHOWN.format(p="a")} AS fingerprint, {_SHOWN.format(p="b")} AS edited_fingerprint,
  {_alike("ha", "hb")} AS near_edited, {_alike("ha", "hn")} AS near_next
FROM g
"""

ORACLES: dict[str, str] = {
    "op1_sharding": OP1_SHARDING,
    "op7_winnowing": OP7_WINNOWING,
}
