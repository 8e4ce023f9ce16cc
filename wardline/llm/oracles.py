"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations


def pii_sql() -> str:
    """Personal data, written from the patterns as they are stated."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{0,2}[0-9])?)\b",
        "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    }
    digits = "regexp_replace(x.m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(len({digits})), lambda i: "
            f"CASE WHEN i % 2 = 0 THEN {digits}[len({digits}) - i]::INT "
            f"WHEN {digits}[len({digits}) - i]::INT > 4 THEN {digits}[len({digits}) - i]::INT * 2 - 9 "
            f"ELSE {digits}[len({digits}) - i]::INT * 2 END)) % 10 = 0")
    plain = "replace(x.m, ' ', '')"
    turned = f"({plain}[5:] || {plain}[:4])"
    as_digits = (f"list_aggregate(list_transform(range(1, len({turned}) + 1), lambda i: "
                 f"CASE WHEN ascii({turned}[i]) < 58 THEN {turned}[i] "
                 f"ELSE (ascii({turned}[i]) - 55)::VARCHAR END), 'string_agg', '')")
    # 34 characters are up to 68 digits: modulo 97 in two halves
    halves = f"(({as_digits}[1:18]::HUGEINT % 97)::VARCHAR || {as_digits}[19:36])"
    more = f"(({halves}::HUGEINT % 97)::VARCHAR || {as_digits}[37:54])"
    mod97 = f"(({more}::HUGEINT % 97)::VARCHAR || {as_digits}[55:72])::HUGEINT % 97 = 1"
    rules = {
        "email": "true",
        "ip": "len(list_filter(string_split(x.m, '.'), lambda v: len(ltrim(v, '0')) > 3 "
              "OR ('0' || right(ltrim(v, '0'), 3))::INT > 255)) = 0",
        "card": f"CASE WHEN len({digits}) BETWEEN 13 AND 19 THEN {luhn} ELSE false END",
        "phone": f"len({digits}) BETWEEN 9 AND 15",
        "iban": f"CASE WHEN len({plain}) BETWEEN 15 AND 34 THEN {mod97} ELSE false END",
        "ssn": "x.m[1:3] NOT IN ('000', '666') AND x.m[1] <> '9' AND x.m[5:6] <> '00' AND x.m[8:11] <> '0000'",
    }
    scores = {
        "email": (0.8, 0.1, "mail|contact|kontakt|contacto|adresse|write|correo"),
        "ip": (0.6, 0.2, "ip|host|server|address|login|client"),
        "card": (0.8, 0.2, "card|visa|mastercard|credit|karte|carte|tarjeta|payment"),
        "phone": (0.5, 0.3, "phone|tel|call|mobile|fax|telefon|appel|llame|handy"),
        "iban": (0.8, 0.2, "iban|account|bank|konto|compte|cuenta"),
        "ssn": (0.3, 0.4, "ssn|social security|social-security|taxpayer"),
    }
    parts, raw, found = [], [], []
    for k, pattern in patterns.items():
        parts.append(f"regexp_extract_all(t, '{pattern}') AS m_{k}, string_split_regex(t, '{pattern}') AS p_{k}")
        raw.append(
            f"list_transform(range(1, len(m_{k}) + 1), lambda i: struct_pack("
            f"s := list_sum(list_transform(p_{k}[1:i], lambda y: len(y)))::BIGINT + "
            f"CASE WHEN i = 1 THEN 0 ELSE list_sum(list_transform(m_{k}[1:i - 1], lambda y: len(y)))::BIGINT END, "
            f"m := m_{k}[i], near := lower(right(p_{k}[i], 40) || ' ' || left(p_{k}[i + 1], 20)))) AS r_{k}")
        base, extra, words = scores[k]
        sure = "true" if k not in ("iban", "ssn") else "y.score >= 0.6"
        found.append(
            f"list_filter(list_transform(list_filter(r_{k}, lambda x: {rules[k]}), lambda x: struct_pack("
            f"span := '{k}:' || x.s || ':' || (x.s + len(x.m)), score := least(1.0, {base} + "
            f"CASE WHEN regexp_matches(x.near, '\\b(?:{words})') THEN {extra} ELSE 0 END)::DOUBLE)), "
            f"lambda y: {sure}) AS {k}")
    base = "list_concat(list_concat(list_concat(email, ip), card), phone)"
    every = f"list_concat(list_concat({base}, iban), ssn)"

    def joined(rows: str, what: str) -> str:
        return f"coalesce(list_aggregate(list_transform({rows}, lambda y: {what}), 'string_agg', ','), '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT doc_id, {', '.join(parts)} FROM d),
raw AS (SELECT doc_id, {', '.join(raw)} FROM parts),
found AS (SELECT doc_id, {', '.join(found)} FROM raw)
SELECT doc_id, len(email) AS n_email, len(ip) AS n_ip, len(card) AS n_card, len(phone) AS n_phone,
       sha256({joined(base, 'y.span')}) AS base_sha256, {joined(every, 'y.span')} AS spans,
       {joined(every, "format('{:.1f}', y.score)")} AS scores
FROM found"""


def warc_sql() -> str:
    """Archive records: SHA-1 in base 32 is read off the hexadecimal digest,
    five hexadecimal digits (20 bits) for four letters."""
    letters = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"1 + (('0x' || substr(h, {5 * g + 1}, 5))::INT >> {shift} & 31), 1)"
        for g in range(8) for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
named AS (SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {letters} AS payload_digest FROM hashed),
least AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM named)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM least"""


def nearest_sql(k: int = 5, modulus: int = 50) -> str:
    """The ``k`` nearest by cosine in double precision, against all rows."""
    return f"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % {modulus} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Product quantisation by plain distances to every entry."""
    text = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p)),
starts AS (
  SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT {entries}),
book0 AS MATERIALIZED (SELECT p, e, x AS c FROM pieces JOIN starts USING (r))"""
    for k in range(rounds + 1):
        text += f""",
near{k} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min(256 * list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + e) AS best
  FROM pieces JOIN book{k} USING (p) GROUP BY r, p)"""
        if k < rounds:
            text += f""",
means{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
      SELECT p, best % 256 AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
      FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY ALL))
  GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m ON b.p = m.p AND b.e = m.e)"""
    return text + f""",
coded AS (
  SELECT r, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error
  FROM near{rounds} GROUP BY r),
digest AS (
  SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (r), digest"""


def trie_sql(block: int = 100, heads: int = 6) -> str:
    """The trie of the rebuilt conversations, from lists of whole turns; CRC-32
    of the decimal id bit by bit."""
    crc = ("xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''), "
           "lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)")
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(struct_pack(r := role, x := text)
                       ORDER BY turn NULLS FIRST, sha256(length(role)::VARCHAR || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id),
sized AS (SELECT conv_id, turns, ({crc}) % {heads} AS h, conv_id - conv_id % {block} AS base FROM own),
built AS MATERIALIZED (
  SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
  FROM sized s LEFT JOIN own b ON b.conv_id = s.base),
prefixes AS (
  SELECT conv_id, d AS depth, turns[1:d] AS path, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS MATERIALIZED (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (ends) AS n_ends,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path),
subtrees AS (
  SELECT v.depth, v.path, count(*) FILTER (w.n_ends = w.n_convs) AS n_leaves,
         sum((w.n_convs - 1) * CASE WHEN w.depth = 0 THEN 0 ELSE length(w.path[w.depth].x) END)::BIGINT AS saved_tokens
  FROM nodes v JOIN nodes w ON w.path[1:v.depth] = v.path GROUP BY v.depth, v.path),
children AS (
  SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens, v.ends_sha256
FROM nodes v
JOIN subtrees s ON s.depth = v.depth AND s.path = v.path
LEFT JOIN children c ON c.depth = v.depth AND c.path = v.path
LEFT JOIN nodes p ON p.depth = v.depth - 1 AND p.path = v.path[1:v.depth - 1]"""
