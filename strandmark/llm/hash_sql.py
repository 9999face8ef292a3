"""DuckDB SQL of fingerprints: XXH64 spelled out over a text's bytes in hexadecimal, for tables of megabytes."""

from __future__ import annotations


def simhash_sql() -> str:
    """op8 by brute force: every shingle's hash, every pair of fingerprints, the closure of their links."""
    # The five primes of XXH64.
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    full = f"{1 << 64}::UHUGEINT"
    mul = lambda a, b: f"((({a})::UHUGEINT * {b}::UHUGEINT) % {full})::UBIGINT"
    add = lambda a, b: f"((({a})::UHUGEINT + ({b})::UHUGEINT) % {full})::UBIGINT"
    let = lambda name, value, body: f"list_transform([{value}], lambda {name}: {body})[1]"
    rot = lambda x, r: f"({mul(x, 1 << r)} | ({x} >> {64 - r}))"
    mixed = lambda acc, x: let("m", add(acc, mul(x, p2)), mul(rot("m", 31), p1))
    u = lambda n: f"{n % (1 << 64)}::UBIGINT"
    little = lambda at, n: "('0x' || " + " || ".join(f"substr(x, {at} + {2 * k + 1}, 2)" for k in reversed(range(n))) + ")::UBIGINT"
    lane = lambda k, start: f"list_reduce(w[{k}:4 * stripes:4], lambda a, b: {mixed('a', 'b')}, {u(start)})"
    merged = "h0"
    for k in range(1, 5):
        merged = let(f"g{k}", f"xor({merged}, {mixed(u(0), f'v{k}')})", add(mul(f"g{k}", p1), p4))
    bits = " + ".join(f"CASE WHEN 2 * sum((h >> {b}) & 1) > count(*) THEN {1 << b}::UHUGEINT ELSE 0::UHUGEINT END" for b in range(64))
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
pieces AS (SELECT doc_id, unnest(CASE WHEN len(t) < 3 THEN [array_to_string(t, ' ')] ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END) AS s FROM d WHERE len(t) > 0),
bytes AS (SELECT s, hex(encode(s)) AS x, octet_length(encode(s)) AS n FROM (SELECT DISTINCT s FROM pieces)),
words AS (SELECT s, x, n, n // 32 AS stripes, list_transform(range(0, n // 8), lambda i: {little('16 * i', 8)}) AS w FROM bytes),
lanes AS (SELECT *, {lane(1, 42 + p1 + p2)} AS v1, {lane(2, 42 + p2)} AS v2, {lane(3, 42)} AS v3, {lane(4, 42 - p1)} AS v4 FROM words),
began AS (SELECT *, {add(add(rot('v1', 1), rot('v2', 7)), add(rot('v3', 12), rot('v4', 18)))} AS h0 FROM lanes),
joined AS (SELECT s, x, n, stripes, w, {add(f"CASE WHEN n >= 32 THEN {merged} ELSE {u(42 + p5)} END", 'n')} AS h FROM began),
eights AS (SELECT s, x, n, list_reduce(w[4 * stripes + 1:], lambda a, b: {let('e', f"xor(a, {mixed(u(0), 'b')})", add(mul(rot('e', 27), p1), p4))}, h) AS h FROM joined),
fours AS (SELECT s, x, n, CASE WHEN n % 8 >= 4 THEN {let('f', f"xor(h, {mul(little('2 * (n - n % 8)', 4), p1)})", add(mul(rot('f', 23), p2), p3))} ELSE h END AS h FROM eights),
ones AS (SELECT s, list_reduce(list_transform(range(n - n % 4, n), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT), lambda a, b: {let('o', f"xor(a, {mul('b', p5)})", mul(rot('o', 11), p1))}, h) AS h FROM fours),
hashed AS (SELECT s, xor(h, h >> 32) AS h FROM (SELECT s, {mul('xor(h, h >> 29)', p3)} AS h FROM (SELECT s, {mul('xor(h, h >> 33)', p2)} AS h FROM ones))),
marks AS (SELECT doc_id, ({bits})::UBIGINT AS fp FROM pieces JOIN hashed USING (s) GROUP BY doc_id UNION ALL SELECT doc_id, 0 FROM d WHERE len(t) = 0),
nodes AS (SELECT DISTINCT fp FROM marks),
links AS (SELECT a.fp AS a, b.fp AS b FROM nodes a JOIN nodes b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= 2),
reach AS (SELECT a AS fp, b AS far FROM links UNION SELECT r.fp, l.b FROM reach r JOIN links l ON l.a = r.far),
roots AS (SELECT n.fp, least(n.fp, coalesce(min(r.far), n.fp)) AS root FROM nodes n LEFT JOIN reach r USING (fp) GROUP BY n.fp)
SELECT m.doc_id, lpad(lower(hex(m.fp)), 16, '0') AS fingerprint, min(m.doc_id) OVER (PARTITION BY r.root) AS component_id FROM marks m JOIN roots r USING (fp)
"""
