"""DuckDB SQL for the operators that SQL can express: decontamination, line runs, repeated bytes,
clusters, resampling, exact duplicates.

The others need a tokeniser, XXH64 or a trained model; tests/llm holds them against
brute force, round trips and held-out rows.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, key: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w"
            f" FROM {table}")


OP3 = f"""
WITH d AS MATERIALIZED ({_words('documents', 'doc_id')}),
item AS (SELECT * FROM ({_words('benchmark', 'item_id')}) i WHERE len(w) > 0),
win AS MATERIALIZED (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, least(10, len(w)) AS n,
         array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM item) x),
place AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS words
  FROM (SELECT d.*, k.n, unnest(range(1, len(w) - k.n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) k) x),
found AS MATERIALIZED (SELECT doc_id, s, n, item FROM place JOIN win USING (n, words)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM found) y GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
          FROM (SELECT DISTINCT doc_id, item FROM found) z GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5 = r"""
WITH line AS MATERIALIZED (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS x
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d),
full_line AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS p, lead(x) OVER (PARTITION BY doc_id ORDER BY pos) AS y
  FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
run AS (SELECT doc_id, p, 2 AS n, x || chr(10) || y AS lines FROM full_line WHERE y IS NOT NULL
        UNION ALL SELECT doc_id, p, 1, x FROM full_line WHERE length(x) >= 250),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n, lines ORDER BY doc_id, p) AS copy FROM run),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, p + unnest(range(n)) AS p FROM ranked WHERE copy > 1),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS DISTINCT FROM p - 1) AS n_runs
         FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) g GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY pos) AS text
         FROM line LEFT JOIN full_line USING (doc_id, pos, x) LEFT JOIN (SELECT *, true AS cut FROM gone) g USING (doc_id, p)
         WHERE cut IS NULL GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n_lines FROM line GROUP BY doc_id)
SELECT doc_id, n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM total LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP10 = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS MATERIALIZED (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS x
                     FROM (SELECT *, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS s FROM d) w),
first AS (SELECT x, min(doc_id) AS first FROM win GROUP BY x HAVING min(doc_id) < max(doc_id)),
gone AS MATERIALIZED (SELECT doc_id, s FROM win JOIN first USING (x) WHERE doc_id > first),
mark AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM gone),
span AS MATERIALIZED (
  SELECT doc_id, min(s) AS a, max(s) + 50 AS b
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM mark) m GROUP BY doc_id, k),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id),
stay AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
  FROM (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM span
        UNION ALL SELECT doc_id, max(b), CAST(1000000000 AS BIGINT) FROM span GROUP BY doc_id) g JOIN d USING (doc_id)
  GROUP BY doc_id)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(from_hex(coalesce(stay.h, d.h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN stay USING (doc_id)
"""


def _clusters(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds written out: every vector against every centroid."""
    out = [f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h, v FROM v ORDER BY h, v LIMIT {k}) s)"""]
    for t in range(rounds + 1):
        out.append(f"""
a{t} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := c)) AS best
  FROM v, c{t} GROUP BY rid)""")
        if t < rounds:
            out.append(f"""
s{t} AS (SELECT c, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x
         FROM (SELECT best.c AS c, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{t} JOIN v USING (rid)) u GROUP BY c, i),
c{t + 1} AS MATERIALIZED (SELECT c, coalesce(n, m) AS m FROM c{t} LEFT JOIN (SELECT c, list(x ORDER BY i) AS n FROM s{t} GROUP BY c) g USING (c))""")
    return ",".join(out) + f"""
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} ON c{rounds}.c = best.c
"""


OP12 = f"""
WITH digit AS (SELECT list_reduce(list_concat([k], range(8)), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS x, k
               FROM range(256) r(k)),
digits AS MATERIALIZED (SELECT list(x ORDER BY k) AS crc FROM digit),
d AS MATERIALIZED ({_words('documents', 'doc_id')}),
both_words AS MATERIALIZED (SELECT word, count(*) FILTER (from_target = 0) AS s, count(*) FILTER (from_target = 1) AS t
  FROM (SELECT unnest(w) AS word, 0 AS from_target FROM d UNION ALL SELECT unnest(w), 1 FROM ({_words('benchmark', 'item_id')}) b) u GROUP BY word),
hashed AS MATERIALIZED (
  SELECT word, s, t, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
           list_transform(range(0, octet_length(encode(word))), lambda i: CAST(('0x' || substr(hex(encode(word)), 2 * i + 1, 2)) AS BIGINT))),
           lambda c, b: xor(c // 256, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM both_words, digits),
total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM hashed),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
         FROM (SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket) h, total),
weight AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
           FROM (SELECT doc_id, unnest(w) AS word FROM d) x JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS MATERIALIZED (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weight USING (doc_id)),
place AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN place USING (doc_id)
"""

OP13 = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(x) AS text_sha256
FROM d WINDOW w AS (PARTITION BY x)
"""

ORACLE: dict[str, str] = {"op3_positional_index": OP3, "op5_line_runs": OP5, "op10_radix": OP10,
                          "op11_ns_clusters": _clusters(), "op12_resample": OP12, "op13_exact": OP13}
