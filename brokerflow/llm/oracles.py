"""DuckDB equivalents, where SQL can express the operator."""

OP4 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hit AS (
  SELECT DISTINCT doc_id, s, dw.n FROM dw JOIN iw USING (n, t)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1
), item AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(k, ',' ORDER BY k)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM dw JOIN iw USING (n, t)) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN item USING (doc_id)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || doc_id) AS h FROM documents
), k AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), s AS (
  SELECT *, array_to_string(w[1 : least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1 : greatest(a, b)], '') AS m,
    array_to_string(w[greatest(a, b) + 1 : len(w)], '') AS x FROM k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN len(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m WHEN 'spm' THEN '<S>' || x || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""


def _lloyd(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Whole-number Lloyd with full scans: one common table per round."""
    find = """
  SELECT r.vec_id, r.label, r.p, r.x, min(struct_pack(d := list_sum(list_transform(list_zip(r.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := b.e)) AS f
  FROM parts r JOIN book{0} b ON r.p = b.p GROUP BY ALL"""
    move = """
  SELECT o.p, o.e, coalesce(n.x, o.x) AS x FROM book{0} o LEFT JOIN (
    SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS x
    FROM (SELECT p, f.e AS e, i, sum(x[i]) AS s, count(*) AS c FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM found{0}) GROUP BY ALL) GROUP BY p, e
  ) n ON o.p = n.p AND o.e = n.e"""
    steps = [f"found{i} AS ({find.format(i)}\n), book{i + 1} AS ({move.format(i)}\n)" for i in range(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM (SELECT *, unnest(range({parts})) AS p FROM kept)
), book0 AS (
  SELECT p, e, x FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id)
), {", ".join(steps)}, last AS ({find.format(rounds)}
), coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(hex(f.e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(f.d) AS BIGINT) AS error FROM last GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest
"""


ORACLES = {
    "op4_exact_dedup": OP4,
    "op8_decontamination": OP8,
    "op11_fill_in_middle": OP11,
    "op13_vector_codes": _lloyd(),
}
