"""DuckDB SQL for the longer questions, by their meaning and not the way the operators compute them."""

from __future__ import annotations

# The crc32 of a text's UTF-8 bytes, from the polynomial: `crc_table` has the 256 remainders of a byte.
CRC_TABLE = """
    crc_table AS (
      SELECT [list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k:
                CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                CAST(i AS BIGINT)) FOR i IN range(256)] AS remainders)"""


def crc32(bytes_: str) -> str:
    """SQL of the crc32 of a list of bytes, where `remainders` is at hand."""
    return (
        f"xor(list_reduce({bytes_}, lambda c, b: "
        "xor(remainders[CAST(xor(c & 255, b) AS INTEGER) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295)"
    )


def utf8(text: str) -> str:
    """SQL of the list of a text's bytes."""
    return (
        f"[CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT) "
        f"FOR k IN range(octet_length(encode({text})))]"
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING_VARIANTS = f"""
    WITH RECURSIVE {CRC_TABLE},
    runs AS (
      SELECT CAST(doc_id AS VARCHAR) AS id, run, count(*) AS times
      FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                                                     '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
            FROM documents)
      WHERE length(run) >= 5 GROUP BY ALL),
    hashed AS (
      SELECT run, times, {crc32(utf8("coalesce(id, '') || ':' || run"))} AS h FROM runs, crc_table),
    words AS (
      SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                                       || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                  ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
      FROM hashed GROUP BY word HAVING length(word) >= 5 AND sum(times) >= 3),
    holes AS (
      SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)),
    shorter AS (
      SELECT DISTINCT h.word AS a, w.word AS b FROM holes AS h JOIN words AS w ON w.word = h.rest),
    near AS (
      SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter
      UNION ALL
      SELECT x.word, y.word FROM holes AS x JOIN holes AS y
        ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
    best AS (
      SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS other, max(n) AS other_n
      FROM near JOIN words ON words.word = b GROUP BY a),
    formed AS (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
             CASE WHEN other_n >= 2 * w.n THEN other END AS form,
             CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
      FROM words AS w LEFT JOIN best ON best.word = w.word),
    paths AS (
      SELECT word, word AS root, form AS further FROM formed
      UNION ALL
      SELECT p.word, f.word, f.form FROM paths AS p JOIN formed AS f ON f.word = p.further)
    SELECT f.word, form, root, n, n_near, form_n
    FROM formed AS f JOIN paths AS p ON p.word = f.word AND p.further IS NULL"""

PERIODIC_RUNS = f"""
    WITH {CRC_TABLE},
    plain AS (
      SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w,
             {crc32(utf8("CAST(doc_id AS VARCHAR)"))} AS h
      FROM documents, crc_table),
    cut AS (
      SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM plain),
    tailed AS (
      SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM cut),
    texts AS (
      SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE
               [CASE WHEN i < a THEN w[i + 1] ELSE w[CAST(a + (i - a) % p AS BIGINT) + 1] END
                FOR i IN range(len(w))] END AS w
      FROM tailed),
    placed AS (
      SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
    same AS (
      SELECT x.doc_id, y.i - x.i AS q, x.i AS i
      FROM placed AS x JOIN placed AS y
        ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
    stretches AS (
      SELECT doc_id, q, min(i) AS start, count(*) + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
      GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS (
      SELECT * FROM stretches AS s
      WHERE NOT EXISTS (SELECT 1 FROM stretches AS t
                        WHERE t.doc_id = s.doc_id AND t.q < s.q AND t.start <= s.start
                          AND t.start + t.length >= s.start + s.length)),
    listed AS (
      SELECT doc_id, count(*) AS n_runs,
             first(struct_pack(s := start, l := length, q := q)
                   ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS best,
             string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
      FROM runs GROUP BY doc_id),
    dropped AS (
      SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
    kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
      FROM (SELECT * FROM placed ANTI JOIN dropped USING (doc_id, i)) GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start,
           CAST(best.l AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
           CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256,
           sha256(coalesce(text, '')) AS collapsed_sha256
    FROM texts AS t LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
