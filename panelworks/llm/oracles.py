"""SQL twins of queries that need checksums, byte strings or a parse."""

from __future__ import annotations


def _checksum_table() -> str:
    """A common table ``tab`` with the 256 entries of the CRC-32 step for one byte."""
    entry = "i"
    for _ in range(8):
        entry = f"[CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FOR x IN [{entry}]][1]"
    return f"tab AS (SELECT list({entry} ORDER BY i) AS t FROM range(256) AS r(i))"


def _checksum(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text, next to the table ``tab``."""
    byte = f"CAST('0x' || substr(hex({text}), 2 * k + 1, 2) AS BIGINT)"
    listed = f"[CAST(4294967295 AS BIGINT)] || [{byte} FOR k IN range(strlen({text}))]"
    step = "xor(a >> 8, t[CAST(xor(a & 255, b) + 1 AS INTEGER)])"
    return f"xor(list_reduce({listed}, lambda a, b: {step}), 4294967295)"


REPEATED_BYTES = """WITH d AS (
        SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents),
      pieces AS (SELECT doc_id, first, least(n - first, 1199) AS size, substr(h, 2 * first + 1, 2398) AS piece
            FROM (SELECT doc_id, h, n, unnest(range(0, n, 1000)) AS first FROM d)),
      starts AS (SELECT doc_id, first + p AS p, md5(substr(piece, 2 * p + 1, 400)) AS s
            FROM (SELECT doc_id, first, piece, unnest(range(0, size - 199)) AS p FROM pieces)),
      twice AS (SELECT doc_id, p FROM starts QUALIFY count(*) OVER (PARTITION BY s) > 1),
      steps AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER w + 200 THEN 0 ELSE 1 END AS fresh
            FROM twice WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
      runs AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
      spans AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM runs GROUP BY doc_id, run),
      gone AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, count(*) AS n_spans,
            sum(b - a) AS n_removed FROM spans GROUP BY doc_id),
      kept AS (SELECT doc_id, n, n_spans, n_removed, CASE WHEN a IS NULL THEN h ELSE
            array_to_string([substr(h, 2 * x[1] + 1, 2 * (x[2] - x[1]))
              FOR x IN list_zip([CAST(0 AS BIGINT)] || b, a || [n])], '') END AS k
            FROM d LEFT JOIN gone USING (doc_id))
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM kept"""


VARIANTS = rf"""WITH RECURSIVE {_checksum_table()},
      found AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''),
            '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{6,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
      distinct_words AS (SELECT doc_id || ':' || w AS key, w, count(*) AS n FROM found GROUP BY ALL),
      marked AS (SELECT w, n, {_checksum("key")} AS h FROM distinct_words, tab),
      damaged AS (SELECT n, CASE WHEN h % 199 = 0
            THEN left(w, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2)
            ELSE w END AS word FROM marked),
      words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6
            GROUP BY word HAVING sum(n) >= 5),
      cut AS (SELECT word, k, left(word, CAST(k AS INTEGER)) || substr(word, CAST(k AS INTEGER) + 2) AS rest
            FROM (SELECT word, unnest(range(length(word))) AS k FROM words)),
      one_way AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest
            AND a.word <> b.word
          UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word),
      near AS (SELECT word, near FROM one_way UNION SELECT near, word FROM one_way),
      best AS (SELECT near.word, near, f.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near
            FROM near JOIN words f ON f.word = near
            QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY f.n DESC, near) = 1),
      forms AS (SELECT words.word, CASE WHEN near_n >= 5 * words.n THEN near END AS form, words.n,
            coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * words.n THEN near_n END AS form_n
            FROM words LEFT JOIN best USING (word)),
      hops AS (SELECT word, word AS stop FROM forms
          UNION ALL SELECT hops.word, forms.form FROM hops JOIN forms ON hops.stop = forms.word
            WHERE forms.form IS NOT NULL),
      roots AS (SELECT hops.word, stop AS root FROM hops JOIN forms ON stop = forms.word
            WHERE forms.form IS NULL)
    SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN roots USING (word)"""


def _plus(way: str, cost: str, letter: str) -> str:
    """A way (eight digits of cost, then letters) with one more edit."""
    digits = f"lpad(CAST(CAST(left({way}, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0')"
    return f"({digits} || substr({way}, 9) || '{letter}')"


def _with_inserts(ways: str) -> str:
    """Ways to the ends '', s, u and a (four texts) with turns inserted."""
    a0, a1, a2, a3 = (f"{ways}[{k}]" for k in range(1, 5))
    user = f"least({a2}, {_plus(a0, '3', 'I')}, {_plus(a1, '3', 'I')}, {_plus(a3, '3', 'I')})"
    return (
        f"[[v[1], v[2], v[3], least(v[4], {_plus('v[3]', '3', 'I')})] "
        f"FOR v IN [[{a0}, {a1}, {user}, {a3}]]][1]"
    )


def _after_row() -> str:
    """Ways ``b`` after a row ``x``: initial, whether it must go, and what a fault adds."""
    gone = [_plus(f"b[{k}]", "4", "D") for k in range(1, 5)]
    none = "'90000000'"

    def kept(way: str, symbol: str) -> str:
        keep = _plus(way, "CAST(x[3] AS INTEGER)", "K")
        rerole = _plus(way, "3 + CAST(x[3] AS INTEGER)", "R")
        return f"CASE WHEN x[2] = '1' THEN {none} WHEN x[1] = '{symbol}' THEN {keep} ELSE {rerole} END"

    system = f"CASE WHEN x[2] = '0' AND x[1] = 's' THEN {_plus('b[1]', 'CAST(x[3] AS INTEGER)', 'K')} ELSE {none} END"
    user = ", ".join(kept(f"b[{k}]", "u") for k in (1, 2, 4))
    return (
        f"[{gone[0]}, least({gone[1]}, {system}), least({gone[2]}, {user}), "
        f"least({gone[3]}, {kept('b[3]', 'a')})]"
    )


_SPACES = r"[\x20\x09-\x0D]"
REPAIR = rf"""WITH {_checksum_table()},
      keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations),
      kinds AS (SELECT *, {_checksum("key")} % 20 AS kind FROM keyed, tab),
      damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
              ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
            FROM kinds WHERE kind <> 0),
      placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged),
      marked AS (SELECT *, left(role, 1) AS initial,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
            CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?]{_SPACES}*$') THEN 'truncated' ELSE '' END AS fault
            FROM placed),
      parsed AS (SELECT conv_id,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            CAST(count_if(fault = 'blank') AS BIGINT) AS blank,
            CAST(count_if(fault = 'duplicate') AS BIGINT) AS duplicate,
            CAST(count_if(fault = 'truncated') AS BIGINT) AS truncated, CAST(count_if(before IS NOT NULL
              AND before || initial NOT IN ('su', 'ua', 'au')) AS BIGINT) AS illegal,
            list_reduce([['00000000', '90000000', '90000000', '90000000']] || list([initial,
              CASE WHEN fault IN ('blank', 'duplicate') THEN '1' ELSE '0' END,
              CASE WHEN fault = 'truncated' THEN '3' ELSE '0' END, ''] ORDER BY pos),
              lambda a, x: [{_after_row()} FOR b IN [{_with_inserts("a")}]][1]) AS ways
            FROM marked GROUP BY conv_id),
      best AS (SELECT * EXCLUDE (ways), [least(b[1], b[4]) FOR b IN [{_with_inserts("ways")}]][1] AS way
            FROM parsed),
      audits AS (SELECT * EXCLUDE (way), CAST(left(way, 8) AS BIGINT) AS cost, substr(way, 9) AS audit
            FROM best),
      letters AS (SELECT conv_id, k, audit[k] AS edit, length(replace(left(audit, k), 'I', '')) AS pos
            FROM (SELECT conv_id, audit, CAST(unnest(range(1, length(audit) + 1)) AS INTEGER) AS k FROM audits)),
      stays AS (SELECT letters.conv_id, k, edit, role, text,
            row_number() OVER (PARTITION BY letters.conv_id ORDER BY k) AS nth
            FROM letters LEFT JOIN placed ON placed.conv_id IS NOT DISTINCT FROM letters.conv_id
              AND placed.pos = letters.pos AND edit <> 'I' WHERE edit <> 'D'),
      written AS (SELECT conv_id, k, CASE WHEN edit = 'K' THEN role
              WHEN (nth - max(CASE WHEN nth = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END)
                OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM stays),
      digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY k)) AS digest
            FROM written GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
        coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
        coalesce(digest, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN digests s ON s.conv_id IS NOT DISTINCT FROM c.conv_id"""
