"""Pieces of DuckDB SQL that the corpus queries are held against."""

from __future__ import annotations

from tablewright.llm.common import LOWER, UPPER

ACCENTS = "".join(chr(c) for c in range(0xC0, 0x100))


def _crc_step(c: int) -> int:
    for _ in range(8):
        c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
    return c


def crc32(text: str) -> str:
    """SQL for the crc32 of the UTF-8 bytes of a text expression, by a table made from its polynomial."""
    table = "[" + ", ".join(f"{_crc_step(c)}::BIGINT" for c in range(256)) + "]"
    digits = f"hex(encode({text}))"
    codes = f"[('0x' || substr({digits}, 2 * k - 1, 2))::BIGINT FOR k IN range(1, length({digits}) // 2 + 1)]"
    step = f"lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, {step}), 4294967295::BIGINT)"


def spellings(every: int, length: int, count: int, ratio: int) -> str:
    """SQL of op13: all words by deletion neighbours, then the edit distance of words in one-byte letters."""
    # the edit distance of DuckDB counts bytes: accented letters become signs that words do not hold
    signs = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c not in "'")[:len(ACCENTS)]
    word = f"translate(run, '{UPPER}', '{LOWER}')"

    def one_byte(column: str) -> str:
        return f"translate({column}, '{ACCENTS}', '{signs}')"

    return f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, {word} AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= {length} GROUP BY ALL),
        told AS (SELECT run, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
        damaged AS (SELECT n, CASE WHEN h % {every} = 0
                                   THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
                    FROM told),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= {length}
                  GROUP BY word HAVING sum(n) >= {count}),
        variants AS (SELECT word, n, unnest([word] || [substr(word, 1, k - 1) || substr(word, k + 1)
                                                       FOR k IN range(1, length(word) + 1)]) AS v FROM words),
        near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
                 FROM variants a JOIN variants b USING (v)
                 WHERE a.word <> b.word AND levenshtein({one_byte("a.word")}, {one_byte("b.word")}) = 1),
        ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
                          row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM near),
        best AS (SELECT word, n_near, CASE WHEN other_n >= {ratio} * n THEN other END AS form,
                        CASE WHEN other_n >= {ratio} * n THEN other_n END AS form_n FROM ranked WHERE r = 1),
        walk AS (SELECT word, form AS reached, 1 AS steps FROM best WHERE form IS NOT NULL
                 UNION ALL SELECT walk.word, best.form, steps + 1 FROM walk JOIN best ON best.word = walk.reached
                 WHERE best.form IS NOT NULL),
        ends AS (SELECT word, arg_max(reached, steps) AS root FROM walk GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
        FROM words LEFT JOIN best USING (word) LEFT JOIN ends USING (word)"""


def repairs() -> str:
    """SQL of op11: from the last row to the first, the least `cost, letters` for each role written before it."""
    def add(value: str, cost: str, letter: str) -> str:
        return f"(lpad(CAST(CAST(substr({value}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({value}, 10))"

    def inserts(values: list[str]) -> list[str]:
        return [f"least({v}, {add(values[fill], '3', 'I')})" for v, fill in zip(values, fills)]

    fills, worst = (2, 2, 3, 2), "'900000000'"
    keeps = (("s", 1), ("u", 2)), (("u", 2),), (("a", 3),), (("u", 2),)
    ends = [f"'{'0' * 9}'", worst, worst, f"'{'0' * 9}'"]
    rest = [f"v.v{q}" for q in range(4)]
    once = []
    for q in range(4):
        keep = " ".join(f"WHEN initial = '{x}' AND NOT forced THEN {add(rest[to], 'short', 'K')}" for x, to in keeps[q])
        rerole = f"CASE WHEN forced THEN {worst} ELSE {add(rest[fills[q]], '3 + short', 'R')} END"
        once.append(f"least({add(rest[q], '4', 'D')}, CASE {keep} ELSE {worst} END, {rerole})")

    def columns(values: list[str]) -> str:
        return ", ".join(f"{v} AS v{q}" for q, v in enumerate(values))

    names = ", ".join(f"v{q}" for q in range(4))
    plain = [f"v{q}" for q in range(4)]
    same = "v.conv_id IS NOT DISTINCT FROM r.conv_id"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    told = crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    return f"""
        WITH RECURSIVE told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                                       {told} % 20 AS fault FROM conversations),
        spoilt AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                          CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                          unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM told WHERE fault <> 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                          left(role, 1) AS initial, rtrim(text, {blanks}) AS body FROM spoilt),
        judged AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                          lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
        r AS (SELECT conv_id, i, turn, role, text, initial, CASE WHEN body = '' THEN 'b' WHEN again THEN 'd'
                     WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
                     before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS illegal FROM judged),
        found AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal
                  FROM r GROUP BY conv_id),
        coded AS (SELECT conv_id, i, initial, fault IN ('b', 'd') AS forced, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS short FROM r),
        ends0 AS (SELECT conv_id, n, {columns(ends)} FROM found),
        ends1 AS (SELECT conv_id, n, {columns(inserts(plain))} FROM ends0),
        ends2 AS (SELECT conv_id, n, {columns(inserts(plain))} FROM ends1),
        v AS (SELECT conv_id, n AS i, {names} FROM ends2
              UNION ALL
              SELECT conv_id, i, {columns(inserts(plain))} FROM (
                  SELECT conv_id, i, {columns(inserts(plain))} FROM (
                      SELECT v.conv_id, v.i - 1 AS i, {columns(once)} FROM v JOIN coded r ON {same} AND v.i = r.i))),
        best AS (SELECT conv_id, CAST(substr(v0, 1, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM v WHERE i = 0),
        letters AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS p, unnest(string_split(audit, '')) AS letter
                    FROM best WHERE audit <> ''),
        counted AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o
                    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
        written AS (SELECT c.conv_id, p, o, letter, CASE WHEN letter <> 'I' THEN r.role END AS role,
                           CASE WHEN letter <> 'I' THEN r.text ELSE '' END AS text
                    FROM counted c JOIN r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = greatest(c.i, 1)
                    WHERE letter <> 'D'),
        started AS (SELECT *, coalesce(first_value(role) OVER (PARTITION BY conv_id ORDER BY p), '') LIKE 's%'
                              AND first_value(letter) OVER (PARTITION BY conv_id ORDER BY p) = 'K' AS s FROM written),
        repaired AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - CASE WHEN s THEN 1 ELSE 0 END) % 2 = 1
                                                     THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS whole
                     FROM started GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN found f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
        LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
        LEFT JOIN repaired p ON c.conv_id IS NOT DISTINCT FROM p.conv_id"""
