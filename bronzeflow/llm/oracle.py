"""What the queries of this subpackage return, as SQL where SQL can say it."""

from __future__ import annotations

#: Windows of 13 words and their smallest document, by comparing all of them.
SUBSTRING_SQL = r"""WITH texts AS (SELECT doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, i, list_slice(ws, i, i + 12) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM texts)),
    firsts AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
    held AS (SELECT w.doc_id, w.i FROM windows w JOIN firsts f ON w.g = f.g WHERE f.m < w.doc_id),
    gone AS (SELECT DISTINCT doc_id, i + k AS j
    FROM (SELECT doc_id, i, unnest(range(13)) AS k FROM held)),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM texts),
    marked AS (SELECT w.*, g.j IS NOT NULL AS out FROM words w
    LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.j = g.j),
    kept AS (SELECT doc_id, count(*) FILTER (WHERE out) AS n_removed,
    string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT out) AS kept FROM marked GROUP BY doc_id)
    SELECT t.doc_id, CAST(len(t.ws) AS BIGINT) AS n_words,
    CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(k.kept, '')) AS kept_sha256 FROM texts t LEFT JOIN kept k USING (doc_id)"""


def _plus(way: str, cost: str, letters: str) -> str:
    """A way is its cost in six digits, then its letters: the least text is the best way."""
    return (
        f"lpad(CAST(CAST(substr({way}, 1, 6) AS BIGINT) + {cost} AS VARCHAR), 6, '0')"
        f" || substr({way}, 7) || '{letters}'"
    )


def _dialogue_sql() -> str:
    """Best ways to each state turn by turn, first over insertions, then over the turn."""
    u = f"least(s2, {_plus('s0', '5', 'I')}, {_plus('s1', '5', 'I')}, {_plus('s3', '5', 'I')})"
    a = f"least(s3, {_plus('s2', '5', 'I')}, {_plus('s0', '10', 'II')}, {_plus('s1', '10', 'II')})"

    def on(way: str, initial: str) -> str:
        """The turn kept or renamed, if it may stay."""
        return (
            f"CASE WHEN stays THEN CASE WHEN initial = '{initial}' THEN {_plus(way, 'extra', 'K')}"
            f" ELSE {_plus(way, 'extra + 1', 'R')} END END"
        )

    system = f"CASE WHEN stays AND initial = 's' THEN {_plus('s0', 'extra', 'K')} END"
    return rf"""WITH RECURSIVE summed AS (SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS name, conv_id, turn,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda c: CAST(ord(c) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda k, z: xor(k >> 1, 3988292384 * (k & 1))))) % 20 AS fault FROM conversations),
    damaged AS (SELECT name, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM summed WHERE fault <> 0),
    numbered AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY name
    ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
    met AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY name, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open,
    lag(initial) OVER (PARTITION BY name ORDER BY i) || initial AS pair FROM numbered),
    turns AS (SELECT *, NOT (blank OR again) AS stays, CASE WHEN open THEN 5 ELSE 0 END AS extra FROM met),
    counts AS (SELECT name, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
    count(*) FILTER (WHERE open AND stays) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY name),
    ways AS (SELECT name, CAST(0 AS BIGINT) AS i, '000000' AS s0, CAST(NULL AS VARCHAR) AS s1,
    CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM counts
    UNION ALL SELECT w.name, t.i, {_plus('s0', '2', 'D')},
    least({_plus('s1', '2', 'D')}, {system}),
    least({_plus(u, '2', 'D')}, {on('s0', 'u')}, {on('s1', 'u')}, {on(a, 'u')}),
    least({_plus(a, '2', 'D')}, {on(u, 'a')})
    FROM ways w JOIN turns t ON t.name = w.name AND t.i = w.i + 1),
    best AS (SELECT c.*, CAST(substr(way, 1, 6) AS BIGINT) AS cost, substr(way, 7) AS audit FROM counts c
    JOIN (SELECT name, i, least(s0, {a}) AS way FROM ways) w ON w.name = c.name AND w.i = c.n),
    letters AS (SELECT name, unnest(string_split(audit, '')) AS l,
    unnest(range(1, CAST(len(audit) AS BIGINT) + 1)) AS k FROM best WHERE audit <> ''),
    placed AS (SELECT *, count(*) FILTER (WHERE l <> 'I') OVER before AS i,
    count(*) FILTER (WHERE l <> 'D') OVER before AS j FROM letters
    WINDOW before AS (PARTITION BY name ORDER BY k)),
    edited AS (SELECT p.*, CASE WHEN l <> 'I' THEN t.role END AS role,
    CASE WHEN l <> 'I' THEN t.text ELSE '' END AS text,
    coalesce(max(CASE WHEN l = 'K' AND j = 1 AND t.initial = 's' THEN 1 END) OVER (PARTITION BY p.name), 0) AS led
    FROM placed p LEFT JOIN turns t ON t.name = p.name AND t.i = p.i),
    texts AS (SELECT name, string_agg(CASE WHEN l = 'K' THEN role
    WHEN (j - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS repaired
    FROM edited WHERE l <> 'D' GROUP BY name),
    every AS (SELECT DISTINCT conv_id, name FROM summed)
    SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
    FROM every e LEFT JOIN best b USING (name) LEFT JOIN texts t USING (name)"""


def _codes_sql(rounds: int = 4) -> str:
    """Every part against every entry, round by round."""
    far = (
        "list_sum(list_transform(list_zip(a.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    )

    def near(k: int) -> str:
        return (
            f"near{k} AS MATERIALIZED (SELECT row, p, least % 256 AS e, least // 256 AS d FROM"
            f" (SELECT a.row, a.p, min(CAST({far} AS BIGINT) * 256 + b.e) AS least"
            f" FROM parts a JOIN book{k} b ON a.p = b.p GROUP BY a.row, a.p))"
        )

    steps = []
    for k in range(rounds):
        steps.append(near(k))
        steps.append(
            f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b"
            " LEFT JOIN (SELECT p, e, list(f ORDER BY i) AS c FROM (SELECT p, e, i,"
            " CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS f FROM (SELECT n.p, n.e,"
            " unnest(a.x) AS v, unnest(range(len(a.x))) AS i"
            f" FROM near{k} n JOIN parts a ON a.row = n.row AND a.p = n.p)"
            " GROUP BY p, e, i) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"
        )
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT row, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS x
    FROM (SELECT *, unnest(range(4)) AS p FROM kept)),
    book0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM parts WHERE row <= 256),
    {", ".join(steps)}, {near(rounds)},
    coded AS (SELECT row, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY row),
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM book{rounds})
    SELECT k.vec_id, c.code, c.error,
    CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
    (SELECT s FROM digest) AS codebooks_sha256 FROM kept k JOIN coded c ON c.row = k.row"""


ORACLE_SQL: dict[str, str] = {
    "op7_substring_dedup": SUBSTRING_SQL,
    "op11_conversation_repair": _dialogue_sql(),
    "op12_vector_codes": _codes_sql(),
}
