"""SQL for the repair of conversations: a forward recursion over rows, nodes as structs of cost, audit and texts."""

from __future__ import annotations


def _way(node: str, letter: str, cost: str, piece: str | None) -> str:
    texts = f"{node}.t" if piece is None else f"list_append({node}.t, {piece})"
    return f"CASE WHEN {node} IS NOT NULL THEN {{'c': {node}.c + {cost}, 'a': {node}.a || '{letter}', 't': {texts}}} END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _inserted(source: str) -> str:
    user, assistant = "'user:'", "'assistant:'"
    two = _least("v2", *(_way(f"v{n}", "I", "3", user) for n in (0, 1, 3)))
    three = _least("v3", _way("v2", "I", "3", assistant))
    return f"SELECT * EXCLUDE (v2, v3), {two} AS v2, {three} AS v3 FROM ({source})"


def _row(node: int, initial: str, before: tuple[int, ...]) -> str:
    """What leads to ``node``: the row deleted, kept, or given another role."""
    ways = [_way(f"v{node}", "D", "4", None)]
    for n in before:
        kept = _way(f"v{n}", "K", "more", "role || ':' || text")
        ways.append(f"CASE WHEN usable AND initial = '{initial}' THEN {kept} END")
        if initial != "s":
            role = {"u": "'user:'", "a": "'assistant:'"}[initial]
            ways.append(f"CASE WHEN usable THEN {_way(f'v{n}', 'R', '3 + more', f'{role} || text')} END")
    return f"{_least(*ways)} AS v{node}"


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_STEP = ", ".join(_row(*x) for x in ((0, "", ()), (1, "s", (0,)), (2, "u", (0, 1, 3)), (3, "a", (2,))))

SQL = f"""WITH RECURSIVE crcs AS (SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1
        THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) r(i)),
    named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    kinds AS (SELECT * EXCLUDE (key, crc), xor(4294967295, list_reduce([4294967295] || list_transform(range(1, length(key) + 1),
        lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT)), lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) % 20 AS kind
        FROM named, crcs),
    damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN ''
        WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
    keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), '-') AS k, left(role, 1) AS initial,
        right(rtrim(text, {_BLANKS}), 1) AS last FROM damaged),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role,
        sha256(k || ':' || length(role) || ':' || role || text), copy) AS i FROM keyed),
    judged AS (SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'd'
        WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault FROM numbered),
    rows AS (SELECT k, i, role, text, initial, fault IN ('-', 't') AS usable, CASE fault WHEN 't' THEN 3 ELSE 0 END AS more,
        fault, turn, i > 1 AND lag(initial) OVER (PARTITION BY k ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS wrong FROM judged),
    walk AS (SELECT DISTINCT coalesce(CAST(conv_id AS VARCHAR), '-') AS k, CAST(0 AS BIGINT) AS i,
        {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS v0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])) AS v1,
        CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])) AS v2, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])) AS v3
        FROM conversations
    UNION ALL SELECT k, i, {_STEP} FROM (SELECT w.v0, w.v1, w.v2, w.v3, r.* FROM ({_inserted(_inserted("SELECT * FROM walk"))}) w
        JOIN rows r ON r.k = w.k AND r.i = w.i + 1)),
    ends AS (SELECT k, {_least("v0", "v3")} AS best FROM ({_inserted(_inserted(
        "SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1"))})),
    counts AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (wrong) AS illegal FROM rows GROUP BY k)
    SELECT CASE k WHEN '-' THEN NULL ELSE CAST(k AS BIGINT) END AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
    coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
    sha256(array_to_string(best.t, chr(10))) AS repaired_sha256 FROM ends LEFT JOIN counts USING (k)"""
