"""SQL for the dealt operators that SQL can express, run on the whole tables."""

from __future__ import annotations


def clustering(clusters: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> str:
    """Centroid clustering, each round two WITH clauses; plain integer arithmetic."""
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS p
            FROM embeddings
            WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""centroids_0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS INTEGER) AS cluster, p AS c
            FROM kept ORDER BY sha256('{seed}:' || vec_id) LIMIT {clusters})""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""nearest_{n} AS MATERIALIZED (
            SELECT vec_id, any_value(p) AS p, min(struct_pack(d := d, cluster := cluster)) AS best
            FROM (SELECT vec_id, p, cluster,
                         CAST(list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                  FROM kept, centroids_{n})
            GROUP BY vec_id)""")
        if n < rounds:
            steps.append(f"""centroids_{n + 1} AS MATERIALIZED (
                SELECT cluster, coalesce(any_value(m.c), any_value(o.c)) AS c
                FROM centroids_{n} o LEFT JOIN (
                    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
                    FROM (SELECT best.cluster AS cluster, i, sum(p[i]) AS s, count(*) AS n
                          FROM nearest_{n}, (SELECT unnest(range(1, 65)) AS i)
                          GROUP BY 1, 2)
                    GROUP BY cluster) m USING (cluster)
                GROUP BY cluster)""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, best.cluster AS cluster, best.d AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM nearest_{rounds} JOIN centroids_{rounds} ON cluster = best.cluster"""


def _after(weight: str, cost: int | str, letter: str) -> str:
    """A repair's weight, nine digits of cost and then the audit, after one more edit."""
    return (f"(lpad(CAST(CAST(substr({weight}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0')"
            f" || substr({weight}, 10) || '{letter}')")


def _least(*weights: str) -> str:
    return f"list_min([{', '.join(weights)}])"


def conversation_repair() -> str:
    """Repair by one step of recursion a row, with the lightest weight by state
    (e: nothing yet, s, u, a: after these initials); damage by a bitwise crc32.
    """
    crc = """xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))
        ), 4294967295)"""
    keep, rerole = [
        lambda w, start=start, letter=letter: _after(w, f"late{start}", letter)
        for start, letter in (("", "K"), (" + 2", "R"))
    ]
    start = "'000000000'"

    def if_kept(initial: str, *states: str) -> list[str]:
        return [f"CASE WHEN NOT gone AND initial = '{initial}' THEN {keep(w)} END" for w in states]

    def if_not_gone(*states: str) -> list[str]:
        return [f"CASE WHEN NOT gone THEN {rerole(w)} END" for w in states]

    gone = {w: _after(w, 3, "D") for w in "esua"}
    return f"""WITH RECURSIVE hashed AS (
            SELECT *, {crc} % 20 AS kind FROM (
                SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                       coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv,
                       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
                FROM conversations)),
        damaged AS (
            SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM hashed WHERE kind > 0),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i
            FROM damaged),
        checked AS MATERIALIZED (
            SELECT *, substr(role, 1, 1) AS initial,
                   lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY i) || substr(role, 1, 1) AS pair,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated'
                        ELSE '' END AS fault
            FROM numbered),
        edits AS MATERIALIZED (
            SELECT conv, i, initial, fault IN ('blank', 'duplicate') AS gone,
                   CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late
            FROM checked),
        ways AS (
            SELECT DISTINCT conv, 0::BIGINT AS i, {start} AS e, CAST(NULL AS VARCHAR) AS s,
                   '000000002I' AS u, '000000004II' AS a
            FROM hashed
            UNION ALL
            SELECT conv, i, e, s, {_least("u", _after("e", 2, "I"), _after("s", 2, "I"), _after("a", 2, "I"))} AS u,
                   {_least("a", _after(_least("u", _after("e", 2, "I"), _after("s", 2, "I"), _after("a", 2, "I")), 2, "I"))} AS a
            FROM (SELECT ways.conv, ways.i + 1 AS i, {gone["e"]} AS e,
                         {_least(gone["s"], *if_kept("s", "e"))} AS s,
                         {_least(gone["u"], *if_kept("u", "e", "s", "a"), *if_not_gone("e", "s", "a"))} AS u,
                         {_least(gone["a"], *if_kept("a", "u"), *if_not_gone("u"))} AS a
                  FROM ways JOIN edits ON edits.conv = ways.conv AND edits.i = ways.i + 1)),
        goals AS (
            SELECT conv, arg_max({_least("e", "a")}, i) AS goal FROM ways GROUP BY conv),
        letters AS (
            SELECT conv, p, substr(audit, p, 1) AS letter
            FROM (SELECT conv, substr(goal, 10) AS audit, unnest(range(1, length(goal) - 8)) AS p FROM goals)),
        placed AS (
            SELECT *, count(*) FILTER (letter <> 'I') OVER before AS i,
                   count(*) FILTER (letter <> 'D') OVER before AS place
            FROM letters WINDOW before AS (PARTITION BY conv ORDER BY p)),
        lines AS (
            SELECT placed.conv, p, letter, place, checked.role, checked.text,
                   max(CASE WHEN place = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY placed.conv) AS led
            FROM placed LEFT JOIN checked ON checked.conv = placed.conv AND checked.i = placed.i AND letter <> 'I'
            WHERE letter <> 'D'),
        repaired AS (
            SELECT conv, string_agg(
                CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS text
            FROM lines GROUP BY conv),
        counts AS (
            SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM checked GROUP BY conv)
        SELECT h.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, CAST(substr(goal, 1, 9) AS BIGINT) AS cost,
               substr(goal, 10) AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, conv FROM hashed) h
        JOIN goals ON goals.conv = h.conv
        LEFT JOIN repaired ON repaired.conv = h.conv
        LEFT JOIN counts ON counts.conv = h.conv"""


ORACLES: dict[str, str] = {
    "op13_conversation_repair": conversation_repair(),
    "op12_centroid_clustering": clustering(),
}
