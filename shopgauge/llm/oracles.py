"""Queries of this subpackage as SQL for DuckDB, where SQL can express them: written plainly, by comparing everything with everything."""

from __future__ import annotations

from shopgauge.llm import repair

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

TOPK = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, e.vec_id, CAST(list_dot_product(q.v, e.v) AS BIGINT) AS score
    FROM whole q JOIN whole e ON q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0
)
SELECT * FROM (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
) WHERE rank <= 10
"""

#: Every position of a document with whether a run of 50 that starts there also starts in an earlier document, and whether one covers it.
_COVERED = """
starts AS (SELECT doc_id, pos, {run} AS run FROM places WHERE pos + 49 <= size),
firsts AS (SELECT run, min(doc_id) AS first FROM starts GROUP BY run),
again AS (SELECT doc_id, pos FROM starts JOIN firsts USING (run) WHERE first < doc_id),
covered AS (
    SELECT p.doc_id, p.pos, max(CASE WHEN a.pos IS NULL THEN 0 ELSE 1 END) OVER
        (PARTITION BY p.doc_id ORDER BY p.pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone, {part} AS part
    FROM places p LEFT JOIN again a ON p.doc_id = a.doc_id AND p.pos = a.pos
)"""

SUBSTRINGS = f"""
WITH split AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, len(w) AS size, unnest(range(1, len(w) + 1)) AS pos FROM split),
{_COVERED.format(run="md5_number(array_to_string(list_slice(w, pos, pos + 49), ' '))", part="p.w[p.pos]")},
kept AS (
    SELECT doc_id, sum(gone) AS n_removed, string_agg(part, ' ' ORDER BY pos) FILTER (gone = 0) AS body FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, pos, pos + 4), ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM split WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = documents.doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id)
"""


def _conversations() -> str:
    """The repair as a recursion over the turns: of every place the cheapest way so far as (cost, edits, lines)."""
    blank = r"'[^\x20\x09-\x0D]'"
    table = "SELECT i AS v FROM range(256) t(i)"
    for _ in range(8):
        table = f"SELECT xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END) AS v FROM ({table})"
    table = table.replace("SELECT xor", "SELECT i, xor").replace("SELECT i AS v", "SELECT i, i AS v")
    crc = "xor(list_reduce(list_prepend(4294967295, spelled), lambda c, b: xor(codes[xor(c, b) % 256 + 1], c >> 8)), 4294967295)"

    def put(place: int, edits: str, cost: str, lines: str) -> str:
        return f"CASE WHEN w{place} IS NOT NULL THEN {{'cost': w{place}.cost + {cost}, 'edits': w{place}.edits || '{edits}', 'lines': {lines}}} END"

    def line(place: int, parts: list[str]) -> str:
        return " || ".join([f"w{place}.lines", *(f"chr(10) || {p}" for p in parts)])

    due, role = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "'user:'", 3: "'assistant:'"}
    ways: dict[int, list[str]] = {p: [] for p in range(4)}
    extra = f"CASE WHEN fault = 'truncated' THEN {repair.UNFINISHED} ELSE 0 END"
    open_ = "fault IS NULL OR fault = 'truncated'"
    for place in range(4):
        ways[place].append(put(place, "D", str(repair.DELETE), f"w{place}.lines"))
        at, ahead, price, before = place, "", 0, []
        for _ in range(2):
            kept = {"s": 1 if at == 0 else None, "u": 2 if at != 2 else None, "a": 3 if at == 2 else None}
            for initial, after in kept.items():
                if after is not None:
                    way = put(place, ahead + "K", f"{price} + {extra}", line(place, [*before, "role || ':' || text"]))
                    ways[after].append(f"CASE WHEN ({open_}) AND role[1] = '{initial}' THEN {way} END")
            way = put(place, ahead + "R", f"{price + repair.REROLE} + {extra}", line(place, [*before, f"{role[due[at]]} || text"]))
            ways[due[at]].append(f"CASE WHEN {open_} THEN {way} END")
            before = [*before, role[due[at]]]
            at, ahead, price = due[at], ahead + "I", price + repair.INSERT
    best = ", ".join(f"list_min([{', '.join(w)}]) AS w{p}" for p, w in ways.items())
    last = ", ".join([
        "w0", "w3", put(2, "I", str(repair.INSERT), line(2, [role[3]])), put(1, "II", str(2 * repair.INSERT), line(1, [role[2], role[3]])),
    ])
    none = "CAST(NULL AS STRUCT(cost BIGINT, edits VARCHAR, lines VARCHAR))"
    order = "ORDER BY turn NULLS FIRST, role, text"
    return rf"""
WITH RECURSIVE codes AS (SELECT list(v ORDER BY i) AS codes FROM ({table})),
coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS code
    FROM (SELECT *, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)) AS spelled FROM conversations), codes
), damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM coded, range(2) t(copy) WHERE code <> 0 AND (copy = 0 OR code = 3)
), seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS times,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
    FROM damaged
), turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id {order}, times) AS number,
        CASE WHEN NOT regexp_matches(text, {blank}) THEN 'blank' WHEN times > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
    FROM seen
), pairs AS (
    SELECT *, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY number) || role[1] AS pair FROM turns
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id
), ways AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS number, {{'cost': CAST(0 AS BIGINT), 'edits': '', 'lines': ''}} AS w0, {none} AS w1, {none} AS w2, {none} AS w3 FROM conversations
    UNION ALL
    SELECT conv_id, number, {best} FROM (
        SELECT t.conv_id, t.number, t.role, t.text, t.fault, w.w0, w.w1, w.w2, w.w3
        FROM ways w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.number = w.number + 1
    )
), ended AS (
    SELECT w.conv_id, c.*  EXCLUDE (conv_id), list_min([{last}]) AS way
    FROM ways w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.number = coalesce(c.n, 0)
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, way.cost AS cost, way.edits AS audit, sha256(substr(way.lines, 2)) AS repaired_sha256
FROM ended
"""


CONVERSATIONS = _conversations()
