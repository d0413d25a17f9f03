"""The catalog's queries as SQL for DuckDB, written plainly over the same tables.

The SQL uses one window over each whole key where the Spark plans work in slots, and recomputes
statistics from the readings where they are merged in Spark.
"""

import csv

from shopgauge.operators import fixed_values as fixed
from shopgauge.operators.lookups import MOVED_STATIONS, STATIONS_FILE
from shopgauge.plans.catalog import MARK, RUN_TIME
from shopgauge.plans.clean import AUDIT_COLUMNS, FINAL_QC_COLUMNS, INSPECTION_COLUMNS, SECOND_COLUMNS
from shopgauge.schema import KEY, LIMIT_COLUMNS
from shopgauge.sources.fixtures import BONDING_WORKSHOPS, PLANTS, SAMPLE_SIZES, WORKSHOP_NAMES

K = ", ".join(KEY)
ORACLES: dict[str, str] = {}


def on_key(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in KEY)


def fixed3(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), 3) AS DOUBLE)"


def text(value) -> str:
    return "NULL" if value is None else f"'{value}'"


def pick(names, number: str) -> str:
    return f"([{', '.join(text(n) for n in names)}])[({number}) % {len(names)} + 1]"


def values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


def with_(parts, final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n" + final


# -- fixtures ------------------------------------------------------------------------------------

_plant = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {text(p)}" for t, p in PLANTS.items()) + " ELSE '古城二厂' END"
_size = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {k}" for t, k in SAMPLE_SIZES.items()) + " ELSE 10 END"
def row_id(*columns, equal: bool = False):
    """Each value with its length before it, so that neither borders nor NULL can be mistaken; equal rows are numbered on request."""
    parts = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    if equal:
        parts += ["'#'", f"CAST(row_number() OVER (PARTITION BY {', '.join(columns)}) AS VARCHAR)"]
    return f"sha256(concat({', '.join(parts)}))"


def with_row_ids(columns, rows: str) -> str:
    return f"SELECT {row_id(*columns, equal=True)} AS id, {', '.join(columns)} FROM {rows}"


INSP = [
    ("numbered", "SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events"),
    (
        "insp",
        f"""SELECT CAST(event_id AS VARCHAR) AS id, '巡检' AS first_time, '古二COB二区' AS workshop_code, 'P1' AS part_spec,
        event_type AS op_code, 'S1' AS sta_code, 'A' AS eattribute1_1, 'value' AS testitem, {_plant} AS factory,
        CAST((rn - 1) // ({_size}) AS VARCHAR) AS id_no, CAST((rn - 1) // ({_size}) AS VARCHAR) AS rcard, ts AS mdate,
        CASE WHEN event_type <> 'error' THEN 0.0::DOUBLE END AS lower, CASE WHEN event_type <> 'signup' THEN 60.0::DOUBLE END AS upper,
        CASE WHEN event_id % 97 = 0 THEN 'NG'
             WHEN event_id % 89 = 0 THEN CAST(value AS VARCHAR) || ';' || CAST(value AS VARCHAR) || ';x'
             ELSE CAST(value AS VARCHAR) END AS tdata
        FROM numbered""",
    ),
]

_line_id = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
WIDE = [
    (
        "wide",
        f"""SELECT {_line_id} AS id, '巡检' AS first_time, '古二COB二区' AS workshop_code, p_type AS part_spec,
        l_returnflag AS op_code, p_brand AS sta_code, 'A' AS eattribute1_1, 'quantity' AS testitem, '古城二厂' AS factory,
        CAST(l_orderkey AS VARCHAR) AS id_no, CAST(l_linenumber AS VARCHAR) AS rcard, l_shipdate AS mdate,
        0.0::DOUBLE AS lower, 51.0::DOUBLE AS upper, CAST(l_quantity AS VARCHAR) AS tdata
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
]

BONDING = [
    (
        "placed",
        f"SELECT *, {pick(BONDING_WORKSHOPS, 'l_suppkey')} AS workshop_code, lpad(CAST(l_partkey % 15 + 1 AS VARCHAR), 2, '0') AS num FROM lineitem",
    ),
    (
        "bonding",
        f"""SELECT {_line_id} AS id, CASE WHEN l_linenumber = 7 THEN '首检' ELSE '巡检' END AS first_time, workshop_code,
        'P1' AS part_spec, CASE WHEN l_returnflag = 'N' THEN 'DB' ELSE 'WB' END AS op_code,
        CASE WHEN workshop_code = '古城COB一区' THEN 'WB' || num || CAST(l_partkey % 3 + 1 AS VARCHAR)
             WHEN workshop_code = '生产一区' AND l_linenumber % 2 = 0 AND num = '02' THEN 'WB-01-0030'
             WHEN workshop_code = '生产四区' AND l_linenumber % 2 = 0 AND num = '01' THEN 'WB-03-0226'
             ELSE 'WB' || num END AS sta_code,
        'A' AS eattribute1_1, 'Wire pull' AS testitem,
        CASE workshop_code WHEN '生产四区' THEN '汉浦厂' WHEN '古城COB一区' THEN '古城厂' ELSE '台虹厂' END AS factory,
        CAST(l_orderkey AS VARCHAR) AS id_no, CAST(l_linenumber AS VARCHAR) AS rcard, l_shipdate AS mdate,
        CASE WHEN l_partkey % 5 <> 0 THEN 0.0::DOUBLE END AS lower, CASE WHEN l_partkey % 5 <> 0 THEN 51.0::DOUBLE END AS upper,
        CAST(l_quantity AS VARCHAR) AS tdata
        FROM placed""",
    ),
]

# -- samples and limits --------------------------------------------------------------------------

_number = r"'[-+]?[0-9]*\.?[0-9]+'"


def reading_parts(rows: str, p: str):
    return [
        (
            f"{p}read",
            f"""SELECT m.*, CAST(t.tok AS DOUBLE) AS value FROM {rows} m, unnest(string_split(m.tdata, ';')) AS t(tok)
            WHERE regexp_full_match(t.tok, {_number})""",
        )
    ]


def sample_parts(rows: str, p: str = ""):
    """<p>sub: statistics of each sample; <p>ranged: the same with the (moving) range."""
    timed = (f"{p}timed", f"SELECT *, max(mdate) OVER (PARTITION BY {K}, rcard, id_no) AS last_mdate FROM {rows}")
    return [timed] + reading_parts(f"{p}timed", p) + [
        (
            f"{p}row",
            f"SELECT {K}, rcard, id_no, id, mdate, sum(value) AS row_sum FROM {p}read GROUP BY {K}, rcard, id_no, id, mdate",
        ),
        (
            f"{p}newest",
            f"SELECT {K}, rcard, id_no, arg_max(row_sum, mdate) AS newest_row_sum FROM {p}row GROUP BY {K}, rcard, id_no",
        ),
        (
            f"{p}stat",
            f"""SELECT {K}, rcard, id_no, CAST(count(*) AS INTEGER) AS n, sum(value) AS total, max(value) - min(value) AS span,
            stddev_pop(value) AS deviation, max(last_mdate) AS mdate
            FROM {p}read GROUP BY {K}, rcard, id_no""",
        ),
        (f"{p}sub", f"SELECT s.*, w.newest_row_sum FROM {p}stat s JOIN {p}newest w ON {on_key('s', 'w')} AND s.rcard = w.rcard AND s.id_no = w.id_no"),
        (
            f"{p}ranged",
            f"""SELECT *, CASE WHEN n = 1 THEN abs(total - lag(newest_row_sum) OVER (PARTITION BY {K} ORDER BY mdate, id_no, rcard))
            ELSE span END AS range FROM {p}sub""",
        ),
    ]


def taken_parts(rows: str, take: str, p: str = ""):
    way = "" if take == "oldest" else " DESC"
    return sample_parts(rows, p) + [
        (
            f"{p}taken",
            f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {K} ORDER BY mdate{way}, id_no{way}, rcard{way}) AS INTEGER) AS num
            FROM {p}ranged) WHERE num <= 30""",
        )
    ]


CONSTANTS = "VALUES (1, NULL, NULL, NULL, NULL, NULL), " + ", ".join(
    [f"({n}, {a}::DOUBLE, {d}::DOUBLE, NULL, NULL, NULL)" for n, (a, d) in fixed.A2_D4.items()]
    + [f"({n}, NULL, NULL, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for n, (a, b, c) in fixed.A3_B4_B3.items()]
)
CONST_PART = ("const", f"SELECT * FROM ({CONSTANTS}) AS c(size, a2, d4, a3, b4, b3)")


def limit_select(n: str, x: str, r: str, s: str) -> str:
    half = f"CASE WHEN {n} = 1 THEN 2.660::DOUBLE * {r} WHEN {n} <= 5 THEN a2 * {r} ELSE a3 * {s} END"
    rucl = f"CASE WHEN {n} = 1 THEN 3.267::DOUBLE * {r} WHEN {n} <= 5 THEN d4 * {r} END"
    return f"""{fixed3(f'{x} + {half}')} AS avgucl, {fixed3(f'{x} - {half}')} AS avglcl, {fixed3(rucl)} AS rangeucl,
        CASE WHEN {rucl} IS NOT NULL THEN 0.0::DOUBLE END AS rangelcl,
        {fixed3(f'CASE WHEN {n} >= 6 THEN b4 * {s} END')} AS stddevucl, {fixed3(f'CASE WHEN {n} >= 6 THEN b3 * {s} END')} AS stddevlcl"""


def limit_parts(rows: str, p: str = "", take: str = "oldest", force_n=None, require_spec=True, time=RUN_TIME):
    """<p>limits with the newest measurement time in mdate. `const` must be there."""
    pcs = str(force_n) if force_n else "m.n"
    return taken_parts(rows, take, p) + [
        (
            f"{p}modal",
            f"""SELECT * FROM (SELECT {K}, n, row_number() OVER (PARTITION BY {K} ORDER BY count(*) DESC, n) AS place
            FROM {p}taken GROUP BY {K}, n) WHERE place = 1""",
        ),
        (
            f"{p}centre",
            f"""SELECT {K}, sum(total) / sum(n) AS x, avg(range) AS r, avg(deviation) AS s FROM {p}taken
            GROUP BY {K} HAVING count(*) >= 30""",
        ),
        (
            f"{p}newrow",
            f"""SELECT * FROM (SELECT {K}, upper, lower, mdate, row_number() OVER (PARTITION BY {K} ORDER BY mdate DESC, id DESC) AS place
            FROM {rows}) WHERE place = 1""",
        ),
        (f"{p}sheets", f"SELECT {K}, count(DISTINCT id_no) AS sheets FROM {rows} GROUP BY {K}"),
        (
            f"{p}limits",
            f"""SELECT {', '.join('c.' + k for k in KEY)}, TIMESTAMP '{time}' AS time, CAST({pcs} AS INTEGER) AS pcs,
            w.upper AS usl, w.lower AS lsl, {limit_select(pcs, 'c.x', 'c.r', 'c.s')}, w.mdate
            FROM {p}centre c JOIN {p}modal m ON {on_key('c', 'm')} JOIN {p}newrow w ON {on_key('c', 'w')}
            JOIN {p}sheets h ON {on_key('c', 'h')} JOIN const ON const.size = {pcs}
            WHERE h.sheets >= 30 {'AND (w.upper IS NOT NULL OR w.lower IS NOT NULL)' if require_spec else ''}""",
        ),
    ]


LIMIT_FIELDS = f"{K}, time, pcs, usl, lsl, {', '.join(LIMIT_COLUMNS)}"
ALL_LIMITS = [*INSP, CONST_PART, *limit_parts("insp")]


def add(name: str, parts, final: str):
    ORACLES[name] = with_(parts, final) if parts else final


SAMPLES = [*INSP, *sample_parts("insp")]
add("parse_readings", [*INSP, *reading_parts("insp", "")], "SELECT op_code, id, value FROM read")
add(
    "null_normalise",
    [
        (
            "raw",
            "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN ' null ' ELSE ' ' || props END AS p FROM events",
        )
    ],
    "SELECT event_id, nullif(nullif(trim(p), 'null'), '') AS props FROM raw",
)
add(
    "typed_measurements",
    INSP,
    f"SELECT id, {K}, id_no, rcard, mdate, lower, upper, tdata FROM insp",
)
add(
    "subgroup_stats",
    SAMPLES,
    f"SELECT op_code, rcard, id_no, n, mdate, {fixed3('total')} AS total, {fixed3('span')} AS span, {fixed3('deviation')} AS deviation FROM sub",
)
for name, take in (("last_n_subgroups", "oldest"), ("newest_subgroups", "newest")):
    add(name, [*INSP, *taken_parts("insp", take)], f"SELECT op_code, id_no, num, n, {fixed3('range')} AS range FROM taken")
add(
    "modal_pcs",
    [*INSP, *taken_parts("insp", "oldest")],
    """SELECT op_code, n AS pcs FROM (SELECT op_code, n, row_number() OVER (PARTITION BY op_code ORDER BY count(*) DESC, n) AS place
    FROM taken GROUP BY op_code, n) WHERE place = 1""",
)
for name in ("moving_range", "moving_range_slots"):
    add(name, SAMPLES, f"SELECT op_code, id_no, n, {fixed3('range')} AS range FROM ranged")
for name in ("rank_newest", "rank_newest_slots"):
    add(name, INSP, f"SELECT op_code, id, row_number() OVER (PARTITION BY {K} ORDER BY mdate DESC, id DESC) AS num FROM insp")
add("rank_oldest", INSP, f"SELECT op_code, id_no, id, row_number() OVER (PARTITION BY {K}, id_no ORDER BY mdate, id) AS num FROM insp")
add("row_id", INSP, "SELECT op_code, id_no, id, " + row_id("op_code", "id_no", "id", "tdata") + " AS row_id FROM insp")
add(
    "chart_class",
    SAMPLES,
    """SELECT op_code, id_no, n, CASE WHEN n = 1 THEN 'individual' WHEN n <= 5 THEN 'mean_range' ELSE 'mean_stddev' END AS chart FROM sub""",
)
add("chart_constants", [*SAMPLES, CONST_PART], "SELECT op_code, id_no, n, a2, d4, a3, b4, b3 FROM sub JOIN const ON n = size")
for name in ("control_limits", "limits_from_batches"):
    add(name, ALL_LIMITS, f"SELECT {LIMIT_FIELDS} FROM limits")
add("control_limits_newest", [*INSP, CONST_PART, *limit_parts("insp", take="newest")], f"SELECT {LIMIT_FIELDS} FROM limits")
add(
    "control_limits_n1",
    [*INSP, CONST_PART, *limit_parts("insp", force_n=1, require_spec=False)],
    f"SELECT {LIMIT_FIELDS} FROM limits",
)
_texts = ", ".join(f"coalesce(printf('%.3f', {c}), '') AS {c}" for c in ("usl", "lsl", *LIMIT_COLUMNS))
add(
    "limits_export",
    ALL_LIMITS,
    f"SELECT {', '.join(f"coalesce({k}, '') AS {k}" for k in KEY)}, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, CAST(pcs AS VARCHAR) AS pcs, {_texts} FROM limits",
)
add("limits_imr", ALL_LIMITS, f"SELECT {LIMIT_FIELDS} FROM limits WHERE pcs = 1")
add("limits_xbar_r", ALL_LIMITS, f"SELECT {LIMIT_FIELDS} FROM limits WHERE pcs BETWEEN 2 AND 5")
add("limits_xbar_s", ALL_LIMITS, f"SELECT {LIMIT_FIELDS} FROM limits WHERE pcs >= 6")
add(
    "limits_scoped",
    [
        *BONDING,
        ("scoped", "SELECT * FROM bonding WHERE first_time = '巡检' AND op_code = 'WB' AND workshop_code = '生产三区'"),
        CONST_PART,
        *limit_parts("scoped"),
    ],
    f"SELECT {LIMIT_FIELDS} FROM limits",
)

def _csv_rows(path):
    with open(path, encoding="utf-8", newline="") as file:
        return [(r["workshop"], r["plant"] or None, r["old"], r["new"]) for r in csv.DictReader(file)]


_station_rows = _csv_rows(STATIONS_FILE)
STATIONS = ("stations", f"SELECT * FROM ({values(_station_rows)}) AS v(workshop, plant, old, new)")
_match = "r.workshop_code = v.workshop AND (v.plant IS NULL OR r.factory = v.plant) AND r.sta_code = v.old"
WB_ROWS = ("wbrows", "SELECT * FROM bonding WHERE first_time = '巡检' AND op_code = 'WB'")
_other_fields = "r.* EXCLUDE (sta_code), coalesce(v.new, r.sta_code) AS sta_code"
_latest = f"row_number() OVER (PARTITION BY {K} ORDER BY mdate DESC, pcs DESC, avgucl DESC, avglcl DESC) AS place"
add(
    "limits_recode",
    [
        *BONDING,
        WB_ROWS,
        STATIONS,
        CONST_PART,
        *limit_parts("wbrows", require_spec=False),
        ("recoded", f"SELECT {_other_fields} FROM limits r LEFT JOIN stations v ON {_match}"),
    ],
    f"SELECT {LIMIT_FIELDS} FROM (SELECT *, {_latest} FROM recoded) WHERE place = 1",
)
add(
    "limits_recode_first",
    [
        *BONDING,
        WB_ROWS,
        STATIONS,
        CONST_PART,
        ("recoded", f"SELECT {_other_fields} FROM wbrows r LEFT JOIN stations v ON {_match}"),
        *limit_parts("recoded", require_spec=False),
    ],
    f"SELECT {LIMIT_FIELDS} FROM limits",
)
_move_rows = [(old, new) for _, _, old, new in _csv_rows(MOVED_STATIONS)]
add(
    "limits_relocate",
    [
        *BONDING,
        ("moving", "SELECT * FROM bonding WHERE first_time = '巡检' AND op_code = 'WB' AND workshop_code = '生产四区' AND factory = '汉浦厂'"),
        ("moves", f"SELECT * FROM ({values(_move_rows)}) AS v(old, new)"),
        CONST_PART,
        *limit_parts("moving", require_spec=False),
        (
            "recoded",
            """SELECT r.* EXCLUDE (sta_code, workshop_code, factory), coalesce(v.new, r.sta_code) AS sta_code,
            CASE WHEN v.new IS NULL THEN workshop_code ELSE '古二COB二区' END AS workshop_code,
            CASE WHEN v.new IS NULL THEN factory ELSE '古城厂' END AS factory FROM limits r LEFT JOIN moves v ON r.sta_code = v.old""",
        ),
    ],
    f"SELECT {LIMIT_FIELDS} FROM (SELECT *, {_latest} FROM recoded) WHERE place = 1",
)

# -- points and rules ----------------------------------------------------------------------------

add(
    "limited_measurements",
    ALL_LIMITS,
    f"SELECT op_code, id_no, id, tdata FROM insp WHERE EXISTS (SELECT 1 FROM limits l WHERE {' AND '.join(f'l.{k} IS NOT DISTINCT FROM insp.{k}' for k in KEY)})",
)


def point_parts(rows: str, limits: str, p: str = "p", mark: str | None = None):
    same = " AND ".join(f"l.{k} IS NOT DISTINCT FROM m.{k}" for k in KEY)
    after = f" AND mdate > TIMESTAMP '{mark}'" if mark else ""
    return [
        (
            f"{p}rows",
            f"""SELECT *, first_value(rcard) OVER s AS first_rcard, min(mdate) OVER (PARTITION BY {K}, id_no) AS first_mdate
            FROM {rows} m WHERE EXISTS (SELECT 1 FROM {limits} l WHERE {same}) WINDOW s AS (PARTITION BY {K}, id_no ORDER BY mdate)""",
        ),
        *reading_parts(f"{p}rows", p),
        (
            f"{p}sheet",
            f"""SELECT {K}, id_no, any_value(first_rcard) AS rcard, any_value(first_mdate) AS mdate, count(*) AS n, avg(value) AS mean,
            min(value) AS low, max(value) AS high, stddev_pop(value) AS deviation FROM {p}read GROUP BY {K}, id_no""",
        ),
        (
            f"{p}prev",
            f"""SELECT *, lag(low) OVER w AS plow, lag(high) OVER w AS phigh FROM {p}sheet
            WINDOW w AS (PARTITION BY {K} ORDER BY mdate, id_no)""",
        ),
        (
            f"{p}points",
            f"""SELECT {row_id(*KEY, 'id_no')} AS id, {K}, id_no, rcard, mdate, n, {fixed3('mean')} AS avgvalue,
            {fixed3('CASE WHEN n = 1 THEN greatest(high, phigh) - least(low, plow) WHEN n <= 5 THEN high - low END')} AS rangevalue,
            {fixed3('CASE WHEN n >= 6 THEN deviation END')} AS stddevvalue
            FROM {p}prev WHERE (n > 1 OR plow IS NOT NULL){after}""",
        ),
    ]


POINT_FIELDS = f"id, {K}, id_no, rcard, mdate, avgvalue, rangevalue, stddevvalue"
ALL_POINTS = [*ALL_LIMITS, *point_parts("insp", "limits")]
add("chart_points", ALL_POINTS, f"SELECT {POINT_FIELDS} FROM ppoints")
add("points_individual", ALL_POINTS, f"SELECT {POINT_FIELDS} FROM ppoints WHERE n = 1")
for name in ("sink_append", "points_to_sink"):
    add(name, ALL_POINTS, f"SELECT {POINT_FIELDS} FROM ppoints")
add("sink_partitions", ALL_POINTS, "SELECT CAST(3 AS BIGINT) AS n_files, count(*) AS n_points FROM ppoints")
add(
    "lookback_points",
    [
        *ALL_LIMITS,
        ("recent", f"SELECT * FROM insp WHERE mdate > CAST(TIMESTAMP '{MARK}' AS DATE) - INTERVAL 10 DAY"),
        *point_parts("recent", "limits", mark=MARK),
    ],
    f"SELECT {POINT_FIELDS} FROM ppoints",
)

_MEASURES = {
    "avg": ("avgvalue", "avgucl", "avglcl"),
    "range": ("rangevalue", "rangeucl", "rangelcl"),
    "stddev": ("stddevvalue", "stddevucl", "stddevlcl"),
}


def lag(v: str, i: int) -> str:
    return f"lag({v}, {i}) OVER w"


def rule_sql(rule: int, v: str, u: str, low: str, compat: bool = False) -> str:
    if rule == 1:
        return f"({v} > {u} OR {v} < {low})"
    if rule == 4:
        chain = [lag(v, i) for i in range(1, 6)]
        chain = [v, *(reversed(chain) if compat else chain)]
        up = " AND ".join(f"{a} > {b}" for a, b in zip(chain, chain[1:]))
        down = " AND ".join(f"{a} < {b}" for a, b in zip(chain, chain[1:]))
        return f"(({up}) OR ({down}))"
    depth, need, share = (2, 1, 2) if rule == 2 else (4, 3, 1)
    cl = f"(({u} + {low}) / 2)"
    dist = f"(({u} - {cl}) * {share} / 3)"
    there = " AND ".join(f"{lag(v, i)} IS NOT NULL" for i in range(1, depth + 1))
    sides = []
    for cmp in (">", "<"):
        def far(x):
            return f"(abs({x} - {cl}) > {dist} AND {x} {cmp} {cl})"
        count = " + ".join(f"CAST({far(lag(v, i))} AS INTEGER)" for i in range(1, depth + 1))
        sides.append(f"({far(v)} AND {count} >= {need})")
    return f"({there} AND ({sides[0]} OR {sides[1]}))"


def judged_parts(points: str, rules, p: str = "j", compat: bool = False):
    flags = ", ".join(
        f"coalesce({rule_sql(r, *m, compat)}, false) AS {name}_{r}" for r in rules for name, m in _MEASURES.items()
    )
    limit_fields = ", ".join("l." + c for c in ("pcs", "usl", "lsl", *LIMIT_COLUMNS))
    same = " AND ".join(f"l.{k} IS NOT DISTINCT FROM q.{k}" for k in KEY)
    return [
        (f"{p}join", f"SELECT q.*, {limit_fields} FROM {points} q JOIN limits l ON {same}"),
        (f"{p}flag", f"SELECT *, {flags} FROM {p}join WINDOW w AS (PARTITION BY {K} ORDER BY mdate, id_no)"),
    ]


for name, rule, compat in (
    ("rule_outside", 1, False),
    ("rule_2of3", 2, False),
    ("rule_4of5", 3, False),
    ("rule_trend6", 4, False),
    ("rule_trend6_compat", 4, True),
):
    add(
        name,
        [*ALL_POINTS, *judged_parts("ppoints", [rule], compat=compat)],
        "SELECT op_code, id_no, " + ", ".join(f"CAST({m}_{rule} AS INTEGER) AS {m}" for m in _MEASURES) + " FROM jflag",
    )


def result_parts(rules, p: str = "j", extra: str = ""):
    words = []
    for r in rules:
        number = fixed.RULE_NUMBERS[r]
        if r in (2, 3):
            words += [f"CASE WHEN pcs = 1 AND avg_{r} THEN '单值{number}' END", f"CASE WHEN pcs = 1 AND range_{r} THEN '极差{number}' END"]
        else:
            words += [
                f"CASE WHEN avg_{r} THEN CASE WHEN pcs = 1 THEN '单值{number}' ELSE '均值{number}' END END",
                f"CASE WHEN pcs <= 5 AND range_{r} THEN '极差{number}' END",
                f"CASE WHEN pcs >= 6 AND stddev_{r} THEN '标准差{number}' END",
            ]
    return [
        (
            f"{p}results",
            f"""SELECT id, mdate AS time, {K}, id_no, rcard, pcs AS samplenum, usl, lsl, {', '.join(LIMIT_COLUMNS)}, avgvalue AS testvalueavg,
            rangevalue AS testvaluerange, stddevvalue AS testvaluestdev, concat_ws(', ', {', '.join(words)}) AS spcwarn,
            CASE WHEN pcs = 1 THEN '单值和移动极差图' WHEN pcs <= 5 THEN '均值极差图' ELSE '均值标准差图' END AS spcgraphtype
            FROM {p}flag WHERE avgvalue IS NOT NULL AND CASE WHEN pcs >= 6 THEN stddevvalue IS NOT NULL ELSE rangevalue IS NOT NULL END {extra}""",
        )
    ]


ALL_RESULTS = [*ALL_POINTS, *judged_parts("ppoints", [1, 2, 3, 4]), *result_parts([1, 2, 3, 4])]
for name in ("judge_full", "judge_full_slots"):
    add(name, ALL_RESULTS, "SELECT * FROM jresults")
add(
    "judge_stream_of_batches",
    [*ALL_POINTS, *judged_parts("ppoints", [1, 4]), *result_parts([1, 4])],
    "SELECT * FROM jresults",
)
add(
    "judge_incremental",
    [
        *ALL_POINTS,
        ("recent", f"SELECT * FROM ppoints WHERE mdate > CAST(TIMESTAMP '{MARK}' AS DATE) - INTERVAL 90 DAY"),
        *judged_parts("recent", [1, 4]),
        *result_parts(
            [1, 4],
            extra=f"AND mdate > TIMESTAMP '{MARK}' AND (pcs < 6 OR (stddevucl IS NOT NULL AND stddevlcl IS NOT NULL))",
        ),
    ],
    "SELECT * FROM jresults",
)


def recheck_parts(excluded, classes: str):
    out = f"WHERE coalesce(factory NOT IN ({', '.join(text(f) for f in excluded)}), true)" if excluded else ""
    clean = "FILTER (spcwarn = '')"
    return [
        (
            "recent25",
            f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY time DESC, id_no DESC) AS num FROM jresults {out}) WHERE num <= 25",
        ),
        (
            "checked",
            f"""SELECT {K}, count(*) {clean} AS clean_points, avg(testvalueavg) {clean} AS x, avg(testvaluerange) {clean} AS r,
            avg(testvaluestdev) {clean} AS s, min(samplenum) FILTER (num = 1) AS pcs FROM recent25 GROUP BY {K} HAVING count(*) >= 25""",
        ),
        (
            "acted",
            f"""SELECT *, CASE WHEN clean_points = 0 THEN 'delete' WHEN clean_points < 25 AND {classes} THEN 'update' ELSE 'keep' END AS action
            FROM checked""",
        ),
        (
            "decided",
            f"SELECT {K}, action, clean_points, pcs, {limit_select('pcs', 'x', 'r', 's')} FROM acted JOIN const ON size = least(pcs, 25)",
        ),
        (
            "decisions",
            f"SELECT {K}, action, clean_points, pcs, "
            + ", ".join(f"CASE WHEN action = 'update' THEN {c} END AS {c}" for c in LIMIT_COLUMNS)
            + " FROM decided",
        ),
    ]


RECHECK = [*ALL_RESULTS, *recheck_parts(fixed.RECHECK_EXCLUDED_PLANTS, "pcs <= 25")]
add("relimit", RECHECK, "SELECT * FROM decisions")
add(
    "relimit_n1",
    [*ALL_POINTS, *judged_parts("ppoints", [1]), *result_parts([1]), *recheck_parts([], "pcs = 1")],
    "SELECT * FROM decisions",
)
add(
    "relimit_apply",
    RECHECK,
    f"SELECT {', '.join('l.' + k for k in KEY)}, time, l.pcs, usl, lsl, "
    + ", ".join(f"CASE WHEN d.action = 'update' THEN d.{c} ELSE l.{c} END AS {c}" for c in LIMIT_COLUMNS)
    + f" FROM limits l LEFT JOIN decisions d ON {on_key('l', 'd')} WHERE d.action IS DISTINCT FROM 'delete'",
)
_some = ("chosen", "SELECT * FROM insp WHERE op_code IN ('click', 'view', 'purchase')")
add(
    "limits_upsert",
    [*ALL_LIMITS, _some, *limit_parts("chosen", "n_", take="newest", time="2024-03-01 00:00:00")],
    f"SELECT {LIMIT_FIELDS} FROM n_limits UNION ALL SELECT {LIMIT_FIELDS} FROM limits l WHERE NOT EXISTS (SELECT 1 FROM n_limits n WHERE {on_key('n', 'l')})",
)
add(
    "limits_update",
    [*ALL_LIMITS, ("chosen", "SELECT * FROM insp WHERE op_code <> 'click'"), *limit_parts("chosen", "n_", take="newest")],
    f"SELECT {', '.join('l.' + k for k in KEY)}, l.time, l.pcs, l.usl, l.lsl, "
    + ", ".join(f"CASE WHEN n.op_code IS NOT NULL THEN n.{c} ELSE l.{c} END AS {c}" for c in LIMIT_COLUMNS)
    + f" FROM limits l LEFT JOIN n_limits n ON {on_key('l', 'n')}",
)
add(
    "limits_merge",
    [*ALL_LIMITS, *limit_parts("insp", "n_", take="newest", time="2024-03-01 00:00:00")],
    f"SELECT {LIMIT_FIELDS} FROM limits WHERE op_code = 'error' UNION ALL SELECT {LIMIT_FIELDS} FROM n_limits "
    f"WHERE op_code NOT IN ('click', 'view', 'error') UNION ALL SELECT {', '.join('l.' + k for k in KEY)}, l.time, l.pcs, l.usl, l.lsl, "
    + ", ".join(f"n.{c}" for c in LIMIT_COLUMNS)
    + f" FROM limits l JOIN n_limits n ON {on_key('l', 'n')} WHERE l.op_code = 'view'",
)
add("limits_delete", ALL_LIMITS, f"SELECT {LIMIT_FIELDS} FROM limits WHERE pcs <> 1")

# -- capability ----------------------------------------------------------------------------------


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


_LABEL = {
    "week": "'WEEK' || CAST(weekofyear({e}) AS VARCHAR)",
    "month": "strftime({e}, '%Y-%m')",
    "quarter": "'Q' || CAST(quarter({e}) AS VARCHAR)",
    "year": "strftime({e}, '%Y')",
}
_STEP = {"week": "7 DAY", "month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR"}


def cpk_sql(rows: str, unit: str, clip: str | None = None):
    begin, end = "b", f"CAST(b + INTERVAL {_STEP[unit]} - INTERVAL 1 DAY AS DATE)"
    if clip:
        begin = f"greatest({begin}, (SELECT CAST(min(ts) AS DATE) FROM {clip}))"
        end = f"least({end}, (SELECT CAST(max(ts) AS DATE) FROM {clip}))"
    year = "d1" if unit == "week" else "d2"
    return [
        ("digits", f"SELECT * FROM {rows} WHERE first_time = '巡检' AND regexp_matches(tdata, '[1-9]')"),
        *reading_parts("digits", ""),
        (
            "pooled",
            f"""SELECT {K}, CAST(date_trunc('{unit}', mdate) AS DATE) AS b, count(*) AS n, avg(value) AS x, stddev_pop(value) AS s
            FROM read GROUP BY {K}, b HAVING count(*) >= 32""",
        ),
        (
            "spec",
            f"""SELECT * FROM (SELECT {K}, CAST(date_trunc('{unit}', mdate) AS DATE) AS b, upper, lower,
            row_number() OVER (PARTITION BY {K}, date_trunc('{unit}', mdate) ORDER BY mdate DESC, id DESC) AS place FROM read) WHERE place = 1""",
        ),
        (
            "indexed",
            f"""SELECT p.*, {begin.replace('b', 'p.b', 1) if begin == 'b' else begin.replace('greatest(b', 'greatest(p.b')} AS d1,
            {end.replace('CAST(b', 'CAST(p.b')} AS d2, {fixed3('abs(w.upper - x) / 3 / nullif(s, 0)')} AS cpuvalue,
            {fixed3('abs(x - w.lower) / 3 / nullif(s, 0)')} AS cplvalue
            FROM pooled p JOIN spec w ON {on_key('p', 'w')} AND p.b = w.b WHERE coalesce(w.upper > w.lower, w.upper IS NOT NULL OR w.lower IS NOT NULL)""",
        ),
    ], f"""SELECT {row_id(f"'{unit}'", f"({day('d1')} || '至' || {day('d2')})", *KEY)} AS id, {day('d1')} || '至' || {day('d2')} AS {unit}time, strftime({year}, '%Y') AS year, {_LABEL[unit].format(e='d2')} AS {unit}, {K},
        cpuvalue, cplvalue, least(cpuvalue, cplvalue) AS cpkvalue, 1.0::DOUBLE AS cpkwarnline FROM indexed"""


_parts, _final = cpk_sql("insp", "week", "events")
add("cpk_week", [*INSP, *_parts], _final)
_parts, _final = cpk_sql("insp", "week")
add("cpk_onesided", [*INSP, *_parts], _final + " WHERE cpuvalue IS NULL OR cplvalue IS NULL")
add("cpk_finished_weeks", [*INSP, *_parts], _final + " WHERE d2 < DATE '2024-02-05'")
_parts, _final = cpk_sql("flat", "month")
for name in ("cpk_month", "cpk_from_days"):
    add(name, [*WIDE, ("flat", "SELECT * REPLACE ('-' AS op_code, '-' AS sta_code) FROM wide"), *_parts], _final)
_parts, _final = cpk_sql("flat", "quarter")
add("cpk_quarter", [*WIDE, ("flat", "SELECT * REPLACE ('-' AS part_spec) FROM wide"), *_parts], _final)

# -- calendar ------------------------------------------------------------------------------------

for unit, step in _STEP.items():
    add(
        f"periods_{unit}",
        [
            ("ranges", "SELECT l_suppkey, CAST(min(l_shipdate) AS DATE) AS b, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem GROUP BY l_suppkey"),
            (
                "units",
                f"""SELECT l_suppkey, b, e, CAST(u AS DATE) AS u FROM ranges,
                unnest(generate_series(date_trunc('{unit}', b)::TIMESTAMP, e::TIMESTAMP, INTERVAL {step})) AS g(u)""",
            ),
            (
                "clipped",
                f"SELECT l_suppkey, greatest(u, b) AS d1, least(CAST(u + INTERVAL {step} - INTERVAL 1 DAY AS DATE), e) AS d2 FROM units",
            ),
        ],
        f"""SELECT l_suppkey, {day('d1')} || '至' || {day('d2')} AS period, strftime({'d1' if unit == 'week' else 'd2'}, '%Y') AS year,
        {_LABEL[unit].format(e='d2')} AS label FROM clipped""",
    )

add(
    "calendar_dim",
    [
        ("bounds", "SELECT CAST(min(l_shipdate) AS DATE) AS b, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem"),
        ("days", "SELECT CAST(u AS DATE) AS d FROM bounds, unnest(generate_series(b::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 DAY)) AS g(u)"),
        (
            "parts",
            """SELECT d, CAST(date_trunc('week', d) AS DATE) AS wb, CAST(date_trunc('month', d) AS DATE) AS mb,
            CAST(date_trunc('quarter', d) AS DATE) AS qb, last_day(d) AS me,
            CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qe FROM days""",
        ),
    ],
    f"""SELECT {day('d')} AS day, strftime(d, '%Y%m%d') AS compact_day, {day("strptime(strftime(d, '%Y%m%d'), '%Y%m%d')")} AS from_compact,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
    CAST(dayofweek(d) AS INTEGER) AS weekday, CAST(weekofyear(d) AS INTEGER) AS week_of_year, {day('wb')} AS week_begin,
    {day('wb + 6')} AS week_end, {day('wb')} || ' - ' || {day('wb + 6')} AS week_label, strftime(d, '%Y-%m') AS year_month,
    {day('mb')} AS month_begin, {day('me')} AS month_end, CAST(day(me) AS INTEGER) AS days_in_month,
    CAST(day(d) AS INTEGER) AS passed_in_month, CAST(me - d AS INTEGER) AS left_in_month, CAST(quarter(d) AS INTEGER) AS season,
    strftime(qb, '%Y-%m') || ',' || strftime(qb + INTERVAL 1 MONTH, '%Y-%m') || ',' || strftime(qb + INTERVAL 2 MONTH, '%Y-%m') AS season_months,
    {day('qb')} AS season_begin, {day('qe')} AS season_end, CAST(qe - qb + 1 AS INTEGER) AS days_in_season,
    CAST(d - qb + 1 AS INTEGER) AS passed_in_season, CAST(qe - d AS INTEGER) AS left_in_season FROM parts""",
)

# -- slices --------------------------------------------------------------------------------------

add(
    "watermark_slice",
    [
        ("mark", f"SELECT coalesce(max(ts), TIMESTAMP '2020-06-01 01:12:51') AS t FROM events WHERE event_type = 'error' AND ts <= TIMESTAMP '{MARK}'"),
        ("newest", "SELECT max(ts) AS t FROM events"),
    ],
    "SELECT event_id, ts, event_type, value FROM events WHERE ts > (SELECT t FROM mark) AND ts <= (SELECT t FROM newest)",
)
add(
    "next_month_slice",
    [
        (
            "done",
            "SELECT date_trunc('month', max(l_shipdate)) AS b FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-06-15'",
        )
    ],
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_shipdate >= coalesce((SELECT b FROM done), TIMESTAMP '1995-08-01') AND l_shipdate < TIMESTAMP '1999-09-01'""",
)
add(
    "next_period_slice",
    [("done", "SELECT CAST(max(l_shipdate) AS DATE) + 1 AS b FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-03-31'")],
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {day('l_shipdate')} AS ship_day FROM lineitem
    WHERE CAST(l_shipdate AS DATE) >= (SELECT coalesce(b, DATE '1995-01-01') FROM done)""",
)

# -- lookups and cleaning ------------------------------------------------------------------------

WORKSHOPS = ("workshops", f"SELECT * FROM ({values([(o, *v) for o, v in fixed.WORKSHOPS.items()])}) AS v(old, plant, new)")
_plain = {**fixed.WORKSHOPS, **fixed.WORKSHOPS_EXTRA}
_sections = [(o, p, None, c, t) for o, (p, c, t) in fixed.WORKSHOPS_BY_SECTION.items()]
_sections += [(o, p, n, n, n) for o, (p, n) in _plain.items() if o not in fixed.WORKSHOPS_BY_SECTION]
SECTIONS = ("sections", f"SELECT * FROM ({values(_sections)}) AS v(old, plant, anyname, cob, test)")


def by_class(c: str) -> str:
    return f"CASE WHEN {c} IN ('十级', 'COB') THEN v.cob WHEN {c} IN ('千级', '测试') THEN v.test ELSE v.anyname END"


NAMED = (
    "named",
    f"""SELECT o_orderkey, {pick(WORKSHOP_NAMES, 'o_custkey')} AS w,
    CASE WHEN o_orderkey % 5 <> 4 THEN {pick(['十级', '千级', 'COB', '测试', '其它'], 'o_orderkey % 7')} END AS c FROM orders""",
)
for name, part, new in (
    ("workshop_map", WORKSHOPS, "v.new"),
    ("workshop_map_class", SECTIONS, by_class("c")),
    ("workshop_map_fqc", SECTIONS, "v.test"),
):
    add(
        name,
        [NAMED, part],
        f"""SELECT o_orderkey, CASE WHEN v.old IS NULL THEN w ELSE {new} END AS workshop_code, v.plant AS factory
        FROM named LEFT JOIN {part[0]} v ON w = v.old""",
    )
add(
    "station_recode",
    [*BONDING, STATIONS],
    f"SELECT r.id, r.workshop_code, r.factory, coalesce(v.new, r.sta_code) AS sta_code, r.tdata FROM bonding r LEFT JOIN stations v ON {_match}",
)
INSPECTIONS = [
    WORKSHOPS,
    (
        "header",
        f"""SELECT o_orderkey AS id, {pick(WORKSHOP_NAMES, 'o_custkey')} AS w, o_orderdate AS mdate,
        CASE WHEN o_orderpriority = '5-LOW' THEN '首检' ELSE '巡检' END AS first_time, 'R' || o_custkey AS rcard, 'P1' AS part_spec,
        '8M' AS pixel, {pick(['DB', 'WB', 'HM', 'AA'], 'o_orderkey')} AS op_code, 'S' || (o_orderkey % 10) AS sta_code,
        'A' AS eattribute1_1, o_orderstatus AS result FROM orders""",
    ),
    (
        "detail",
        f"""SELECT l_orderkey AS id_no, {pick(['偏心X', 'Wire pull', '浮高Z', 'holder shear', '其它'], 'l_linenumber')} AS testitem,
        0.0::DOUBLE AS lower, 51.0::DOUBLE AS upper, CAST(l_quantity AS VARCHAR) AS tdata FROM lineitem""",
    ),
    (
        "inspections",
        f"""SELECT CASE WHEN v.old IS NULL THEN w ELSE v.new END AS workshop_code, mdate, first_time, rcard, part_spec, pixel, op_code, sta_code,
        testitem, eattribute1_1, result, id_no, lower, upper, tdata, v.plant AS factory
        FROM header JOIN detail ON header.id = detail.id_no LEFT JOIN workshops v ON w = v.old""",
    ),
]
ITEMS = (
    "items",
    f"SELECT * FROM ({values([(op, i) for op, items in fixed.CHARTED_ITEMS.items() for i in items])}) AS v(op, item)",
)
add("inspection_clean", INSPECTIONS, with_row_ids([*INSPECTION_COLUMNS, "factory"], "inspections"))
_listed = "EXISTS (SELECT 1 FROM items WHERE op = op_code AND item = testitem)"
add("item_whitelist", [*INSPECTIONS, ITEMS], f"SELECT id_no, op_code, testitem, tdata FROM inspections WHERE {_listed}")
add("item_rejected", [*INSPECTIONS, ITEMS], f"SELECT id_no, op_code, testitem, tdata FROM inspections WHERE NOT {_listed}")

_audit_own = {
    "description": "concat_ws(',', s_name, s_nationkey, 'ok')",
    "mdate": "'2021-01-05 08:00:00'",
    "muser": "s_name",
    "id": "CAST(s_suppkey AS DOUBLE)",
    "area": f"CASE WHEN v.old IS NULL THEN a ELSE {by_class('k')} END",
    "eattribute2": "k",
    "qty": "CAST(s_acctbal AS VARCHAR)",
}
add(
    "audit_clean",
    [
        SECTIONS,
        (
            "found",
            f"""SELECT *, {pick(WORKSHOP_NAMES, 's_suppkey')} AS a,
            CASE WHEN s_suppkey % 5 <> 4 THEN {pick(['十级', '千级', '其它'], 's_suppkey')} END AS k FROM supplier""",
        ),
    ],
    "SELECT "
    + ", ".join(f"{_audit_own.get(c, text(c))} AS {c}" for c in AUDIT_COLUMNS)
    + """, v.plant AS factory, CASE k WHEN '十级' THEN 'COB' WHEN '千级' THEN '测试' ELSE '' END AS section
    FROM found LEFT JOIN sections v ON a = v.old""",
)
add(
    "fqc_clean",
    [
        SECTIONS,
        (
            "lots",
            f"""SELECT o_orderkey AS wo_code, 'R' || o_orderkey AS rcard, {pick(['QC外观检', 'QC CCD检验', '其它'], 'o_orderkey')} AS op_code,
            CAST(floor(o_totalprice / 1000) AS DOUBLE) AS ok_qty, CAST(o_orderkey % 50 AS DOUBLE) AS sampling_qty,
            'U' || (o_custkey % 9) AS muser, o_orderdate AS mdate, {pick(WORKSHOP_NAMES, 'o_custkey')} AS w,
            o_custkey % 200 + 1 AS item_code FROM orders""",
        ),
        (
            "bad",
            "SELECT rcard, op_code, mdate, wo_code % 30 AS ec_code, CAST(wo_code % 3 AS DOUBLE) AS qty FROM lots WHERE wo_code % 4 = 0",
        ),
        ("pnames", "SELECT DISTINCT op_code AS pname FROM lots"),
        (
            "checked",
            """SELECT wo_code, p_brand AS pixel, lots.rcard, 'RT1' AS router_code, lots.op_code, ok_qty, sampling_qty, n_name AS ec_name, qty,
    CASE WHEN qty IS NULL OR qty = 0 THEN 'OK' ELSE 'NG' END AS result, muser, lots.mdate,
    CASE WHEN v.old IS NULL THEN w ELSE v.test END AS workshop_code, v.plant AS factory
    FROM lots LEFT JOIN bad ON lots.rcard = bad.rcard AND lots.op_code = bad.op_code AND lots.mdate = bad.mdate
    LEFT JOIN nation ON bad.ec_code = n_nationkey JOIN part ON item_code = p_partkey LEFT JOIN pnames ON lots.op_code = pname
    LEFT JOIN sections v ON w = v.old WHERE lots.op_code IN ('QC外观检', 'QC CCD检验')""",
        ),
    ],
    with_row_ids(FINAL_QC_COLUMNS, "checked"),
)
_second_rows = [r for r in _station_rows if r[0] in ("生产一区", "生产四区", "古城COB一区")]
add(
    "wb_join",
    [
        ("plants", f"SELECT * FROM ({values(fixed.SECOND_SOURCE_PLANTS.items())}) AS v(workshop, plant)"),
        ("stations", f"SELECT * FROM ({values(_second_rows)}) AS v(workshop, plant, old, new)"),
        (
            "header",
            f"""SELECT s_suppkey AS id, {pick(['生产一区', '生产四区', '古城COB一区', '未知区'], 's_suppkey')} AS workshop_code,
            CAST(DATE '2021-01-01' + CAST(s_suppkey AS INTEGER) AS TIMESTAMP) AS mdate,
            CASE WHEN s_suppkey % 5 = 0 THEN '首检' ELSE '巡检' END AS first_time, s_name AS rcard, n_name AS part_spec,
            CASE WHEN s_suppkey % 7 = 0 THEN 'DB' ELSE 'WB' END AS op_code,
            'WB' || lpad(CAST(s_suppkey % 20 + 1 AS VARCHAR), 2, '0') || CASE WHEN s_suppkey % 4 = 2 THEN '1' ELSE '' END AS line
            FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        ),
        (
            "joined",
            """SELECT h.*, p.plant, 'Wire pull' AS testitem, l_returnflag AS eattribute1_1, CAST(h.id AS DOUBLE) AS id_no, 0.0::DOUBLE AS lower,
            51.0::DOUBLE AS upper, concat_ws(';', l_quantity, l_linenumber) AS tdata
            FROM header h JOIN lineitem ON h.id = l_suppkey LEFT JOIN plants p ON h.workshop_code = p.workshop
            WHERE op_code = 'WB' AND first_time = '巡检'""",
        ),
        (
            "coded",
            """SELECT workshop_code, mdate, first_time, rcard,
    part_spec, op_code, coalesce(v.new, line) AS sta_code, testitem, eattribute1_1, id_no, lower, upper, tdata, j.plant AS factory
    FROM joined j LEFT JOIN stations v ON j.workshop_code = v.workshop AND (v.plant IS NULL OR j.plant = v.plant) AND line = v.old""",
        ),
    ],
    with_row_ids(SECOND_COLUMNS, "coded"),
)
