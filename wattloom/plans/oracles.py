"""The same queries in plain SQL, for a second engine to check the results."""

from __future__ import annotations

# Fixed values, stated here anew so that a wrong entry on the other side shows.
VOLT_PHASES = {1: "volt_a", 2: "volt_b", 3: "volt_c"}
CURRENT_PHASES = {1: "cur_a", 2: "cur_b", 3: "cur_c"}
FACTOR_PHASES = {0: "pfsum", 1: "pf_a", 2: "pf_b", 3: "pf_c"}
POWER_TYPES = {1: "psum", 2: "pa", 3: "pb", 4: "pc", 5: "qsum", 6: "qa", 7: "qb", 8: "qc"}
DAY_CURVES = {
    "P": ("P", "data_type", 1),
    "Q": ("P", "data_type", 5),
    "V": ("U", "phase_flag", 0),
    "A": ("I", "phase_flag", 0),
    "PF": ("C", "phase_flag", 0),
    "EP": ("R", "data_type", 1),
    "EQ": ("R", "data_type", 2),
}
CHANNELS = [
    ("V", 1, "V", "A"), ("V", 2, "V", "B"), ("V", 3, "V", "C"),
    ("A", 1, "A", "A"), ("A", 2, "A", "B"), ("A", 3, "A", "C"),
    ("PF", 0, "PF", "none"), ("PF", 1, "PF", "A"), ("PF", 2, "PF", "B"), ("PF", 3, "PF", "C"),
    ("P", 1, "P", "none"), ("P", 2, "P", "A"), ("P", 3, "P", "B"), ("P", 4, "P", "C"),
    ("P", 5, "Q", "none"), ("P", 6, "Q", "A"), ("P", 7, "Q", "B"), ("P", 8, "Q", "C"),
    ("E", 1, "EP", "none"), ("E", 2, "EQ", "none"),
]
MEASUREMENT_KINDS = {1: "V", 2: "A", 3: "P", 4: "Q", 5: "PF", 6: "EP", 7: "EQ"}
PHASE_NAMES = {0: "none", 1: "phaseA", 2: "phaseB", 3: "phaseC"}
LOAD_TYPES = ("Industrial", "Commercial", "Residential")
SEASONS = ("Spring", "Summer", "Fall", "Winter")
DAYTYPES = ("Weekday", "Weekend", "Holiday")

READINGS = """
readings AS (
  SELECT *, CAST(day AS TIMESTAMP) + to_minutes(CAST(15 * (idx - 1) AS BIGINT)) AS ts,
         CAST(date_diff('day', DATE '2013-01-01', day) * 96 + idx AS BIGINT) AS dti
  FROM (
    SELECT id, DATE '2013-01-01' + CAST((dd // 7) * 91 + dd % 7 AS INTEGER) AS day,
           CAST(CASE id % 3 WHEN 0 THEN h % 96 + 1 WHEN 2 THEN (h % 48) * 2 + 1
                ELSE (h % 24) * 4 + 1 END AS INTEGER) AS idx,
           phase_flag, data_type,
           CAST(CASE WHEN h % 97 = 0 THEN NULL WHEN q <= 12 THEN 0 WHEN q <= 16 THEN 60 + q WHEN q <= 20 THEN 120 + 2 * q
                ELSE 180 + 1.4 * q END AS DECIMAL(8,4)) AS volt,
           CASE WHEN h % 89 <> 1 THEN CAST(price * 0.0001 AS DECIMAL(8,6)) END AS power,
           CAST(q * 0.1 AS DECIMAL(8,4)) AS cur,
           CAST(1 - discount AS DECIMAL(8,4)) AS pf,
           CAST(price * (1 + tax) * 0.001 AS DECIMAL(12,7)) AS energy
    FROM (
      SELECT CAST(CASE WHEN l_suppkey < 1 THEN 1 ELSE (l_suppkey - 1) // 10 + 1 END AS BIGINT) AS id,
             7 * l_orderkey + 13 * l_linenumber AS h,
             ((date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 28) + 28) % 28 AS dd,
             CAST(l_linenumber % 4 AS INTEGER) AS phase_flag,
             CAST(l_partkey % 8 + 1 AS INTEGER) AS data_type,
             CAST(l_quantity AS DECIMAL(4,0)) AS q,
             CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
             CAST(l_discount AS DECIMAL(4,2)) AS discount,
             CAST(l_tax AS DECIMAL(4,2)) AS tax
      FROM lineitem)))
"""


# The same with the days running on as the ship dates do.
SPAN = READINGS.replace("CAST((dd // 7) * 91 + dd % 7 AS INTEGER)", "CAST(dd AS INTEGER)").replace(
    "((date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 28) + 28) % 28",
    "date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))",
)


def season(ts: str) -> str:
    return (
        f"CASE WHEN month({ts}) BETWEEN 3 AND 5 THEN 1 WHEN month({ts}) BETWEEN 6 AND 9 THEN 2 "
        f"WHEN month({ts}) BETWEEN 10 AND 11 THEN 3 ELSE 4 END"
    )


def daytype(ts: str) -> str:
    return f"CASE WHEN isodow({ts}) <= 5 THEN 1 ELSE 2 END"


def sdti(ts: str) -> str:
    return f"CAST((({season(ts)}) - 1) * 3 + {daytype(ts)} AS INTEGER)"


CURVE = f"""
curve AS (
  SELECT id, ts, volt AS volt_c, power, dti, {sdti("day")} AS sdti,
         CAST({season("day")} AS INTEGER) AS season, CAST({daytype("day")} AS INTEGER) AS daytype
  FROM readings)
"""

PROFILE = """
profile AS (
  SELECT id, season, daytype, CAST(dti % 96 AS INTEGER) AS bucket,
         CAST(sum(power) AS DOUBLE) / count(power) AS avg_power,
         CAST(sum(volt_c) AS DOUBLE) / count(volt_c) AS avg_volt
  FROM curve WHERE volt_c BETWEEN 88 AND 300 AND power IS NOT NULL
  GROUP BY ALL)
"""

FEATURES = """
ranked AS (
  SELECT *, row_number() OVER g - 1 AS pos, count(*) OVER (PARTITION BY id, season, daytype) AS size,
         nth_value(avg_volt, 2) OVER (PARTITION BY id, season, daytype ORDER BY bucket
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_volt
  FROM profile WINDOW g AS (PARTITION BY id, season, daytype ORDER BY bucket)),
features AS (
  SELECT id, season, daytype,
         CAST(CASE size WHEN 96 THEN (pos - 1) // 4 WHEN 48 THEN (pos - 1) // 2 ELSE pos END AS BIGINT) AS hourindex,
         avg_power AS power,
         avg_volt / CASE WHEN second_volt < 154 THEN 110.0::DOUBLE ELSE 220.0::DOUBLE END AS volt
  FROM ranked
  WHERE (size = 96 AND pos % 4 = 1) OR (size = 48 AND pos % 2 = 1) OR size = 24)
"""


def hour_group_ctes(k: int = 6, rounds: int = 21) -> str:
    """Lloyd rounds as a chain of assign and mean steps, then numbering by first hour."""
    steps = [
        f"means0 AS (SELECT id, season, daytype, hourindex // {24 // k} AS c, power, volt "
        f"FROM features WHERE hourindex % {24 // k} = 0)"
    ]

    def assign(n: int) -> str:
        return f"""
assign{n} AS MATERIALIZED (
  SELECT f.id, f.season, f.daytype, f.hourindex, f.power, f.volt,
         arg_min(m.c, {{'d': (f.power - m.power) * (f.power - m.power)
                           + (f.volt - m.volt) * (f.volt - m.volt), 'c': m.c}}) AS c
  FROM features f JOIN means{n} m USING (id, season, daytype)
  GROUP BY ALL)"""

    for n in range(rounds):
        steps.append(assign(n))
        steps.append(
            f"""
means{n + 1} AS MATERIALIZED (
  SELECT id, season, daytype, c, sum(power) / count(*) AS power, sum(volt) / count(*) AS volt
  FROM assign{n} GROUP BY ALL)"""
        )
    steps.append(assign(rounds))
    steps.append(
        f"""
firsts AS (
  SELECT id, season, daytype, c,
         CAST(row_number() OVER (PARTITION BY id, season, daytype ORDER BY min(hourindex)) - 1 AS INTEGER) AS hourgroup
  FROM assign{rounds} GROUP BY id, season, daytype, c),
hourgroups AS (
  SELECT id, season, daytype, hourgroup, hourindex
  FROM assign{rounds} JOIN firsts USING (id, season, daytype, c))"""
    )
    return ",".join(steps)


def seeded_group_ctes(seed: int, runs: int, k: int = 6, rounds: int = 21) -> str:
    """Lloyd rounds of several runs from drawn hours, and the groups of the cheapest run."""
    keys = "id, season, daytype, run"
    steps = [
        f"""
drawn AS (
  SELECT f.*, run, row_number() OVER (PARTITION BY {keys}
    ORDER BY md5(concat_ws('|', id, season, daytype, hourindex, {seed}, run))) - 1 AS place
  FROM features f, range({runs}) r(run)),
means0 AS (SELECT {keys}, place AS c, power, volt FROM drawn WHERE place < {k})"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
assign{n} AS MATERIALIZED (
  SELECT {keys}, f.hourindex, f.power, f.volt,
         min({{'d': (f.power - m.power) * (f.power - m.power) + (f.volt - m.volt) * (f.volt - m.volt), 'c': m.c}}) AS near
  FROM drawn f JOIN means{n} m USING ({keys}) GROUP BY ALL),
means{n + 1} AS MATERIALIZED (
  SELECT {keys}, near.c AS c, sum(power) / count(*) AS power, sum(volt) / count(*) AS volt
  FROM assign{n} GROUP BY ALL)""")
    steps.append(f"""
costs AS (SELECT {keys}, round(sum(near.d), 9) AS cost FROM assign{rounds} GROUP BY ALL),
cheapest AS (
  SELECT id, season, daytype, min({{'cost': cost, 'run': run}}).run AS run FROM costs GROUP BY ALL),
chosen AS (
  SELECT id, season, daytype, hourindex, near.c AS c FROM assign{rounds} JOIN cheapest USING ({keys})),
firsts AS (
  SELECT id, season, daytype, c,
         CAST(row_number() OVER (PARTITION BY id, season, daytype ORDER BY min(hourindex)) - 1 AS INTEGER) AS hourgroup
  FROM chosen GROUP BY id, season, daytype, c)""")
    return ",".join(steps)


def _drawn(keys: str, item: str, source: str, k: int, seed: int) -> str:
    return f"""
SELECT *, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY md5(concat_ws('|', {keys}, {item}, {seed}, 0))) AS INTEGER) AS place
FROM {source} QUALIFY place <= {k}"""


def _values(name: str, columns: str, rows) -> str:
    def text(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


TYPES = ",\n".join(
    [
        _values("kinds", "measurementkindid, code", MEASUREMENT_KINDS.items()),
        _values("phases", "phasecode, code", PHASE_NAMES.items()),
        _values(
            "wanted",
            "family, flag, code, phase, pattern",
            [(*c, "%none%" if c[3] == "none" else f"%{c[3]}") for c in CHANNELS],
        ),
        """
readingtype AS (
  SELECT p_partkey + 1 AS readingtypeid, CAST((p_partkey // 7) % 4 AS INTEGER) AS phases,
         CASE WHEN p_size > 25 THEN p_type END AS tou,
         CAST(p_partkey % 7 + 1 AS INTEGER) AS measurementkind
  FROM part),
types AS (
  SELECT family, flag, w.code, w.phase, CAST(min(readingtypeid) AS BIGINT) AS readingtypeid
  FROM readingtype r
  JOIN phases p ON r.phases = p.phasecode
  JOIN kinds k ON r.measurementkind = k.measurementkindid
  JOIN wanted w ON w.code = k.code AND p.code LIKE w.pattern
  WHERE r.tou IS NULL
  GROUP BY ALL)
""",
    ]
)

_FAMILY = {
    "V": ("volt", "phase_flag"),
    "A": ("cur", "phase_flag"),
    "PF": ("pf", "phase_flag"),
    "P": ("power", "data_type"),
    "E": ("energy", "data_type"),
}


def _fact(family: str) -> str:
    value, flag = _FAMILY[family]
    return (
        f"SELECT id AS meter, dti AS timeperiod, readingtypeid AS readingtype, "
        f"CAST(NULL AS BIGINT) AS reason, CAST(NULL AS TIMESTAMP) AS reporteddatatime, "
        f"CAST({value} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS source "
        f"FROM readings JOIN types ON types.flag = readings.{flag} AND types.family = '{family}' WHERE {value} IS NOT NULL"
    )


def _star(*families: str) -> str:
    facts = " UNION ALL ".join(_fact(f) for f in families)
    return f"""{TYPES},
known AS ({facts}),
fact AS (
  SELECT * FROM known
  UNION ALL SELECT * REPLACE (meter + 1000000000 AS meter) FROM known WHERE timeperiod % 50 = 7
  UNION ALL SELECT * REPLACE (timeperiod + 100000000 AS timeperiod) FROM known WHERE timeperiod % 50 = 8),
span AS (SELECT min(dti - idx + 1) AS lowest, max(dti - idx + 96) AS highest FROM readings),
star AS (
  SELECT meter AS meterid, timeperiod AS datetimeintervalid,
         TIMESTAMP '2013-01-01' + to_minutes(CAST(15 * (timeperiod - 1) AS BIGINT)) AS mtime,
         value, k.code, r.phases
  FROM fact
  JOIN readingtype r ON r.readingtypeid = fact.readingtype
  JOIN kinds k ON k.measurementkindid = r.measurementkind
  WHERE meter IN (SELECT CASE WHEN s_suppkey < 1 THEN 1 ELSE (s_suppkey - 1) // 10 + 1 END FROM supplier)
    AND timeperiod BETWEEN (SELECT lowest FROM span) AND (SELECT highest FROM span))
"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select


def _pivot(value: str, columns: dict[int, str], flag: str) -> str:
    cells = ", ".join(
        f"CAST(max(CASE WHEN {flag} = {n} THEN {value} END) AS DOUBLE) AS {c}" for n, c in columns.items()
    )
    return f"SELECT id, ts, dti, {cells} FROM readings GROUP BY id, ts, dti"


def _unpivot(value: str, flag: str) -> str:
    return _with(
        READINGS,
        f"""cells AS (SELECT id, day, {flag}, idx, CAST(max({value}) AS DOUBLE) AS {value} FROM readings GROUP BY ALL),
days AS (SELECT DISTINCT id, day, {flag} FROM readings)""",
        select=f"""
SELECT id, CAST(day AS TIMESTAMP) + to_minutes(CAST(15 * (idx - 1) AS BIGINT)) AS ts,
       CAST(date_diff('day', DATE '2013-01-01', day) * 96 + idx AS BIGINT) AS dti, {flag}, {value}
FROM (SELECT *, unnest(range(1, 97)) AS idx FROM days) LEFT JOIN cells USING (id, day, {flag}, idx)""",
    )


def _day_curve(code: str, family: str, first_bucket: int = 2) -> str:
    prefix, flag, flag_value = DAY_CURVES[code]
    cells = ", ".join(
        f"max(CASE WHEN datetimeintervalid % 96 = {(n + first_bucket) % 96} THEN value END) AS {prefix}{n}"
        for n in range(96)
    )
    return _with(
        READINGS,
        _star(family),
        select=f"""
SELECT meterid, strftime(mtime, '%Y-%m-%d') AS mdate, {flag_value} AS {flag}, 1 AS data_point_flag,
       1 AS data_whole_flag, {cells}
FROM star WHERE code = '{code}' GROUP BY meterid, strftime(mtime, '%Y-%m-%d')""",
    )


_LOW = "((volt < 188 AND volt > 132) OR (volt < 88 AND volt > 10))"


def _volt(where: str) -> str:
    return _with(
        READINGS,
        select=f"SELECT id, ts, dti, phase_flag, CAST(volt AS DOUBLE) AS volt FROM readings WHERE {where}",
    )


VOLTS = "volts AS (" + _pivot("volt", VOLT_PHASES, "phase_flag") + ")"
DEAD = "points AS (SELECT id, ts, dti FROM volts WHERE volt_a = 0 AND volt_b = 0 AND volt_c = 0)"
EVENTS = """
SELECT id, min(ts) AS ts, min(dti) AS rangestart, max(dti) AS rangeend, count(*) AS duration
FROM (SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY dti) AS run
      FROM (SELECT *, CASE WHEN dti = 1 + lag(dti) OVER (PARTITION BY id ORDER BY dti) THEN 0 ELSE 1 END AS fresh
            FROM (SELECT id, dti, min(ts) AS ts FROM points GROUP BY id, dti)))
GROUP BY id, run
"""


def _curve_join(data_type: int) -> str:
    return _with(
        READINGS,
        VOLTS,
        select=f"""
SELECT v.id, v.ts, v.volt_c, CAST(p.power AS DOUBLE) AS power, v.dti, {sdti("v.ts")} AS sdti,
       CAST({season("v.ts")} AS INTEGER) AS season, CAST({daytype("v.ts")} AS INTEGER) AS daytype
FROM volts v JOIN readings p ON p.id = v.id AND p.dti = v.dti
WHERE p.data_type = {data_type} AND p.power IS NOT NULL""",
    )


def _joined(name: str, data_type: int) -> str:
    """The joined curve as a table of exact decimals."""
    return f"""
{name} AS (
  SELECT v.id, v.ts, v.volt_c, p.power, v.dti, {sdti("v.ts")} AS sdti,
         CAST({season("v.ts")} AS INTEGER) AS season, CAST({daytype("v.ts")} AS INTEGER) AS daytype
  FROM (SELECT id, ts, dti, max(CASE WHEN phase_flag = 3 THEN volt END) AS volt_c
        FROM readings GROUP BY id, ts, dti) v
  JOIN readings p ON p.id = v.id AND p.dti = v.dti
  WHERE p.data_type = {data_type} AND p.power IS NOT NULL)"""


def _labelled(name: str) -> str:
    return f"""
SELECT c.id, ts, CAST(volt_c AS DOUBLE) AS volt_c, CAST(power AS DOUBLE) AS power, dti, sdti, c.season, c.daytype,
       coalesce(hourgroup, -1) AS hourgroup
FROM {name} c LEFT JOIN hourgroups g
  ON g.id = c.id AND g.season = c.season AND g.daytype = c.daytype AND g.hourindex = (c.dti - 1) % 96 // 4"""


def _bins(weekday: int = 10, weekend: int = 4, volt: int = 3) -> tuple[str, str]:
    """Points of the adaptive histograms of a slot: one per distinct value up to the bins."""
    power = f"least(CASE WHEN daytype = 1 THEN {weekday} ELSE {weekend} END, count(DISTINCT power))"
    return power, f"least({volt}, count(DISTINCT volt_c))"


def _slot_points() -> str:
    power, volt = _bins()
    return f"""
slots AS (
  SELECT id, season, daytype, CAST(dti % 96 AS INTEGER) AS bucket, count(*) AS n, {power} AS power_points,
         {volt} AS volt_points, CAST(sum(power) AS DOUBLE) AS power_sum, CAST(sum(volt_c) AS DOUBLE) AS volt_sum
  FROM curve WHERE volt_c BETWEEN 154 AND 300 AND power IS NOT NULL
  GROUP BY id, season, daytype, dti % 96)"""


def _adaptive(select: str) -> str:
    """Distinct values of a slot with counts; the nearest two become one until few are left."""
    steps = """
counted AS (
  SELECT id, season, daytype, CAST(dti % 96 AS INTEGER) AS bucket, kind, x, CAST(count(*) AS DOUBLE) AS y
  FROM (
    SELECT *, unnest([{'kind': 'power', 'x': CAST(power AS DOUBLE)}, {'kind': 'volt', 'x': CAST(volt_c AS DOUBLE)}], recursive := true)
    FROM curve WHERE volt_c BETWEEN 154 AND 300 AND power IS NOT NULL)
  GROUP BY ALL),
merged AS (
  SELECT id, season, daytype, bucket, kind, CASE WHEN kind = 'volt' THEN 3 WHEN daytype = 1 THEN 10 ELSE 4 END AS bins,
         list({'x': x, 'y': y} ORDER BY x) AS h
  FROM counted GROUP BY ALL
  UNION ALL
  SELECT id, season, daytype, bucket, kind, bins,
         list_concat(h[:i - 1], [{'x': (h[i].x * h[i].y + h[i + 1].x * h[i + 1].y) / (h[i].y + h[i + 1].y),
                                  'y': h[i].y + h[i + 1].y}], h[i + 2:]) AS h
  FROM (SELECT *, list_position(gaps, list_min(gaps)) AS i
        FROM (SELECT *, list_transform(range(1, len(h)), lambda p: h[p + 1].x - h[p].x) AS gaps
              FROM merged WHERE len(h) > bins))),
points AS (
  SELECT id, season, daytype, bucket, kind, CAST(place - 1 AS INTEGER) AS place,
         CASE kind WHEN 'volt' THEN h[place].x / 1000.0::DOUBLE ELSE h[place].x END AS x,
         h[place].y / CASE kind WHEN 'volt' THEN 100.0::DOUBLE ELSE 5.0::DOUBLE END AS y
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS place FROM merged WHERE len(h) <= bins))"""
    return _with(READINGS, CURVE, steps, select=select).replace("WITH ", "WITH RECURSIVE ", 1)


_VECTORS = """
SELECT id, season, daytype, bucket // 4 AS hourindex,
       CAST(row_number() OVER (PARTITION BY id, season, daytype, bucket ORDER BY kind, place, axis) - 1 AS INTEGER) AS place,
       CASE axis WHEN 0 THEN x ELSE y END AS feature
FROM points, (VALUES (0), (1)) a(axis) WHERE bucket % 4 = 1"""


def _elbow(last: int = 20, rounds: int = 20) -> str:
    """Lloyd rounds for 2 to ``last`` clusters together, from centres evenly between the extremes."""

    def assign(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
  SELECT k, p.power, p.volt, min({{'d': (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y), 'i': c.i}}) AS near
  FROM numbered p, c{n} c GROUP BY k, p.row, p.power, p.volt)"""

    steps = [
        """
exact AS (SELECT CAST(power AS DECIMAL(20,12)) AS power, CAST(volt AS DECIMAL(20,12)) AS volt FROM features),
numbered AS (SELECT *, CAST(power AS DOUBLE) AS x, CAST(volt AS DOUBLE) AS y, row_number() OVER () AS row FROM exact)""",
        f"""
c0 AS (
  SELECT k, i, lx + (i + 0.5::DOUBLE) * (hx - lx) / k AS x, ly + (i + 0.5::DOUBLE) * (hy - ly) / k AS y
  FROM (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM numbered),
       (SELECT unnest(range(2, {last + 1})) AS k), (SELECT unnest(range(0, {last})) AS i)
  WHERE i < k)""",
    ]
    for n in range(rounds):
        steps.append(assign(n))
        steps.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT k, near.i AS i, CAST(sum(power) AS DOUBLE) / count(*) AS x, CAST(sum(volt) AS DOUBLE) / count(*) AS y
  FROM a{n} GROUP BY k, near.i)""")
    steps.append(assign(rounds))
    return _with(
        READINGS, CURVE, PROFILE, FEATURES, *steps,
        select=f"SELECT CAST(k AS INTEGER) AS k, round(sum(near.d), 6) AS cost FROM a{rounds} GROUP BY k",
    )


def _pqvcf() -> str:
    def names(columns: dict[int, str]) -> str:
        return ", ".join(columns.values())

    return _with(
        READINGS,
        VOLTS,
        "powers AS (" + _pivot("power", POWER_TYPES, "data_type") + ")",
        "curs AS (" + _pivot("cur", CURRENT_PHASES, "phase_flag") + ")",
        "pfs AS (" + _pivot("pf", FACTOR_PHASES, "phase_flag") + ")",
        select=f"""
SELECT powers.id, powers.ts, powers.dti, {names(VOLT_PHASES)}, {names(CURRENT_PHASES)}, {names(POWER_TYPES)},
       {names(FACTOR_PHASES)}
FROM powers
JOIN volts ON volts.id = powers.id AND volts.dti = powers.dti
JOIN curs ON curs.id = powers.id AND curs.dti = powers.dti
LEFT JOIN pfs ON pfs.id = powers.id AND pfs.dti = powers.dti
WHERE volt_a > 0 OR volt_c > 0 OR psum > 0 OR pa > 0 OR pc > 0 OR cur_a > 0 OR cur_c > 0""",
    )


CATEGORIES = """
categories AS (
  SELECT DISTINCT id, CASE id % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '11' ELSE '99' END AS mp_attr_code
  FROM (SELECT CASE WHEN s_suppkey < 1 THEN 1 ELSE (s_suppkey - 1) // 10 + 1 END AS id FROM supplier)),
coded AS (
  SELECT r.id, ts, dti, data_type, CAST(power AS DOUBLE) AS power, mp_attr_code,
         CASE mp_attr_code WHEN '01' THEN 1 WHEN '02' THEN 2 WHEN '11' THEN 3 ELSE 0 END AS loadtype
  FROM readings r JOIN categories c ON c.id = r.id
  WHERE data_type = 1 AND power IS NOT NULL)
"""

IRREGULAR = "SELECT id, season, daytype FROM profile GROUP BY ALL HAVING count(*) NOT IN (24, 48, 96)"


def _labels() -> str:
    rows = [
        (lt + 1, se * 3 + dy + 1, se + 1, dy + 1, f"{load}-{sea}-{day}")
        for lt, load in enumerate(LOAD_TYPES)
        for se, sea in enumerate(SEASONS)
        for dy, day in enumerate(DAYTYPES)
    ]
    return _with(
        READINGS,
        CATEGORIES,
        _values("labels", "loadtype, sdti, season, daytype, label", rows),
        f"covered AS (SELECT loadtype, {sdti('ts')} AS sdti, count(*) AS readings FROM coded GROUP BY ALL)",
        select="SELECT labels.*, coalesce(readings, 0) AS readings FROM labels LEFT JOIN covered USING (loadtype, sdti)",
    )


def _season_labels() -> str:
    rows = [
        (se * 3 + dy + 1, se + 1, dy + 1, f"{sea}-{day}")
        for se, sea in enumerate(SEASONS)
        for dy, day in enumerate(DAYTYPES)
    ]
    return _with(
        READINGS,
        _values("labels", "sdti, season, daytype, label", rows),
        f"covered AS (SELECT {sdti('ts')} AS sdti, count(*) AS readings FROM readings GROUP BY ALL)",
        select="SELECT labels.*, coalesce(readings, 0) AS readings FROM labels LEFT JOIN covered USING (sdti)",
    )


def _slot_stats() -> str:
    return _with(
        READINGS,
        """
cells AS (
  SELECT id, date_trunc('week', day) AS week, idx, CAST(max(volt) AS DOUBLE) AS value
  FROM readings GROUP BY ALL),
complete AS (SELECT id, week FROM cells GROUP BY ALL HAVING count(value) = 96)""",
        select="""
SELECT idx, count(*) AS count, round(avg(value), 6) AS mean, round(var_samp(value), 6) AS variance,
       min(value) AS min, max(value) AS max, count(*) FILTER (value <> 0) AS nonzeros,
       round(sum(abs(value)), 6) AS norm_l1, round(sqrt(sum(value * value)), 6) AS norm_l2
FROM cells JOIN complete USING (id, week) GROUP BY idx""",
    )


def _histograms(power_bins: int = 10, volt_bins: int = 3) -> str:
    def place(value: str, low: str, high: str, bins: int) -> str:
        edges = [f"CAST({value} >= {low} + {i} * ({high} - {low}) / {bins} AS BIGINT)" for i in range(1, bins)]
        return f"CASE WHEN {high} > {low} THEN {' + '.join(edges)} ELSE 0 END"

    counts = [f"count(*) FILTER (p = {n}) AS p{n}" for n in range(power_bins)]
    counts += [f"count(*) FILTER (v = {n}) AS v{n}" for n in range(volt_bins)]
    return _with(
        READINGS,
        CURVE,
        f"""
band AS (SELECT id, season, daytype, dti, CAST(power AS DOUBLE) AS power, CAST(volt_c AS DOUBLE) AS volt
         FROM curve WHERE volt_c BETWEEN 154 AND 300 AND power IS NOT NULL),
edges AS (SELECT id, season, daytype, min(power) AS pl, max(power) AS ph, min(volt) AS vl, max(volt) AS vh
          FROM band GROUP BY ALL),
hours AS (SELECT *, unnest(range(0, 24)) AS hourindex FROM edges),
samples AS (SELECT id, season, daytype, (dti - 1) % 96 // 4 AS hourindex, power, volt FROM band WHERE dti % 4 = 1),
binned AS (
  SELECT id, season, daytype, hourindex,
         CASE WHEN power IS NOT NULL THEN {place("power", "pl", "ph", power_bins)} END AS p,
         CASE WHEN volt IS NOT NULL THEN {place("volt", "vl", "vh", volt_bins)} END AS v
  FROM hours LEFT JOIN samples USING (id, season, daytype, hourindex))""",
        select=f"SELECT id, season, daytype, hourindex, {', '.join(counts)} FROM binned GROUP BY ALL",
    )


def _linear(rows: str, keys: str) -> str:
    fit = "regr_{0}(CAST(power AS DOUBLE), CAST(volt_c AS DOUBLE) - 220)"
    return f"""
SELECT {keys}, count(*) AS points,
       CASE WHEN min(volt_c) < max(volt_c)
            THEN round({fit.format("intercept")} - 220 * {fit.format("slope")}, 6) END AS c0,
       CASE WHEN min(volt_c) < max(volt_c) THEN round({fit.format("slope")}, 6) END AS c1
FROM {rows} GROUP BY ALL"""


# Voltages within half a volt of the nominal one.
NARROW = "(SELECT * REPLACE (CAST(219.5 + CAST(volt_c AS DOUBLE) / 300 AS DECIMAL(9,5)) AS volt_c) FROM curve)"


def _polynomial(degree: int, source: str = "curve", at: float = 0.0) -> str:
    """Least squares by Gram-Schmidt: orthogonal columns from window means, one per power.

    The coefficients are those of powers of ``x - at``.
    """
    part = "OVER (PARTITION BY id, season, daytype)"
    steps = [
        f"""
band AS (
  SELECT id, season, daytype, CAST(power AS DOUBLE) AS y, CAST(volt_c AS DOUBLE) AS x,
         count(*) {part} AS n, avg(CAST(volt_c AS DOUBLE)) {part} AS mx,
         count(DISTINCT volt_c) {part} AS levels
  FROM {source} AS c WHERE volt_c BETWEEN 88 AND 300 AND power IS NOT NULL),
w0 AS (SELECT *, x - mx AS u, 1.0::DOUBLE AS q0, 1.0::DOUBLE AS b0 FROM band)"""
    ]
    # q_k is u^k made orthogonal to q_0..q_(k-1).
    for k in range(1, degree + 1):
        dots = ", ".join(f"sum(pow(u, {k}) * q{j}) {part} / sum(q{j} * q{j}) {part} AS r{k}{j}" for j in range(k))
        minus = " - ".join(f"r{k}{j} * q{j}" for j in range(k))
        steps.append(
            f"p{k} AS (SELECT *, {dots} FROM w{k - 1}), "
            f"w{k} AS (SELECT *, pow(u, {k}) - {minus} AS q{k} FROM p{k})"
        )
    sums = ", ".join(f"sum(y * q{k}) / sum(q{k} * q{k}) AS a{k}" for k in range(degree + 1))
    rs = ", ".join(f"min(r{k}{j}) AS r{k}{j}" for k in range(1, degree + 1) for j in range(k))
    steps.append(
        f"sums AS (SELECT id, season, daytype, count(*) AS points, min(mx) AS mx, min(levels) AS levels, "
        f"{sums}, {rs} FROM w{degree} GROUP BY id, season, daytype)"
    )
    # Coefficients of q_k in u, then of the sum in u, then in x.
    terms: list[list[str]] = []
    for k in range(degree + 1):
        row = ["0"] * (degree + 1)
        row[k] = "1"
        for j in range(k):
            for m in range(j + 1):
                row[m] = f"({row[m]} - r{k}{j} * {terms[j][m]})"
        terms.append(row)
    in_u = [" + ".join(f"a{k} * {terms[k][m]}" for k in range(degree + 1)) for m in range(degree + 1)]
    steps.append(
        "inu AS (SELECT id, season, daytype, points, mx, levels, "
        + ", ".join(f"{e} AS e{m}" for m, e in enumerate(in_u))
        + " FROM sums)"
    )
    choose = {(m, j): _binomial(m, j) for m in range(degree + 1) for j in range(m + 1)}
    out = []
    for j in range(degree + 1):
        parts = " + ".join(f"{choose[(m, j)]} * e{m} * pow({at}::DOUBLE - mx, {m - j})" for m in range(j, degree + 1))
        out.append(f"CASE WHEN levels > {degree} THEN round({parts}, 6) END AS c{j}")
    return _with(
        READINGS, CURVE, *steps, select=f"SELECT id, season, daytype, points, {', '.join(out)} FROM inu"
    )


def _binomial(n: int, k: int) -> int:
    value = 1
    for i in range(k):
        value = value * (n - i) // (i + 1)
    return value


def oracles() -> dict[str, str]:
    groups = hour_group_ctes()
    profile = (READINGS, CURVE, PROFILE)
    grouped = (*profile, FEATURES, groups)
    hour = "(c.dti - 1) % 96 // 4"
    on_hour = (
        f"g.id = c.id AND g.season = c.season AND g.daytype = c.daytype AND g.hourindex = {hour}"
    )
    found = {
        "hourly_profile": _with(*profile, select="SELECT * FROM profile"),
        "interval_calendar": _with(
            READINGS,
            "span AS (SELECT min(day) AS a, max(day) AS b FROM readings)",
            select="""
SELECT CAST(i AS BIGINT) AS datetimeintervalid, CAST(NULL AS TIMESTAMP) AS start,
       TIMESTAMP '2013-01-01' + to_minutes(CAST(15 * (i - 1) AS BIGINT)) AS "end"
FROM (SELECT unnest(range(date_diff('day', DATE '2013-01-01', a) * 96 + 1,
                          date_diff('day', DATE '2013-01-01', b) * 96 + 97)) AS i FROM span)""",
        ),
        "calendar_labels": _labels(),
        "season_labels": _season_labels(),
        "season_columns": _with(
            READINGS,
            select=f"""
SELECT id, dti,
       CAST(date_diff('day', DATE '2013-01-01', CAST(ts AS DATE)) * 96 + hour(ts) * 4 + minute(ts) // 15 + 1 AS BIGINT) AS dti_of_ts,
       TIMESTAMP '2013-01-01' + to_minutes(CAST(15 * (dti - 1) AS BIGINT)) AS ts_of_dti,
       dti % 96 AS bucket, (dti - 1) % 96 // 4 AS hourindex, {sdti("ts")} AS sdti,
       CAST({season("ts")} AS INTEGER) AS season, CAST({daytype("ts")} AS INTEGER) AS daytype,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y-%m-%d') AS date_text
FROM readings""",
        ),
        "edge_casts": _with(
            READINGS,
            select="""
SELECT id, dti, CAST(trunc(power) AS INTEGER) AS power_int, CAST(trunc(volt) AS BIGINT) AS volt_long,
       CAST(power AS DOUBLE) AS power_double, CAST(CAST(cur AS DECIMAL(18,1)) AS DOUBLE) AS cur_decimal,
       ts AS ts_back
FROM readings""",
        ),
        "phase_pivot_volt": _with(READINGS, select=_pivot("volt", VOLT_PHASES, "phase_flag")),
        "phase_pivot_current": _with(READINGS, select=_pivot("cur", CURRENT_PHASES, "phase_flag")),
        "phase_pivot_pf": _with(READINGS, select=_pivot("pf", FACTOR_PHASES, "phase_flag")),
        "power_pivot": _with(READINGS, select=_pivot("power", POWER_TYPES, "data_type")),
        "reading_types": _with(TYPES, select="SELECT * FROM types"),
        "star_readings": _with(READINGS, _star(*_FAMILY), select="SELECT * FROM star"),
        "star_readings_sorted": _with(
            READINGS, _star(*_FAMILY),
            select="""
SELECT *, row_number() OVER (ORDER BY meterid NULLS FIRST, datetimeintervalid NULLS FIRST, mtime NULLS FIRST,
                             value NULLS FIRST, code NULLS FIRST, phases NULLS FIRST) - 1 AS position FROM star""",
        ),
        "day_curve_p": _day_curve("P", "P"),
        "day_curve_q": _day_curve("Q", "P"),
        "day_curve_v": _day_curve("V", "V"),
        "day_curve_a": _day_curve("A", "A"),
        "day_curve_pf": _day_curve("PF", "PF"),
        "day_curve_ep": _day_curve("EP", "E"),
        "day_curve_eq": _day_curve("EQ", "E"),
        "day_curve_p_aligned": _day_curve("P", "P", first_bucket=1),
        "identifiedobject": _with(
            READINGS,
            select="""
SELECT DISTINCT id AS identifiedobjectid, CAST(NULL AS VARCHAR) AS aliasname, 'meter' AS description,
       CAST(NULL AS VARCHAR) AS mrid, CAST(NULL AS VARCHAR) AS name FROM readings""",
        ),
        "enddevice": _with(
            READINGS,
            select="""
SELECT DISTINCT id AS enddeviceid, CAST(NULL AS BOOLEAN) AS ispan, CAST(NULL AS BOOLEAN) AS isvirtual,
       CAST(NULL AS DOUBLE) AS timezoneoffset, CAST(NULL AS BIGINT) AS usagepoint,
       CAST(NULL AS BIGINT) AS enddeviceinfo, CAST(NULL AS BIGINT) AS servicelocation,
       CAST(NULL AS BIGINT) AS customer, CAST(NULL AS BIGINT) AS assetcontainerid,
       CAST(NULL AS VARCHAR) AS installcode, CAST(NULL AS VARCHAR) AS amrsystem FROM readings""",
        ),
        "meter": _with(
            READINGS,
            select="""
SELECT DISTINCT id AS meterid, CAST(NULL AS VARCHAR) AS formnumber, CAST(NULL AS VARCHAR) AS description
FROM readings""",
        ),
        "meters_in_range": _volt("id BETWEEN 2 AND 1636"),
        "meters_selected": _with(
            *profile,
            f"irregular AS ({IRREGULAR})",
            select="""
SELECT id, ts, CAST(volt_c AS DOUBLE) AS volt_c, CAST(power AS DOUBLE) AS power, dti, sdti, season, daytype
FROM curve WHERE id IN (SELECT id FROM irregular)""",
        ),
        "volt_low": _volt(_LOW),
        "volt_high": _volt("volt > 236"),
        "volt_out": _volt("volt < 10"),
        "quality_tags": _with(
            READINGS,
            select=f"""
SELECT * FROM (
  SELECT id, ts, dti, phase_flag, CAST(volt AS DOUBLE) AS volt,
         CASE WHEN volt < 0.1 THEN 'Voltage-Missing' WHEN {_LOW} THEN 'Voltage-Low'
              WHEN volt > 236 THEN 'Voltage-High' END AS prbcode
  FROM readings) WHERE prbcode IS NOT NULL""",
        ),
        "quality_tags_power": _with(
            READINGS,
            select="""
SELECT * FROM (
  SELECT id, ts, dti, data_type, CAST(power AS DOUBLE) AS power,
         CASE WHEN power < 0.1 THEN 'Power-Missing' WHEN power < 0.5 THEN 'Power-Low'
              WHEN power > 10 THEN 'Power-High' END AS prbcode
  FROM readings) WHERE prbcode IS NOT NULL""",
        ),
        "slot_stats": _slot_stats(),
        "outage_points": _with(
            READINGS,
            VOLTS,
            DEAD,
            select="""
SELECT DISTINCT id, ts, dti AS rangestart, dti AS rangeend, CAST(1 AS BIGINT) AS duration FROM points""",
        ),
        "outage_events": _with(READINGS, VOLTS, DEAD, select=EVENTS),
        "outage_events_any": _with(
            READINGS, "points AS (SELECT id, ts, dti FROM readings WHERE volt = 0)", select=EVENTS
        ),
        "outage_events_sorted": _with(
            READINGS, "points AS (SELECT id, ts, dti FROM readings WHERE volt = 0)",
            select=f"SELECT *, row_number() OVER (ORDER BY id, rangestart) - 1 AS position FROM ({EVENTS})",
        ),
        "outage_events_tree": _with(
            SPAN, "points AS (SELECT id, ts, dti FROM readings WHERE volt < 190 OR pf > 0.9)", select=EVENTS
        ),
        "outage_events_daily_chunks": _with(
            READINGS, "points AS (SELECT id, ts, dti FROM readings WHERE volt = 0)", select=EVENTS
        ),
        "outage_events_span": _with(
            SPAN, "points AS (SELECT id, ts, dti FROM readings WHERE volt = 0 OR pf > 0.93)", select=EVENTS
        ),
        "pv_curve": _curve_join(1),
        "qv_curve": _curve_join(5),
        "pqvcf": _pqvcf(),
        "pv_hourly_profile": _with(READINGS, _joined("curve", 1), PROFILE, select="SELECT * FROM profile"),
        "pv_hour_groups": _with(
            READINGS, _joined("curve", 1), PROFILE, FEATURES, groups, select="SELECT * FROM hourgroups"
        ),
        "pv_labelled": _with(
            READINGS, _joined("curve", 1), PROFILE, FEATURES, groups, select=_labelled("curve")
        ),
        "qv_labelled": _with(
            READINGS, _joined("curve", 1), _joined("qv", 5), PROFILE, FEATURES, groups, select=_labelled("qv")
        ),
        "adaptive_totals": _with(
            READINGS, CURVE, _slot_points(),
            select="""
SELECT id, season, daytype, bucket, n AS power_mass, n AS volt_mass, power_points, volt_points,
       round(power_sum, 6) AS power_sum, round(volt_sum, 6) AS volt_sum FROM slots""",
        ),
        "smallest_histograms": _with(
            READINGS, CURVE, _slot_points(),
            select="""
SELECT id, season, daytype, CAST(min(power_points) AS INTEGER) AS min_power_bins,
       CAST(min(volt_points) AS INTEGER) AS min_volt_bins FROM slots GROUP BY ALL""",
        ),
        "adaptive_histograms": _adaptive("SELECT * FROM points"),
        "adaptive_vectors": _adaptive(_VECTORS),
        "elbow_cost": _elbow(),
        "meter_profile": _with(
            READINGS,
            select="""
SELECT id, CAST(sum(power) AS DOUBLE) AS totp, CAST(sum(power) AS DOUBLE) / count(power) AS avgp,
       CAST(max(power) AS DOUBLE) AS maxp
FROM readings WHERE data_type = 1 AND power IS NOT NULL GROUP BY id""",
        ),
        "meter_ids": _with(*profile, select="SELECT DISTINCT id FROM profile"),
        "hour_start_power": _with(
            READINGS,
            select="SELECT id, dti, CAST(power AS DOUBLE) AS power FROM readings WHERE data_type = 1 AND power IS NOT NULL AND dti % 4 = 1",
        ),
        "load_category": _with(READINGS, CATEGORIES, select="SELECT * FROM coded"),
        "irregular_groups": _with(*profile, select=IRREGULAR),
        "hour_features": _with(*profile, FEATURES, select="SELECT * FROM features"),
        "hour_histograms": _histograms(),
        "hour_groups": _with(*grouped, select="SELECT * FROM hourgroups"),
        "hour_groups_seeded": _with(
            *profile, FEATURES, seeded_group_ctes(7, 3),
            select="SELECT id, season, daytype, hourgroup, hourindex FROM chosen JOIN firsts USING (id, season, daytype, c)",
        ),
        "seed_points": _with(*profile, FEATURES, select=_drawn("id, season, daytype", "hourindex", "features", 6, 11)),
        "seed_readings": _with(
            READINGS, CURVE, select=_drawn("season", "dti", "(SELECT DISTINCT season, dti FROM curve)", 20, 3)
        ),
        "label_hour_groups": _with(
            *grouped,
            select=f"""
SELECT c.id, ts, CAST(volt_c AS DOUBLE) AS volt_c, CAST(power AS DOUBLE) AS power, dti, sdti, c.season, c.daytype,
       coalesce(hourgroup, -1) AS hourgroup
FROM curve c LEFT JOIN hourgroups g ON {on_hour}""",
        ),
        "hour_group_curve": _with(
            *grouped,
            select=f"""
SELECT c.id, ts, c.season, c.daytype, hourgroup, CAST(power AS DOUBLE) AS power, CAST(volt_c AS DOUBLE) AS volt_c
FROM curve c JOIN hourgroups g ON {on_hour} WHERE volt_c BETWEEN 154 AND 300 AND power IS NOT NULL""",
        ),
        "fit_curve_linear": _with(
            READINGS,
            CURVE,
            select=_linear("(SELECT * FROM curve WHERE volt_c BETWEEN 88 AND 300 AND power IS NOT NULL)", "id, season, daytype"),
        ),
        "fit_curve_quadratic": _polynomial(2),
        "fit_curve_cubic": _polynomial(3),
        "fit_narrow_quadratic": _polynomial(2, NARROW, 220.0),
        "fit_narrow_cubic": _polynomial(3, NARROW, 220.0),
        "fit_curve_hour_group": _with(
            *grouped,
            f"rows_hg AS (SELECT c.*, hourgroup FROM curve c JOIN hourgroups g ON {on_hour} "
            "WHERE volt_c BETWEEN 154 AND 300 AND power IS NOT NULL)",
            select=_linear("rows_hg", "id, season, daytype, hourgroup"),
        ),
        "csv_series": _with(
            READINGS,
            select="""
SELECT id, CASE WHEN volt = 0 THEN NULL WHEN power < 1 THEN NULL ELSE CAST(cur AS DOUBLE) END AS value FROM readings""",
        ),
    }
    found["stored_labels"] = found["label_hour_groups"]
    found["series_files"] = _with(READINGS, select="SELECT id, CAST(power AS DOUBLE) AS value FROM readings")
    found["published_curve"] = f"""
SELECT *, CAST(count(*) OVER () AS INTEGER) AS said, CAST(count(*) OVER () AS INTEGER) AS said_again
FROM ({found["pv_curve"]})"""
    for value, flag in (("volt", "phase_flag"), ("power", "data_type"), ("cur", "phase_flag"),
                        ("pf", "phase_flag"), ("energy", "data_type")):
        found[f"unpivot_{value}"] = _unpivot(value, flag)
    for family in _FAMILY:
        found[f"basereading_{family.lower()}"] = _with(READINGS, TYPES, select=_fact(family))
    return found
