"""Registry and the common table expressions of the comparison SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.numeric import rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CUT = "2000-01-01"
METRICS = ("cpu_p95", "mem_p95", "disk_p95", "net_in_p95", "net_out_p95")


def register(key: str, sql: str | None = None, doubles: Sequence[str] = (), digits: int = 6):
    """Register a query; its double columns and the named ones of the SQL are rounded alike."""
    def take(fn):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(fn(spark, folder), digits)

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql if not doubles else (
                "SELECT * REPLACE (" + ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles) + f") FROM ({sql}) AS t"
            )
        return fn

    return take


def interpolated(columns: Sequence[str], source: str, edges: str = "both") -> str:
    """SQL of per-server linear interpolation by row position."""
    near, pick = [], []
    for c in columns:
        near.append(f"""
          last_value({c} IGNORE NULLS) OVER up AS pv_{c}, last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER up AS pp_{c},
          first_value({c} IGNORE NULLS) OVER dn AS nv_{c}, first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER dn AS np_{c}""")
        edge = f"coalesce(pv_{c}, nv_{c})" if edges == "both" else f"pv_{c}"
        pick.append(f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NOT NULL AND nv_{c} IS NOT NULL
          THEN pv_{c} + (nv_{c} - pv_{c}) * (CAST(rn - pp_{c} AS DOUBLE) / (np_{c} - pp_{c})) ELSE {edge} END AS {c}""")
    return f"""SELECT server_id, timestamp, {', '.join(pick)} FROM (
        SELECT *, {', '.join(near)} FROM (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY timestamp) AS rn FROM {source})
        WINDOW up AS (PARTITION BY server_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               dn AS (PARTITION BY server_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def winsorized(columns: Sequence[str], source: str) -> str:
    """SQL of the rolling cap."""
    stats, pick = [], []
    for c in columns:
        stats.append(f"avg({c}) OVER w AS m_{c}, stddev_samp({c}) OVER w AS s_{c}")
        pick.append(f"""CASE WHEN s_{c} > 1e-9 AND abs(({c} - m_{c}) / s_{c}) > 4.0
          THEN m_{c} + sign({c} - m_{c}) * 4.0 * s_{c} ELSE {c} END AS {c}""")
    return f"""SELECT server_id, timestamp, {', '.join(pick)} FROM (SELECT *, {', '.join(stats)} FROM {source}
        WINDOW w AS (PARTITION BY server_id ORDER BY timestamp ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))"""


def holiday_sql(d: str) -> str:
    def fixed(x):
        return (f"((month({x}) = 1 AND day({x}) = 1) OR (month({x}) = 6 AND day({x}) = 19 AND year({x}) >= 2021) OR (month({x}) = 7 AND day({x}) = 4)"
                f" OR (month({x}) = 11 AND day({x}) = 11) OR (month({x}) = 12 AND day({x}) = 25))")
    w = f"isodow({d})"
    return (f"CASE WHEN {fixed(d)} OR ({w} = 5 AND {fixed(f'CAST({d} + INTERVAL 1 DAY AS DATE)')})"
            f" OR ({w} = 1 AND {fixed(f'CAST({d} - INTERVAL 1 DAY AS DATE)')})"
            f" OR ({w} = 1 AND ((month({d}) IN (1, 2) AND day({d}) BETWEEN 15 AND 21) OR (month({d}) = 5 AND day({d}) >= 25)"
            f" OR (month({d}) = 9 AND day({d}) <= 7) OR (month({d}) = 10 AND day({d}) BETWEEN 8 AND 14)))"
            f" OR ({w} = 4 AND month({d}) = 11 AND day({d}) BETWEEN 22 AND 28) THEN 1 ELSE 0 END")


def eoq_sql(d: str, variant: str = "month_end") -> str:
    length = "31" if variant == "fixed31" else f"day(last_day({d}))"
    return f"CASE WHEN month({d}) IN (3, 6, 9, 12) AND day({d}) >= {length} - 7 + 1 THEN 1 ELSE 0 END"


def quarter_end_sql(d: str) -> str:
    return f"CASE WHEN month({d}) % 3 = 0 AND {d} = last_day({d}) THEN 1 ELSE 0 END"


_METRIC_SQL = """max(l_quantity * 2.0) AS cpu_p95, max(l_extendedprice / 1050.0) AS mem_p95, max(l_discount * 1000.0) + 0.0 AS disk_p95,
    max(l_tax * 1000.0) + 0.0 AS net_in_p95, avg(l_quantity) AS net_out_p95"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "dim": ((), """SELECT printf('SRV-%04d', s_suppkey) AS server_id, r_name AS business_unit, n_name AS region,
        CASE WHEN s_acctbal >= 6000 THEN 'High' WHEN s_acctbal >= 2000 THEN 'Medium' ELSE 'Low' END AS criticality
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "readings": ((), """SELECT printf('SRV-%04d', l_suppkey) AS server_id, CAST(l_shipdate AS DATE) AS timestamp, l_orderkey AS reading_id,
        l_linenumber AS reading_line, l_quantity * 2.0 AS cpu_p95, l_extendedprice / 1050.0 AS mem_p95, l_discount * 1000.0 + 0.0 AS disk_p95,
        l_tax * 1000.0 + 0.0 AS net_in_p95, CAST(l_quantity AS DOUBLE) AS net_out_p95 FROM lineitem
        WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL"""),
    "metrics": ((), f"""SELECT printf('SRV-%04d', l_suppkey) AS server_id, CAST(l_shipdate AS DATE) AS timestamp, {_METRIC_SQL}
        FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2"""),
    "panel": (("dim", "metrics"), """SELECT m.server_id, m.timestamp, business_unit, region, criticality,
        cpu_p95, mem_p95, disk_p95, net_in_p95, net_out_p95 FROM metrics m JOIN dim USING (server_id)"""),
    "axis": (("metrics",), """SELECT server_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS timestamp FROM (
        SELECT server_id, CAST(min(timestamp) AS TIMESTAMP) AS lo, CAST(max(timestamp) AS TIMESTAMP) AS hi FROM metrics GROUP BY server_id)"""),
    "spine": (("axis", "metrics"), """SELECT a.server_id, a.timestamp, cpu_p95, mem_p95, disk_p95, net_in_p95, net_out_p95
        FROM axis a LEFT JOIN metrics m ON a.server_id = m.server_id AND a.timestamp = m.timestamp"""),
    "clean": (("spine",), interpolated(METRICS, "spine")),
    "cpu": (("spine",), interpolated(("cpu_p95",), "spine")),
    "capped": (("clean",), winsorized(METRICS, "clean")),
    "sparse": ((), """SELECT printf('SRV-%04d', l_suppkey) AS server_id, CAST(l_shipdate AS DATE) AS timestamp,
        max(CASE WHEN l_returnflag <> 'R' THEN l_quantity * 2.0 END) AS cpu_p95, max(CASE WHEN l_linestatus = 'O' THEN l_extendedprice / 1050.0 END) AS mem_p95,
        max(l_discount * 1000.0 + 0.0) AS disk_p95 FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2"""),
    "events_": ((), """SELECT printf('USR-%04d', user_id) AS server_id, ts AS timestamp, event_id AS reading_id, event_type, value AS cpu_p95
        FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL"""),
    "types": (("dim",), """SELECT server_id, CASE WHEN rn <= w THEN 'web' WHEN rn <= w + a THEN 'application' WHEN rn <= w + a + d THEN 'database'
        WHEN rn <= w + a + d + b THEN 'batch' ELSE 'application' END AS server_type FROM (
        SELECT server_id, row_number() OVER (ORDER BY server_id) AS rn, floor(n * 0.35::DOUBLE) AS w, floor(n * 0.40::DOUBLE) AS a,
        floor(n * 0.15::DOUBLE) AS d, floor(n * 0.10::DOUBLE) AS b FROM dim, (SELECT count(*)::DOUBLE AS n FROM dim))"""),
    "marked": (("cpu",), f"""SELECT server_id, timestamp, cpu_p95 AS y, timestamp < DATE '{CUT}' AS train, isodow(timestamp) - 1 AS wd, month(timestamp) AS mo,
        CAST(datediff('day', DATE '{CUT}', timestamp) AS DOUBLE) AS x, {eoq_sql('timestamp')} AS eoq, {holiday_sql('timestamp')} AS hol FROM cpu"""),
    "ok": (("marked",), """SELECT server_id, max(timestamp) AS last_day, max(CASE WHEN train THEN timestamp END) AS last_train,
        count(*) FILTER (WHERE train) AS train_rows, count(*) FILTER (WHERE NOT train) AS test_rows FROM marked GROUP BY server_id
        HAVING count(*) FILTER (WHERE train) >= 365 AND count(*) FILTER (WHERE NOT train) > 0"""),
    "train": (("marked", "ok"), "SELECT m.* FROM marked m JOIN ok USING (server_id) WHERE train"),
    "target": (("marked", "ok"), f"""SELECT m.server_id, m.timestamp, y AS actual, false AS is_future, wd, mo, x, eoq, hol, last_train FROM marked m JOIN ok USING (server_id) WHERE NOT train
        UNION ALL SELECT server_id, timestamp, NULL, true, isodow(timestamp) - 1, month(timestamp), CAST(datediff('day', DATE '{CUT}', timestamp) AS DOUBLE),
        {eoq_sql('timestamp')}, {holiday_sql('timestamp')}, last_train FROM (SELECT server_id, last_train, CAST(unnest(generate_series(
        CAST(last_day AS TIMESTAMP) + INTERVAL 1 DAY, CAST(last_day AS TIMESTAMP) + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS timestamp FROM ok)"""),
    "wdmean": (("train",), "SELECT server_id, wd, avg(y) AS m FROM train GROUP BY 1, 2"),
    "line": (("train",), "SELECT server_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM train GROUP BY 1"),
    "r0": (("train", "line"), "SELECT t.*, y - a - b * x AS r FROM train t JOIN line USING (server_id)"),
    "e1": (("r0",), "SELECT server_id, wd, avg(r) AS e_wd FROM r0 GROUP BY 1, 2"),
    "r1": (("r0", "e1"), "SELECT r0.* REPLACE (r - e_wd AS r) FROM r0 JOIN e1 USING (server_id, wd)"),
    "e2": (("r1",), "SELECT server_id, mo, avg(r) AS e_mo FROM r1 GROUP BY 1, 2"),
    "r2": (("r1", "e2"), "SELECT r1.* REPLACE (r - e_mo AS r) FROM r1 JOIN e2 USING (server_id, mo)"),
    "e3": (("r2",), "SELECT server_id, coalesce(avg(r) FILTER (WHERE eoq = 1), 0) AS e_eoq FROM r2 GROUP BY 1"),
    "r3": (("r2", "e3"), "SELECT r2.* REPLACE (r - e_eoq * eoq AS r) FROM r2 JOIN e3 USING (server_id)"),
    "e4": (("r3",), "SELECT server_id, coalesce(avg(r) FILTER (WHERE hol = 1), 0) AS e_hol FROM r3 GROUP BY 1"),
    "r4": (("r3", "e4"), "SELECT r3.* REPLACE (r - e_hol * hol AS r) FROM r3 JOIN e4 USING (server_id)"),
    "e5": (("r4",), "SELECT server_id, coalesce(avg(r) FILTER (WHERE wd >= 5), 0) AS e_we FROM r4 GROUP BY 1"),
    "r5": (("r4", "e5"), "SELECT r4.* REPLACE (r - CASE WHEN wd >= 5 THEN e_we ELSE 0 END AS r) FROM r4 JOIN e5 USING (server_id)"),
    "e6": (("r5",), "SELECT server_id, stddev_samp(r) AS s FROM r5 GROUP BY 1"),
    "levels": (("train", "ok"), """SELECT server_id, max_by(y, timestamp) AS last_y, sum(CASE WHEN n = 1 THEN 1.0 ELSE 0.3 END * pow(0.7, age) * y) AS ses FROM (
        SELECT t.server_id, t.timestamp, y, datediff('day', t.timestamp, last_train) AS age,
        row_number() OVER (PARTITION BY t.server_id ORDER BY t.timestamp) AS n FROM train t JOIN ok USING (server_id)) GROUP BY 1"""),
    "f_baseline": (("target", "wdmean"), """SELECT t.server_id, 'baseline' AS model, timestamp, actual, m AS predicted, NULL::DOUBLE AS yhat_lower,
        NULL::DOUBLE AS yhat_upper, is_future FROM target t LEFT JOIN wdmean w ON t.server_id = w.server_id AND t.wd = w.wd"""),
    "f_additive": (("target", "line", "e1", "e2", "e3", "e4", "e5", "e6"), """SELECT server_id, 'additive' AS model, timestamp, actual, p AS predicted,
        p - 1.2816 * s AS yhat_lower, p + 1.2816 * s AS yhat_upper, is_future FROM (SELECT t.server_id, timestamp, actual, is_future, s,
        a + b * x + coalesce(e_wd, 0) + coalesce(e_mo, 0) + e_eoq * eoq + e_hol * hol + CASE WHEN t.wd >= 5 THEN e_we ELSE 0 END AS p
        FROM target t JOIN line USING (server_id) LEFT JOIN e1 ON t.server_id = e1.server_id AND t.wd = e1.wd
        LEFT JOIN e2 ON t.server_id = e2.server_id AND t.mo = e2.mo JOIN e3 ON t.server_id = e3.server_id JOIN e4 ON t.server_id = e4.server_id
        JOIN e5 ON t.server_id = e5.server_id JOIN e6 ON t.server_id = e6.server_id)"""),
    "f_naive": (("target", "levels"), """SELECT t.server_id, 'naive' AS model, timestamp, actual, last_y AS predicted, NULL::DOUBLE AS yhat_lower,
        NULL::DOUBLE AS yhat_upper, is_future FROM target t JOIN levels USING (server_id)"""),
    "f_ses": (("target", "levels"), """SELECT t.server_id, 'ses' AS model, timestamp, actual, ses AS predicted, NULL::DOUBLE AS yhat_lower,
        NULL::DOUBLE AS yhat_upper, is_future FROM target t JOIN levels USING (server_id)"""),
    "f_theta": (("target", "levels", "line"), """SELECT t.server_id, 'theta' AS model, timestamp, actual, ses + 0.5 * b * datediff('day', last_train, timestamp) AS predicted,
        NULL::DOUBLE AS yhat_lower, NULL::DOUBLE AS yhat_upper, is_future FROM target t JOIN levels USING (server_id) JOIN line USING (server_id)"""),
    "forecast": (("f_baseline", "f_additive"), "SELECT * FROM f_baseline UNION ALL SELECT * FROM f_additive"),
    "forecast5": (("f_baseline", "f_additive", "f_naive", "f_ses", "f_theta"), """SELECT * FROM f_baseline UNION ALL SELECT * FROM f_additive
        UNION ALL SELECT * FROM f_naive UNION ALL SELECT * FROM f_ses UNION ALL SELECT * FROM f_theta"""),
    "flagged": (("forecast",), """SELECT *, coalesce(predicted > 53, false) AS risk_flag,
        CASE WHEN predicted > 53 * 1.2::DOUBLE THEN 'high' WHEN predicted > 53 THEN 'medium' ELSE 'low' END AS risk_level FROM forecast"""),
}


def sql(names: str, select: str) -> str:
    """``select`` behind the named table expressions and everything they need, in order."""
    seen: list[str] = []

    def visit(name: str) -> None:
        if name not in seen:
            for n in CTES[name][0]:
                visit(n)
            seen.append(name)

    for n in names.split():
        visit(n)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in seen) + " " + select
