"""DuckDB SQL for the stand-in views and the per-query oracles.

The oracles restate each query's semantics in plain SQL over the same base
tables (``events``, ``lineitem``, ``orders`` are views in the checker), so
the Spark plans can be compared value by value.
"""

from __future__ import annotations

VIEWS = {
    "bookings_v": """
  SELECT event_id AS booking_id,
         event_type AS task_id,
         ts - to_hours(CAST(event_id % 96 AS BIGINT)) AS booking_created_time,
         ts AS appointment_time,
         CASE WHEN event_id % 33 <> 0 THEN ts END AS check_in_time,
         CASE WHEN event_id % 50 = 1 THEN ts - INTERVAL 60 SECOND
              ELSE ts + to_seconds(CAST(round(value * 60) AS BIGINT)) END AS check_out_time,
         CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(event_id % 50 AS VARCHAR) END AS queue_number,
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 5 + 1 AS VARCHAR) END AS satisfaction_rating,
         (['1', '0', 'yes', 'No', 'YES', 'maybe'])[CAST(event_id % 6 + 1 AS INTEGER)] AS document_uploaded
  FROM events""",
    "tasks_v": """
  SELECT task_id,
         CASE task_id WHEN 'signup' THEN 'SEC-001' WHEN 'purchase' THEN 'SEC-003' ELSE 'SEC-002' END AS section_id,
         CASE WHEN task_id <> 'view' THEN upper(task_id) END AS task_name,
         CASE task_id WHEN 'signup' THEN 'Registration' WHEN 'purchase' THEN 'Sales' ELSE 'Browsing' END AS section_name
  FROM (SELECT DISTINCT event_type AS task_id FROM events) d
  WHERE task_id <> 'error'""",
    "staffing_v": """
  SELECT strftime(d, '%Y-%m-%d') AS date,
         'SEC-00' || CAST(s AS VARCHAR) AS section_id,
         CASE WHEN day(d) % 7 = 0 THEN NULL WHEN day(d) = 13 THEN CAST(0 AS BIGINT) ELSE n END AS employees_on_duty,
         CASE WHEN day(d) <> 28 THEN q * 5 END AS total_task_time_minutes
  FROM (SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey % 6 + 1 AS s, count(*) AS n, sum(l_quantity) AS q
        FROM lineitem GROUP BY 1, 2) g""",
    "task1_test_v": """
  SELECT o_orderkey AS row_id,
         strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date,
         CASE WHEN o_orderkey % 97 = 0 THEN 'bad' ELSE lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30' END AS time,
         (['signup', 'click', 'view', 'purchase', 'error', 'refund'])[CAST(o_custkey % 6 + 1 AS INTEGER)] AS task_id
  FROM orders""",
    "task2_test_v": """
  SELECT o_orderkey AS row_id,
         strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date,
         CASE WHEN o_orderkey % 41 <> 0 THEN 'SEC-00' || CAST(o_custkey % 7 + 1 AS VARCHAR) END AS section_id
  FROM orders""",
    # ---- cleaned / feature views shared by many oracles ----
    "bookings_clean": """
  SELECT *,
         CASE WHEN raw_minutes BETWEEN 0 AND 480 THEN raw_minutes END AS processing_time_minutes
  FROM (SELECT *, (epoch_us(check_out_time) - epoch_us(check_in_time)) / 60000000.0 AS raw_minutes FROM bookings_v) b""",
    "t1_train": """
  SELECT task_id, hour(appointment_time) AS appt_hour, isodow(appointment_time) - 1 AS appt_weekday,
         processing_time_minutes AS y
  FROM bookings_clean WHERE processing_time_minutes IS NOT NULL""",
    "t1_test": """
  SELECT row_id, task_id, hour(ts) AS appt_hour, isodow(ts) - 1 AS appt_weekday
  FROM (SELECT *, try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M') AS ts FROM task1_test_v) t""",
    "staffing_typed": """
  SELECT try_strptime(date, '%Y-%m-%d')::DATE AS date, section_id,
         CAST(employees_on_duty AS DOUBLE) AS employees_on_duty,
         CAST(total_task_time_minutes AS DOUBLE) AS total_task_time_minutes
  FROM staffing_v""",
    "mpe": """
  SELECT median(CASE WHEN employees_on_duty <> 0 THEN total_task_time_minutes / employees_on_duty
                     WHEN total_task_time_minutes > 0 THEN 'inf'::DOUBLE
                     WHEN total_task_time_minutes < 0 THEN '-inf'::DOUBLE END) AS minutes_per_employee,
         count(CASE WHEN employees_on_duty <> 0 OR total_task_time_minutes <> 0 THEN 1 END) AS pairs
  FROM staffing_typed WHERE employees_on_duty IS NOT NULL AND total_task_time_minutes IS NOT NULL""",
    "staffing_clean": """
  SELECT s.date, s.section_id,
         CASE WHEN s.employees_on_duty IS NULL AND s.total_task_time_minutes IS NOT NULL
              THEN round_even(s.total_task_time_minutes / m.minutes_per_employee, 0)
              ELSE s.employees_on_duty END AS employees_on_duty,
         s.total_task_time_minutes
  FROM staffing_typed s, mpe m""",
    "t2_train": """
  SELECT section_id, isodow(date) - 1 AS weekday, coalesce(isodow(date) - 1 >= 5, false) AS is_weekend,
         month(date) AS month, employees_on_duty AS y
  FROM staffing_clean WHERE employees_on_duty IS NOT NULL AND employees_on_duty >= 0""",
    "t2_test": """
  SELECT row_id, section_id, isodow(d) - 1 AS weekday, coalesce(isodow(d) - 1 >= 5, false) AS is_weekend
  FROM (SELECT *, try_strptime(date, '%Y-%m-%d')::DATE AS d FROM task2_test_v) t""",
}

# Dependencies between views, so a query pulls in just what it needs, in order.
_DEPS = {
    "bookings_clean": ["bookings_v"],
    "t1_train": ["bookings_clean"],
    "t1_test": ["task1_test_v"],
    "staffing_typed": ["staffing_v"],
    "mpe": ["staffing_typed"],
    "staffing_clean": ["staffing_typed", "mpe"],
    "t2_train": ["staffing_clean"],
    "t2_test": ["task2_test_v"],
}


def _closure(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause of the named views (plus ``extra`` CTEs) followed by ``body``."""
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in _closure(names)]
    ctes += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def hier_lookup_sql(train: str, test: str, levels: list[list[str]], out_value: str, lo: float, hi: float, default: int) -> tuple[list[tuple[str, str]], str]:
    """CTEs and SELECT for a hierarchical-median prediction in plain SQL."""
    ctes = []
    joins = []
    meds = []
    levels_sql = []
    for i, keys in enumerate(levels):
        k = ", ".join(keys)
        ctes.append((f"m{i}", f"SELECT {k}, median(y) AS med FROM {train} WHERE {' AND '.join(c + ' IS NOT NULL' for c in keys)} GROUP BY {k}"))
        on = " AND ".join(f"t.{c} = m{i}.{c}" for c in keys)
        joins.append(f"LEFT JOIN m{i} ON {on}")
        meds.append(f"m{i}.med")
        levels_sql.append(f"WHEN m{i}.med IS NOT NULL THEN {i}")
    ctes.append(("mg", f"SELECT coalesce(median(y), 0) AS med FROM {train}"))
    pred = f"coalesce({', '.join(meds)}, mg.med)"
    clipped = f"least(greatest({pred}, {lo}), {hi})"
    value = f"coalesce(CAST(round_even({clipped}, 0) AS INTEGER), {default})"
    level = "CASE " + " ".join(levels_sql) + " ELSE -1 END"
    body = f"SELECT t.row_id, {value} AS {out_value}, {level} AS level, {pred} AS raw_prediction FROM {test} t CROSS JOIN mg " + " ".join(joins)
    return ctes, body


def calendar_sql(ts: str, prefix: str) -> str:
    """DuckDB calendar block matching ``timefns.calendar_block`` (ints as INTEGER)."""
    h = f"hour({ts})"
    wd = f"(isodow({ts}) - 1)"
    p = prefix
    return ", ".join(
        [
            f"CAST({h} AS INTEGER) AS {p}hour",
            f"CAST({wd} AS INTEGER) AS {p}weekday",
            f"CAST(month({ts}) AS INTEGER) AS {p}month",
            f"CAST(day({ts}) AS INTEGER) AS {p}day",
            f"CAST(year({ts}) AS INTEGER) AS {p}year",
            f"CASE WHEN {h} >= 0 AND {h} <= 6 THEN 'night' WHEN {h} > 6 AND {h} <= 12 THEN 'morning' "
            f"WHEN {h} > 12 AND {h} <= 18 THEN 'afternoon' WHEN {h} > 18 AND {h} <= 24 THEN 'evening' END AS {p}time_of_day",
            f"coalesce({wd} >= 5, false) AS {p}is_weekend",
            f"coalesce({wd} < 5 AND {h} >= 9 AND {h} < 17, false) AS {p}is_business_hour",
        ]
    )


def date_block_sql(d: str) -> str:
    wd = f"(isodow({d}) - 1)"
    return ", ".join(
        [
            f"CAST({wd} AS INTEGER) AS weekday",
            f"CAST(month({d}) AS INTEGER) AS month",
            f"CAST(day({d}) AS INTEGER) AS day",
            f"CAST(year({d}) AS INTEGER) AS year",
            f"coalesce({wd} >= 5, false) AS is_weekend",
            f"CAST(quarter({d}) AS INTEGER) AS quarter",
            f"coalesce(last_day({d}) = {d}, false) AS is_month_end",
            f"coalesce(day({d}) = 1, false) AS is_month_start",
        ]
    )


TASK_TIME_CATEGORY_SQL = (
    "CASE WHEN coalesce({t}, 0) >= 0 AND coalesce({t}, 0) <= 120 THEN 'very_low' "
    "WHEN coalesce({t}, 0) > 120 AND coalesce({t}, 0) <= 240 THEN 'low' "
    "WHEN coalesce({t}, 0) > 240 AND coalesce({t}, 0) <= 480 THEN 'medium' "
    "WHEN coalesce({t}, 0) > 480 AND coalesce({t}, 0) <= 960 THEN 'high' "
    "WHEN coalesce({t}, 0) > 960 THEN 'very_high' END"
)

def _bool_map_sql() -> str:
    from tallyline import schemas as S

    mapping = {**S.BOOLEAN_MAP, **S.BOOLEAN_NUMERIC_TEXT}
    t = ", ".join(f"'{k}'" for k, v in mapping.items() if v)
    f = ", ".join(f"'{k}'" for k, v in mapping.items() if not v)
    return "CASE WHEN {c} IN (" + t + ") THEN true WHEN {c} IN (" + f + ") THEN false END"


BOOL_MAP_SQL = _bool_map_sql()

VIEWS.update(
    {
        "tasks_one": """
  SELECT task_id, min(struct_pack(section_id := section_id, task_name := task_name, section_name := section_name)) AS b
  FROM tasks_v WHERE task_id IS NOT NULL GROUP BY task_id""",
        "t1_feat": f"""
  SELECT b.booking_id, b.task_id, t.b.section_id AS section_id, t.b.task_name AS task_name,
         t.b.task_name IS NOT NULL AS has_task_name, t.b.section_name AS section_name,
         t.b.section_name IS NOT NULL AS has_section_name,
         {calendar_sql('b.appointment_time', 'appt_')},
         {calendar_sql('b.check_in_time', 'checkin_')},
         (epoch_us(b.appointment_time) - epoch_us(b.booking_created_time)) / 3600000000.0 AS booking_advance_hours,
         try_cast(trim(b.queue_number) AS DOUBLE) AS queue_number,
         try_cast(trim(b.queue_number) AS DOUBLE) IS NOT NULL AS has_queue_number,
         CAST(coalesce({BOOL_MAP_SQL.format(c='b.document_uploaded')}, false) AS INTEGER) AS document_uploaded,
         try_cast(trim(b.satisfaction_rating) AS DOUBLE) AS satisfaction_rating,
         try_cast(trim(b.satisfaction_rating) AS DOUBLE) IS NOT NULL AS has_satisfaction_rating,
         b.processing_time_minutes
  FROM bookings_clean b LEFT JOIN tasks_one t ON b.task_id = t.task_id""",
        "t2_feat": f"""
  SELECT strftime(date, '%Y-%m-%d') AS date, section_id, {date_block_sql('date')},
         total_task_time_minutes, total_task_time_minutes IS NOT NULL AS has_task_time,
         {TASK_TIME_CATEGORY_SQL.format(t='total_task_time_minutes')} AS task_time_category,
         employees_on_duty AS historical_employees,
         CASE WHEN isfinite(employees_on_duty) AND employees_on_duty >= 0 THEN employees_on_duty END AS staffing_target
  FROM staffing_clean""",
    }
)
_DEPS.update({"tasks_one": ["tasks_v"], "t1_feat": ["bookings_clean", "tasks_one"], "t2_feat": ["staffing_clean"]})
