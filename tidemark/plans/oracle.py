"""Oracle SQL (DuckDB dialect) for every registered query that has a SQL form.

Each statement reads the driver's tables directly (views ``events``, ``orders``,
``customer``, ``nation``, ``region``, ``lineitem``) and restates the adapter and the
model in plain SQL. Doubles are rounded to 9 places as on the Spark side.
"""

from __future__ import annotations

from tidemark import constants as K
from tidemark.functions.stats import normal_quantile
from tidemark.plans import driver_queries as Q
from tidemark.sources import adapter as A


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


Z_CRIT = repr(normal_quantile(1 - 0.05 / 2))
Z_POWER = repr(normal_quantile(0.8))

# staged product events (adapter + staging)
SE = f"""se AS (
  SELECT event_id, user_id,
         CASE WHEN event_type = 'error' AND ts >= {_ts(A.CHURN_SINCE)} THEN '{A.CHURN_EVENT}' ELSE event_type END AS event_name,
         ts AS event_ts, CAST(ts AS DATE) AS event_date,
         CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS experiment_id, CAST(NULL AS VARCHAR) AS variant,
         CAST(coalesce(value, 0) AS DECIMAL(20,6)) AS revenue, props AS properties
  FROM events)"""

def _users(first_sql: str) -> str:
    return f"""(SELECT c.c_custkey AS user_id, f.signup_ts, CAST(f.signup_ts AS DATE) AS signup_date,
          c.c_mktsegment AS plan, r.r_name AS channel, n.n_name AS country
   FROM customer c
   JOIN ({first_sql}) f ON c.c_custkey = f.uid
   LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
   LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


EU = "eu AS " + _users(f"SELECT user_id AS uid, min(ts) AS signup_ts FROM events WHERE event_type = '{A.SIGNUP_EVENT}' GROUP BY 1")
OU = "ou AS " + _users("SELECT o_custkey AS uid, min(o_orderdate) AS signup_ts FROM orders GROUP BY 1")


def _assigned(users: str, name: str) -> str:
    parity, thirds, one_arm = A.EXPERIMENTS
    split = lambda n: f"CASE WHEN user_id % {n} = 0 THEN 'control' ELSE 'treatment' END"
    return f"""{name} AS (
  SELECT '{parity}' AS experiment_id, user_id, {split(2)} AS variant, signup_ts AS assigned_ts FROM {users}
  UNION ALL SELECT '{thirds}', user_id, {split(3)}, signup_ts FROM {users}
  UNION ALL SELECT '{one_arm}', user_id, 'control', signup_ts FROM {users} WHERE user_id % 5 = 0)"""


OE = """oe AS (
  SELECT o_orderkey AS event_id, o_custkey AS user_id, o_orderpriority AS event_name, o_orderdate AS event_ts,
         CAST(coalesce(o_totalprice, 0) AS DECIMAL(20,6)) AS revenue
  FROM orders)"""

AB = f"""ab AS (
  SELECT a.experiment_id, a.user_id, a.variant, coalesce(c.converted, 0) AS converted,
         coalesce(c.revenue, 0) AS revenue, a.assigned_ts
  FROM oasg a LEFT JOIN (
    SELECT user_id,
           max(CASE WHEN event_name IN {_in(A.ORDER_CONVERSION_EVENTS)} THEN 1 ELSE 0 END) AS converted,
           sum(CASE WHEN event_name = '{A.ORDER_PAYMENT_EVENT}' THEN revenue ELSE 0 END) AS revenue
    FROM oe GROUP BY 1) c USING (user_id))"""

ORDER_WORLD = ",\n".join([OU, _assigned("ou", "oasg"), OE, AB])

# experiment statistics from per-arm sufficient statistics
STATS = f"""st AS (
  SELECT experiment_id,
         count(*) FILTER (WHERE variant = 'control') AS n_control,
         count(*) FILTER (WHERE variant = 'treatment') AS n_treatment,
         CAST(coalesce(sum(converted) FILTER (WHERE variant = 'control'), 0) AS BIGINT) AS control_converted,
         CAST(coalesce(sum(converted) FILTER (WHERE variant = 'treatment'), 0) AS BIGINT) AS treatment_converted,
         count(revenue) FILTER (WHERE variant = 'control') AS k_c,
         avg(CAST(revenue AS DOUBLE)) FILTER (WHERE variant = 'control') AS m_c,
         var_samp(CAST(revenue AS DOUBLE)) FILTER (WHERE variant = 'control') AS v_c,
         count(revenue) FILTER (WHERE variant = 'treatment') AS k_t,
         avg(CAST(revenue AS DOUBLE)) FILTER (WHERE variant = 'treatment') AS m_t,
         var_samp(CAST(revenue AS DOUBLE)) FILTER (WHERE variant = 'treatment') AS v_t
  FROM ab GROUP BY 1),
d0 AS (
  SELECT *, control_converted / n_control AS control_rate, treatment_converted / n_treatment AS treatment_rate,
         (control_converted + treatment_converted) / (n_control + n_treatment) AS pooled,
         CAST(1 AS DOUBLE) / nullif(n_control, 0) + CAST(1 AS DOUBLE) / nullif(n_treatment, 0) AS inv_n
  FROM st),
d AS (
  SELECT *, treatment_rate - control_rate AS uplift,
         sqrt(pooled * (1 - pooled) * inv_n) AS se,
         sqrt(2 * pooled * (1 - pooled) * inv_n) AS se2,
         CASE WHEN sqrt(pooled * (1 - pooled) * inv_n) > 0
              THEN (control_rate - treatment_rate) / sqrt(pooled * (1 - pooled) * inv_n) END AS z_stat
  FROM d0),
pv AS (
  -- two-sided normal tail: 1 - 2 * Simpson integral of the density over [0, |z|], 2000 panels
  SELECT d.experiment_id,
         1 - 2 * (abs(any_value(d.z_stat)) / 2000 / 3)
               * sum((CASE WHEN r.range IN (0, 2000) THEN 1 WHEN r.range % 2 = 1 THEN 4 ELSE 2 END)
                     * exp(-0.5 * pow(abs(d.z_stat) * r.range / 2000, 2)) / sqrt(2 * pi())) AS p_value
  FROM d, range(0, 2001) r WHERE d.z_stat IS NOT NULL GROUP BY d.experiment_id),
ev AS (
  SELECT d.*, pv.p_value, coalesce(pv.p_value < 0.05, false) AS significant
  FROM d LEFT JOIN pv USING (experiment_id))"""

WELCH = """w0 AS (
  SELECT experiment_id, v_c / k_c + v_t / k_t AS se2w,
         CASE WHEN v_c / k_c + v_t / k_t > 0 THEN (m_c - m_t) / sqrt(v_c / k_c + v_t / k_t) END AS t,
         CASE WHEN v_c / k_c + v_t / k_t > 0 THEN pow(v_c / k_c + v_t / k_t, 2)
              / (pow(v_c / k_c, 2) / (k_c - 1) + pow(v_t / k_t, 2) / (k_t - 1)) END AS nu
  FROM st),
w1 AS (
  -- two-sided Student-t tail: 1 - 2 * Simpson integral of the t density over [0, |t|]
  SELECT w0.experiment_id,
         1 - 2 * (abs(any_value(w0.t)) / 2000 / 3)
               * sum((CASE WHEN r.range IN (0, 2000) THEN 1 WHEN r.range % 2 = 1 THEN 4 ELSE 2 END)
                     * exp(lgamma((w0.nu + 1) / 2) - lgamma(w0.nu / 2)) / sqrt(w0.nu * pi())
                     * pow(1 + pow(abs(w0.t) * r.range / 2000, 2) / w0.nu, -(w0.nu + 1) / 2)) AS p
  FROM w0, range(0, 2001) r WHERE w0.t IS NOT NULL GROUP BY w0.experiment_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


PRODUCT = (SE, EU)


def _funnel_sql(steps) -> str:
    values = ", ".join(f"({i}, '{s}')" for i, s in enumerate(steps))
    return _with(
        OE,
        f"steps(step_index, step) AS (VALUES {values})",
        f"""counts AS (SELECT event_name AS step, count(DISTINCT user_id) AS users FROM oe
                WHERE event_name IN {_in(steps)} GROUP BY 1)""",
        """j AS (SELECT s.step_index, s.step, coalesce(c.users, 0) AS users
           FROM steps s LEFT JOIN counts c USING (step) WHERE EXISTS (SELECT 1 FROM oe))""",
        """l AS (SELECT *, lag(users) OVER (ORDER BY step_index) AS prev FROM j)""",
        """f AS (SELECT step_index, step, users,
                CASE WHEN prev IS NULL OR prev = 0 THEN CAST(1 AS DOUBLE) ELSE users / prev END AS conversion_from_previous,
                CASE WHEN prev IS NULL OR prev = 0 THEN CAST(0 AS DOUBLE) ELSE 1 - users / prev END AS dropoff_from_previous
           FROM l)""",
    )


def _funnel(steps) -> str:
    return _funnel_sql(steps) + """SELECT step, users, round(conversion_from_previous, 9) AS conversion_from_previous,
       round(dropoff_from_previous, 9) AS dropoff_from_previous FROM f"""


def _retention_ctes(users: str, events: str, session_pred: str, period: str) -> list[str]:
    unit = "week" if period == "weekly" else "month"
    if period == "weekly":
        pn = "CAST(date_diff('day', u.cohort_period, s.active_period) // 7 AS INTEGER)"
    else:
        pn = ("CAST((year(s.active_period) - year(u.cohort_period)) * 12 + month(s.active_period)"
              " - month(u.cohort_period) AS INTEGER)")
    return [
        f"""u AS (SELECT user_id, CAST(date_trunc('{unit}', signup_ts) AS DATE) AS cohort_period FROM {users}
              WHERE user_id IS NOT NULL AND signup_ts IS NOT NULL)""",
        f"""s AS (SELECT DISTINCT user_id, CAST(date_trunc('{unit}', event_ts) AS DATE) AS active_period FROM {events}
              WHERE {session_pred} AND user_id IS NOT NULL AND event_ts IS NOT NULL)""",
        f"""j AS (SELECT u.cohort_period, {pn} AS period_number, s.user_id FROM s JOIN u USING (user_id))""",
        """r AS (SELECT cohort_period, period_number, count(DISTINCT user_id) AS retained FROM j
              WHERE period_number >= 0 GROUP BY 1, 2)""",
        """sz AS (SELECT cohort_period, count(DISTINCT user_id) AS users FROM u GROUP BY 1)""",
        """ret AS (SELECT r.cohort_period, r.period_number, r.retained, sz.users,
                r.retained / sz.users AS retention_rate FROM r LEFT JOIN sz USING (cohort_period))""",
    ]


WEEKLY_RET = _retention_ctes("eu", "se", f"event_name = '{A.SESSION_EVENT}'", "weekly")
MONTHLY_RET = _retention_ctes("ou", "oe", "true", "monthly")


def _ab_select(cols: str) -> str:
    return _with(ORDER_WORLD, STATS) + f"SELECT {cols} FROM ev"


def _checks_union(rows) -> str:
    return "\nUNION ALL\n".join(rows)


def _nn(table, col):
    return (f"SELECT '{table}' AS model, '{col}' AS column_name, 'not_null' AS test, "
            f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {table}")


def _av(table, col, values, model=None, source=None):
    return (f"SELECT '{model or table}' AS model, '{col}' AS column_name, 'accepted_values' AS test, "
            f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN {_in(values)}) AS failures FROM {source or table}")


def _uq(table, col):
    return (f"SELECT '{table}' AS model, '{col}' AS column_name, 'unique' AS test, count(*) AS failures FROM "
            f"(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


def _rel(table, col, parent, pcol):
    return (f"SELECT '{table}' AS model, '{col}' AS column_name, 'relationships' AS test, count(*) AS failures "
            f"FROM {table} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")




def _first_times(steps, source: str) -> str:
    cols = ", ".join(f"min(CASE WHEN event_name = '{s}' THEN event_ts END) AS \"{s}_ts\"" for s in steps)
    return f"fs AS (SELECT user_id, {cols} FROM {source} GROUP BY 1)"


FS_SE = _first_times(A.FUNNEL_STEPS, "se")
FS_OE = _first_times(A.ORDER_FUNNEL_STEPS, "oe")


def _fct_funnel_from_fs(steps) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT user_id, '{s}' AS stage, \"{s}_ts\" AS converted_at, \"{s}_ts\" IS NULL AS dropped FROM fs"
        for s in steps
    )


PRODUCT_MARTS = [
    SE,
    EU,
    _assigned("eu", "pasg"),
    FS_SE,
    f"fct_funnel AS ({_fct_funnel_from_fs(A.FUNNEL_STEPS)})",
    f"""fct_cohort AS (
      SELECT cohort_week, CAST(date_diff('day', cohort_week, active_week) // 7 AS INTEGER) AS period_number,
             count(DISTINCT user_id) AS retained_users
      FROM (SELECT s.user_id, CAST(date_trunc('week', s.signup_ts) AS DATE) AS cohort_week,
                   CAST(date_trunc('week', a.event_ts) AS DATE) AS active_week
            FROM eu s JOIN se a ON s.user_id = a.user_id WHERE a.event_name = '{A.SESSION_EVENT}')
      WHERE active_week >= cohort_week GROUP BY 1, 2)""",
    f"""fct_ab_p AS (SELECT a.experiment_id, a.user_id FROM pasg a)""",
    f"""fct_eng AS (SELECT user_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start, event_name AS feature_event,
              count(*) AS usage_count FROM se WHERE starts_with(event_name, '{A.FEATURE_PREFIX}') GROUP BY 1, 2, 3)""",
]


def _daily_metrics_sql() -> str:
    steps = A.ORDER_FUNNEL_STEPS
    values = ", ".join(f"({i}, '{s}')" for i, s in enumerate(steps))
    pct = lambda x, n: f"printf('%.{n}f', ({x}) * 100) || '%'"
    return _with(
        OU,
        _assigned("ou", "oasg"),
        OE,
        f"steps(step_index, step) AS (VALUES {values})",
        f"""counts AS (SELECT event_name AS step, count(DISTINCT user_id) AS users FROM oe
                WHERE event_name IN {_in(steps)} GROUP BY 1)""",
        """j AS (SELECT s.step_index, s.step, coalesce(c.users, 0) AS users
           FROM steps s LEFT JOIN counts c USING (step) WHERE EXISTS (SELECT 1 FROM oe))""",
        """l AS (SELECT *, lag(users) OVER (ORDER BY step_index) AS prev FROM j)""",
        """f AS (SELECT step_index, step, users,
                CASE WHEN prev IS NULL OR prev = 0 THEN CAST(1 AS DOUBLE) ELSE users / prev END AS conv,
                CASE WHEN prev IS NULL OR prev = 0 THEN CAST(0 AS DOUBLE) ELSE 1 - users / prev END AS drop
           FROM l)""",
        """bd AS (SELECT step, drop FROM f WHERE step_index > 0 ORDER BY drop DESC, step_index ASC LIMIT 1)""",
        f"""ab AS (SELECT a.experiment_id, a.user_id, a.variant,
                 CASE WHEN EXISTS (SELECT 1 FROM oe e WHERE e.user_id = a.user_id
                                   AND e.event_name IN {_in(A.ORDER_CONVERSION_EVENTS)}) THEN 1 ELSE 0 END AS converted,
                 CAST(NULL AS DOUBLE) AS revenue
           FROM oasg a)""",
        STATS.replace("GROUP BY 1)", "GROUP BY ALL)").replace(
            "SELECT experiment_id,\n         count(*) FILTER (WHERE variant = 'control') AS n_control",
            "SELECT 'all' AS experiment_id,\n         count(*) FILTER (WHERE variant = 'control') AS n_control",
        ),
        f"""tl AS (SELECT (SELECT count(DISTINCT user_id) FROM ou) AS users, (SELECT count(*) FROM oe) AS events,
                  (SELECT count(DISTINCT experiment_id) FROM oasg) AS experiments)""",
    ) + f"""
SELECT 1 AS line, 'topline' AS section, 'users' AS metric, CAST(users AS DOUBLE) AS value, format('{{:,}}', users) AS display FROM tl
UNION ALL SELECT 2, 'topline', 'events', CAST(events AS DOUBLE), format('{{:,}}', events) FROM tl
UNION ALL SELECT 3, 'topline', 'experiments', CAST(experiments AS DOUBLE), CAST(experiments AS VARCHAR) FROM tl
UNION ALL SELECT 10, 'funnel', 'biggest_dropoff_step', CAST(NULL AS DOUBLE),
                 coalesce((SELECT step FROM bd), 'Not enough data for drop-off analysis')
UNION ALL SELECT 11, 'funnel', 'biggest_dropoff', round((SELECT drop FROM bd), 9), {pct('(SELECT drop FROM bd)', 1)}
UNION ALL SELECT 100 + step_index * 3, 'funnel', step || ':users', CAST(users AS DOUBLE), format('{{:,}}', users) FROM f
UNION ALL SELECT 101 + step_index * 3, 'funnel', step || ':conversion_from_previous', round(conv, 9), {pct('conv', 1)} FROM f
UNION ALL SELECT 102 + step_index * 3, 'funnel', step || ':dropoff_from_previous', round(drop, 9), {pct('drop', 1)} FROM f
UNION ALL SELECT 1000, 'experiment', 'control_rate', round(control_rate, 9), {pct('control_rate', 2)} FROM ev
UNION ALL SELECT 1001, 'experiment', 'treatment_rate', round(treatment_rate, 9), {pct('treatment_rate', 2)} FROM ev
UNION ALL SELECT 1002, 'experiment', 'uplift', round(uplift, 9), {pct('uplift', 2)} FROM ev
UNION ALL SELECT 1003, 'experiment', 'p_value', round(p_value, 9), printf('%.4f', p_value) FROM ev
UNION ALL SELECT 1004, 'experiment', 'ci_low', round(uplift - {Z_CRIT} * se, 9), {pct(f'uplift - {Z_CRIT} * se', 2)} FROM ev
UNION ALL SELECT 1005, 'experiment', 'ci_high', round(uplift + {Z_CRIT} * se, 9), {pct(f'uplift + {Z_CRIT} * se', 2)} FROM ev
UNION ALL SELECT 1006, 'experiment', 'mde', round(({Z_CRIT} + {Z_POWER}) * se2, 9), {pct(f'({Z_CRIT} + {Z_POWER}) * se2', 2)} FROM ev
UNION ALL SELECT 1007, 'experiment', 'recommendation', CAST(NULL AS DOUBLE),
  CASE WHEN significant AND uplift > 0 THEN 'Ship treatment: statistically significant uplift detected.'
       WHEN significant AND uplift < 0 THEN 'Do not ship: treatment significantly underperforms control.'
       ELSE 'No significant effect: continue test or increase sample size.' END FROM ev"""


CUSTOMER_ORDERS = """customer_orders AS (SELECT c_custkey, min(o_orderdate) AS first_order
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)"""

CHURN = _with(
    SE,
    f"""cb AS (SELECT user_id,
            count(*) FILTER (WHERE event_name = '{A.SESSION_EVENT}') AS session_count,
            count(*) FILTER (WHERE starts_with(event_name, '{A.FEATURE_PREFIX}')) AS feature_events,
            CAST(sum(CASE WHEN event_name = '{A.PAYMENT_EVENT}' THEN coalesce(revenue, 0) ELSE 0 END) AS DOUBLE) AS revenue_total,
            max(CASE WHEN event_name = '{A.CHURN_EVENT}' THEN 1 ELSE 0 END) AS churned,
            greatest(CAST(date_part('day', (SELECT max(event_ts) FROM se) - max(event_ts)) AS BIGINT), 0) AS days_since_active
          FROM se GROUP BY user_id)""",
    """cf AS (SELECT user_id, CAST(session_count AS DOUBLE) AS session_count, CAST(feature_events AS DOUBLE) AS feature_events,
            CAST(days_since_active AS DOUBLE) AS days_since_active, revenue_total, CAST(churned AS DOUBLE) AS label FROM cb)""",
    f"""cs AS (SELECT cf.*, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(CAST(user_id AS VARCHAR) || ':{K.CHURN_SEED}'), user_id)
            <= ceil(count(*) OVER (PARTITION BY label) * {K.CHURN_TEST_SHARE}) THEN 'test' ELSE 'train' END AS split FROM cf)""",
)


def _newton_sql(steps: int = 14) -> str:
    """The logistic fit as a chain of CTEs: one aggregation and one 5 x 5 elimination per Newton step."""
    x = [*K.CHURN_FEATURES, "1.0"]
    k = len(x)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    out = ["tr AS MATERIALIZED (SELECT * FROM cs WHERE split = 'train')", "n0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(k)) + ")"]
    for s in range(steps):
        z = " + ".join(f"w{i} * {x[i]}" for i in range(k))
        sums = [f"sum((p - label) * {x[i]}) + {'any_value(w%d)' % i if i < k - 1 else '0'} AS g{i}" for i in range(k)]
        sums += [f"sum(p * (1 - p) * {x[i]} * {x[j]}) + {1 if i == j < k - 1 else 0} AS a{i}{j}" for i, j in pairs]
        out.append(
            f"s{s} AS MATERIALIZED (SELECT {', '.join(f'any_value(w{i}) AS w{i}' for i in range(k))}, {', '.join(sums)}"
            f" FROM (SELECT *, 1 / (1 + exp(-({z}))) AS p FROM tr, n{s}))"
        )
        last = f"s{s}"
        for c in range(k - 1):  # the matrix is symmetric: only its upper part is kept
            cols = [f"w{i}" for i in range(k)]
            for i in range(k):
                cols.append(f"g{i} - a{c}{i} / a{c}{c} * g{c} AS g{i}" if i > c else f"g{i}")
            for i, j in pairs:
                cols.append(f"a{i}{j} - a{c}{i} / a{c}{c} * a{c}{j} AS a{i}{j}" if i > c else f"a{i}{j}")
            out.append(f"e{s}_{c} AS MATERIALIZED (SELECT {', '.join(cols)} FROM {last})")
            last = f"e{s}_{c}"
        solved = last
        for i in reversed(range(k)):
            rest = "".join(f" - a{i}{j} * d{j}" for j in range(i + 1, k))
            solved = f"(SELECT *, (g{i}{rest}) / a{i}{i} AS d{i} FROM {solved})"
        out.append(f"n{s + 1} AS MATERIALIZED (SELECT {', '.join(f'w{i} - d{i} AS w{i}' for i in range(k))} FROM {solved})")
    z = " + ".join(f"w{i} * {x[i]}" for i in range(k))
    out.append(f"scored AS MATERIALIZED (SELECT cs.*, 1 / (1 + exp(-({z}))) AS score FROM cs, n{steps})")
    out.append(f"fit AS (SELECT * FROM n{steps})")
    return ",\n".join(out)


def oracle_sql() -> dict[str, str]:
    order_steps = _with(OE, FS_OE)
    rec_counts = _with(*PRODUCT_MARTS) + """, c AS (
  SELECT (SELECT count(*) FROM events) AS raw_events, (SELECT count(*) FROM se) AS stg_raw_events,
         (SELECT count(*) FROM eu) AS dim_users, (SELECT count(*) FROM eu) AS stg_dim_users,
         (SELECT count(*) FROM pasg) AS ab_test_assignments, (SELECT count(*) FROM fct_ab_p) AS fct_ab_tests,
         (SELECT count(*) FROM fct_funnel) AS fct_funnel, (SELECT count(*) FROM fct_cohort) AS fct_cohort_retention,
         (SELECT count(*) FROM fct_eng) AS fct_feature_engagement)
"""
    n_stages = len(A.FUNNEL_STEPS)
    return {
        "stg_events": _with(SE) + """SELECT event_id, user_id, event_name, event_ts, event_date, session_id,
            experiment_id, variant, round(CAST(revenue AS DOUBLE), 9) AS revenue, properties FROM se""",
        "stg_users": _with(EU) + "SELECT user_id, signup_ts, signup_date, plan, channel, country FROM eu",
        "stg_assignments": _with(EU, _assigned("eu", "pasg")) + "SELECT experiment_id, user_id, variant, assigned_ts FROM pasg",
        "int_user_activity": _with(SE) + f"""SELECT user_id,
            count(*) FILTER (WHERE event_name = '{A.SESSION_EVENT}') AS session_count,
            count(*) FILTER (WHERE starts_with(event_name, '{A.FEATURE_PREFIX}')) AS feature_events,
            min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts,
            round(CAST(sum(CASE WHEN event_name = '{A.PAYMENT_EVENT}' THEN revenue ELSE 0 END) AS DOUBLE), 9) AS revenue_total,
            max(CASE WHEN event_name = '{A.CHURN_EVENT}' THEN 1 ELSE 0 END) AS churned_flag,
            CAST(date_part('day', {_ts(A.AS_OF)} - max(event_ts)) AS BIGINT) AS days_since_active
          FROM se GROUP BY user_id""",
        "int_funnel_steps": order_steps + "SELECT * FROM fs",
        "fct_funnel": order_steps + _fct_funnel_from_fs(A.ORDER_FUNNEL_STEPS),
        "fct_cohort_weekly": _with(*PRODUCT_MARTS) + "SELECT * FROM fct_cohort",
        "fct_ab_tests": _with(ORDER_WORLD) + """SELECT experiment_id, user_id, variant, converted,
            round(CAST(revenue AS DOUBLE), 9) AS revenue, assigned_ts FROM ab""",
        "fct_feature_engagement": _with(*PRODUCT_MARTS) + "SELECT * FROM fct_eng",
        "fct_feature_engagement_like": _with(SE) + f"""SELECT user_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
            event_name AS feature_event, count(*) AS usage_count FROM se
            WHERE event_name LIKE '{Q.LIKE_PREFIX}%' GROUP BY 1, 2, 3""",
        "funnel": _funnel(A.ORDER_FUNNEL_STEPS),
        "funnel_custom_steps": _funnel(Q.CUSTOM_STEPS),
        "funnel_zero_step": _funnel(Q.ZERO_STEPS),
        "biggest_dropoff": _funnel_sql(A.ORDER_FUNNEL_STEPS) + """SELECT step, round(dropoff_from_previous, 9) AS dropoff,
            round(conversion_from_previous, 9) AS conversion FROM f WHERE step_index > 0
            ORDER BY dropoff_from_previous DESC, step_index ASC LIMIT 1""",
        "retention_weekly_bitmaps": _with(SE, EU, *WEEKLY_RET) + """SELECT cohort_period, period_number, retained, users,
            round(retention_rate, 9) AS retention_rate FROM ret""",
        "retention_weekly": _with(SE, EU, *WEEKLY_RET) + """SELECT cohort_period, period_number, retained, users,
            round(retention_rate, 9) AS retention_rate FROM ret""",
        "retention_monthly_bitmaps": _with(OU, OE, *MONTHLY_RET) + """SELECT cohort_period, period_number, retained, users,
            round(retention_rate, 9) AS retention_rate FROM ret""",
        "retention_monthly": _with(OU, OE, *MONTHLY_RET) + """SELECT cohort_period, period_number, retained, users,
            round(retention_rate, 9) AS retention_rate FROM ret""",
        "cohort_sizes_monthly": _with(OU) + """SELECT CAST(date_trunc('month', signup_ts) AS DATE) AS cohort_period,
            count(DISTINCT user_id) AS users FROM ou WHERE user_id IS NOT NULL AND signup_ts IS NOT NULL GROUP BY 1""",
        "retention_heatmap": _with(SE, EU, *WEEKLY_RET) + """, cells AS (
              SELECT CAST(cohort_period AS VARCHAR) AS cohort_period, period_number, retention_rate FROM ret)
            SELECT cohort_period, coalesce(round(COLUMNS(* EXCLUDE (cohort_period)), 9), 0.0)
            FROM (PIVOT cells ON period_number USING avg(retention_rate) GROUP BY cohort_period)""",
        "behavior_table": _with(SE) + f"""SELECT user_id,
            count(*) FILTER (WHERE event_name = '{A.SESSION_EVENT}') AS session_count,
            count(*) FILTER (WHERE starts_with(event_name, '{A.FEATURE_PREFIX}')) AS feature_events,
            round(CAST(sum(CASE WHEN event_name = '{A.PAYMENT_EVENT}' THEN coalesce(revenue, 0) ELSE 0 END) AS DOUBLE), 9) AS revenue_total,
            max(event_ts) AS last_event_ts,
            max(CASE WHEN event_name = '{A.CHURN_EVENT}' THEN 1 ELSE 0 END) AS churned,
            greatest(CAST(date_part('day', (SELECT max(event_ts) FROM se) - max(event_ts)) AS BIGINT), 0) AS days_since_active
          FROM se GROUP BY user_id""",
        "ab_rates": _ab_select("""experiment_id, n_control, n_treatment, control_converted, treatment_converted,
            round(control_rate, 9) AS control_rate, round(treatment_rate, 9) AS treatment_rate, round(uplift, 9) AS uplift"""),
        "ab_ci_mde": _ab_select(f"""experiment_id, round(uplift - {Z_CRIT} * se, 9) AS ci_low,
            round(uplift + {Z_CRIT} * se, 9) AS ci_high, round(({Z_CRIT} + {Z_POWER}) * se2, 9) AS mde"""),
        "ab_pvalue": _ab_select("experiment_id, round(z_stat, 9) AS z_stat, round(p_value, 9) AS p_value"),
        "ab_decision": _ab_select("""experiment_id, round(p_value, 9) AS p_value, significant,
            CASE WHEN significant AND uplift > 0 THEN 'Ship treatment: statistically significant uplift detected.'
                 WHEN significant AND uplift < 0 THEN 'Do not ship: treatment significantly underperforms control.'
                 ELSE 'No significant effect: continue test or increase sample size.' END AS recommendation"""),
        "ab_revenue_welch": _with(ORDER_WORLD, STATS, WELCH) + """SELECT w0.experiment_id, round(w0.t, 9) AS revenue_t_stat,
            round(w0.nu, 6) AS revenue_df, round(w1.p, 9) AS revenue_p_value
          FROM w0 LEFT JOIN w1 USING (experiment_id)""",
        "ab_results": _with(ORDER_WORLD, STATS, WELCH) + f"""SELECT experiment_id, n_control, n_treatment, control_converted,
            treatment_converted, round(control_rate, 9) AS control_rate, round(treatment_rate, 9) AS treatment_rate,
            round(uplift, 9) AS uplift, round(z_stat, 9) AS z_stat, round(p_value, 9) AS p_value, significant,
            round(uplift - {Z_CRIT} * se, 9) AS ci_low, round(uplift + {Z_CRIT} * se, 9) AS ci_high,
            round(uplift - {Z_CRIT} * se, 9) AS interval_low, round(uplift + {Z_CRIT} * se, 9) AS interval_high,
            round(({Z_CRIT} + {Z_POWER}) * se2, 9) AS mde,
            CASE WHEN significant AND uplift > 0 THEN 'Ship treatment: statistically significant uplift detected.'
                 WHEN significant AND uplift < 0 THEN 'Do not ship: treatment significantly underperforms control.'
                 ELSE 'No significant effect: continue test or increase sample size.' END AS recommendation,
            round(w0.t, 9) AS revenue_t_stat, round(w0.nu, 6) AS revenue_df, round(w1.p, 9) AS revenue_p_value
          FROM ev LEFT JOIN w0 USING (experiment_id) LEFT JOIN w1 USING (experiment_id)""",
        "ab_variant_comparison": _with(ORDER_WORLD) + """SELECT variant, round(avg(converted), 9) AS conversion_rate
            FROM ab GROUP BY 1""",
        "ab_pooled": _with(
            OU,
            _assigned("ou", "oasg"),
            OE,
            f"""ab AS (SELECT a.experiment_id, a.user_id, a.variant,
                 CASE WHEN EXISTS (SELECT 1 FROM oe e WHERE e.user_id = a.user_id
                                   AND e.event_name IN {_in(A.ORDER_CONVERSION_EVENTS)}) THEN 1 ELSE 0 END AS converted,
                 CAST(NULL AS DOUBLE) AS revenue FROM oasg a)""",
            STATS.replace("GROUP BY 1)", "GROUP BY ALL)").replace(
                "SELECT experiment_id,\n         count(*) FILTER (WHERE variant = 'control') AS n_control",
                "SELECT 'all' AS experiment_id,\n         count(*) FILTER (WHERE variant = 'control') AS n_control",
            ),
        ) + f"""SELECT experiment_id, round(control_rate, 9) AS control_rate, round(treatment_rate, 9) AS treatment_rate,
            round(uplift, 9) AS uplift, round(p_value, 9) AS p_value, significant,
            round(uplift - {Z_CRIT} * se, 9) AS ci_low, round(uplift + {Z_CRIT} * se, 9) AS ci_high,
            round(({Z_CRIT} + {Z_POWER}) * se2, 9) AS mde,
            CASE WHEN significant AND uplift > 0 THEN 'Ship treatment: statistically significant uplift detected.'
                 WHEN significant AND uplift < 0 THEN 'Do not ship: treatment significantly underperforms control.'
                 ELSE 'No significant effect: continue test or increase sample size.' END AS recommendation FROM ev""",
        "dq_not_null": _checks_union(
            [_nn("events", c) for c in ("event_id", "user_id", "event_type", "ts")]
            + [_nn("orders", c) for c in ("o_orderkey", "o_custkey", "o_orderdate")]
            + [_nn("customer", c) for c in ("c_custkey", "c_mktsegment")]
        ),
        "dq_unique": _checks_union(
            [_uq("events", "event_id"), _uq("orders", "o_orderkey"), _uq("customer", "c_custkey"), _uq("lineitem", "l_orderkey")]
        ),
        "dq_accepted_values": _with(SE) + _checks_union(
            [
                _av("events", "event_type", Q.EVENT_TYPES),
                _av("orders", "o_orderpriority", A.ORDER_PRIORITIES),
                _av("orders", "o_orderstatus", Q.ORDER_STATUSES),
                _av("customer", "c_mktsegment", Q.SEGMENTS),
                _av("se", "event_name", A.FUNNEL_STEPS, model="stg_raw_events"),
            ]
        ),
        "dq_relationships": _checks_union(
            [
                _rel("events", "user_id", "customer", "c_custkey"),
                _rel("orders", "o_custkey", "customer", "c_custkey"),
                _rel("lineitem", "l_orderkey", "orders", "o_orderkey"),
                _rel("customer", "c_nationkey", "nation", "n_nationkey"),
            ]
        ),
        "dq_duplicate_grain": _with(*PRODUCT_MARTS, OU, _assigned("ou", "oasg")) + """
SELECT 'no_duplicate_event_ids' AS "check", CAST(event_id AS VARCHAR) AS key, count(*) AS records FROM se GROUP BY event_id HAVING count(*) > 1
UNION ALL SELECT 'no_duplicate_assignment_grain', experiment_id || '|' || CAST(user_id AS VARCHAR), count(*) FROM oasg GROUP BY experiment_id, user_id HAVING count(*) > 1
UNION ALL SELECT 'no_duplicate_funnel_grain', CAST(user_id AS VARCHAR) || '|' || stage, count(*) FROM fct_funnel GROUP BY user_id, stage HAVING count(*) > 1
UNION ALL SELECT 'lineitem_grain', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "dq_non_empty": _with(*PRODUCT_MARTS, OU, _assigned("ou", "oasg")) + """
SELECT 'fct_funnel' AS model, count(*) AS row_count, count(*) > 0 AS passed FROM fct_funnel
UNION ALL SELECT 'fct_cohort_retention', count(*), count(*) > 0 FROM fct_cohort
UNION ALL SELECT 'fct_ab_tests', count(*), count(*) > 0 FROM oasg""",
        "dq_reconciliation": rec_counts + f"""
SELECT 'staging_event_count_matches_source' AS "check", 'equals' AS comparison, raw_events AS expected, stg_raw_events AS actual, raw_events = stg_raw_events AS passed FROM c
UNION ALL SELECT 'staging_user_count_matches_source', 'equals', dim_users, stg_dim_users, dim_users = stg_dim_users FROM c
UNION ALL SELECT 'assignment_mart_matches_source', 'equals', ab_test_assignments, fct_ab_tests, ab_test_assignments = fct_ab_tests FROM c
UNION ALL SELECT 'funnel_has_five_rows_per_user', 'equals', dim_users * {n_stages}, fct_funnel, dim_users * {n_stages} = fct_funnel FROM c
UNION ALL SELECT 'cohort_mart_is_not_empty', 'at_least', 1, fct_cohort_retention, fct_cohort_retention >= 1 FROM c
UNION ALL SELECT 'engagement_mart_is_not_empty', 'at_least', 1, fct_feature_engagement, fct_feature_engagement >= 1 FROM c""",
        "dq_known_failures": _with(CUSTOMER_ORDERS) + _checks_union(
            [_nn("customer_orders", c) for c in ("c_custkey", "first_order")]
            + [_rel("customer", "c_custkey", "supplier", "s_suppkey"), _rel("customer", "c_custkey", "orders", "o_custkey")]
        ),
        "contract_violations": _with(CUSTOMER_ORDERS) + _checks_union(
            [
                f"""SELECT '{t}' AS "table", 'duplicate_key' AS "check", count(*) AS failures
                    FROM (SELECT {k} FROM {t} GROUP BY 1 HAVING count(*) > 1)
                    UNION ALL SELECT '{t}', 'not_null:{k}', count(*) FILTER ({k} IS NULL) FROM {t}
                    UNION ALL SELECT '{t}', 'not_null:{c}', count(*) FILTER ({c} IS NULL) FROM {t}"""
                for t, k, c in (
                    ("lineitem", "l_orderkey", "l_shipdate"), ("customer_orders", "c_custkey", "first_order"), ("events", "event_id", "ts")
                )
            ]
        ),
        "text_parsing": """SELECT event_id, event_type AS event_name,
            CASE WHEN event_id % 9 <> 0 THEN ts - INTERVAL 330 MINUTE END AS event_ts,
            CASE WHEN event_id % 9 <> 0 THEN ts - INTERVAL 330 MINUTE END AS strict_ts FROM events""",
        "display_formats": """SELECT quantity, printf('%.1f', share / 16 * 100) || '%' AS one_place,
            printf('%.2f', -share / 32 * 100) || '%' AS two_places, printf('%.4f', share / 64) AS four_places,
            coalesce(printf('%.1f', share / 3 * 100) || '%', 'n/a') AS shown,
            format('{:,}', CAST(quantity * 12345 AS BIGINT)) AS thousands
          FROM (SELECT DISTINCT CAST(l_quantity AS DOUBLE) AS quantity, nullif(CAST(l_quantity AS DOUBLE), 7.0) AS share FROM lineitem)""",
        "contract_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS records FROM lineitem
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "topline": _with(SE, EU, _assigned("eu", "pasg")) + """SELECT (SELECT count(DISTINCT user_id) FROM eu) AS users,
            (SELECT count(*) FROM se) AS events, (SELECT count(DISTINCT experiment_id) FROM pasg) AS experiments""",
        "daily_metrics": _daily_metrics_sql(),
        "churn_features": CHURN + """SELECT user_id, session_count, feature_events, days_since_active,
            round(revenue_total, 9) AS revenue_total, label FROM cf""",
        "churn_split": CHURN + "SELECT user_id, CAST(label AS INTEGER) AS churned, split FROM cs",
        "churn_auc": CHURN + """, t AS (SELECT *, days_since_active * 40 - session_count * 2 - feature_events AS score
              FROM cs WHERE split = 'test'),
            p AS (SELECT sum(CASE WHEN b.score < a.score THEN 1.0 WHEN b.score = a.score THEN 0.5 ELSE 0.0 END) AS won
              FROM t a, t b WHERE a.label = 1 AND b.label <> 1)
            SELECT round(CAST(won AS DOUBLE) / nullif((SELECT count(*) FILTER (label = 1) * count(*) FILTER (label <> 1) FROM t), 0), 9) AS auc,
              (SELECT count(*) FILTER (label = 1) FROM t) AS n_positive, (SELECT count(*) FILTER (label <> 1) FROM t) AS n_negative
            FROM p""",
        "churn_scores": CHURN + ", " + _newton_sql() + """SELECT user_id, CAST(label AS INTEGER) AS churned, split,
            round(score, 6) AS churn_probability FROM scored""",
        "churn_model": CHURN + ", " + _newton_sql() + f""", t AS (SELECT * FROM scored WHERE split = 'test'),
            p AS (SELECT sum(CASE WHEN b.score < a.score THEN 1.0 WHEN b.score = a.score THEN 0.5 ELSE 0.0 END) AS won
              FROM t a, t b WHERE a.label = 1 AND b.label <> 1)
            SELECT 'logistic_regression' AS model, (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM t) AS n_test,
              round(CAST(won AS DOUBLE) / (SELECT count(*) FILTER (label = 1) * count(*) FILTER (label <> 1) FROM t), 6) AS auc,
              {", ".join(f"round(w{i}, 6) AS {f}" for i, f in enumerate((*K.CHURN_FEATURES, "intercept")))} FROM p, fit""",
        "event_positions": "SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS position FROM events",
        "fct_ab_tests_bucketed": _with(ORDER_WORLD) + """SELECT experiment_id, user_id, variant, converted,
            round(CAST(revenue AS DOUBLE), 9) AS revenue, assigned_ts FROM ab""",
        "table_bounds": " UNION ALL ".join(
            f"SELECT '{t}' AS name, count(*) AS n_rows, min({k}) AS least, max({k}) AS greatest FROM {t}" for t, k in Q.BOUNDED
        ),
        "csv_round_trip": _with(SE) + """SELECT event_id, user_id, event_name, event_ts, round(CAST(revenue AS DOUBLE), 9) AS revenue,
            nullif(properties, '') AS properties FROM se""",
        "snapshot_round_trip": _with(SE, EU, _assigned("eu", "pasg")) + """SELECT 'raw_events' AS name, count(*) AS receipt,
              count(*) AS stored, CAST(sum(event_id) AS BIGINT) AS key_sum, count(*) - count(event_id) AS nulls FROM se
            UNION ALL SELECT 'dim_users', count(*), count(*), CAST(sum(user_id) AS BIGINT), count(*) - count(user_id) FROM eu
            UNION ALL SELECT 'ab_test_assignments', count(*), count(*), CAST(sum(user_id) AS BIGINT), count(*) - count(user_id) FROM pasg""",
        "quarantine": """SELECT event_id, concat_ws(',', CASE WHEN event_id % 13 = 0 THEN 'user_id' END,
            CASE WHEN event_id % 11 = 0 THEN 'event_ts' END, CASE WHEN event_id % 7 = 0 THEN 'revenue' END) AS reasons FROM events""",
        "incremental_marts": _with(*PRODUCT_MARTS) + f""", act AS (SELECT user_id,
              count(*) FILTER (WHERE event_name = '{A.SESSION_EVENT}') AS s,
              count(*) FILTER (WHERE starts_with(event_name, '{A.FEATURE_PREFIX}')) AS f, max(event_ts) AS moment,
              max(CASE WHEN event_name = '{A.CHURN_EVENT}' THEN 1 ELSE 0 END) AS c,
              CAST(date_part('day', {_ts(A.AS_OF)} - max(event_ts)) AS BIGINT) AS d,
              CAST(sum(CASE WHEN event_name = '{A.PAYMENT_EVENT}' THEN revenue ELSE 0 END) AS DOUBLE) AS r,
              max(CASE WHEN event_name IN {_in(A.PRODUCT_CONVERSION_EVENTS)} THEN 1 ELSE 0 END) AS conv FROM se GROUP BY 1)
            SELECT 'int_user_activity' AS mart, user_id, concat_ws(':', s, f, c, d) AS key, moment, s AS n, round(r, 9) AS amount FROM act
            UNION ALL SELECT 'fct_funnel', user_id, stage, converted_at, CAST(dropped AS BIGINT), NULL FROM fct_funnel
            UNION ALL SELECT 'fct_cohort_retention', NULL, concat_ws(':', cohort_week, period_number), NULL, retained_users, NULL FROM fct_cohort
            UNION ALL SELECT 'fct_ab_tests', p.user_id, concat_ws(':', experiment_id, variant), assigned_ts, coalesce(conv, 0),
              round(coalesce(r, 0), 9) FROM pasg p LEFT JOIN act ON act.user_id = p.user_id
            UNION ALL SELECT 'fct_feature_engagement', user_id, concat_ws(':', feature_event, week_start), NULL, usage_count, NULL FROM fct_eng""",
    }
