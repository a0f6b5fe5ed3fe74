"""Registered queries: grid worlds and MDP operators on the event-log grid.

The maps of the reference are fixtures for the tests; the registered
queries plan over a grid derived from ``events`` (user x day), so the state
space grows with the data.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from orchard.operators import halo
from orchard.operators import mdp as M
from orchard.plans.common import r6, t
from orchard.plans.registry import register
from orchard.session import cut_lineage
from orchard.sources.grids import SQL_EVENT_GRID, grid_from_events, grid_stats

GAMMA = 0.99          # discount of the reference's runs (fixed value)
VI_SWEEPS = 5         # unrolled depth of the exact value-iteration checks
CONV_SWEEPS = 149     # most sweeps of the convergence run (fixed value)


def on_grid(fn):
    """Query over the event grid: ``fn(cells, states, tp)``; the result is
    checkpointed, then the prepared transitions and cached tables go."""
    @functools.wraps(fn)
    def run(spark, sf):
        cells = grid_from_events(t(spark, sf, "events")).persist()
        states = M.grid_states(cells).persist()
        with M.prepared_transitions(M.grid_transitions(cells), states) as tp:
            out = cut_lineage(fn(cells, states, tp))
        cells.unpersist()
        states.unpersist()
        return out
    return run


def _start(states):
    r = states.where(~F.col("terminal")).orderBy("x", "y").select("x", "y").first()
    return (int(r["x"]), int(r["y"]))


# ------------------------------------------------------------------ SQL pieces
SQL_MDP = f"""{SQL_EVENT_GRID},
st AS (SELECT x, y, code,
              CASE code WHEN 9 THEN CAST(100.0 AS DOUBLE) WHEN 3 THEN CAST(-100.0 AS DOUBLE)
                        WHEN 2 THEN CAST(-0.75 AS DOUBLE) ELSE CAST(-0.5 AS DOUBLE) END AS r,
              code IN (9, 3) AS terminal
       FROM cells WHERE code <> 1),
mv AS (SELECT s.x, s.y, d.d, coalesce(o.x, s.x) AS x2, CASE WHEN o.x IS NULL THEN s.y ELSE o.y END AS y2
       FROM st s CROSS JOIN (VALUES (0, 0, 1), (1, 0, -1), (2, 1, 0), (3, -1, 0)) AS d(d, dx, dy)
       LEFT JOIN st o ON o.x = s.x + d.dx AND o.y = s.y + d.dy),
tr AS (SELECT mv.x, mv.y, CAST(ac.a AS INTEGER) AS a, mv.x2, mv.y2,
              sum(CASE WHEN ac.a = mv.d THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) / 3 END) AS p
       FROM mv JOIN st s ON s.x = mv.x AND s.y = mv.y AND NOT s.terminal
       CROSS JOIN (VALUES (0), (1), (2), (3)) AS ac(a)
       GROUP BY mv.x, mv.y, ac.a, mv.x2, mv.y2),
trr AS (SELECT tr.*, st.r FROM tr JOIN st ON st.x = tr.x AND st.y = tr.y),
v0 AS (SELECT x, y, CAST(0.0 AS DOUBLE) AS v FROM st WHERE NOT terminal)"""


def _sql_sweeps(n: int, gamma: float = GAMMA, policy: str | None = None) -> str:
    parts = []
    for i in range(1, n + 1):
        flt = f"WHERE t.a = {policy}" if policy else ""
        if policy:
            body = (f"SELECT t.x, t.y, sum(t.p * (t.r + CAST({gamma!r} AS DOUBLE) * coalesce(v.v, 0.0))) AS v "
                    f"FROM trr t LEFT JOIN v{i - 1} v ON v.x = t.x2 AND v.y = t.y2 {flt} GROUP BY t.x, t.y")
        else:
            body = (f"SELECT x, y, max(q) AS v FROM (SELECT t.x, t.y, t.a, "
                    f"sum(t.p * (t.r + CAST({gamma!r} AS DOUBLE) * coalesce(v.v, 0.0))) AS q "
                    f"FROM trr t LEFT JOIN v{i - 1} v ON v.x = t.x2 AND v.y = t.y2 GROUP BY t.x, t.y, t.a) "
                    f"GROUP BY x, y")
        parts.append(f"v{i} AS MATERIALIZED ({body})")
    return ",\n".join(parts)


SQL_START = "start AS (SELECT x, y FROM st WHERE NOT terminal ORDER BY x, y LIMIT 1)"
SQL_REACH = f"""{SQL_START},
reach(x, y) AS (SELECT x, y FROM start
                UNION SELECT tr.x2, tr.y2 FROM reach JOIN tr ON tr.x = reach.x AND tr.y = reach.y WHERE tr.p > 0)"""


# ------------------------------------------------------------------ grid
@register("s7_grid_cells", f"WITH {SQL_EVENT_GRID} SELECT x, y, code FROM cells")
def q_s7(spark, sf):
    return grid_from_events(t(spark, sf, "events"))


@register("s8_grid_stats", f"""WITH {SQL_EVENT_GRID}
SELECT CAST(max(x) + 1 AS INTEGER) AS width, CAST(max(y) + 1 AS INTEGER) AS height,
       CAST(count(*) FILTER (WHERE code <> 1) AS BIGINT) AS states,
       CAST(count(*) FILTER (WHERE code = 0) AS BIGINT) AS n_code_0, CAST(count(*) FILTER (WHERE code = 1) AS BIGINT) AS n_code_1,
       CAST(count(*) FILTER (WHERE code = 2) AS BIGINT) AS n_code_2, CAST(count(*) FILTER (WHERE code = 3) AS BIGINT) AS n_code_3,
       CAST(count(*) FILTER (WHERE code = 9) AS BIGINT) AS n_code_9
FROM cells""")
def q_s8(spark, sf):
    return grid_stats(grid_from_events(t(spark, sf, "events")))


@register("m1_grid_moves", f"WITH {SQL_MDP} SELECT x, y, CAST(d AS INTEGER) AS d, x2, y2 FROM mv")
def q_m1(spark, sf):
    return M.grid_moves(grid_from_events(t(spark, sf, "events")))


@register("m2_grid_transitions", f"WITH {SQL_MDP} SELECT x, y, a, x2, y2, round(p, 9) AS p FROM tr")
def q_m2(spark, sf):
    tr = M.grid_transitions(grid_from_events(t(spark, sf, "events")))
    return tr.select("x", "y", "a", "x2", "y2", F.round("p", 9).alias("p"))


@register("m3_grid_reward", f"WITH {SQL_MDP} SELECT x, y, code, r, terminal FROM st")
def q_m3(spark, sf):
    return M.grid_states(grid_from_events(t(spark, sf, "events")))


@register("m3_reward_on_next", f"WITH {SQL_MDP} SELECT tr.x, tr.y, tr.a, tr.x2, tr.y2, round(tr.p, 9) AS p, st.r "
          "FROM tr JOIN st ON st.x = tr.x2 AND st.y = tr.y2")
def q_m3_next(spark, sf):
    cells = grid_from_events(t(spark, sf, "events"))
    tr = M.with_reward(M.grid_transitions(cells), M.grid_states(cells), "s2")
    return tr.select("x", "y", "a", "x2", "y2", F.round("p", 9).alias("p"), "r")


@register("m5_reachable", f"WITH RECURSIVE {SQL_MDP},\n{SQL_REACH}\nSELECT x, y FROM reach")
def q_m5(spark, sf):
    states = M.grid_states(grid_from_events(t(spark, sf, "events"))).persist()
    try:
        return cut_lineage(M.grid_reachable(states, None, _start(states)))
    finally:
        states.unpersist()


@register("m7_value_iteration", lambda: f"WITH {SQL_MDP},\n{_sql_sweeps(VI_SWEEPS)}\n"
          f"SELECT x, y, round(v, 6) AS v FROM v{VI_SWEEPS}")
def q_m7(spark, sf):
    """All sweeps in one exchange."""
    state, _ = halo.run_sweeps(halo.start(grid_from_events(t(spark, sf, "events"))), VI_SWEEPS, GAMMA)
    return halo.values(state).select("x", "y", r6("v").alias("v"))


@register("m8_policy_evaluation", lambda: f"WITH {SQL_MDP},\n{_sql_sweeps(VI_SWEEPS, policy='(t.x + t.y) % 4')}\n"
          f"SELECT x, y, round(v, 6) AS v FROM v{VI_SWEEPS}")
@on_grid
def q_m8(cells, states, tp):
    pol = states.where(~F.col("terminal")).select("x", "y", ((F.col("x") + F.col("y")) % 4).alias("a"))
    v = M.policy_evaluation(tp, pol, states, GAMMA, VI_SWEEPS)
    return v.select("x", "y", r6("v").alias("v"))


@register("m9_greedy_policy", lambda: f"""WITH {SQL_MDP},\n{_sql_sweeps(3)},
q AS (SELECT t.x, t.y, t.a, sum(t.p * (t.r + CAST({GAMMA!r} AS DOUBLE) * coalesce(v.v, 0.0))) AS q
      FROM trr t LEFT JOIN v3 v ON v.x = t.x2 AND v.y = t.y2 GROUP BY t.x, t.y, t.a),
b AS (SELECT x, y, a, row_number() OVER (PARTITION BY x, y ORDER BY round(q, 9) DESC, a) AS rn FROM q)
SELECT x, y, a FROM b WHERE rn = 1""")
@on_grid
def q_m9(cells, states, tp):
    v = M.value_iteration(tp, states, GAMMA, 3)
    return M.greedy_policy(tp, v, GAMMA).select("x", "y", "a")


@register("m11_values_match", lambda: f"""WITH {SQL_MDP},\n{_sql_sweeps(5)},
d AS (SELECT abs(coalesce(a.v, 0.0) - coalesce(b.v, 0.0)) AS diff FROM v4 a FULL OUTER JOIN v5 b ON a.x = b.x AND a.y = b.y)
SELECT round(max(diff), 6) AS max_diff, max(diff) <= 0.05 AS match FROM d""")
@on_grid
def q_m11(cells, states, tp):
    v4 = M.value_iteration(tp, states, GAMMA, 4)
    v5 = M.bellman_backup(tp, v4, GAMMA)
    return M.values_match(v4, v5, 0.05).select(r6("max_diff").alias("max_diff"), "match")


@register("j5_value_diff", lambda: f"""WITH {SQL_MDP},\n{_sql_sweeps(5)}
SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, round(coalesce(a.v, 0.0), 6) AS v1,
       round(coalesce(b.v, 0.0), 6) AS v2, round(abs(coalesce(a.v, 0.0) - coalesce(b.v, 0.0)), 6) AS diff
FROM v4 a FULL OUTER JOIN v5 b ON a.x = b.x AND a.y = b.y""")
@on_grid
def q_j5(cells, states, tp):
    v4 = M.value_iteration(tp, states, GAMMA, 4)
    v5 = M.bellman_backup(tp, v4, GAMMA)
    d = M.values_diff(v4, v5)
    return d.select("x", "y", r6("v1").alias("v1"), r6("v2").alias("v2"), r6("diff").alias("diff"))


@register("m6_bellman_backup", f"""WITH {SQL_MDP},
vr AS (SELECT x, y, r AS v FROM st WHERE NOT terminal),
q AS (SELECT t.x, t.y, t.a, sum(t.p * (t.r + CAST({GAMMA!r} AS DOUBLE) * coalesce(v.v, 0.0))) AS q
      FROM trr t LEFT JOIN vr v ON v.x = t.x2 AND v.y = t.y2 GROUP BY t.x, t.y, t.a)
SELECT x, y, round(max(q), 6) AS v FROM q GROUP BY x, y""")
@on_grid
def q_m6(cells, states, tp):
    v0 = states.where(~F.col("terminal")).select("x", "y", F.col("r").alias("v"))
    return M.bellman_backup(tp, v0, GAMMA).select("x", "y", r6("v").alias("v"))


def _sql_m12():
    """All sweeps as a recursion; terminal states loop at value 0 so that every successor has a row."""
    return f"""WITH RECURSIVE {SQL_MDP},
tz AS (SELECT x, y, a, x2, y2, p, r FROM trr UNION ALL SELECT x, y, 0, x, y, 0.0, 0.0 FROM st WHERE terminal),
w AS (SELECT 0 AS i, x, y, CAST(0.0 AS DOUBLE) AS v FROM st
      UNION ALL SELECT i + 1, x, y, max(q) FROM (
        SELECT w.i, tz.x, tz.y, tz.a, sum(tz.p * (tz.r + CAST({GAMMA!r} AS DOUBLE) * w.v)) AS q FROM tz JOIN w ON w.x = tz.x2 AND w.y = tz.y2
        WHERE w.i < {CONV_SWEEPS} GROUP BY w.i, tz.x, tz.y, tz.a) GROUP BY i, x, y),
d AS (SELECT b.i AS iter, max(abs(a.v - b.v)) AS d FROM w a JOIN w b ON a.x = b.x AND a.y = b.y AND b.i = a.i + 1 GROUP BY b.i)
SELECT CAST(iter AS INTEGER) AS iter, round(d, 6) AS max_delta,
       CAST((SELECT min(iter) FROM d WHERE iter > 1 AND d <= 0.05) AS INTEGER) AS first_converged FROM d"""


@register("m12_convergence_sweep", _sql_m12)
def q_m12(spark, sf):
    """All 149 sweeps, 50 of them per exchange."""
    rows, _ = halo.convergence(grid_from_events(t(spark, sf, "events")), GAMMA, CONV_SWEEPS, stop=False)
    return rows.withColumn("max_delta", r6("max_delta"))


@register("m13_value_grid", lambda: f"""WITH RECURSIVE {SQL_MDP},\n{SQL_REACH},\n{_sql_sweeps(VI_SWEEPS)}
SELECT c.x, c.y, round(coalesce(v.v, 0.0), 6) AS v
FROM cells c LEFT JOIN (SELECT v{VI_SWEEPS}.* FROM v{VI_SWEEPS} SEMI JOIN reach ON reach.x = v{VI_SWEEPS}.x
                        AND reach.y = v{VI_SWEEPS}.y) v ON v.x = c.x AND v.y = c.y""")
def q_m13(spark, sf):
    cells = grid_from_events(t(spark, sf, "events")).persist()
    try:
        state, _ = halo.run_sweeps(halo.start(cells), VI_SWEEPS, GAMMA)
        states = M.grid_states(cells)
        reach = M.grid_reachable(states, None, _start(states))
        return cut_lineage(M.value_grid(halo.values(state), cells, reach).select("x", "y", r6("v").alias("v")))
    finally:
        cells.unpersist()


# ------------------------------------------------------------------ logged experience
def _log_action():
    return (F.regexp_extract("props", r"(\d+)", 1).cast("int") % 4)


SQL_LOG = r"""e AS (SELECT user_id, ts, event_id, event_type AS s,
                  CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) % 4 AS a, value AS rw,
                  lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s2 FROM events),
steps AS (SELECT s, a, rw AS r, s2 FROM e WHERE s2 IS NOT NULL)"""


@register("m14_transitions_from_log", f"""WITH {SQL_LOG},
c AS (SELECT s, a, s2, count(*) AS n, sum(CAST(round(r * 100) AS BIGINT)) AS rsum FROM steps GROUP BY ALL)
SELECT s, a, s2, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER (PARTITION BY s, a), 6) AS p,
       CAST((2 * sum(rsum) OVER (PARTITION BY s, a) * 10000 + sum(n) OVER (PARTITION BY s, a))
            // (2 * sum(n) OVER (PARTITION BY s, a)) AS DOUBLE) / 1e6 AS r FROM c""")
def q_m14(spark, sf):
    tl = M.transitions_from_log(t(spark, sf, "events"), action=_log_action(), reward_scale=100)
    return tl.select("s", "a", "s2", "n", r6("p").alias("p"), "r")


def _log_steps(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("s"),
                                       _log_action().alias("a"), F.col("value").alias("r"))
    pairs = M.next_in_order(ev, ["user_id"], ["ts", "event_id"], ["s"])
    return pairs.where(F.col("next_s").isNotNull()).select("s", "a", "r", F.col("next_s").alias("s2"))


SQL_Q2 = f"""{SQL_LOG},
q0 AS (SELECT DISTINCT s, a, CAST(0.0 AS DOUBLE) AS q FROM steps),
m0 AS (SELECT s AS s2, max(q) AS v2 FROM q0 GROUP BY s),
q1 AS (SELECT st.s, st.a, avg(st.r + CAST({GAMMA!r} AS DOUBLE) * coalesce(m0.v2, 0.0)) AS q
       FROM steps st LEFT JOIN m0 ON m0.s2 = st.s2 GROUP BY st.s, st.a),
m1 AS (SELECT s AS s2, max(q) AS v2 FROM q1 GROUP BY s),
q2 AS (SELECT st.s, st.a, avg(st.r + CAST({GAMMA!r} AS DOUBLE) * coalesce(m1.v2, 0.0)) AS q
       FROM steps st LEFT JOIN m1 ON m1.s2 = st.s2 GROUP BY st.s, st.a)"""


def _q2(spark, sf):
    steps = _log_steps(spark, sf).persist()
    q1 = M.q_update_batch(steps, None, GAMMA)
    return M.q_update_batch(steps, q1, GAMMA)


@register("m15_q_update_batch", f"WITH {SQL_Q2} SELECT s, a, round(q, 6) AS q FROM q2")
def q_m15(spark, sf):
    return _q2(spark, sf).select("s", "a", r6("q").alias("q"))


@register("m16_action_probs", f"""WITH {SQL_Q2},
g AS (SELECT s, a, q, count(*) OVER (PARTITION BY s) AS n, max(q) OVER (PARTITION BY s) AS mq,
             min(a) FILTER (WHERE round(q, 9) = mr) OVER (PARTITION BY s) AS best
      FROM (SELECT *, max(round(q, 9)) OVER (PARTITION BY s) AS mr FROM q2)),
z AS (SELECT *, exp((q - mq) / CAST(10.0 AS DOUBLE)) AS ez FROM g)
SELECT s, a, 'greedy' AS policy, round(CASE WHEN a = best THEN 1.0 ELSE 0.0 END, 6) AS prob FROM z
UNION ALL SELECT s, a, 'epsilon', round(CAST(0.1 AS DOUBLE) / n + CAST(0.9 AS DOUBLE) * CASE WHEN a = best THEN 1.0 ELSE 0.0 END, 6) FROM z
UNION ALL SELECT s, a, 'boltzmann', round(ez / sum(ez) OVER (PARTITION BY s), 6) FROM z""")
def q_m16(spark, sf):
    q = _q2(spark, sf).persist()
    parts = [M.action_probs(q, "greedy").withColumn("policy", F.lit("greedy")),
             M.action_probs(q, "epsilon", 0.1).withColumn("policy", F.lit("epsilon")),
             M.action_probs(q, "boltzmann", 10.0).withColumn("policy", F.lit("boltzmann"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("s", "a", "policy", r6("prob").alias("prob"))


SQL_STEPS = """steps AS (
  SELECT user_id AS episode, event_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS t,
         CAST(datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS INTEGER) AS x,
         CAST(hour(ts) AS INTEGER) AS y, event_type AS action, value AS reward FROM events),
summ AS (SELECT episode, CAST(count(*) AS BIGINT) AS n_steps,
                coalesce(sum(CASE WHEN t >= 1 THEN reward END), 0.0) AS total_reward FROM steps GROUP BY episode)"""


@register("m17_episode_summary", f"WITH {SQL_STEPS} SELECT episode, n_steps, round(total_reward, 6) AS total_reward FROM summ")
def q_m17(spark, sf):
    s = M.episode_summary(t(spark, sf, "events"))
    return s.select("episode", "n_steps", r6("total_reward").alias("total_reward"))


SQL_BEST = f"""{SQL_STEPS},
best AS (SELECT (SELECT episode FROM summ ORDER BY n_steps, episode LIMIT 1) AS fewest_steps_episode,
                (SELECT min(n_steps) FROM summ) AS fewest_steps,
                (SELECT episode FROM summ ORDER BY total_reward DESC, episode LIMIT 1) AS top_reward_episode,
                (SELECT max(total_reward) FROM summ) AS top_reward)"""


@register("m18_best_episode", f"""WITH {SQL_BEST}
SELECT fewest_steps_episode, fewest_steps, top_reward_episode, round(top_reward, 6) AS top_reward FROM best""")
def q_m18(spark, sf):
    b = M.best_episode(M.episode_summary(t(spark, sf, "events")))
    return b.select("fewest_steps_episode", "fewest_steps", "top_reward_episode", r6("top_reward").alias("top_reward"))


@register("m19_episode_path", f"""WITH {SQL_BEST},
p AS (SELECT s.* FROM steps s, best WHERE s.episode = best.fewest_steps_episode),
q AS (SELECT * FROM p WHERE t < (SELECT max(t) FROM p))
SELECT CAST(floor(t / 10) AS BIGINT) AS line, string_agg(concat(x, ',', y), ' ' ORDER BY t) AS path
FROM q GROUP BY 1""")
def q_m19(spark, sf):
    events = t(spark, sf, "events")
    best = M.best_episode(M.episode_summary(events)).first()["fewest_steps_episode"]
    return M.episode_path(M.steps_from_events(events, best), int(best))
