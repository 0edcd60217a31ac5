"""Ordered-series queries: events per user, and hourly bars as one series."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.kernels import gaussian
from millrace.operators import signals, smoothing, stats
from millrace.operators.series import pair_by_position, with_position
from millrace.operators.smoothing import Smoother, smooth
from millrace.plans.registry import cents, load, query, rounded
from millrace.session import stage

USER = ["user_id"]


def user_series(spark, folder):
    """Event values of each user by time: user_id, value, idx."""
    ticks = load(spark, folder, "events", "user_id", "ts", "event_id", "value")
    return with_position(ticks, ["ts", "event_id"], USER).drop("ts", "event_id")


def hour_series(spark, folder):
    """Hourly means in cents as one series: bar, v, idx. The bars are staged, since numbering counts them first."""
    bars = stats.time_bars(load(spark, folder, "events"), "ts", cents("value"), "hour", output="v")
    return with_position(stage(bars.drop("ticks")), ["bar"])


def minute_series(spark, folder):
    """The same of minutes, a long series."""
    bars = stats.time_bars(load(spark, folder, "events"), "ts", cents("value"), "minute", output="v")
    return with_position(stage(bars.drop("ticks")), ["bar"])


def holed_series(spark, folder):
    """Every seventh event of a user without a value."""
    rows = user_series(spark, folder)
    return rows.withColumn("value", F.when(F.col("idx") % 7 != 3, F.col("value")))


# --- the same in SQL -------------------------------------------------------------------------------------------

USERS = """users AS (SELECT user_id, ts, value AS raw, value AS v,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx FROM events)"""
HOLED = USERS.replace("users AS (", "every AS (") + """, users AS (SELECT user_id, ts, CASE WHEN idx % 7 <> 3 THEN raw END AS raw,
  CASE WHEN idx % 7 <> 3 THEN v END AS v, idx FROM every)"""
MINUTES = """minutes AS MATERIALIZED (SELECT bar, v AS raw, v, row_number() OVER (ORDER BY bar) - 1 AS idx FROM (
  SELECT date_trunc('minute', ts) AS bar, avg(round(value * 100)::BIGINT) AS v FROM events GROUP BY 1))"""
HOURS = """hours AS (SELECT bar, v AS raw, v, row_number() OVER (ORDER BY bar) - 1 AS idx FROM (
  SELECT date_trunc('hour', ts) AS bar, avg(round(value * 100)::BIGINT) AS v FROM events GROUP BY 1))"""
INVERSE = "1.0::DOUBLE / (abs(b.idx - a.idx) + 1)"


def gauss(width: float) -> str:
    return f"exp(-((b.idx - a.idx) * (b.idx - a.idx)) / {width}::DOUBLE)"


def pass_sql(name: str, source: str, before: int, after: int, keys: str = "", weight: str = INVERSE) -> str:
    """One smoothing pass as a CTE: a weighted mean over a band join on the position, NULL if a value is missing."""
    same = f"a.{keys} = b.{keys} AND " if keys else ""
    group = f"a.{keys}, " if keys else ""
    return f"""{name} AS (SELECT {group}a.idx, any_value(a.raw) AS raw, CASE WHEN count(b.v) = count(*) THEN sum(b.v * ({weight})) / sum({weight}) END AS v
      FROM {source} a JOIN {source} b ON {same}b.idx BETWEEN a.idx - {before} AND a.idx + {after} GROUP BY {group}a.idx)"""


def passes_sql(name: str, source: str, power: int, before: int, after: int, keys: str = "") -> str:
    steps, previous = [], source
    for i in range(1, power + 1):
        current = name if i == power else f"{name}_{i}"
        steps.append(pass_sql(current, previous, before, after, keys))
        previous = current
    return ", ".join(steps)


def slopes_sql(source: str, keys: str = "", name: str = "slopes") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    key = f"{keys}, " if keys else ""
    return f"""{name}_1 AS (SELECT {key}idx, raw, v, CASE WHEN idx <= 1 THEN 0 ELSE
        (v - lag(v, 2) OVER ({part}ORDER BY idx)) / 2 END AS d FROM {source}),
      {name} AS (SELECT *, CASE WHEN idx <= 1 THEN 0 ELSE (d - lag(d, 2) OVER ({part}ORDER BY idx)) / 2 END AS d2
        FROM {name}_1)"""


# --- smoothing and derivatives ---------------------------------------------------------------------------------


@query(f"WITH {USERS}, {pass_sql('s', 'users', 3, 3, 'user_id')} SELECT user_id, idx, round(v, 6) AS smoothed FROM s")
def smooth_centered(spark, folder):
    out = smooth(user_series(spark, folder), "value", 3, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(f"WITH {USERS}, {pass_sql('s', 'users', 5, 0, 'user_id')} SELECT user_id, idx, round(v, 6) AS smoothed FROM s")
def smooth_causal(spark, folder):
    out = smooth(user_series(spark, folder), "value", 5, causal=True, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(f"WITH {HOURS}, {passes_sql('s', 'hours', 3, 2, 2)} SELECT idx, round(v, 6) AS smoothed FROM s")
def smooth_power(spark, folder):
    return rounded(smooth(hour_series(spark, folder), "v", 2, power=3).select("idx", "smoothed"), 6, "smoothed")


@query(
    f"""WITH {USERS}, {pass_sql('s', 'users', 3, 0, 'user_id', gauss(3.0))}
        SELECT user_id, idx, round(v, 6) AS smoothed FROM s"""
)
def smooth_gaussian(spark, folder):
    out = smooth(user_series(spark, folder), "value", 3, kernel=gaussian(3.0), causal=True, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(
    f"""WITH {HOURS}, {pass_sql('s_1', 'hours', 3, 3, '', gauss(10.0))}, {pass_sql('s', 's_1', 3, 3)}
        SELECT idx, round(v, 6) AS smoothed FROM s"""
)
def smooth_first_kernel(spark, folder):
    """The given kernel in the first pass only, inverse distance in the second."""
    out = smooth(hour_series(spark, folder), "v", 3, power=2, kernel=gaussian(10.0), kernel_each_pass=False)
    return rounded(out.select("idx", "smoothed"), 6, "smoothed")


@query(
    f"""WITH {USERS}, {passes_sql('s', 'users', 2, 20, 20, 'user_id')}
        SELECT user_id, idx, round(v, 6) AS smoothed FROM s"""
)
def smooth_wide(spark, folder):
    """A neighbourhood large enough for the array passes."""
    out = smooth(user_series(spark, folder), "value", 20, power=2, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(
    """WITH bars AS (SELECT date_trunc('hour', ts) AS bar, avg(round(value * 100)::BIGINT) AS v, count(*) AS ticks FROM events GROUP BY 1)
       SELECT 'hours' AS kind, count(*) AS n, round(avg(v), 4) AS mean FROM bars
       UNION ALL SELECT 'busy hours', count(*), round(avg(v), 4) FROM bars WHERE ticks >= (SELECT avg(ticks) FROM bars)"""
)
def reuse_prepared(spark, folder):
    """Three passes over bars that are computed once."""
    bars = stage(stats.time_bars(load(spark, folder, "events"), "ts", cents("value"), "hour", output="v"))
    usual = bars.agg(F.avg("ticks")).first()[0]
    parts = {"hours": bars, "busy hours": bars.where(F.col("ticks") >= usual)}
    rows = [p.agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean")).select(F.lit(k).alias("kind"), "n", "mean") for k, p in parts.items()]
    return rounded(rows[0].unionByName(rows[1]), 4, "mean")


SKEWED = "CASE WHEN b.idx < a.idx THEN 1.0::DOUBLE / (a.idx - b.idx) ELSE 2.0::DOUBLE / (b.idx - a.idx + 1) END"


@query(f"WITH {USERS}, {pass_sql('s', 'users', 3, 3, 'user_id', SKEWED)} SELECT user_id, idx, round(v, 6) AS smoothed FROM s")
def smooth_asymmetric(spark, folder):
    """Later neighbours weigh otherwise than earlier ones."""
    out = smooth(user_series(spark, folder), "value", 3, kernel=lambda o: -1.0 / o if o < 0 else 2.0 / (o + 1), by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


BY_PLACE = "(1 + b.idx % 3) / (abs(b.idx - a.idx) + 1 + a.idx % 2)::DOUBLE"


@query(
    f"""WITH {USERS}, {pass_sql('s_1', 'users', 4, 4, 'user_id', BY_PLACE)}, {pass_sql('s', 's_1', 4, 4, 'user_id', BY_PLACE)}
        SELECT user_id, idx, round(v, 6) AS smoothed FROM s"""
)
def smooth_by_position(spark, folder):
    """Weights that depend on both positions, in two passes."""
    kernel = lambda i, j: (1 + j % 3) / (abs(i - j) + 1 + i % 2)
    out = smoothing.smooth_by_position(user_series(spark, folder), "value", 4, kernel, power=2, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(f"WITH {HOLED}, {pass_sql('s', 'users', 2, 2, 'user_id')} SELECT user_id, idx, round(v, 6) AS smoothed FROM s")
def smooth_nulls(spark, folder):
    out = smooth(holed_series(spark, folder), "value", 2, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(f"WITH {HOLED}, {passes_sql('s', 'users', 1, 20, 20, 'user_id')} SELECT user_id, idx, round(v, 6) AS smoothed FROM s")
def smooth_wide_nulls(spark, folder):
    """The same by array passes."""
    out = smooth(holed_series(spark, folder), "value", 20, by=USER)
    return rounded(out.select("user_id", "idx", "smoothed"), 6, "smoothed")


@query(
    f"""WITH {USERS}, {slopes_sql('users', 'user_id')}
        SELECT user_id, idx, round(d, 6) AS slope, round(d2, 6) AS curvature FROM slopes"""
)
def derivatives(spark, folder):
    out = smoothing.with_derivatives(user_series(spark, folder), "value", USER)
    return rounded(out.select("user_id", "idx", "slope", "curvature"), 6, "slope", "curvature")


@query(
    f"""WITH {USERS} SELECT user_id, idx, round(coalesce(v - lag(v) OVER (PARTITION BY user_id ORDER BY idx), 0), 6) AS change
        FROM users"""
)
def changes(spark, folder):
    out = smoothing.with_changes(user_series(spark, folder), "value", USER)
    return rounded(out.select("user_id", "idx", "change"), 6, "change")


@query(
    f"""WITH {HOLED} SELECT user_id, idx, round(geometric_mean, 6) AS geometric_mean FROM (
          SELECT user_id, idx, CASE WHEN count(v) OVER w = 5 THEN exp(avg(ln(v)) OVER w) END AS geometric_mean
          FROM users WINDOW w AS (PARTITION BY user_id ORDER BY idx ROWS 4 PRECEDING)) WHERE idx >= 4"""
)
def rolling_geomean_nulls(spark, folder):
    out = smoothing.rolling_geometric_mean(holed_series(spark, folder), "value", 5, USER)
    return rounded(out.select("user_id", "idx", "geometric_mean"), 6, "geometric_mean")


@query(
    f"""WITH {USERS} SELECT user_id, idx, round(geometric_mean, 6) AS geometric_mean FROM (
          SELECT user_id, idx, pow(product(v) OVER (PARTITION BY user_id ORDER BY idx ROWS 4 PRECEDING), 0.2::DOUBLE)
          AS geometric_mean FROM users) WHERE idx >= 4"""
)
def rolling_geomean(spark, folder):
    out = smoothing.rolling_geometric_mean(user_series(spark, folder), "value", 5, USER)
    return rounded(out.select("user_id", "idx", "geometric_mean"), 6, "geometric_mean")


@query(
    f"""WITH {HOURS}, {pass_sql('f', 'hours', 2, 2)}, {pass_sql('s', 'hours', 5, 5)}
        SELECT f.idx, round(f.v, 6) AS fast, round(s.v, 6) AS slow FROM f JOIN s USING (idx)"""
)
def zip_by_index(spark, folder):
    bars = hour_series(spark, folder)
    fast = smooth(bars, "v", 2, output="fast").select("idx", "fast")
    slow = smooth(bars, "v", 5, output="slow").select("idx", "slow")
    return rounded(pair_by_position(fast, slow).select("idx", "fast", "slow"), 6, "fast", "slow")


# --- turning points, regimes -----------------------------------------------------------------------------------


@query(
    f"""WITH {USERS}, {pass_sql('s', 'users', 2, 2, 'user_id')}, {slopes_sql('s', 'user_id')},
        t AS (SELECT *, lead(d) OVER (PARTITION BY user_id ORDER BY idx) AS next FROM slopes),
        k AS (SELECT user_id, idx, v, lead(v) OVER w AS v2, lead(idx) OVER w AS i2 FROM t
              WHERE (d < 0 AND next > 0) OR (d > 0 AND next < 0) WINDOW w AS (PARTITION BY user_id ORDER BY idx))
        SELECT user_id, round(v2 - v, 6) AS move, round(v, 6) AS from_value, round(v2, 6) AS to_value,
               idx AS from_idx, i2 AS to_idx, i2 - idx AS length FROM k WHERE i2 IS NOT NULL AND abs(v2 - v) >= 10"""
)
def turning_moves(spark, folder):
    """Moves of at least 10 between the turning points of each user's smoothed values."""
    smoothed = smooth(user_series(spark, folder), "value", 2, by=USER)
    sloped = smoothing.with_derivatives(smoothed, "smoothed", USER)
    moves = signals.turning_moves(sloped, "smoothed", "slope", 10.0, USER)
    return rounded(moves, 6, "move", "from_value", "to_value")


@query(
    f"""WITH {USERS}, t AS (SELECT *, lead(idx % 2) OVER (PARTITION BY user_id ORDER BY idx) AS next FROM users),
        k AS (SELECT user_id, idx, CASE WHEN idx % 7 <> 3 THEN v END AS v, lead(CASE WHEN idx % 7 <> 3 THEN v END) OVER w AS v2, lead(idx) OVER w AS i2
              FROM t WHERE next IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY idx))
        SELECT user_id, idx AS from_idx, i2 AS to_idx, round(v, 6) AS from_value, round(v2, 6) AS to_value, round(v2 - v, 6) AS move,
          i2 - idx AS length FROM k WHERE i2 IS NOT NULL AND abs(v2 - v) >= 10"""
)
def turning_moves_nulls(spark, folder):
    """Every row turns; moves from or to a missing value are none, whatever lies behind it."""
    zigzag = holed_series(spark, folder).withColumn("slope", F.when(F.col("idx") % 2 == 0, 1.0).otherwise(-1.0))
    moves = signals.turning_moves(zigzag, "value", "slope", 10.0, USER)
    return rounded(moves, 6, "move", "from_value", "to_value")


REGIMES = f"""{HOURS}, {passes_sql('m25', 'hours', 4, 25, 0)}, {passes_sql('m50', 'hours', 4, 50, 0)},
    {passes_sql('m100', 'hours', 4, 100, 0)},
    regimes AS (SELECT a.idx, a.raw, a.v AS fast, b.v AS middle, c.v AS slow,
      CASE WHEN a.v < b.v AND b.v < c.v THEN 'bear' WHEN a.v > b.v AND b.v > c.v THEN 'bull' ELSE 'none' END AS regime
      FROM m25 a JOIN m50 b USING (idx) JOIN m100 c USING (idx))"""


@query(
    f"""WITH {REGIMES} SELECT idx, raw AS v, round(fast, 6) AS fast, round(middle, 6) AS middle, round(slow, 6) AS slow,
        regime FROM regimes"""
)
def regimes(spark, folder):
    """Falling and rising regimes of the hourly means, from three causal averages."""
    out = signals.regimes(hour_series(spark, folder), "v").select("idx", "v", "fast", "middle", "slow", "regime")
    return rounded(out, 6, "fast", "middle", "slow")


@query(
    f"""WITH {REGIMES}, k AS (SELECT idx, raw, lead(idx) OVER (ORDER BY idx) AS i2, lead(raw) OVER (ORDER BY idx) AS v2
          FROM regimes WHERE regime = 'bear')
        SELECT idx AS end_idx, raw AS end_value, i2 AS next_idx, v2 AS next_value FROM k WHERE i2 <> idx + 1"""
)
def regime_breaks(spark, folder):
    bears = signals.regimes(hour_series(spark, folder), "v").where(F.col("regime") == "bear")
    return signals.run_breaks(bears, "v")


MINUTE_REGIMES = f"""{MINUTES}, {passes_sql('m25', 'minutes', 4, 25, 0)}, {passes_sql('m50', 'minutes', 4, 50, 0)},
    {passes_sql('m100', 'minutes', 4, 100, 0)},
    regimes AS (SELECT a.idx, a.raw, CASE WHEN a.v < b.v AND b.v < c.v THEN 'bear' WHEN a.v > b.v AND b.v > c.v THEN 'bull' ELSE 'none' END AS regime
      FROM m25 a JOIN m50 b USING (idx) JOIN m100 c USING (idx))"""


@query(f"WITH {MINUTE_REGIMES} SELECT regime, count(*) AS n, sum(idx)::BIGINT AS idx_sum FROM regimes GROUP BY regime")
def regimes_minutes(spark, folder):
    """Regimes of minute bars, counted."""
    out = signals.regimes(minute_series(spark, folder), "v")
    return out.groupBy("regime").agg(F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"))


@query(
    f"""WITH {MINUTE_REGIMES}, k AS (SELECT idx, raw, lead(idx) OVER (ORDER BY idx) AS i2, lead(raw) OVER (ORDER BY idx) AS v2
          FROM regimes WHERE regime = 'bear')
        SELECT idx AS end_idx, raw AS end_value, i2 AS next_idx, v2 AS next_value FROM k WHERE i2 <> idx + 1"""
)
def regime_breaks_minutes(spark, folder):
    bears = signals.regimes(minute_series(spark, folder), "v").where(F.col("regime") == "bear")
    return signals.run_breaks(bears, "v")


# --- signals and returns ---------------------------------------------------------------------------------------

USER_SIGNALS = f"""{USERS}, {pass_sql('s', 'users', 3, 3, 'user_id')}, {slopes_sql('s', 'user_id')},
    later AS (SELECT *, lead(d) OVER w AS dn, lead(d2) OVER w AS d2n, lead(idx) OVER w IS NULL AS last
      FROM slopes WINDOW w AS (PARTITION BY user_id ORDER BY idx)),
    sig AS (SELECT user_id, idx, raw AS value, CASE WHEN last THEN 'sell'
        WHEN d < 0.5 AND dn > 0.5 THEN 'sell' WHEN d > 0.5 AND dn < 0.5 THEN 'buy'
        WHEN d2 > 0.25 AND d2n < 0.25 THEN 'sell' WHEN d2 < 0.25 AND d2n > 0.25 THEN 'buy' END AS signal FROM later)"""
USER_TRADES = f"""{USER_SIGNALS}, marked AS (SELECT *, signal <> lag(signal, 1, 'sell') OVER (PARTITION BY user_id ORDER BY idx)
      AS traded FROM sig WHERE signal IS NOT NULL)"""


def _user_signals(spark, folder):
    smoother = Smoother(radius=3)
    return signals.with_price_signals(user_series(spark, folder), "value", smoother, 0.5, 0.25, USER)


@query(f"WITH {USER_SIGNALS} SELECT user_id, idx, value, signal FROM sig WHERE signal IS NOT NULL")
def crossing_signals(spark, folder):
    out = _user_signals(spark, folder).select("user_id", "idx", "value", "signal")
    return out.where(F.col("signal").isNotNull())


@query(
    f"""WITH {USERS}, {slopes_sql('users', 'user_id')}, earlier AS (SELECT *, lag(d) OVER w AS dp, lag(d2) OVER w AS d2p,
          lead(idx) OVER w IS NULL AS last FROM slopes WINDOW w AS (PARTITION BY user_id ORDER BY idx)),
        sig AS (SELECT user_id, idx, CASE WHEN last THEN 'sell' WHEN dp < 0.5 AND d > 0.5 THEN 'sell'
          WHEN dp > 0.5 AND d < 0.5 THEN 'buy' WHEN d2p > 0.25 AND d2 < 0.25 THEN 'sell'
          WHEN d2p < 0.25 AND d2 > 0.25 THEN 'buy' END AS signal FROM earlier)
        SELECT user_id, signal, count(*) AS n, sum(idx)::BIGINT AS idx_sum FROM sig GROUP BY user_id, signal"""
)
def crossing_signals_causal(spark, folder):
    """The rules without a look at the next row, on unsmoothed values, counted per user."""
    sloped = smoothing.with_derivatives(user_series(spark, folder), "value", USER)
    out = signals.with_crossing_signals(
        sloped, slope_level=0.5, curvature_level=0.25, by=USER, lookahead=False
    )
    return out.groupBy("user_id", "signal").agg(F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"))


@query(f"WITH {USER_TRADES} SELECT user_id, idx, value, signal FROM marked WHERE traded")
def alternating_trades(spark, folder):
    marked = signals.with_trades(_user_signals(spark, folder), USER)
    return marked.where("traded").select("user_id", "idx", "value", "signal")


@query(
    f"""WITH {USER_TRADES} SELECT user_id, count(*) FILTER (WHERE traded) AS trades, round(sum(CASE WHEN NOT traded THEN 0
        WHEN signal = 'buy' THEN ln(0.998::DOUBLE / value) ELSE ln(0.998::DOUBLE * value) END), 6) AS log_return
        FROM marked GROUP BY user_id"""
)
def strategy_log_return(spark, folder):
    marked = signals.with_trades(_user_signals(spark, folder), USER)
    return rounded(signals.strategy_returns(marked, "value", by=USER), 6, "log_return")


SWEEP = {"radii": (2, 4), "powers": (1, 2), "slope_levels": (0.0, -0.5, -1.0), "curvature_levels": (0.0, 0.5)}


#: A twentieth of the levels of a full search in each direction, on four radii and three powers.
GRID = {
    "radii": (10, 20, 30, 40),
    "powers": (3, 4, 5),
    "slope_levels": tuple(-k / 2 for k in range(11)),
    "curvature_levels": tuple(k / 4 for k in range(11)),
}


def sweep_sql(grid: dict = SWEEP) -> str:
    ctes, shapes = [HOURS], []
    for r in grid["radii"]:
        for p in grid["powers"]:
            ctes.append(passes_sql(f"s{r}_{p}", "hours", p, r, r))
            ctes.append(slopes_sql(f"s{r}_{p}", name=f"d{r}_{p}"))
            shapes.append(
                f"""SELECT {r} AS radius, {p} AS power, idx, raw, d, d2, lead(d) OVER w AS dn, lead(d2) OVER w AS d2n,
                    lead(idx) OVER w IS NULL AS last FROM d{r}_{p} WINDOW w AS (ORDER BY idx)"""
            )
    slopes = ", ".join(f"({v}::DOUBLE)" for v in grid["slope_levels"])
    curves = ", ".join(f"({v}::DOUBLE)" for v in grid["curvature_levels"])
    return f"""WITH {", ".join(ctes)}, shapes AS ({" UNION ALL ".join(shapes)}),
      sig AS (SELECT radius, power, t1 AS slope_level, t2 AS curvature_level, idx, raw, CASE WHEN last THEN 'sell'
          WHEN d < t1 AND dn > t1 THEN 'sell' WHEN d > t1 AND dn < t1 THEN 'buy'
          WHEN d2 > t2 AND d2n < t2 THEN 'sell' WHEN d2 < t2 AND d2n > t2 THEN 'buy' END AS signal
        FROM shapes, (VALUES {slopes}) AS x(t1), (VALUES {curves}) AS y(t2)),
      marked AS (SELECT *, signal <> lag(signal, 1, 'sell') OVER (PARTITION BY radius, power, slope_level, curvature_level
          ORDER BY idx) AS traded FROM sig WHERE signal IS NOT NULL)
      SELECT radius, power, slope_level, curvature_level, count(*) FILTER (WHERE traded) AS trades,
        round(sum(CASE WHEN NOT traded THEN 0 WHEN signal = 'buy' THEN ln(0.998::DOUBLE / raw)
          ELSE ln(0.998::DOUBLE * raw) END), 6) AS log_return
      FROM marked GROUP BY radius, power, slope_level, curvature_level"""


@query(sweep_sql())
def strategy_sweep(spark, folder):
    out = signals.strategy_sweep(hour_series(spark, folder), "v", **SWEEP)
    return rounded(out, 6, "log_return")


@query(f"SELECT * FROM ({sweep_sql()}) ORDER BY log_return DESC, radius, power, slope_level, curvature_level LIMIT 5")
def sweep_topk(spark, folder):
    return signals.best_of(strategy_sweep(spark, folder), "log_return", 5)


@query(sweep_sql(GRID))
def strategy_sweep_grid(spark, folder):
    """1,452 combinations, of which a row crosses few levels or all of them."""
    out = signals.strategy_sweep(hour_series(spark, folder), "v", **GRID)
    return rounded(out, 6, "log_return")
