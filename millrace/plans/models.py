"""Linear models on orders: the price against two bounded features, so that fits behave alike at every table size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from millrace.operators import regression, tables
from millrace.operators.stats import minutes_since_open
from millrace.plans.registry import load, query, rounded
from millrace.plans.sources import CLOCK, SQL_CLOCK

TERMS = ["constant", "x", "z"]


def design(spark, folder):
    """o_orderkey, constant, x, z, xz, price."""
    x = ((F.col("o_custkey") % 1500) / 1500.0).alias("x")
    z = ((F.col("o_orderkey") % 1000) / 1000.0).alias("z")
    price = (F.col("o_totalprice") / 100_000.0).alias("price")
    orders = load(spark, folder, "orders", "o_orderkey", F.lit(1.0).alias("constant"), x, z, price)
    return orders.withColumn("xz", F.col("x") * F.col("z"))


# --- the same in SQL -------------------------------------------------------------------------------------------

DESIGN = """design AS (SELECT *, x * z AS xz FROM (SELECT o_orderkey, 1.0::DOUBLE AS constant, (o_custkey % 1500) / 1500.0::DOUBLE AS x,
    (o_orderkey % 1000) / 1000.0::DOUBLE AS z, o_totalprice / 100000.0::DOUBLE AS price FROM orders))"""
SLOT = "('0x' || substr(md5(o_orderkey || '#{seed}'), 1, 8))::BIGINT % 10000"
PARTS = f"""parts AS (SELECT *, CASE WHEN slot < 4500 THEN 'train' WHEN slot < 9000 THEN 'validation' ELSE 'test' END AS part
    FROM (SELECT *, {SLOT.format(seed=1)} AS slot FROM design))"""


def sums_sql(terms: list[str], source: str = "design", name: str = "s") -> str:
    """All sums of products as one row: g_i_j, b_i, yy, n."""
    k = range(len(terms))
    grams = [f"sum({terms[i]} * {terms[j]}) AS g_{i}_{j}" for i in k for j in k]
    sides = [f"sum({terms[i]} * price) AS b_{i}" for i in k]
    return f"{name} AS (SELECT {', '.join([*grams, *sides])}, sum(price * price) AS yy, count(*)::DOUBLE AS n FROM {source})"


def residual_sql(i: int, k: int, sums: str = "s") -> str:
    """Entry i of XtX w - Xty."""
    return "(" + " + ".join(f"{sums}.g_{i}_{j} * w{j}" for j in range(k)) + f" - {sums}.b_{i})"


def rss_sql(k: int, w: list[str], sums: str = "s") -> str:
    cross = " + ".join(f"{w[i]} * {sums}.b_{i}" for i in range(k))
    square = " + ".join(f"{w[i]} * {w[j]} * {sums}.g_{i}_{j}" for i in range(k) for j in range(k))
    return f"({sums}.yy - 2 * ({cross}) + ({square}))"


def terms_out(terms: list[str], source: str, digits: int = 9, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{t}' AS term, round(w{i}, {digits}) AS coefficient FROM {source}" for i, t in enumerate(terms)
    )


# --- sums and descent ------------------------------------------------------------------------------------------


@query(
    f"WITH {DESIGN} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS row_term, '{b}' AS col_term, round(sum({a} * {b}), 6) AS value FROM design"
        for i, a in enumerate([*TERMS, "price"])
        for b in [*TERMS, "price"][i:]
    )
)
def gram_matrix(spark, folder):
    return rounded(regression.gram_matrix(design(spark, folder), TERMS, "price"), 6, "value")


def fixed_sql(terms: list[str], updates: int, rate: float, l2: str = "0.0") -> str:
    k = range(len(terms))
    moves = [
        f"w{i} - {rate}::DOUBLE / n * (2 * {residual_sql(i, len(terms))}" + (f" + 2 * {l2} * w{i})" if i else ")") for i in k
    ]
    return f"""SELECT * FROM (WITH RECURSIVE {DESIGN}, {sums_sql(terms)},
        gd AS (SELECT 0 AS i, {", ".join(f"0.0::DOUBLE AS w{i}" for i in k)}
               UNION ALL SELECT i + 1, {", ".join(moves)} FROM gd, s WHERE i < {updates})
        SELECT * FROM gd WHERE i = {updates})"""


@query(terms_out(TERMS, f"({fixed_sql(TERMS, 50, 0.2)})"))
def gd_fixed(spark, folder):
    m = regression.moments(design(spark, folder), TERMS, "price")
    fit = regression.descend_fixed(m, step=0.2 / m.n, tolerance=0.0, max_updates=50)
    return rounded(fit.frame(spark), 9, "coefficient")


@query(
    terms_out(TERMS[:2], f"({fixed_sql(TERMS[:2], 100, 0.2)})", extra="0.0::DOUBLE AS penalty, ")
    + " UNION ALL "
    + terms_out(TERMS[:2], f"({fixed_sql(TERMS[:2], 100, 0.2, '(0.5::DOUBLE * n)')})", extra="0.5::DOUBLE, ")
)
def gd_ridge(spark, folder):
    """A sweep over two penalties, given per row of the table."""
    m = regression.moments(design(spark, folder), TERMS[:2], "price")
    frames = []
    for penalty in (0.0, 0.5):
        fit = regression.descend_ridge(m, step=0.2 / m.n, l2=penalty * m.n, iterations=100)
        frames.append(fit.frame(spark).select(F.lit(penalty).alias("penalty"), "term", "coefficient"))
    return rounded(frames[0].unionByName(frames[1]), 9, "coefficient")


def extrapolated_sql(terms: list[str], rate: float, leap: float) -> str:
    """The adaptive rule with the weights before the last update (o), for moves that keep their length."""
    k = len(terms)
    old, new = [f"w{i}" for i in range(k)], [f"u{i}" for i in range(k)]
    updates = ", ".join(f"w{i} - step * 2 * {residual_sql(i, k)} AS u{i}" for i in range(k))
    steady = " + ".join(f"(floor(coalesce(abs(o{i} - w{i}) / nullif(abs(w{i} - u{i}), 0), 0) * 100 + 0.5) - 100)" for i in range(k))
    moved = ", ".join(f"CASE WHEN gain > 1e-5 THEN w{i} + (u{i} - w{i}) * CASE WHEN steps >= 3 AND steady = 0 THEN {leap}::DOUBLE ELSE 1 END ELSE w{i} END" for i in range(k))
    kept = ", ".join(f"CASE WHEN gain > 1e-5 THEN w{i} ELSE o{i} END" for i in range(k))
    return f"""SELECT * FROM (WITH RECURSIVE {DESIGN}, {sums_sql(terms)},
        gd AS (SELECT 0 AS steps, {rate}::DOUBLE / n AS step, false AS done, {", ".join(f"0.0::DOUBLE AS w{i}" for i in range(k))},
            {", ".join(f"0.0::DOUBLE AS o{i}" for i in range(k))} FROM s
          UNION ALL SELECT CASE WHEN gain > 1e-5 THEN steps + 1 ELSE steps END, CASE WHEN gain < 0 THEN step / 10 ELSE step END,
            gain >= 0 AND NOT gain > 1e-5, {moved}, {kept}
          FROM (SELECT gd.*, {", ".join(new)}, {steady} AS steady, sqrt({rss_sql(k, old)} / n) - sqrt({rss_sql(k, new)} / n) AS gain
                FROM (SELECT gd.*, {updates} FROM gd, s WHERE NOT done) AS gd, s))
        SELECT * FROM gd WHERE done)"""


@query(terms_out(TERMS[:2], f"({extrapolated_sql(TERMS[:2], 0.001, 100.0)})", digits=5, extra="steps::BIGINT AS steps, "))
def gd_extrapolated(spark, folder):
    """Moves that keep their length are taken a hundred times as long."""
    m = regression.moments(design(spark, folder), TERMS[:2], "price")
    fit = regression.descend_adaptive(m, step=0.001 / m.n, error_threshold=1e-5, extrapolate=True, leap=100.0)
    steps = F.lit(fit.steps).cast("bigint").alias("steps")
    return rounded(fit.frame(spark).select(steps, "term", "coefficient"), 5, "coefficient")


def adaptive_sql(terms: list[str]) -> str:
    k = len(terms)
    old, new = [f"w{i}" for i in range(k)], [f"u{i}" for i in range(k)]
    updates = ", ".join(f"w{i} - step * 2 * {residual_sql(i, k)} AS u{i}" for i in range(k))
    chosen = ", ".join(f"CASE WHEN gain > 1e-6 THEN u{i} ELSE w{i} END" for i in range(k))
    return f"""SELECT * FROM (WITH RECURSIVE {DESIGN}, {sums_sql(terms)},
        gd AS (SELECT 0 AS i, 0 AS steps, 2.0::DOUBLE / n AS step, false AS done, {", ".join(f"0.0::DOUBLE AS w{i}" for i in range(k))} FROM s
          UNION ALL SELECT i + 1, CASE WHEN gain > 1e-6 THEN steps + 1 ELSE steps END, CASE WHEN gain < 0 THEN step / 10 ELSE step END,
            gain >= 0 AND NOT gain > 1e-6, {chosen}
          FROM (SELECT gd.*, {", ".join(new)}, sqrt({rss_sql(k, old)} / n) - sqrt({rss_sql(k, new)} / n) AS gain
                FROM (SELECT gd.*, {updates} FROM gd, s WHERE NOT done) AS gd, s))
        SELECT * FROM gd WHERE done)"""


@query(terms_out(TERMS, f"({adaptive_sql(TERMS)})", digits=6, extra="steps::BIGINT AS steps, "))
def gd_adaptive(spark, folder):
    m = regression.moments(design(spark, folder), TERMS, "price")
    fit = regression.descend_adaptive(m, step=2.0 / m.n, error_threshold=1e-6)
    steps = F.lit(fit.steps).cast("bigint").alias("steps")
    return rounded(fit.frame(spark).select(steps, "term", "coefficient"), 6, "coefficient")


@query(terms_out(TERMS, f"({adaptive_sql(TERMS).replace(DESIGN, DESIGN.replace('o_totalprice / 100000.0::DOUBLE', 'o_totalprice / 100000.0::DOUBLE - avg(o_totalprice / 100000.0::DOUBLE) OVER ()'))})", digits=4, extra="'x' AS kind, "))
def gd_adaptive_offset(spark, folder):
    """A target whose mean is a million: the weights are those of the centred target, but for the constant."""
    rows = design(spark, folder)
    middle = rows.agg(F.avg("price")).first()[0]
    m = regression.moments(rows.withColumn("price", F.col("price") - middle + 1e6), TERMS, "price")
    fit = regression.descend_adaptive(m, step=2.0 / m.n, error_threshold=1e-6, initial=[1e6, 0.0, 0.0])
    found = fit.frame(spark).withColumn("coefficient", F.col("coefficient") - F.when(F.col("term") == "constant", 1e6).otherwise(0.0))
    return rounded(found.select(F.lit("x").alias("kind"), "term", "coefficient"), 4, "coefficient")


def sgd_cte(terms: list[str], iterations: int, step: float, tol: float, sums: str = "s", name: str = "sgd") -> str:
    k = range(len(terms))
    new = ", ".join(f"w{i} - {step}::DOUBLE / sqrt(i + 1) * {residual_sql(i, len(terms), sums)} / {sums}.n AS u{i}" for i in k)
    moved = " + ".join(f"(u{i} - w{i}) * (u{i} - w{i})" for i in k)
    size = " + ".join(f"u{i} * u{i}" for i in k)
    start = ", ".join(f"{1.0 if t == 'constant' else 0.0}::DOUBLE AS w{i}" for i, t in enumerate(terms))
    return f"""{name} AS (SELECT 0 AS i, false AS done, {start} UNION ALL
        SELECT i + 1, i > 0 AND sqrt({moved}) < {tol}::DOUBLE * greatest(sqrt({size}), 1.0), {", ".join(f"u{i}" for i in k)}
        FROM (SELECT {name}.*, {new} FROM {name}, {sums} WHERE NOT done AND i < {iterations}) AS {name})"""


@query(
    terms_out(
        TERMS,
        f"(SELECT * FROM (WITH RECURSIVE {DESIGN}, {sums_sql(TERMS)}, {sgd_cte(TERMS, 200, 0.5, 0.001)} "
        "SELECT * FROM sgd ORDER BY i DESC LIMIT 1))",
        extra="i::BIGINT AS steps, ",
    )
)
def sgd_fit(spark, folder):
    """Stops before the 200th iteration, as the early-stop rule holds."""
    fit = regression.fit_sgd(regression.moments(design(spark, folder), TERMS, "price"), iterations=200, step=0.5)
    steps = F.lit(fit.steps).cast("bigint").alias("steps")
    return rounded(fit.frame(spark).select(steps, "term", "coefficient"), 9, "coefficient")


def search_sql(first: float, attempts: int) -> str:
    """Every candidate step in full, then the first one that the next does not improve."""
    tries, k = [], len(TERMS)
    for attempt in range(attempts):
        step = first / 10**attempt
        name = f"try_{attempt}"
        error = f"sqrt({rss_sql(k, [f'w{i}' for i in range(k)])} / n)"
        tries.append(sgd_cte(TERMS, 100, step, 0.001, name=name))
        tries.append(f"e{attempt} AS (SELECT {name}.*, {error} AS e, {step}::DOUBLE AS step FROM {name}, s ORDER BY i DESC LIMIT 1)")
    choice = " ".join(f"WHEN NOT e{a + 1}.e < e{a}.e THEN e{a}.step" for a in range(attempts - 1))
    every = " UNION ALL ".join(f"SELECT * FROM e{a}" for a in range(attempts))
    sources = ", ".join(f"e{a}" for a in range(attempts))
    return f"""SELECT * FROM (WITH RECURSIVE {DESIGN}, {sums_sql(TERMS)}, {", ".join(tries)}, every AS ({every}),
        choice AS (SELECT CASE {choice} END AS step FROM {sources}) SELECT every.* FROM every JOIN choice USING (step))"""


@query(terms_out(TERMS, f"({search_sql(5.0, 5)})", digits=6, extra="step, round(e, 6) AS rmse, "))
def step_search(spark, folder):
    """Steps from one that is far too long down to the best one."""
    m = regression.moments(design(spark, folder), TERMS, "price")
    fit, step = regression.search_step(m, first_step=5.0)
    error = m.rmse(np.array(list(fit.weights.values())))
    found = fit.frame(spark).select(F.lit(step).alias("step"), F.lit(error).alias("rmse"), "term", "coefficient")
    return rounded(found, 6, "rmse", "coefficient")


MODELS = {"one": TERMS[:2], "two": TERMS, "three": [*TERMS, "xz"]}
ITERATIONS = (20, 60)


def compare_sql() -> str:
    pieces = []
    for name, terms in MODELS.items():
        for count in ITERATIONS:
            k = range(len(terms))
            guess = " + ".join(f"w{i} * {t}" for i, t in enumerate(terms))
            pieces.append(
                f"""SELECT * FROM (WITH RECURSIVE {DESIGN}, {PARTS}, t AS (SELECT * FROM parts WHERE part = 'train'),
                {sums_sql(terms, 't')}, {sgd_cte(terms, count, 0.5, 0.0)}, best AS (SELECT {", ".join(f"w{i}" for i in k)} FROM sgd WHERE i = {count})
                SELECT '{name}' AS model, 0.5::DOUBLE AS step, {count} AS iterations, part, round(avg(pow(price - ({guess}), 2)), 6) AS mse
                FROM parts, best GROUP BY part)"""
            )
    return " UNION ALL ".join(pieces)


@query(compare_sql())
def model_compare(spark, folder):
    rows = tables.with_split(design(spark, folder), "o_orderkey", tables.TRAIN_VALIDATE_TEST, seed=1, output="part")
    parts = regression.moments_of_parts(rows, MODELS["three"], "price", "part")
    out = regression.compare_models(spark, parts, MODELS, steps=[0.5], iterations=ITERATIONS, convergence_tol=0.0)
    return rounded(out, 6, "mse")


# --- closed form -----------------------------------------------------------------------------------------------


@query(
    f"""WITH {DESIGN} SELECT 'constant' AS term, round(regr_intercept(price, x), 6) AS coefficient FROM design
        UNION ALL SELECT 'x', round(regr_slope(price, x), 6) FROM design"""
)
def ols_univariate(spark, folder):
    _, weights = regression.fit_linear(design(spark, folder), ["x"], "price")
    return rounded(regression.coefficient_frame(spark, weights), 6, "coefficient")


@query(
    f"""WITH {DESIGN}, s AS (SELECT avg(x) AS mx, avg(price) AS my, stddev_samp(x) AS sx, stddev_samp(price) AS sy, corr(x, price) AS r,
          count(*)::DOUBLE AS n FROM design),
        w AS (SELECT *, r * (n - 1) / n AS c, 0.002::DOUBLE / sy AS reg FROM s),
        v AS (SELECT *, sign(c) * greatest(abs(c) - 0.5 * reg, 0) / ((n - 1) / n + 0.5 * reg) * sy / sx AS b FROM w)
        SELECT 'constant' AS term, round(my - b * mx, 4) AS coefficient FROM v UNION ALL SELECT 'x', round(b, 4) FROM v"""
)
def elastic_net_one(spark, folder):
    """One feature under both penalties: soft thresholding of the correlation."""
    _, weights = regression.fit_linear(design(spark, folder), ["x"], "price", reg=0.002, elastic_net=0.5, max_iter=1000)
    return rounded(regression.coefficient_frame(spark, weights), 4, "coefficient")


NET_TERMS = ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_square")
NET_PENALTIES = (20_000.0, 5_000.0, 500.0, 5.0)


def net_sql(rounds: int = 60) -> str:
    """Every round updates the five weights in turn, for all penalties at once."""
    n = len(NET_TERMS)
    pairs = ", ".join(
        f"covar_pop({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})) AS g{i}{j}" for i, a in enumerate(NET_TERMS) for j, b in enumerate(NET_TERMS)
    )
    toward = ", ".join(f"covar_pop({a}, y) / (stddev_samp({a}) * stddev_samp(y)) AS c{i}" for i, a in enumerate(NET_TERMS))
    scales = ", ".join(f"avg({a}) AS m{i}, stddev_samp({a}) AS s{i}" for i, a in enumerate(NET_TERMS))
    inner = "SELECT * FROM path JOIN facts ON true"
    for j in range(n):
        pull = f"(c{j} - ({' + '.join(f'g{j}{k} * w{k}' for k in range(n) if k != j)}))"
        new = f"sign({pull}) * greatest(abs({pull}) - 0.5::DOUBLE * penalty / sy, 0) / (g{j}{j} + 0.5::DOUBLE * penalty / sy)"
        inner = f"SELECT * REPLACE ({new} AS w{j}) FROM ({inner})"
    weights = ", ".join(f"w{k}" for k in range(n))
    terms = " UNION ALL ".join(f"SELECT penalty, '{t}' AS term, w{k} * sy / s{k} AS coefficient FROM done" for k, t in enumerate(NET_TERMS))
    constant = " - ".join(["my", *[f"m{k} * w{k} * sy / s{k}" for k in range(n)]])
    return f"""WITH RECURSIVE rows AS (SELECT l_quantity::DOUBLE AS l_quantity, l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax,
        l_linenumber::DOUBLE AS l_linenumber, l_quantity::DOUBLE * l_quantity::DOUBLE AS l_square, l_extendedprice::DOUBLE AS y FROM lineitem),
      facts AS MATERIALIZED (SELECT {pairs}, {toward}, {scales}, avg(y) AS my, stddev_samp(y) AS sy FROM rows),
      path AS (SELECT 0 AS round, penalty, {', '.join(f'0.0::DOUBLE AS w{k}' for k in range(n))} FROM (VALUES {', '.join(f'({p}::DOUBLE)' for p in NET_PENALTIES)}) AS p(penalty)
        UNION ALL SELECT round + 1, penalty, {weights} FROM ({inner}) WHERE round < {rounds}),
      done AS (SELECT * FROM path JOIN facts ON true WHERE round = {rounds})
      SELECT penalty, term, round(coefficient, 3) AS coefficient FROM (
        SELECT penalty, 'constant' AS term, {constant} AS coefficient FROM done UNION ALL {terms})"""


def net_rows(spark, folder):
    """Lines with the square of the quantity, which follows the quantity closely."""
    rows = load(spark, folder, "lineitem", *NET_TERMS[:4], "l_extendedprice")
    return rows.withColumn("l_square", F.col("l_quantity").cast("double") * F.col("l_quantity").cast("double"))


@query(net_sql(3000))
def elastic_net_path(spark, folder):
    """Four penalties on five features from one pass of sums."""
    sums = regression.moments(net_rows(spark, folder), NET_TERMS, "l_extendedprice")
    fits = regression.elastic_net_path(sums, NET_PENALTIES, share=0.5)
    return rounded(regression.path_frame(spark, fits), 3, "coefficient")


HOLED = f"{DESIGN.replace('design AS', 'every AS', 1)}, design AS (SELECT * FROM every WHERE o_orderkey % 7 <> 3 AND o_orderkey % 11 <> 5)"


def holed_design(spark, folder):
    """Some rows without a price, others without x."""
    key = F.col("o_orderkey")
    return design(spark, folder).withColumns({"price": F.when(key % 7 != 3, F.col("price")), "x": F.when(key % 11 != 5, F.col("x"))})


@query(
    f"""WITH {HOLED}, n AS (SELECT (SELECT count(*) FROM every) - (SELECT count(*) FROM design) AS left_out)
        SELECT 'constant' AS term, round(regr_intercept(price, x), 6) AS coefficient, left_out FROM design, n GROUP BY left_out
        UNION ALL SELECT 'x', round(regr_slope(price, x), 6), left_out FROM design, n GROUP BY left_out"""
)
def fit_nulls(spark, folder):
    """Rows that lack a value are left out of all sums, and counted."""
    m = regression.moments(holed_design(spark, folder), TERMS[:2], "price")
    found = regression.coefficient_frame(spark, dict(zip(m.terms, m.solve())))
    return rounded(found.withColumn("left_out", F.lit(m.left_out).cast("bigint")), 6, "coefficient")


TWO_FEATURES = f"""{DESIGN}, v AS (SELECT var_pop(x) AS vx, var_pop(z) AS vz, covar_pop(x, z) AS cxz, covar_pop(x, price) AS cx,
      covar_pop(z, price) AS cz, avg(x) AS mx, avg(z) AS mz, avg(price) AS my FROM design),
    w AS (SELECT *, (cx * vz - cz * cxz) / (vx * vz - cxz * cxz) AS bx, (cz * vx - cx * cxz) / (vx * vz - cxz * cxz) AS bz FROM v)"""


@query(
    f"""WITH {TWO_FEATURES} SELECT 'constant' AS term, round(my - bx * mx - bz * mz, 6) AS coefficient FROM w
        UNION ALL SELECT 'x', round(bx, 6) FROM w UNION ALL SELECT 'z', round(bz, 6) FROM w"""
)
def ols_multi(spark, folder):
    _, weights = regression.fit_linear(design(spark, folder), ["x", "z"], "price")
    return rounded(regression.coefficient_frame(spark, weights), 6, "coefficient")


@query(
    f"""WITH {TWO_FEATURES} SELECT 'constant' AS term, round(my - bx * mx - bz * mz, 6) AS coefficient FROM w
        UNION ALL SELECT 'x', round(bx, 6) FROM w UNION ALL SELECT 'z', round(bz, 6) FROM w"""
)
def coefficients(spark, folder):
    """The coefficient table of a fit by the normal equations."""
    m = regression.moments(design(spark, folder), TERMS, "price")
    return rounded(regression.coefficient_frame(spark, dict(zip(TERMS, m.solve()))), 6, "coefficient")


@query(
    f"""WITH {DESIGN}, w AS (SELECT regr_slope(price, x) AS b, regr_intercept(price, x) AS a FROM design)
        SELECT o_orderkey, round(a + b * x, 6) AS predicted FROM design, w"""
)
def predict_append(spark, folder):
    rows = design(spark, folder)
    m = regression.moments(rows, TERMS[:2], "price")
    predicted = regression.with_prediction(rows, dict(zip(m.terms, m.solve())))
    return rounded(predicted.select("o_orderkey", "predicted"), 6, "predicted")


@query(
    f"""WITH {TWO_FEATURES} SELECT 0.25::DOUBLE AS x, 0.75::DOUBLE AS z,
        round(my + bx * (0.25 - mx) + bz * (0.75 - mz), 6) AS predicted FROM w"""
)
def predict_point(spark, folder):
    """The fit to all orders, evaluated at one point."""
    m = regression.moments(design(spark, folder), TERMS, "price")
    point = regression.predict_point(spark, dict(zip(TERMS, m.solve())), {"x": 0.25, "z": 0.75})
    return rounded(point, 6, "predicted")


SUBSETS = f"""subsets AS (SELECT *, CASE WHEN slot < 2500 THEN 'set_1' WHEN slot < 5000 THEN 'set_2' WHEN slot < 7500 THEN 'set_3'
    ELSE 'set_4' END AS subset FROM (SELECT *, {SLOT.format(seed=0)} AS slot FROM design))"""


@query(
    f"""WITH {DESIGN}, {SUBSETS} SELECT subset, count(*) AS rows, round(regr_syy(price, x) * (1 - regr_r2(price, x)), 3) AS rss,
        round(regr_intercept(price, x), 6) AS constant, round(regr_slope(price, x), 6) AS x FROM subsets GROUP BY subset"""
)
def fit_by_subset(spark, folder):
    rows = tables.with_split(design(spark, folder), "o_orderkey", tables.QUARTERS, output="subset")
    fits = regression.fit_groups(rows, TERMS[:2], "price", ["subset"])
    return rounded(rounded(fits, 6, "constant", "x"), 3, "rss")


@query(
    f"""WITH {HOLED}, {SUBSETS} SELECT subset, count(*) AS rows, round(regr_syy(price, x) * (1 - regr_r2(price, x)), 3) AS rss,
        round(regr_intercept(price, x), 6) AS constant, round(regr_slope(price, x), 6) AS x FROM subsets GROUP BY subset"""
)
def fit_groups_nulls(spark, folder):
    rows = tables.with_split(holed_design(spark, folder), "o_orderkey", tables.QUARTERS, output="subset")
    fits = regression.fit_groups(rows, TERMS[:2], "price", ["subset"])
    return rounded(rounded(fits, 6, "constant", "x"), 3, "rss")


# A quadratic by hand: centre x, then solve for (x, x*x) from the variances and covariances.
def quadratic_sql(source: str, x: str, y: str, keys: str) -> str:
    key = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {key}n, my - b1 * mx - b2 * mxx AS p0, b1 AS p1, b2 AS p2 FROM (
        SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM (
        SELECT {key}count(*) AS n, avg({x}) AS mx, avg({x} * {x}) AS mxx, avg({y}) AS my, var_pop({x}) AS v1, var_pop({x} * {x}) AS v2,
          covar_pop({x}, {x} * {x}) AS v12, covar_pop({x}, {y}) AS c1, covar_pop({x} * {x}, {y}) AS c2 FROM {source} {group}))"""


DAYS = f"""days AS (SELECT day, ((millis - min(millis) OVER (PARTITION BY day)) // 60000) / 1440.0::DOUBLE AS x, value AS y FROM (
    SELECT substr({SQL_CLOCK}, 1, 8) AS day, epoch_us(ts) // 1000 AS millis, value FROM events))"""


def recurrence_sql(source: str, keys: str, degrees: tuple[int, ...], before: str) -> str:
    """Residuals per group after the given degrees, by polynomials orthogonal over the group's own rows (three-term recurrence).

    One recursive step per degree works on one row of lists per group.
    """
    def dot(*names: str) -> str:
        product = " * ".join(f"{n}[i]" for n in names)
        return f"list_sum(list_transform(range(1, n + 1), lambda i: {product}))"

    return f"""WITH RECURSIVE {before},
      lists AS (SELECT {keys}, count(*)::BIGINT AS n, list(t ORDER BY t, y) AS xs, list(y ORDER BY t, y) AS ys FROM (
          SELECT {keys}, y, coalesce((2 * x - min(x) OVER g - max(x) OVER g) / nullif(max(x) OVER g - min(x) OVER g, 0), 0) AS t
          FROM {source} WINDOW g AS (PARTITION BY {keys})) GROUP BY {keys}),
      fit AS (SELECT -1 AS degree, {keys}, n, xs, ys AS es, list_transform(xs, lambda v: 1.0::DOUBLE) AS ps, list_transform(xs, lambda v: 0.0::DOUBLE) AS qs,
          1.0::DOUBLE AS before FROM lists
        UNION ALL SELECT degree + 1, {keys}, n, xs, list_transform(range(1, n + 1), lambda i: es[i] - c * ps[i]),
          list_transform(range(1, n + 1), lambda i: (xs[i] - alpha) * ps[i] - beta * qs[i]), ps, pp
        FROM (SELECT *, CASE WHEN pp > 1e-25 THEN ep / pp ELSE 0 END AS c, CASE WHEN pp > 1e-25 THEN xpp / pp ELSE 0 END AS alpha,
            CASE WHEN degree >= 0 AND before > 1e-25 THEN pp / before ELSE 0 END AS beta
          FROM (SELECT *, {dot('ps', 'ps')} AS pp, {dot('es', 'ps')} AS ep, {dot('xs', 'ps', 'ps')} AS xpp FROM fit WHERE degree < {max(degrees)})))
      SELECT {keys}, degree, n AS rows, round({dot('es', 'es')}, 3) AS rss FROM fit WHERE degree IN {degrees}"""


DAY_DEGREES, SUBSET_DEGREES = (1, 2, 5, 10), (1, 15)


@query(recurrence_sql("days", "day", DAY_DEGREES, DAYS))
def fit_by_day(spark, folder):
    """Polynomial fits of four degrees per day, over the minutes since its first tick."""
    text = load(spark, folder, "events", F.date_format("ts", CLOCK).alias("text"), "value")
    ticks = minutes_since_open(text, "text", CLOCK).select("day", (F.col("minutes") / 1440.0).alias("x"), "value")
    fits = regression.fit_polynomial_groups(ticks, "x", "value", DAY_DEGREES, ["day"])
    return rounded(fits.select("day", "degree", "rows", "rss"), 3, "rss")


@query(recurrence_sql("(SELECT subset, x, price AS y FROM subsets)", "subset", SUBSET_DEGREES, f"{DESIGN}, {SUBSETS}"))
def poly_by_subset(spark, folder):
    """Degree 15 on each of four subsets."""
    rows = tables.with_split(design(spark, folder), "o_orderkey", tables.QUARTERS, output="subset")
    fits = regression.fit_polynomial_groups(rows, "x", "price", SUBSET_DEGREES, ["subset"])
    return rounded(fits.select("subset", "degree", "rows", "rss"), 3, "rss")


@query(
    f"""WITH {DAYS}, q AS ({quadratic_sql('days', 'x', 'y', 'day')})
        SELECT day, round(p0 + p1 * x + p2 * x * x, 4) AS predicted, count(*) AS n FROM q, (VALUES (0.25::DOUBLE), (2.0)) AS points(x) GROUP BY ALL"""
)
def predict_by_day(spark, folder):
    """The quadratic of each day at a point inside its range and at one far beyond."""
    text = load(spark, folder, "events", F.date_format("ts", CLOCK).alias("text"), "value")
    ticks = minutes_since_open(text, "text", CLOCK).select("day", (F.col("minutes") / 1440.0).alias("x"), "value")
    fits = regression.fit_polynomial_groups(ticks, "x", "value", (2,), ["day"])
    points = fits.withColumn("at", F.explode(F.array(F.lit(0.25), F.lit(2.0))))
    predicted = points.select("day", F.round(regression.polynomial_at("at", 2), 4).alias("predicted"))
    return predicted.groupBy("day", "predicted").agg(F.count(F.lit(1)).alias("n"))


def _degrees(spark, folder, max_degree):
    rows = tables.with_split(design(spark, folder), "o_orderkey", tables.TRAIN_VALIDATE_TEST, seed=1, output="part")
    return regression.fit_degrees(rows, "x", "price", max_degree, "part")


@query(
    f"""WITH {DESIGN}, {PARTS}, t AS (SELECT * FROM parts WHERE part = 'train'),
        one AS (SELECT regr_intercept(price, x) AS a, regr_slope(price, x) AS b FROM t), two AS ({quadratic_sql('t', 'x', 'price', '')})
        SELECT 1 AS degree, part, round(sum(pow(price - a - b * x, 2)), 4) AS rss FROM parts, one GROUP BY part
        UNION ALL SELECT 2, part, round(sum(pow(price - p0 - p1 * x - p2 * x * x, 2)), 4) FROM parts, two GROUP BY part"""
)
def degree_rss(spark, folder):
    return rounded(regression.degree_frame(spark, _degrees(spark, folder, 2)), 4, "rss")


@query(
    f"""WITH {HOLED}, {PARTS}, t AS (SELECT * FROM parts WHERE part = 'train'),
        one AS (SELECT regr_intercept(price, x) AS a, regr_slope(price, x) AS b FROM t), two AS ({quadratic_sql('t', 'x', 'price', '')})
        SELECT 1 AS degree, part, round(sum(pow(price - a - b * x, 2)), 4) AS rss FROM parts, one GROUP BY part
        UNION ALL SELECT 2, part, round(sum(pow(price - p0 - p1 * x - p2 * x * x, 2)), 4) FROM parts, two GROUP BY part"""
)
def degree_rss_nulls(spark, folder):
    rows = tables.with_split(holed_design(spark, folder), "o_orderkey", tables.TRAIN_VALIDATE_TEST, seed=1, output="part")
    return rounded(regression.degree_frame(spark, regression.fit_degrees(rows, "x", "price", 2, "part")), 4, "rss")


def degrees_sql(max_degree: int) -> str:
    """Residuals after every degree, by polynomials that are orthogonal over the fitted rows (three-term recurrence).

    A recursive step per degree works on one row of lists; ``ms`` is 1 for the rows fitted on.
    """
    def dot(*names: str) -> str:
        product = " * ".join(f"{n}[i]" for n in names)
        return f"list_sum(list_transform(range(1, n + 1), lambda i: {product}))"

    parts = ("train", "validation", "test")
    results = " UNION ALL ".join(
        f"SELECT degree, '{p}' AS part, list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN names[i] = '{p}' THEN es[i] * es[i] ELSE 0 END)) AS rss FROM fit WHERE degree > 0"
        for p in parts
    )
    return f"""WITH RECURSIVE {DESIGN}, {PARTS},
        lists AS (SELECT count(*)::BIGINT AS n, list(x * 2 - 1 ORDER BY o_orderkey) AS xs, list(price ORDER BY o_orderkey) AS ys,
          list(part ORDER BY o_orderkey) AS names, list(CASE part WHEN 'train' THEN 1.0::DOUBLE ELSE 0 END ORDER BY o_orderkey) AS ms FROM parts),
        fit AS (SELECT -1 AS degree, n, xs, names, ms, ys AS es, list_transform(xs, lambda v: 1.0::DOUBLE) AS ps,
            list_transform(xs, lambda v: 0.0::DOUBLE) AS qs, 1.0::DOUBLE AS before FROM lists
          UNION ALL SELECT degree + 1, n, xs, names, ms, list_transform(range(1, n + 1), lambda i: es[i] - ep / pp * ps[i]),
            list_transform(range(1, n + 1), lambda i: (xs[i] - xpp / pp) * ps[i] - CASE WHEN degree >= 0 THEN pp / before ELSE 0 END * qs[i]), ps, pp
          FROM (SELECT *, {dot('ms', 'ps', 'ps')} AS pp, {dot('ms', 'es', 'ps')} AS ep, {dot('ms', 'xs', 'ps', 'ps')} AS xpp
            FROM fit WHERE degree < {max_degree})),
        every AS ({results}), best AS (SELECT arg_min(degree, rss) AS chosen FROM every WHERE part = 'validation')
        SELECT degree, part, round(rss, 4) AS rss, degree = chosen AS best FROM every, best"""


@query(degrees_sql(15))
def degree_select(spark, folder):
    """Degrees 1 to 15; the one with the least validation error is marked."""
    fits = _degrees(spark, folder, 15)
    best = regression.best_degree(fits).degree
    frame = regression.degree_frame(spark, fits).withColumn("best", F.col("degree") == best)
    return rounded(frame, 4, "rss")
