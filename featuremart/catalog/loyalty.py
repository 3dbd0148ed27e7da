"""Checks for the loyalty analysis (prose-described)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.catalog import register
from featuremart.catalog.common import rounded, with_ctes
from featuremart.operators import phik
from featuremart.plans import loyalty as ly
from featuremart.sources import tickets as tk
from featuremart.sources.tickets import SQL_CTES

HIST = (0.0, 600000.0, 20)
PAIRS = [
    ("first_device", "first_genre"),
    ("first_device", "first_region"),
    ("first_device", "first_service"),
    ("first_genre", "first_region"),
    ("first_genre", "first_service"),
    ("first_region", "first_service"),
]
NUM_PAIRS = [("n_orders", "revenue_rub"), ("n_orders", "avg_gap_days"), ("revenue_rub", "avg_gap_days")]


def _fx(spark, sf_dir):
    return ly.convert_currency(tk.orders(spark, sf_dir), tk.rates(spark, sf_dir))


def _profile(spark, sf_dir):
    return ly.user_profile(ly.order_gaps(_fx(spark, sf_dir)))


@register(
    "fx_convert",
    with_ctes(SQL_CTES, select="SELECT order_id, currency, CAST(amount AS DOUBLE) AS amount, CAST(revenue_rub AS DOUBLE) AS revenue_rub FROM t_fx"),
)
def fx_convert(spark, sf_dir):
    return _fx(spark, sf_dir).select(
        "order_id", "currency", F.col("amount").cast("double"), F.col("revenue_rub").cast("double")
    )


@register(
    "outlier_trim",
    with_ctes(
        SQL_CTES,
        select="""SELECT order_id, CAST(revenue_rub AS DOUBLE) AS revenue_rub FROM t_fx
WHERE CAST(revenue_rub AS DOUBLE) <= (SELECT quantile_cont(CAST(revenue_rub AS DOUBLE), 0.99) FROM t_fx)""",
    ),
)
def outlier_trim(spark, sf_dir):
    fx = _fx(spark, sf_dir).select("order_id", F.col("revenue_rub").cast("double"))
    return ly.trim_outliers(fx, "revenue_rub", 0.99)


@register(
    "order_gaps",
    with_ctes(
        SQL_CTES,
        select="""SELECT order_id, user_id, order_time, prev_order_time, CAST(gap_days AS BIGINT) AS gap_days
FROM t_gaps2""",
    ),
)
def order_gaps(spark, sf_dir):
    g = ly.order_gaps(_fx(spark, sf_dir))
    return g.select("order_id", "user_id", "order_time", "prev_order_time", F.col("gap_days").cast("long"))


PROFILE_SELECT = """SELECT user_id, first_order, last_order, n_orders, CAST(revenue_rub AS DOUBLE) AS revenue_rub,
       avg_revenue_rub, first_device, first_genre, first_region, first_service,
       last_device, last_genre, last_region, last_service, CAST(last_revenue_rub AS DOUBLE) AS last_revenue_rub,
       CAST(min_revenue_rub AS DOUBLE) AS min_revenue_rub, CAST(max_revenue_rub AS DOUBLE) AS max_revenue_rub, span_days,
       n_regions, n_services, n_months, weekend_share, max_gap_days, n_genres, n_devices, round(avg_gap_days, 9) AS avg_gap_days, is_two, is_five FROM t_profile"""


@register("user_profile", with_ctes(SQL_CTES, select=PROFILE_SELECT))
def user_profile(spark, sf_dir):
    money = ("revenue_rub", "last_revenue_rub", "min_revenue_rub", "max_revenue_rub")
    out = _profile(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in money})
    return rounded(out, {"avg_gap_days": 9})


@register(
    "histogram",
    with_ctes(
        SQL_CTES,
        f"""b AS (
  SELECT CASE WHEN x < {HIST[0]} THEN 0 WHEN x >= {HIST[1]} THEN {HIST[2] + 1}
              ELSE CAST(floor((x - {HIST[0]}) / {(HIST[1] - HIST[0]) / HIST[2]}) AS BIGINT) + 1 END AS bucket
  FROM (SELECT CAST(revenue_rub AS DOUBLE) AS x FROM t_fx) WHERE x IS NOT NULL
)""",
        select=f"""SELECT bucket, {HIST[0]} + (bucket - 1) * {(HIST[1] - HIST[0]) / HIST[2]} AS lower,
       {HIST[0]} + bucket * {(HIST[1] - HIST[0]) / HIST[2]} AS upper, count(*) AS rows
FROM b GROUP BY bucket""",
    ),
)
def histogram(spark, sf_dir):
    return ly.histogram(_fx(spark, sf_dir), "revenue_rub", *HIST)


@register(
    "first_order_segments",
    with_ctes(
        SQL_CTES,
        select="""SELECT attribute, value, users, round(return_share, 9) AS return_share,
       round(users / (SELECT count(*) FROM t_profile), 9) AS share
FROM (
  SELECT 'genre' AS attribute, first_genre AS value, count(*) AS users, avg(CAST(is_two AS DOUBLE)) AS return_share
  FROM t_profile GROUP BY first_genre
  UNION ALL
  SELECT 'device', first_device, count(*), avg(CAST(is_two AS DOUBLE)) FROM t_profile GROUP BY first_device
)""",
    ),
)
def first_order_segments(spark, sf_dir):
    return rounded(ly.first_order_segments(_profile(spark, sf_dir)), {"return_share": 9, "share": 9})


@register(
    "loyalty_summary",
    with_ctes(
        SQL_CTES,
        select="""SELECT count(*) AS users, round(avg(CASE WHEN n_orders = 1 THEN 1.0 ELSE 0.0 END), 9) AS one_time_share,
       round(avg(CASE WHEN n_orders >= 5 THEN avg_gap_days END), 9) AS avg_gap_days_5plus FROM t_profile""",
    ),
)
def loyalty_summary(spark, sf_dir):
    return rounded(ly.loyalty_summary(_profile(spark, sf_dir)), {"one_time_share": 9, "avg_gap_days_5plus": 9})


_LONG = "\n  UNION ALL\n  ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {a} AS a, {b} AS b FROM t_profile" for a, b in PAIRS
)
_CORR = "\nUNION ALL\n".join(
    f"SELECT '{a}', '{b}', 'pearson', round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 9) FROM t_profile" for a, b in NUM_PAIRS
)


@register(
    "association",
    with_ctes(
        SQL_CTES,
        f"""long AS (
  {_LONG}
),
tab AS (SELECT col_a, col_b, a, b, count(*) AS o FROM long GROUP BY col_a, col_b, a, b),
tab2 AS (
  SELECT *, sum(o) OVER (PARTITION BY col_a, col_b, a) AS ra, sum(o) OVER (PARTITION BY col_a, col_b, b) AS cb,
         sum(o) OVER (PARTITION BY col_a, col_b) AS n
  FROM tab
),
pp AS (
  SELECT col_a, col_b, first(n) * (sum(o * o / (ra * cb)) - 1) AS chi2, first(n) AS n,
         count(DISTINCT a) AS r, count(DISTINCT b) AS k
  FROM tab2 GROUP BY col_a, col_b
)""",
        select=f"""SELECT col_a, col_b, 'chi2' AS measure, round(chi2, 6) AS value FROM pp
UNION ALL
SELECT col_a, col_b, 'cramers_v', round(sqrt(greatest(chi2, 0) / (n * (least(r, k) - 1))), 6) FROM pp
UNION ALL
{_CORR}""",
    ),
)
def association(spark, sf_dir):
    out = ly.association(_profile(spark, sf_dir))
    prec = F.when(F.col("measure") == "pearson", F.round("value", 9)).otherwise(F.round("value", 6))
    return out.withColumn("value", prec)


# phi_k: the normal's chi-squared is integrated in SQL on the same points, with a
# rational approximation of the error function (error below 2e-7); the
# correlation is bracketed on a coarse and then on a fine grid.
PHI_NUMERIC = ("revenue_rub", "n_orders")
PHI_COLUMNS = [*(f"first_{a}" for a in ly.PROFILE_ATTRIBUTES), *PHI_NUMERIC]
_PHI_SOURCE = ", ".join(
    [
        *(f"CAST(first_{a} AS VARCHAR) AS first_{a}" for a in ly.PROFILE_ATTRIBUTES),
        *(
            f"CASE WHEN {c} IS NULL THEN NULL WHEN (SELECT max(CAST({c} AS DOUBLE)) <= min(CAST({c} AS DOUBLE)) FROM t_profile) THEN '0' ELSE "
            f"CAST(CAST(least(floor((CAST({c} AS DOUBLE) - (SELECT min(CAST({c} AS DOUBLE)) FROM t_profile)) / "
            f"(SELECT max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE)) FROM t_profile) * 10), 9) AS INTEGER) AS VARCHAR) END AS {c}"
            for c in PHI_NUMERIC
        ),
    ]
)
_PHI_LONG = "\n  UNION ALL\n  ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {a} AS a, {b} AS b FROM ph_bins WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    for i, a in enumerate(PHI_COLUMNS)
    for b in PHI_COLUMNS[i + 1 :]
)


def _normal_cdf(z: str) -> str:
    t = f"(1 / (1 + 0.3275911 * abs({z}) / sqrt(2)))"
    tail = f"((((1.061405429 * {t} - 1.453152027) * {t} + 1.421413741) * {t} - 0.284496736) * {t} + 0.254829592) * {t} * exp(-({z}) * ({z}) / 2)"
    return f"(0.5 * (1 + sign({z}) * (1 - {tail})))"


def _normal_chi2(source: str) -> str:
    """SQL for b(rho) of every (key, r, k, rho) in ``source``."""
    above, below = (f"((-5 + (j + {d}) * 10.0 / k - rho * x) / sqrt(1 - rho * rho))" for d in (1, 0))
    mass = f"CASE WHEN rho >= 1 THEN CASE WHEN floor((x + 5) * k / 10) = j THEN 1.0 ELSE 0.0 END ELSE {_normal_cdf(above)} - {_normal_cdf(below)} END"
    row_mass, col_mass = (f"({_normal_cdf(f'(-5 + ({i} + 1) * 10.0 / {m})')} - {_normal_cdf(f'(-5 + {i} * 10.0 / {m})')})" for i, m in (("i", "r"), ("j", "k")))
    return f"""SELECT key, rho, sum((p - e) * (p - e) / e) AS b FROM (
    SELECT key, rho, i, j, sum(w * m) / any_value(rw) * {row_mass} AS p, {row_mass} * {col_mass} AS e FROM (
      SELECT key, r, k, rho, j, CAST(least(floor((x + 5) * r / 10), r - 1) AS INTEGER) AS i, w, {mass} AS m,
             sum(w) OVER (PARTITION BY key, rho, j, CAST(least(floor((x + 5) * r / 10), r - 1) AS INTEGER)) AS rw
      FROM (SELECT s.*, unnest(range(CAST(k AS BIGINT))) AS j FROM ({source}) s), ph_x
    ) GROUP BY key, rho, i, j, r, k
  ) GROUP BY key, rho"""


PHI_CTES = with_ctes(
    SQL_CTES,
    f"ph_bins AS (SELECT {_PHI_SOURCE} FROM t_profile)",
    f"""ph_long AS (
  {_PHI_LONG}
)""",
    "ph_tab AS (SELECT col_a, col_b, a, b, count(*) AS o FROM ph_long GROUP BY col_a, col_b, a, b)",
    """ph_mar AS (
  SELECT *, sum(o) OVER (PARTITION BY col_a, col_b, a) AS ra, sum(o) OVER (PARTITION BY col_a, col_b, b) AS cb FROM ph_tab
)""",
    """ph_pair AS (
  SELECT col_a || '/' || col_b AS key, col_a, col_b, sum(o) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k,
         sum(o) * (sum(o * o / (ra * cb)) - 1) AS chi2
  FROM ph_mar GROUP BY col_a, col_b
)""",
    """ph_x AS (SELECT -5 + (i + 0.5) * 10.0 / 4000 AS x, exp(-power(-5 + (i + 0.5) * 10.0 / 4000, 2) / 2) AS w FROM range(4000) t(i))""",
    """ph_open AS (
  SELECT *, (chi2 - (r - 1) * (k - 1)) / (n * (least(r, k) - 1) - (r - 1) * (k - 1)) AS part FROM ph_pair
  WHERE least(r, k) >= 2 AND chi2 > (r - 1) * (k - 1) AND chi2 < n * (least(r, k) - 1)
)""",
    "ph_shape AS (SELECT DISTINCT r || 'x' || k AS key, r, k FROM ph_open)",
    f"ph_coarse AS ({_normal_chi2('SELECT key, r, k, unnest(range(51)) / 50.0 AS rho FROM ph_shape')})",
    """ph_goal AS (
  SELECT o.key, o.r, o.k, o.part * c.b AS goal FROM ph_open o JOIN ph_coarse c ON c.key = o.r || 'x' || o.k AND c.rho = 1
)""",
    """ph_low AS (
  SELECT g.key, g.r, g.k, g.goal, max(c.rho) AS low FROM ph_goal g JOIN ph_coarse c ON c.key = g.r || 'x' || g.k AND c.b < g.goal GROUP BY ALL
)""",
    f"ph_fine AS ({_normal_chi2('SELECT key, r, k, low + unnest(range(21)) / 1000.0 AS rho FROM ph_low')})",
    """ph_step AS (
  SELECT f.key, l.goal, f.rho, f.b, lead(f.rho) OVER w AS rho2, lead(f.b) OVER w AS b2
  FROM ph_fine f JOIN ph_low l ON f.key = l.key WINDOW w AS (PARTITION BY f.key ORDER BY f.rho)
)""",
    "ph_root AS (SELECT key, rho + (goal - b) / (b2 - b) * (rho2 - rho) AS root FROM ph_step WHERE b < goal AND b2 >= goal)",
    select="""SELECT col_a, col_b, CAST(n AS BIGINT) AS n, CAST(r AS BIGINT) AS r, CAST(k AS BIGINT) AS k, round(chi2, 6) AS chi2,
       round(CASE WHEN least(r, k) < 2 THEN NULL WHEN chi2 <= (r - 1) * (k - 1) THEN 0.0
                  WHEN chi2 >= n * (least(r, k) - 1) THEN 1.0 ELSE root END, 3) AS phi_k
FROM ph_pair LEFT JOIN ph_root USING (key)""",
)


@register("phi_k", PHI_CTES)
def phi_k(spark, sf_dir):
    out = phik.phi_k(_profile(spark, sf_dir), PHI_COLUMNS[: -len(PHI_NUMERIC)], PHI_NUMERIC)
    return rounded(out, {"chi2": 6, "phi_k": 3})
