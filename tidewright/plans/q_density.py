"""Queries: density scores, anomaly models, and the flagship alarm query."""

from pyspark.sql import functions as F

from ..functions.exprs import DAY, HOUR, attach, idiv, micros
from ..operators import alarms, anomaly, density, windows
from ..session import settle
from .bindings import FEATURES, TRAIN_END, h31, rnd
from .q_sources import out
from .registry import query

CUT = f"epoch_us(TIMESTAMP '{TRAIN_END}')"
HCUT = f"({CUT} // 3600000000)"
LOG2PI = "ln(2 * pi())"
_BW = f"""bw AS (SELECT key AS bk, 0.9 * least(stddev(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34) * power(count(*), -0.2) AS hh
  FROM ser WHERE t < {CUT} GROUP BY 1)"""


def cut():
    return micros(F.lit(TRAIN_END).cast("timestamp"))


def train_points(df, slot, value="value"):
    return df.select(*slot, value).withColumn("w", F.lit(1))


def lse(e, total, d=1, h="hh"):
    """Negative log density from exponents ``e`` (grouped)."""
    return f"-(max({e}) + ln(sum(exp({e} - m0))) - ln({total}) - {d} * ln({h}) - {d} * 0.5 * {LOG2PI})"


@query("den_bandwidth_rule", f"WITH {_BW} SELECT bk AS key, {rnd('hh')} AS h FROM bw")
def den_bandwidth_rule(t):
    return out(density.bandwidth_rule(t.ser().where(F.col("t") < cut()), ["key"], "value"))


_KDE = """p AS (SELECT e.key, e.value, -0.5 * power((e.value - s.value) / hh, 2) AS x, hh
  FROM (SELECT DISTINCT key, value FROM ser) e JOIN bw ON bk = e.key JOIN ser s ON s.key = e.key AND s.t < {cut}),
 sc AS (SELECT key, value, -(max(x) + ln(sum(exp(x - m0))) - ln(count(*)) - ln(any_value(hh)) - 0.5 * ln(2 * pi())) AS signal
  FROM (SELECT *, max(x) OVER (PARTITION BY key, value) AS m0 FROM p) GROUP BY 1, 2)""".replace("{cut}", CUT)


@query("den_kde_1d", f"WITH {_BW}, {_KDE} SELECT event_id, {rnd('signal')} AS signal FROM ser JOIN sc USING (key, value)")
def den_kde_1d(t):
    ser = t.ser()
    past = ser.where(F.col("t") < cut())
    rows = attach(ser, density.bandwidth_rule(past, ["key"], "value"), ["key"])
    s = density.kde_signal(train_points(past, ["key"]), rows, ["key"], "value", "h")
    return out(s.select("event_id", "signal"))


def _kernel_sql(name, body, norm):
    return f"""SELECT '{name}' AS kernel, key, value, {rnd(f'-(ln(nullif(sum({body}), 0)) - ln(count(*)) - {norm})')} AS signal FROM k GROUP BY 2, 3"""


@query(
    "den_kde_kernels",
    f"""WITH k AS (SELECT e.key, e.value, abs(e.value - s.value) / 12.0 AS z FROM (SELECT DISTINCT key, value FROM ser) e JOIN ser s ON s.key = e.key AND s.t < {CUT})
        {_kernel_sql('gaussian', 'exp(-0.5 * z * z)', 'ln(12.0) - 0.5 * ln(2 * pi())')}
        UNION ALL {_kernel_sql('tophat', 'CASE WHEN z < 1 THEN 1.0 ELSE 0 END', 'ln(24.0)')}
        UNION ALL {_kernel_sql('linear', 'CASE WHEN z < 1 THEN 1 - z ELSE 0 END', 'ln(12.0)')}""",
)
def den_kde_kernels(t):
    ser = t.ser()
    train = train_points(ser.where(F.col("t") < cut()), ["key"])
    parts = [
        density.kde_scores(train, ser, ["key"], "value", 12.0, k).select(F.lit(k).alias("kernel"), "key", "value", "signal")
        for k in density.KERNELS
    ]
    return out(parts[0].unionByName(parts[1]).unionByName(parts[2]))


WLEN = 4


def grid_windows(t):
    g = t.grid().withColumn("x", F.col("n").cast("double"))
    return windows.sliding_arrays(g, ["key"], "pos", ["x"], WLEN)


@query(
    "den_kde_window",
    f"""WITH w AS (SELECT key, h, pos, x FROM (SELECT key, h, pos, list(CAST(n AS DOUBLE)) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN {WLEN - 1} PRECEDING AND CURRENT ROW) AS x FROM grid) WHERE pos >= {WLEN}),
        p AS (SELECT a.key, a.h, -0.5 * power(list_distance(a.x, b.x) / 1.5, 2) AS e FROM w a JOIN w b ON a.key = b.key AND b.h < {HCUT}),
        q AS (SELECT *, max(e) OVER (PARTITION BY key, h) AS m0 FROM p)
        SELECT key, h, {rnd(lse('e', 'count(*)', WLEN, '1.5::DOUBLE'))} AS signal FROM q GROUP BY 1, 2""",
)
def den_kde_window(t):
    w = grid_windows(t)
    train = w.where(F.col("h") < idiv(cut(), HOUR))
    s = density.kde_signal(train_points(train, ["key"], "window"), w, ["key"], "window", 1.5, dims=WLEN)
    return out(s.select("key", "h", "signal"))


@query(
    "den_kde_joint_time",
    f"""WITH r AS (SELECT min(n) AS nl, max(n) AS nh FROM grid_total WHERE h < {HCUT}),
        x AS (SELECT h, (h % 24) / 23.0 AS a, (n - nl) / (nh - nl)::DOUBLE AS b FROM grid_total, r),
        p AS (SELECT e.h, -0.5 * (power((e.a - s.a) / 0.1, 2) + power((e.b - s.b) / 0.1, 2)) AS e FROM x e JOIN x s ON s.h < {HCUT}),
        q AS (SELECT *, max(e) OVER (PARTITION BY h) AS m0 FROM p)
        SELECT h, {rnd(lse('e', 'count(*)', 2, '0.1::DOUBLE'), 5)} AS signal FROM q GROUP BY 1""",
)
def den_kde_joint_time(t):
    from ..operators.scale import minmax

    past = F.col("h") < idiv(cut(), HOUR)
    g = minmax(t.grid(total=True).withColumn("hod", F.col("h") % 24), ["hod", "n"], train=past)
    g = g.select("h", F.lit("all").alias("key"), F.array("hod", "n").alias("point"))
    s = density.kde_signal(train_points(g.where(past), ["key"], "point"), g, ["key"], "point", 0.1, dims=2)
    return out(s.select("h", "signal"), 5)


@query(
    "den_kde_time_indexed",
    f"""WITH x AS (SELECT h, h % 24 AS slot, n::DOUBLE AS n FROM grid_total),
        p AS (SELECT a.h, -0.5 * power((a.n - b.n) / 2.0, 2) AS e FROM x a JOIN x b ON a.slot = b.slot AND b.h < {HCUT}),
        q AS (SELECT *, max(e) OVER (PARTITION BY h) AS m0 FROM p)
        SELECT h, {rnd(lse('e', 'count(*)', 1, '2.0::DOUBLE'))} AS signal FROM q GROUP BY 1""",
)
def den_kde_time_indexed(t):
    g = t.grid(total=True).select("h", (F.col("h") % 24).alias("slot"), F.col("n").cast("double").alias("n"))
    train = train_points(g.where(F.col("h") < idiv(cut(), HOUR)), ["slot"], "n")
    return out(density.kde_signal(train, g, ["slot"], "n", 2.0).select("h", "signal"))


BANDS = [1.0, 2.0, 4.0, 8.0]


@query(
    "den_kde_bandwidth_cv",
    f"""WITH x AS (SELECT h AS id, n::DOUBLE AS v, {{fold}} AS fold FROM grid_total WHERE h < {HCUT}), b AS (SELECT unnest([1.0, 2.0, 4.0, 8.0])::DOUBLE AS h),
        p AS (SELECT b.h, a.fold, a.id, -0.5 * power((a.v - c.v) / b.h, 2) AS e FROM x a JOIN x c ON a.fold <> c.fold, b),
        q AS (SELECT *, max(e) OVER (PARTITION BY h, id) AS m0 FROM p),
        s AS (SELECT h, fold, id, max(e) + ln(sum(exp(e - m0))) - ln(count(*)) - ln(h) - 0.5 * ln(2 * pi()) AS l FROM q GROUP BY 1, 2, 3),
        f AS (SELECT h, fold, sum(l) AS l, count(*) AS n FROM s GROUP BY 1, 2)
        SELECT h, {rnd('avg(l)', 5)} AS mean_loglik, sum(n)::BIGINT AS n FROM f GROUP BY 1""".replace("{fold}", f"({h31('h')} % 5)"),
)
def den_kde_bandwidth_cv(t):
    g = t.grid(total=True).where(F.col("h") < idiv(cut(), HOUR))
    g = g.select(F.col("h").alias("id"), F.col("n").cast("double").alias("v"))
    return out(density.bandwidth_cv(g, "v", "id", BANDS, 5), 5)


_GX = ["qty", "price", "retail"]


@query("den_gmm")
def den_gmm(t):
    f = t.feat_table()
    m = anomaly.fit_mixture(anomaly.assemble(f, _GX), "x", 3, seed=7)
    return out(anomaly.score_mixture(f, _GX, m).select("oid", "ln", "log_density", "component", "top_posterior"))


@query("den_gmm_select")
def den_gmm_select(t):
    return out(anomaly.select_components(anomaly.assemble(t.feat_table(), _GX), "x", [2, 3], len(_GX), "oid", 2, seed=7), 4)


@query("ano_pca_gmm_outliers")
def ano_pca_gmm_outliers(t):
    return anomaly.pca_mixture_outliers(t.feat_table(), FEATURES, seed=3).select("oid", "ln", "outlier")


@query("ano_isolation")
def ano_isolation(t):
    s = anomaly.isolation_scores(t.feat_table(), ["qty", "price"], "oid", trees=25, sample=256, contamination=0.045, seed=5)
    return out(s.select("oid", "ln", "score", "outlier"))


@query("ano_reconstruction")
def ano_reconstruction(t):
    r = anomaly.reconstruction_errors(t.feat_table(), FEATURES, 3)
    return out(r.select("oid", "ln", "error", *[f"err_{c}" for c in FEATURES]))


_Z = ", ".join(f"power(({c} - avg({c}) OVER ()) / stddev({c}) OVER (), 2) AS {c}" for c in FEATURES)


@query(
    "ano_error_ranking",
    f"WITH z AS (SELECT y, {_Z} FROM feat), r AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS e FROM z WHERE y = 1" for c in FEATURES)
    + f") SELECT feature, {rnd('e')} AS mean_error FROM r ORDER BY e DESC LIMIT 5",
)
def ano_error_ranking(t):
    from ..operators.scale import standardise

    z = standardise(t.feat().select("y", *FEATURES), FEATURES)
    errors = z.select("y", *[(F.col(c) * F.col(c)).alias(c) for c in FEATURES])
    return out(anomaly.error_ranking(errors, FEATURES, F.col("y") == 1, 5))


_FLAG = f"""WITH x AS (SELECT h, n::DOUBLE AS n FROM grid_total),
  bw AS (SELECT 0.9 * least(stddev(n), (quantile_cont(n, 0.75) - quantile_cont(n, 0.25)) / 1.34) * power(count(*), -0.2) AS hh FROM x WHERE h < {HCUT}),
  p AS (SELECT a.h, -0.5 * power((a.n - b.n) / hh, 2) AS e, hh FROM x a JOIN x b ON b.h < {HCUT}, bw),
  q AS (SELECT *, max(e) OVER (PARTITION BY h) AS m0 FROM p),
  signal2 AS (SELECT h * 3600000000 AS t, {lse('e', 'count(*)', 1, 'any_value(hh)')} AS signal FROM q GROUP BY h),
  g AS (SELECT i, 2.0::DOUBLE + i * 0.05::DOUBLE AS thr FROM (SELECT unnest(range(120)) AS i)),
  al AS (SELECT i, t FROM signal2, g WHERE signal >= thr),
  hit AS (SELECT i, pos, min(t) AS first FROM al JOIN windows ON t >= "begin" AND t < "end" GROUP BY 1, 2),
  w AS (SELECT g.i, sum(CASE WHEN first IS NULL THEN 1 ELSE 0 END)::BIGINT AS missed, sum(CASE WHEN label - first <= 0 THEN 1 ELSE 0 END)::BIGINT AS late
    FROM g CROSS JOIN windows LEFT JOIN hit ON hit.i = g.i AND hit.pos = windows.pos GROUP BY 1),
  f AS (SELECT i, count(*) AS fp FROM al WHERE NOT EXISTS (SELECT 1 FROM windows WHERE t >= "begin" AND t < "end") GROUP BY 1)
  SELECT g.i, {rnd('thr')} AS thr, coalesce(fp, 0) AS false_alarms, missed, late, CAST(coalesce(fp, 0) * 1.0 + missed * 25.0 + late * 10.0 AS DOUBLE) AS cost
  FROM g JOIN w ON g.i = w.i LEFT JOIN f ON g.i = f.i"""


def hourly_signal(t):
    """Hourly arrivals -> training density (rule-of-thumb bandwidth) -> signal per hour."""
    g = t.grid(total=True).select("key", (F.col("h") * HOUR).alias("t"), F.col("n").cast("double").alias("value"))
    past = g.where(F.col("t") < cut())
    rows = attach(g, density.bandwidth_rule(past, ["key"], "value"), ["key"])
    signal = density.kde_signal(train_points(past, ["key"]), rows, ["key"], "value", "h")
    return settle(signal.select("t", "signal"), "signal")


@query("flagship_alarm", _FLAG)
def flagship_alarm(t):
    """Cost of every threshold on the hourly density signal against the label windows."""
    grid = alarms.Grid(2.0, 0.05, 120)
    costs = alarms.sweep_windows(
        hourly_signal(t), t.windows(), "t", "signal", grid, DAY, c_alarm=1.0, c_missed=25.0, c_late=10.0
    )
    return out(costs)
