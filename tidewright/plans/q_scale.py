"""Queries: calendar features, scaling, encoding, transforms, decomposition."""

from pyspark.sql import functions as F

from ..functions.exprs import HOUR, idiv
from ..operators import scale
from ..operators.joins import class_weights
from .bindings import FEATURES, rnd
from .q_sources import out
from .q_windows import SM, sales_positions
from .registry import query

TRAIN = "year < 1999"


@query(
    "feat_calendar",
    """SELECT event_id, month(ts) AS month, isodow(ts) - 1 AS weekday, hour(ts) AS hour, day(ts) AS day, year(ts) - 1990 AS age FROM events""",
)
def feat_calendar(t):
    e = t.events
    return e.select(
        "event_id",
        *[f("ts").cast("bigint").alias(n) for n, f in
          (("month", F.month), ("weekday", F.weekday), ("hour", F.hour), ("day", F.dayofmonth))],
        (F.year("ts") - 1990).cast("bigint").alias("age"),
    )


@query(
    "feat_dayhour",
    f"""SELECT event_id, {rnd('hour(ts) + minute(ts) / 60.0')} AS day_hour, (isodow(ts) - 1) * 24 + hour(ts) AS week_hour FROM events""",
)
def feat_dayhour(t):
    return out(t.events.select(
        "event_id", (F.hour("ts") + F.minute("ts") / 60.0).alias("day_hour"),
        (F.weekday("ts") * 24 + F.hour("ts")).cast("bigint").alias("week_hour"),
    ))


@query(
    "feat_cyclic",
    f"""SELECT zone, m, {rnd('sin(2 * pi() * (m % 12 + 1) / 12)')} AS month_sin, {rnd('cos(2 * pi() * (m % 12 + 1) / 12)')} AS month_cos,
        {rnd('(m // 12 - avg(m // 12) OVER ()) / stddev_pop(m // 12) OVER ()')} AS year_scaled FROM sales_month""",
)
def feat_cyclic(t):
    s = t.sales_month()
    c = scale.cyclic_month(s, F.col("m") % 12 + 1, idiv("m", 12))
    return out(c.select("zone", "m", "month_sin", "month_cos", "year_scaled"))


def _scaled(expr, columns, source="feat", extra=""):
    return f"SELECT oid, ln{extra}, " + ", ".join(rnd(expr.replace("{c}", c), 5) + f" AS {c}" for c in columns) + f" FROM {source}"


@query(
    "scale_standard_train",
    _scaled(f"({{c}} - (SELECT avg({{c}}) FROM feat WHERE {TRAIN})) / (SELECT stddev({{c}}) FROM feat WHERE {TRAIN})", FEATURES),
)
def scale_standard_train(t):
    f = scale.standardise(t.feat().select("oid", "ln", "year", *FEATURES), FEATURES, train=F.expr(TRAIN))
    return out(f.drop("year"), 5)


@query("scale_standard_pop", _scaled("({c} - (SELECT avg({c}) FROM feat)) / (SELECT stddev_pop({c}) FROM feat)", FEATURES))
def scale_standard_pop(t):
    return out(scale.standardise(t.feat().select("oid", "ln", *FEATURES), FEATURES, population=True), 5)


@query(
    "scale_minmax_train",
    f"""WITH r AS (SELECT min(n) AS nl, max(n) AS nh, min(v) AS vl, max(v) AS vh FROM grid WHERE h < epoch_us(TIMESTAMP '2024-01-12') // 3600000000)
        SELECT key, h, {rnd('(n - nl) / (nh - nl)')} AS n, {rnd('(v - vl) / (vh - vl)')} AS v FROM grid, r""",
)
def scale_minmax_train(t):
    cut = F.unix_micros(F.lit("2024-01-12").cast("timestamp"))
    g = scale.minmax(t.grid(), ["n", "v"], train=F.col("h") < idiv(cut, HOUR))
    return out(g.select("key", "h", "n", "v"))


@query(
    "scale_robust",
    _scaled("({c} - (SELECT quantile_cont({c}, 0.5) FROM feat)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM feat)", ["qty", "price", "total"]),
)
def scale_robust(t):
    columns = ["qty", "price", "total"]
    return out(scale.robust(t.feat_table().select("oid", "ln", *columns), columns), 5)


@query(
    "scale_by_max",
    f"""SELECT machine, cycle, {rnd('rul / (SELECT max(rul) FROM mach WHERE machine % 2 = 0)')} AS rul, {rnd('price / (SELECT max(price) FROM mach WHERE machine % 2 = 0)')} AS price FROM mach""",
)
def scale_by_max(t):
    m = scale.by_max(t.mach(), ["rul", "price"], train=F.col("machine") % 2 == 0)
    return out(m.select("machine", "cycle", "rul", "price"))


@query(
    "enc_onehot",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END::BIGINT AS status_O, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END::BIGINT AS status_P FROM orders""",
)
def enc_onehot(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return scale.onehot(o, "o_orderstatus", ["F", "O", "P"], drop_first=True, prefix="status").drop("o_orderstatus")


@query("enc_label", "SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part")
def enc_label(t):
    return scale.label_codes(t.part.select("p_partkey", "p_name"), "p_name", "code")


@query("xf_log", f"SELECT id, {rnd('ln(price)')} AS logged, {rnd('exp(ln(price))', 2)} AS back FROM sales")
def xf_log(t):
    s = t.sales().select("id", F.log("price").alias("logged"))
    return out(s.withColumn("back", F.exp("logged")), back=2)


LAMBDAS = [-0.5, 0.0, 0.25, 0.5, 0.75, 1.0, 1.5]


def _bc(lam):
    return "ln(price)" if lam == 0 else f"((power(price, {lam}) - 1) / {lam})"


_LL = " UNION ALL ".join(
    f"SELECT {lam}::DOUBLE AS lam, -count(*) / 2.0 * ln(var_pop({_bc(lam)})) + ({lam} - 1) * sum(ln(price)) AS loglik FROM sales" for lam in LAMBDAS
)


@query("xf_boxcox_fit", f"SELECT lam, {rnd('loglik', 3)} AS loglik FROM ({_LL})")
def xf_boxcox_fit(t):
    return out(scale.boxcox_fit(t.sales(), "price", LAMBDAS), 3)


@query(
    "xf_boxcox",
    f"""WITH b AS (SELECT lam FROM ({_LL}) ORDER BY loglik DESC, lam DESC LIMIT 1),
        x AS (SELECT id, CASE WHEN lam = 0 THEN ln(price) ELSE (power(price, lam) - 1) / lam END AS z FROM sales, b)
        SELECT id, {rnd('(z - avg(z) OVER ()) / stddev_pop(z) OVER ()')} AS z FROM x""",
)
def xf_boxcox(t):
    return out(scale.boxcox_transform(t.sales().select("id", "price"), "price", LAMBDAS, "z").select("id", "z"))


@query(
    "wt_inverse_freq",
    f"""WITH m AS (SELECT machine, cycle, rul < 25 AS failing FROM mach) SELECT machine, cycle, failing,
        {rnd('1.0 / count(*) OVER (PARTITION BY machine, failing)', 9)} AS weight FROM m""",
)
def wt_inverse_freq(t):
    m = t.mach().select("machine", "cycle", (F.col("rul") < 25).alias("failing"))
    return out(class_weights(m, ["machine", "failing"]), 9)


def _decompose(mult):
    off = "price / trend" if mult else "price - trend"
    norm = "raw / avg(raw) OVER (PARTITION BY zone)" if mult else "raw - avg(raw) OVER (PARTITION BY zone)"
    res = "price / (trend * seasonal)" if mult else "price - trend - seasonal"
    d = 6 if mult else 3
    return f"""WITH {SM}, tr AS (SELECT *, CASE WHEN count(price) OVER w = 13 THEN (sum(price) OVER w - (lag(price, 6) OVER o + lead(price, 6) OVER o) / 2) / 12 END AS trend
        FROM sm WINDOW w AS (PARTITION BY zone ORDER BY m ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING), o AS (PARTITION BY zone ORDER BY m)),
      s AS (SELECT z, ph, {norm.replace('zone', 'z')} AS seasonal FROM (SELECT zone AS z, m % 12 AS ph, avg({off}) AS raw FROM tr GROUP BY 1, 2))
      SELECT zone, m, {rnd('trend', 3)} AS trend, {rnd('seasonal', d)} AS seasonal, {rnd(res, d)} AS residual FROM tr JOIN s ON zone = z AND m % 12 = ph"""


@query("ts_decompose", _decompose(False))
def ts_decompose(t):
    d = scale.decompose(sales_positions(t), ["zone"], "pos", "price", 12, F.col("m") % 12)
    return out(d.select("zone", "m", "trend", "seasonal", "residual"), 3)


@query("ts_decompose_mult", _decompose(True))
def ts_decompose_mult(t):
    d = scale.decompose(sales_positions(t), ["zone"], "pos", "price", 12, F.col("m") % 12, multiplicative=True)
    return out(d.select("zone", "m", "trend", "seasonal", "residual"), 6, trend=3)
