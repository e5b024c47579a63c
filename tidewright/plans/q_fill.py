"""Queries: missing values."""

from pyspark.sql import functions as F

from ..functions.exprs import attach, gauss_logpdf, unit_hash
from ..operators import fill
from ..session import settle
from .bindings import FEATURES, h31, rnd
from .q_sources import out
from .registry import query

_NB = """n AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY key ORDER BY pos) AS pp,
   min(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
   FROM {src}),
 nb AS (SELECT n.*, p.v AS pv, q.v AS nv FROM n LEFT JOIN {src} p ON p.key = n.key AND p.pos = n.pp
   LEFT JOIN {src} q ON q.key = n.key AND q.pos = n.np)"""
_LINEAR = "CASE WHEN v IS NOT NULL THEN v WHEN np IS NULL THEN pv ELSE pv + (nv - pv) / nullif(np - pp, 0) * (pos - pp) END"
_NEAREST = "CASE WHEN v IS NOT NULL THEN v WHEN np IS NULL OR pp IS NULL THEN NULL WHEN pos - pp <= np - pos THEN pv ELSE nv END"
GP = dict(
    amplitude=400.0, length=3.0, period=24.0, period_length=1.0,
    period_amplitude=100.0, noise=900.0,
)


def week():
    return F.expr("(pos - 1) div 168").alias("week")


def neighbours_sql(src="grid_masked"):
    return _NB.replace("{src}", src)


@query("fill_forward", f"WITH {neighbours_sql()} SELECT key, h, {rnd('coalesce(v, pv)')} AS v_forward FROM nb")
def fill_forward(t):
    f = fill.fill_neighbours(t.grid(masked=True), ["key"], "pos", "v", ["forward"])
    return out(f.select("key", "h", "v_forward"))


@query("fill_backward", f"WITH {neighbours_sql()} SELECT key, h, {rnd('coalesce(v, nv)')} AS v_backward FROM nb")
def fill_backward(t):
    f = fill.fill_neighbours(t.grid(masked=True), ["key"], "pos", "v", ["backward"])
    return out(f.select("key", "h", "v_backward"))


@query("fill_linear", f"WITH {neighbours_sql()} SELECT key, h, {rnd(_LINEAR)} AS v_linear FROM nb")
def fill_linear(t):
    f = fill.fill_neighbours(t.grid(masked=True), ["key"], "pos", "v", ["linear"])
    return out(f.select("key", "h", "v_linear"))


@query(
    "fill_time",
    f"""WITH m AS (SELECT key, event_id, t, pos, value AS v FROM ser_pos_masked), {neighbours_sql('m')},
        tt AS (SELECT nb.*, a.t AS pt, b.t AS nt FROM nb LEFT JOIN m a ON a.key = nb.key AND a.pos = nb.pp LEFT JOIN m b ON b.key = nb.key AND b.pos = nb.np)
        SELECT key, event_id, {rnd('CASE WHEN v IS NOT NULL THEN v WHEN np IS NULL THEN pv ELSE pv + (nv - pv) / nullif(nt - pt, 0) * (t - pt) END')} AS value_time FROM tt""",
)
def fill_time(t):
    f = fill.fill_neighbours(t.ser_pos(masked=True), ["key"], "pos", "value", ["time"], axis="t")
    return out(f.select("key", "event_id", "value_time"))


@query("fill_nearest", f"WITH {neighbours_sql()} SELECT key, h, {rnd(_NEAREST)} AS v_nearest FROM nb")
def fill_nearest(t):
    f = fill.fill_neighbours(t.grid(masked=True), ["key"], "pos", "v", ["nearest"])
    return out(f.select("key", "h", "v_nearest"))


_THIRD_P = "CASE WHEN a.bp IS NOT NULL AND (b.ap IS NULL OR n.pos - a.bp <= b.ap - n.pos) THEN a.bp ELSE b.ap END"
_THIRD_V = _THIRD_P.replace("THEN a.bp ELSE b.ap", "THEN a.bv ELSE b.av")
_QUAD = (
    "CASE WHEN v IS NOT NULL THEN v WHEN x1 IS NULL OR x2 IS NULL THEN NULL "
    "WHEN x3 IS NULL THEN y1 + (y2 - y1) * (x - x1) / (x2 - x1) "
    "ELSE y1 * (x - x2) * (x - x3) / ((x1 - x2) * (x1 - x3)) + y2 * (x - x1) * (x - x3) / ((x2 - x1) * (x2 - x3)) "
    "+ y3 * (x - x1) * (x - x2) / ((x3 - x1) * (x3 - x2)) END"
)


@query(
    "fill_polynomial",
    f"""WITH {neighbours_sql()}, vr AS (SELECT key, pos, v, lag(pos) OVER w AS bp, lag(v) OVER w AS bv, lead(pos) OVER w AS ap, lead(v) OVER w AS av
          FROM grid_masked WHERE v IS NOT NULL WINDOW w AS (PARTITION BY key ORDER BY pos)),
        j AS (SELECT n.key, n.h, n.v, n.pos::DOUBLE AS x, n.pp::DOUBLE AS x1, n.pv AS y1, n.np::DOUBLE AS x2, n.nv AS y2, ({_THIRD_P})::DOUBLE AS x3, {_THIRD_V} AS y3
          FROM nb n LEFT JOIN vr a ON a.key = n.key AND a.pos = n.pp LEFT JOIN vr b ON b.key = n.key AND b.pos = n.np)
        SELECT key, h, {rnd(_QUAD)} AS v_quad FROM j""",
)
def fill_polynomial(t):
    return out(fill.fill_quadratic(t.grid(masked=True), ["key"], "pos", "v", "v_quad").select("key", "h", "v_quad"))


@query(
    "fill_column_stat",
    f"""SELECT oid, ln, {rnd('coalesce(qty, (SELECT avg(qty) FROM feat_masked))', 5)} AS qty,
        {rnd('coalesce(price, (SELECT quantile_cont(price, 0.5) FROM feat_masked))', 3)} AS price FROM feat_masked""",
)
def fill_column_stat(t):
    f = fill.fill_column_stat(t.feat_table(masked=True).select("oid", "ln", "qty", "price"), ["qty"], ["price"])
    return out(f, 5, price=3)


@query(
    "fill_key_forward_median",
    f"""WITH {neighbours_sql()} SELECT key, h, {rnd('coalesce(v, pv, (SELECT quantile_cont(v, 0.5) FROM grid_masked))')} AS filled FROM nb""",
)
def fill_key_forward_median(t):
    f = fill.fill_forward_then_median(t.grid(masked=True), ["key"], "pos", "v", "filled")
    return out(f.select("key", "h", "filled"))


@query(
    "fill_knn",
    """WITH s AS (SELECT stddev_pop(disc) AS sd, stddev_pop(tax) AS st, stddev_pop(psize) AS sp FROM feat),
       b AS (SELECT oid, ln, qty, disc, tax, psize FROM feat_masked),
       d AS (SELECT disc, tax, psize, count(*) AS n, sum(qty) AS total FROM b WHERE qty IS NOT NULL GROUP BY 1, 2, 3),
       q AS (SELECT DISTINCT disc, tax, psize FROM b WHERE qty IS NULL),
       p AS (SELECT q.disc, q.tax, q.psize, round(power((q.disc - d.disc) / sd, 2) + power((q.tax - d.tax) / st, 2) + power((q.psize - d.psize) / sp, 2), 9) AS dist, n, total FROM q, d, s),
       l AS (SELECT disc, tax, psize, dist, sum(n) AS n, sum(total) AS total FROM p GROUP BY 1, 2, 3, 4),
       u AS (SELECT *, least(n, 5 - coalesce(sum(n) OVER (PARTITION BY disc, tax, psize ORDER BY dist ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS k FROM l),
       e AS (SELECT disc, tax, psize, sum(k * total / n) / sum(k) AS est FROM u WHERE k > 0 GROUP BY 1, 2, 3)
       SELECT oid, ln, coalesce(qty, CASE WHEN est IS NOT NULL THEN greatest(0, round_even(est, 0)) END) AS filled FROM b LEFT JOIN e USING (disc, tax, psize)""",
)
def fill_knn(t):
    f = t.feat_table(masked=True).select("oid", "ln", "qty", "disc", "tax", "psize")
    return fill.fill_knn(f, "qty", ["disc", "tax", "psize"], 5, "filled").select("oid", "ln", "filled")


def _knn_sql(target: str, others: list[str], k: int) -> str:
    """CTEs up to ``e_{target}``: the estimate per distinct pair of other columns, over those both rows have."""
    a, b = others
    both = f"((q.{a} - d.{a}) IS NOT NULL)::INT + ((q.{b} - d.{b}) IS NOT NULL)::INT"
    return f"""b_{target} AS (SELECT {target} AS y, round({a} / (SELECT stddev_pop({a}) FROM x), 12) AS {a}, round({b} / (SELECT stddev_pop({b}) FROM x), 12) AS {b} FROM x),
        d_{target} AS (SELECT {a}, {b}, count(*) AS n, sum(y) AS total FROM b_{target} WHERE y IS NOT NULL GROUP BY 1, 2),
        q_{target} AS (SELECT {a}, {b}, row_number() OVER () AS id FROM (SELECT DISTINCT {a}, {b} FROM b_{target} WHERE y IS NULL)),
        l_{target} AS (SELECT id, round((coalesce(power(q.{a} - d.{a}, 2), 0) + coalesce(power(q.{b} - d.{b}, 2), 0)) * 2.0::DOUBLE / ({both}), 9) AS dist,
            sum(n) AS n, sum(total) AS total FROM q_{target} q JOIN d_{target} d ON {both} > 0 GROUP BY 1, 2),
        u_{target} AS (SELECT *, least(n, {k} - coalesce(sum(n) OVER (PARTITION BY id ORDER BY dist ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS k FROM l_{target}),
        e_{target} AS (SELECT {a}, {b}, est FROM (SELECT id, sum(k * total / n) / sum(k) AS est FROM u_{target} WHERE k > 0 GROUP BY 1) JOIN q_{target} USING (id))"""


_KNN = ["qty", "disc", "psize"]
_PLACE = "(oid * 7 + ln)"


def _knn_value(c: str) -> str:
    a, b = [o for o in _KNN if o != c]
    same = " AND ".join(f"e.{o} IS NOT DISTINCT FROM round(x.{o} / (SELECT stddev_pop({o}) FROM x), 12)" for o in (a, b))
    return rnd(f"coalesce(x.{c}, (SELECT est FROM e_{c} e WHERE {same}), (SELECT avg({c}) FROM x)) + 1e-9", 5) + f" AS {c}"


@query(
    "fill_knn_all",
    f"""WITH x AS (SELECT oid, ln, CASE WHEN {_PLACE} % 10 <> 3 THEN qty END AS qty, CASE WHEN {_PLACE} % 11 <> 5 THEN disc END AS disc,
          CASE WHEN {_PLACE} % 13 <> 7 THEN psize END AS psize FROM feat),
        {", ".join(_knn_sql(c, [o for o in _KNN if o != c], 5) for c in _KNN)}
        SELECT oid, ln, {", ".join(map(_knn_value, _KNN))} FROM x""",
)
def fill_knn_all(t):
    """Values are missing in all columns, coordinates too."""
    place = F.col("oid") * 7 + F.col("ln")
    f = t.feat().select("oid", "ln", *[F.when(place % m != r, F.col(c)).alias(c) for c, m, r in zip(_KNN, (10, 11, 13), (3, 5, 7))])
    f = fill.fill_knn_all(settle(f, "feat"), _KNN, 5)
    # Shares of tied donors are short fractions: the nudge keeps their exact halves off the rounding edge in both engines.
    return out(f.select("oid", "ln", *[(F.col(f"{c}_filled") + 1e-9).alias(c) for c in _KNN]), 5)


@query("fill_regression")
def fill_regression(t):
    f = t.feat_table(masked=True)
    r = fill.fill_regression(f, "price", ["disc", "tax", "psize", "retail", "total"], 3, "filled")
    return out(r.select("oid", "ln", "filled"), 4)


@query("fill_gp_fixed")
def fill_gp_fixed(t):
    """Each week of a key is a series of its own."""
    g = t.grid(masked=True).select("key", "h", "pos", "v", week())
    return out(fill.gp_posterior(g, ["key", "week"], "pos", "v", **GP).select("key", "h", "gp_mean", "gp_std"))


@query("fill_scaled_by_slot")
def fill_scaled_by_slot(t):
    g = t.grid(masked=True).select("key", "h", "pos", "v", week()).withColumn("slot", F.col("h") % 24)
    unit = dict(GP, amplitude=0.5, period_amplitude=0.2, noise=1.0)
    return out(fill.fill_scaled_by_slot(g, ["key", "week"], "pos", "v", "slot", "filled", unit).select("key", "h", "filled"))


_MASKED = f"mk AS (SELECT key, h, pos, v AS truth, CASE WHEN {h31('h', 5)} / 2147483648.0 >= 0.2 THEN v END AS v FROM grid)"


@query(
    "fill_mask_eval",
    f"WITH {_MASKED}, {neighbours_sql('mk')}, "
    f"x AS (SELECT truth, coalesce(v, pv) AS forward, coalesce(v, nv) AS backward, {_LINEAR} AS linear, {_NEAREST} AS nearest FROM nb WHERE v IS NULL AND truth IS NOT NULL) "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS method, count({m}) AS n, {rnd(f'sqrt(avg(({m} - truth)^2))')} AS rmse FROM x"
        for m in ("forward", "backward", "linear", "nearest")
    ),
)
def fill_mask_eval(t):
    methods = ["forward", "backward", "linear", "nearest"]
    g = t.grid().withColumnRenamed("v", "truth").withColumn("v", F.when(unit_hash("h", 5) >= 0.2, F.col("truth")))
    f = fill.fill_neighbours(g, ["key"], "pos", "v", methods).where("v IS NULL AND truth IS NOT NULL")
    long = f.select(
        "truth",
        F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"v_{m}").alias("x")) for m in methods])).alias("_r"),
    ).select("truth", "_r.*")
    err = F.col("x") - F.col("truth")
    return out(long.groupBy("method").agg(F.count("x").alias("n"), F.sqrt(F.avg(err * err)).alias("rmse")))


@query(
    "eval_gauss_loglik",
    f"""WITH s AS (SELECT grp AS g2, stddev(actual - pred) AS sd FROM scored GROUP BY 1)
        SELECT grp, count(*) AS n, {rnd('sum(-0.5 * power((actual - pred) / sd, 2) - ln(sd) - 0.5 * ln(2 * pi()))', 4)} AS loglik
        FROM scored JOIN s ON grp = g2 GROUP BY 1""",
)
def eval_gauss_loglik(t):
    s = t.scored()
    sd = s.groupBy("grp").agg(F.stddev(F.col("actual") - F.col("pred")).alias("sd"))
    ll = attach(s, sd, ["grp"]).groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum(gauss_logpdf("actual", "pred", "sd")).alias("loglik")
    )
    return out(ll, 4)
