"""Queries: survival, splits, decisions, set operations."""

from pyspark.sql import functions as F

from ..functions.exprs import hash31, idiv
from ..operators import decisions, splits, survival
from ..operators.windows import ewm_mean
from ..session import released, settle
from .bindings import FEATURES, SENSORS, h31, rnd
from .q_sources import out
from .registry import query

U = "({h} / 2147483648.0)"


def unit(expr, seed):
    return f"({h31(expr, seed)} / 2147483648.0)"


@query(
    "surv_censor",
    f"SELECT machine, cycle, rul FROM mach WHERE cycle <= floor(ftime * (0.2 + 0.8 * {unit('machine', 21)})::DOUBLE)",
)
def surv_censor(t):
    return survival.censor(t.mach(), "machine", "cycle", "ftime", 21, 0.2).select("machine", "cycle", "rul")


@query(
    "surv_cutoff_mask",
    f"SELECT machine, cycle, CAST(-1 AS BIGINT) AS rul FROM mach WHERE cycle <= ftime - (10 + {h31('machine', 22)} % 40)",
)
def surv_cutoff_mask(t):
    m = survival.cutoff_mask(t.mach(), "machine", "cycle", "ftime", 10, 50, 22)
    return m.select("machine", "cycle", "rul")


@query("surv_hazard_model")
def surv_hazard_model(t):
    """Weighted fit, then the hazard of every row from the fitted coefficients."""
    m = t.mach().withColumns({
        "label": (F.col("rul") < 10).cast("double"), "age": F.col("cycle") / 100.0,
        "kprice": F.col("price") / 10000.0,
    })
    m = m.withColumn("weight", F.when(F.col("label") == 1, 20.0).otherwise(1.0))
    columns = ["age", "qty", "kprice", "disc", "tax"]
    with released(t.spark):
        m = settle(m.select("machine", "cycle", *columns, "label", "weight"), "mach")
    intercept, weights = survival.hazard_model(m, columns, "label", "weight")
    return out(m.select("machine", "cycle", survival.logistic(intercept, weights).alias("hazard")))


@query(
    "surv_empirical_hazard",
    f"""WITH b AS (SELECT (f - 1) // 10 AS bin, count(*) AS failures FROM (SELECT l_suppkey, count(*) AS f FROM lineitem GROUP BY 1) GROUP BY 1),
        r AS (SELECT *, sum(failures) OVER (ORDER BY bin DESC)::BIGINT AS at_risk FROM b)
        SELECT bin, failures, at_risk, {rnd('failures / at_risk')} AS hazard,
          {rnd('CASE WHEN failures = at_risk THEN 0 ELSE exp(sum(CASE WHEN failures < at_risk THEN ln(1 - failures / at_risk) ELSE 0 END) OVER (ORDER BY bin)) END')} AS survival FROM r""",
)
def surv_empirical_hazard(t):
    runs = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("f"))
    return out(survival.empirical_hazard(runs, "f", 10))


W = {"cycle": 0.004, "qty": 0.01, "disc": 2.0}
B = -6.0
_HZ = "(1 / (1 + exp(-(-6.0 + 0.004 * (cycle + {h}) + 0.01 * qty + 2.0 * disc))))"


def _surv(h):
    return " * ".join(f"(1 - {_HZ.replace('{h}', str(i))})" for i in range(h + 1))


@query("surv_lookahead", "SELECT machine, cycle, " + ", ".join(rnd(_surv(h)) + f" AS s_{h}" for h in range(6)) + " FROM mach")
def surv_lookahead(t):
    s = survival.lookahead(t.mach(), 5, "cycle", B, W)
    return out(s.select("machine", "cycle", *[f"s_{h}" for h in range(6)]))


@query(
    "surv_counterfactual",
    f"""WITH r AS (SELECT avg(qty) AS qty, avg(disc) AS disc FROM mach), v AS (SELECT unnest(range(0, 1000, 50))::DOUBLE AS cycle)
        SELECT cycle, {rnd(_HZ.replace('{h}', '0'), 8)} AS hazard FROM r, v""",
)
def surv_counterfactual(t):
    ref = t.lineitem.agg(F.avg("l_quantity").alias("qty"), F.avg("l_discount").alias("disc")).withColumn("cycle", F.lit(0.0))
    cf = survival.counterfactual(ref, "cycle", list(range(0, 1000, 50)), survival.logistic(B, W), "hazard")
    return out(cf.select("cycle", "hazard"), 8)


@query(
    "surv_rolling_smooth",
    f"""WITH s AS (SELECT machine, cycle, {_surv(5)} AS x FROM mach)
        SELECT a.machine, a.cycle, {rnd('sum(b.x * power(0.8, a.cycle - b.cycle)) / sum(power(0.8, a.cycle - b.cycle))')} AS smooth
        FROM s a JOIN s b ON a.machine = b.machine AND b.cycle <= a.cycle GROUP BY 1, 2""",
)
def surv_rolling_smooth(t):
    s = survival.lookahead(t.mach(), 5, "cycle", B, W).select("machine", "cycle", "s_5")
    return out(ewm_mean(s, ["machine"], "cycle", "s_5", 0.2, "smooth").select("machine", "cycle", "smooth"))


_RID = "oid * 8 + ln"


@query(
    "spl_random",
    f"""SELECT oid, ln, CASE WHEN {unit(_RID, 31)} < 0.7 THEN 'train' WHEN {unit(_RID, 31)} < 0.85 THEN 'val' ELSE 'test' END AS part FROM feat""",
)
def spl_random(t):
    f = t.feat().select("oid", "ln")
    return splits.random_split(f, F.expr(_RID), {"train": 0.7, "val": 0.15, "test": 0.15}, 31)


@query("spl_by_group", f"SELECT machine, cycle, CASE WHEN {unit('machine', 32)} < 0.75 THEN 'train' ELSE 'test' END AS part FROM mach")
def spl_by_group(t):
    return splits.group_split(t.mach().select("machine", "cycle"), "machine", 0.75, 32)


@query(
    "spl_stratified",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {h31('o_orderkey', 33)}, o_orderkey)
        <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM orders""",
)
def spl_stratified(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return splits.stratified_split(o, "o_orderstatus", "o_orderkey", 0.2, 33)


@query("spl_kfold", f"SELECT oid, ln, {h31(_RID, 34)} % 5 AS fold FROM feat")
def spl_kfold(t):
    return splits.kfold(t.feat().select("oid", "ln"), F.expr(_RID), 5, 34)


@query(
    "spl_bootstrap",
    " UNION ALL ".join(f"SELECT o_orderkey, CAST({i} AS BIGINT) AS sample FROM orders WHERE {unit('o_orderkey', 35 + i)} < 0.8" for i in range(4)),
)
def spl_bootstrap(t):
    return splits.repeated_samples(t.orders.select("o_orderkey"), "o_orderkey", 4, 0.8, 35)


@query("smp_normal_only", "SELECT oid, ln, qty, price FROM feat WHERE y = 0")
def smp_normal_only(t):
    return splits.normal_only(t.feat(), "y").select("oid", "ln", "qty", "price")


@query(
    "smp_mask_random",
    f"""WITH r AS (SELECT h, v, CASE WHEN v IS NOT NULL THEN row_number() OVER (PARTITION BY v IS NULL ORDER BY {h31('h', 36)}, h) END AS k FROM grid_total)
        SELECT h, {rnd('v')} AS truth, {rnd('CASE WHEN k > 60 THEN v END')} AS masked FROM r""",
)
def smp_mask_random(t):
    g = t.grid(total=True).select("h", F.col("v").alias("truth"))
    return out(splits.mask_n(g, "truth", "h", 60, 36, "masked"))


# Options of an order are its lines: true cost = extended price, predicted = noisy.
_OPT = f"""op AS (SELECT l_orderkey AS oid, CAST(l_linenumber AS BIGINT) AS ln, l_extendedprice / 1000.0 AS c,
  l_extendedprice / 1000.0 * 0.9 + ({h31('l_orderkey * 64 + l_linenumber * 8 + l_suppkey', 41)} % 1000) / 40.0 AS ch FROM lineitem)"""


def options(t):
    noise = F.pmod(hash31(F.expr("l_orderkey * 64 + l_linenumber * 8 + l_suppkey"), 41), F.lit(1000)) / 40.0
    cost = F.col("l_extendedprice") / 1000.0
    return t.lineitem.select(
        F.col("l_orderkey").alias("oid"), F.col("l_linenumber").cast("bigint").alias("ln"),
        cost.alias("c"), (cost * 0.9 + noise).alias("ch"),
    )


_CH = f"{_OPT}, ch AS (SELECT oid, min_by(ln, (ch, ln, c)) AS chosen, min_by(c, (ch, ln, c)) AS chosen_cost, min(c) AS best_cost FROM op GROUP BY 1)"


@query("dec_argmin", f"WITH {_CH} SELECT oid, chosen, {rnd('chosen_cost')} AS chosen_cost FROM ch")
def dec_argmin(t):
    return out(decisions.choose(options(t), ["oid"], "ln", "c", "ch").drop("best_cost"))


@query("dec_regret", f"WITH {_CH} SELECT {rnd('avg(chosen_cost - best_cost)')} AS regret FROM ch")
def dec_regret(t):
    return out(decisions.regret(options(t), ["oid"], "ln", "c", "ch"))


@query("dec_self_contrastive", f"WITH {_OPT} SELECT {rnd('avg(a - b)')} AS loss FROM (SELECT oid, min_by(ch, (c, ln, c)) AS a, min(ch) AS b FROM op GROUP BY 1)")
def dec_self_contrastive(t):
    return out(decisions.self_contrastive(options(t), ["oid"], "ln", "c", "ch"))


@query("dec_spo_plus", f"WITH {_OPT} SELECT {rnd('avg(a - b)')} AS loss FROM (SELECT oid, min_by(2 * ch - c, (c, ln, c)) AS a, min(2 * ch - c) AS b FROM op GROUP BY 1)")
def dec_spo_plus(t):
    return out(decisions.spo_plus(options(t), ["oid"], "ln", "c", "ch"))


@query("dec_relative_regret", f"WITH {_CH} SELECT oid, {rnd('(chosen_cost - best_cost) / abs(best_cost)')} AS relative_regret FROM ch")
def dec_relative_regret(t):
    return out(decisions.relative_regret(options(t), ["oid"], "ln", "c", "ch").select("oid", "relative_regret"))


_DRAWS = f"""{_OPT}, d AS (SELECT oid, ln, c, draw, ch + 2.0::DOUBLE * sqrt(-2.0 * ln(1.0 - {unit('(oid * 8 + ln) * 8 + draw', 42)})) * cos({unit('(oid * 8 + ln) * 8 + draw', 43)} * 2 * pi()) AS ch
  FROM (SELECT *, unnest(range(8)) AS draw FROM op)),
  x AS (SELECT oid, draw, min_by(c, (ch, ln, c)) - min(c) AS regret, min_by(ch, (c, ln, c)) - min(ch) AS sc, min_by(2 * ch - c, (c, ln, c)) - min(2 * ch - c) AS spo FROM d GROUP BY 1, 2)"""


@query(
    "dec_smoothed",
    f"""WITH {_DRAWS} SELECT 'regret' AS metric, {rnd('avg(regret)')} AS loss FROM x
        UNION ALL SELECT 'self_contrastive', {rnd('avg(sc)')} FROM x UNION ALL SELECT 'spo_plus', {rnd('avg(spo)')} FROM x""",
)
def dec_smoothed(t):
    return out(decisions.smoothed(options(t), ["oid"], "ln", "c", "ch", F.expr("oid * 8 + ln"), 8, 2.0, 42))


@query(
    "dec_perfect_info_gap",
    f"""WITH tb AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) - 1 AS sc, l_returnflag AS opt, avg(l_extendedprice) AS c FROM lineitem GROUP BY 1, 2),
        e AS (SELECT opt, avg(c) AS e FROM tb GROUP BY 1), f AS (SELECT opt AS option, e AS objective FROM e ORDER BY e, opt LIMIT 1),
        b AS (SELECT sc, min(c) AS best FROM tb GROUP BY 1)
        SELECT option, {rnd('objective', 3)} AS objective, {rnd('avg((objective - best) / abs(best))')} AS gap FROM b, f GROUP BY option, objective""",
)
def dec_perfect_info_gap(t):
    scenario = (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).alias("scenario")
    line = t.lineitem.select(scenario, F.col("l_returnflag").alias("opt"), F.col("l_extendedprice").alias("c"))
    return out(decisions.perfect_information_gap(line, "scenario", "opt", "c"), objective=3)


@query("set_union_all", "SELECT l_returnflag AS part, l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem")
def set_union_all(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("part"), "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    back = F.coalesce(F.col("part") == "R", F.lit(False))
    return rows.where(back).unionByName(rows.where(~back))


@query("set_except", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_quantity > 25")
def set_except(t):
    big = t.lineitem.where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey").join(big, "o_orderkey", "left_anti").distinct()


@query(
    "set_union_distinct",
    "SELECT c_custkey AS id FROM customer WHERE c_acctbal > 5000 UNION SELECT o_custkey FROM orders WHERE o_totalprice > 400000",
)
def set_union_distinct(t):
    rich = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("id"))
    return rich.union(t.orders.where("o_totalprice > 400000").select("o_custkey")).distinct()
