"""Decision evaluation on (instance, option, cost, predicted cost) rows.

Every loss is one aggregate with ``min_by`` per instance, combined map-side. ``order`` is
the option column; the first option wins a tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import unit_hash

BUCKETS, HEAVY, HEAVY_ROWS = 4096, 4, 1 << 16  # hash buckets of instances; times the mean and rows of a heavy one


def _at_min(value: Column, by: Column, option: str, cost: str) -> Column:
    return F.min_by(value, F.struct(by, F.col(option), F.col(cost)))


def choose(df: DataFrame, by: Sequence[str], option: str, cost: str, predicted: str) -> DataFrame:
    """Cheapest option by predicted cost, its true cost, and the best true cost."""
    return df.groupBy(*by).agg(
        _at_min(F.col(option), F.col(predicted), option, cost).alias("chosen"),
        _at_min(F.col(cost), F.col(predicted), option, cost).alias("chosen_cost"),
        F.min(cost).alias("best_cost"),
    )


def regret(df: DataFrame, by: Sequence[str], option: str, cost: str, predicted: str) -> DataFrame:
    c = choose(df, by, option, cost, predicted)
    return c.agg(F.avg(F.col("chosen_cost") - F.col("best_cost")).alias("regret"))


def relative_regret(df: DataFrame, by: Sequence[str], option: str, cost: str, predicted: str) -> DataFrame:
    """(cost with prediction - best) / |best| per instance."""
    gap = F.col("chosen_cost") - F.col("best_cost")
    c = choose(df, by, option, cost, predicted)
    return c.withColumn("relative_regret", F.try_divide(gap, F.abs("best_cost")))


def _contrast(df: DataFrame, by: Sequence[str], option: str, cost: str, surrogate: Column) -> DataFrame:
    """Mean over instances of surrogate(best true option) - min surrogate."""
    per = df.withColumn("_s", surrogate).groupBy(*by).agg(
        _at_min(F.col("_s"), F.col(cost), option, cost).alias("_at_best"), F.min("_s").alias("_low")
    )
    return per.agg(F.avg(F.col("_at_best") - F.col("_low")).alias("loss"))


def self_contrastive(df: DataFrame, by: Sequence[str], option: str, cost: str, predicted: str) -> DataFrame:
    return _contrast(df, by, option, cost, F.col(predicted))


def spo_plus(
    df: DataFrame, by: Sequence[str], option: str, cost: str, predicted: str, alpha: float = 2.0
) -> DataFrame:
    return _contrast(df, by, option, cost, alpha * F.col(predicted) - F.col(cost))


def gaussian_noise(ident: Column, seed: int, std: float) -> Column:
    """Normal draw from two hashed uniforms."""
    u = 1.0 - unit_hash(ident, seed)
    angle = unit_hash(ident, seed + 1) * 6.283185307179586
    return std * F.sqrt(-2.0 * F.log(u)) * F.cos(angle)


def _per_instance(df: DataFrame, by: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """``df.groupBy(*by).agg(*values)`` for values much wider than a row: rows are exchanged, not partial results.

    Instances in a hash bucket of over ``HEAVY`` times the mean rows keep partial results before their exchange, so
    an instance with a third of all rows doesn't end in one task.
    """
    bucket = F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int")
    sizes = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    bar = max(HEAVY * sum(r["n"] for r in sizes) / BUCKETS, HEAVY_ROWS)
    heavy = [r["b"] for r in sizes if r["n"] > bar]
    if not heavy:
        return df.repartition(*by).groupBy(*by).agg(*values)
    light = df.where(~bucket.isin(heavy)).repartition(*by).groupBy(*by).agg(*values)
    return light.unionByName(df.where(bucket.isin(heavy)).groupBy(*by).agg(*values))


def smoothed(
    df: DataFrame, by: Sequence[str], option: str, cost: str, predicted: str, ident: Column,
    draws: int, std: float, seed: int,
) -> DataFrame:
    """Regret, self-contrastive and SPO+ losses averaged over noise draws.

    A row is exchanged once, to its instance; the draws are made there and all losses of an instance are one
    aggregate, so nothing is repeated per draw or loss before the exchange.
    """
    noisy = [F.col(predicted) + gaussian_noise(ident * draws + F.lit(d), seed, std) for d in range(draws)]
    spo = [2.0 * p - F.col(cost) for p in noisy]
    at_best = F.min_by(F.array(*noisy, *spo), F.struct(F.col(cost), F.col(option), F.col(cost)))
    values = [F.min(cost).alias("_best"), at_best.alias("_at_best")]
    for d in range(draws):
        values += [
            _at_min(F.col(cost), noisy[d], option, cost).alias(f"_chosen{d}"),
            F.min(noisy[d]).alias(f"_low{d}"), F.min(spo[d]).alias(f"_spo{d}"),
        ]
    per = _per_instance(df, by, values)
    losses = F.array(*[
        F.struct(
            (F.col(f"_chosen{d}") - F.col("_best")).alias("regret"),
            (F.col("_at_best")[d] - F.col(f"_low{d}")).alias("self_contrastive"),
            (F.col("_at_best")[draws + d] - F.col(f"_spo{d}")).alias("spo_plus"),
        )
        for d in range(draws)
    ])
    names = ["regret", "self_contrastive", "spo_plus"]
    one = per.select(F.explode(losses).alias("_l")).agg(*[F.avg(f"_l.{n}").alias(n) for n in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("loss")) for n in names])).alias("_m")).select("_m.*")


def perfect_information_gap(df: DataFrame, scenario: str, option: str, cost: str) -> DataFrame:
    """Choose one option by expected cost over scenarios, compare with the best per scenario:
    mean of (expected cost - scenario best) / scenario best."""
    table = df.groupBy(scenario, option).agg(F.avg(cost).alias("_c"))
    expected = table.groupBy(option).agg(F.avg("_c").alias("_e"))
    fixed = expected.agg(F.min("_e").alias("objective"), F.min_by(option, F.struct("_e", option)).alias("option"))
    best = table.groupBy(scenario).agg(F.min("_c").alias("_best"))
    from ..functions.exprs import scalar_row

    one = scalar_row(fixed)
    rows = best.withColumn("_f", one)
    return rows.agg(
        F.first("_f.option").alias("option"), F.first("_f.objective").alias("objective"),
        F.avg((F.col("_f.objective") - F.col("_best")) / F.abs("_best")).alias("gap"),
    )
