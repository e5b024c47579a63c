"""Feature relevance. Linear methods work on one Gram matrix (one aggregate pass); rankings
and importances have one row per feature."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash31, idiv, scalar_row
from ..session import collected, settled
from .alarms import roc_aucs
from .gram import cross_products
from .ordered import positions
from .quantiles import melt


def variance_scores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.var_pop(c).alias(c) for c in columns])
    return melt(one, [], columns).withColumnRenamed("value", "score")


def variance_select(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    return variance_scores(df, columns).where(F.col("score") > threshold)


def univariate_scores(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """F statistic of the one-variable linear fit: r2 / (1 - r2) * (n - 2)."""
    one = df.agg(F.count(F.lit(1)).cast("double").alias("_n"), *[F.corr(c, target).alias(c) for c in columns])
    long = melt(one, ["_n"], columns)
    r2 = F.col("value") * F.col("value")
    return long.select("feature", (F.try_divide(r2, 1 - r2) * (F.col("_n") - 2)).alias("score"))


def top_features(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.col("score").desc(), "feature").limit(k)


def gram(df: DataFrame, columns: Sequence[str], target: str) -> tuple[np.ndarray, np.ndarray, float, int]:
    """X'X, X'y, y'y and n (X with a leading 1) of the complete rows, from products by partition."""
    p = cross_products(df, [*columns, target], complete=True)
    n, mean = int(p.both[0, 0]), p.mean
    raw = p.products + n * np.outer(mean, mean)
    x = np.zeros((len(columns) + 1, len(columns) + 1))
    x[0, 0], x[0, 1:], x[1:, 0], x[1:, 1:] = n, n * mean[:-1], n * mean[:-1], raw[:-1, :-1]
    return x, np.r_[n * mean[-1], raw[:-1, -1]], float(raw[-1, -1]), n


def solve(x: np.ndarray, xy: np.ndarray, keep: Sequence[int], ridge: float = 1e-9) -> np.ndarray:
    """Least squares on the intercept and the kept features (indices from 1)."""
    idx = [0, *keep]
    a = x[np.ix_(idx, idx)]
    scale = np.trace(a) / len(idx)
    return np.linalg.lstsq(a + ridge * scale * np.eye(len(idx)) * (np.arange(len(idx)) > 0), xy[idx], rcond=None)[0]


def zscored(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    from .scale import standardise

    return standardise(df, columns)


def rfe(df: DataFrame, columns: Sequence[str], target: str, keep: int) -> DataFrame:
    """Recursive elimination on standardised features: drop the weakest, refit on the same
    Gram matrix. rank 1 marks the kept features."""
    x, xy, _, _ = gram(zscored(df, columns), columns, target)
    left = list(range(1, len(columns) + 1))
    rank: dict[int, int] = {}
    while len(left) > keep:
        b = solve(x, xy, left)[1:]
        weak = left[int(np.argmin(np.abs(b)))]
        rank[weak] = len(left) - keep + 1
        left.remove(weak)
    rows = [(columns[i - 1], int(rank.get(i, 1))) for i in range(1, len(columns) + 1)]
    return df.sparkSession.createDataFrame(rows, "feature string, rank bigint")


def subset_search(
    train: DataFrame, test: DataFrame, columns: Sequence[str], target: str, largest: int | None = None
) -> DataFrame:
    """Test RMSE of every feature subset. Train and test are one Gram matrix each; the small
    systems are solved where Spark puts the subsets."""
    x, xy, _, _ = gram(train, columns, target)
    tx, txy, tyy, tn = gram(test, columns, target)
    names = list(columns)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for subset in pdf["subset"]:
                keep = [int(i) for i in subset]
                b = solve(x, xy, keep)
                idx = [0, *keep]
                sse = tyy - 2 * b @ txy[idx] + b @ tx[np.ix_(idx, idx)] @ b
                rows.append((",".join(names[i - 1] for i in keep), len(keep), float(np.sqrt(max(sse, 0.0) / max(tn, 1)))))
            yield pd.DataFrame(rows, columns=["features", "size", "rmse"])

    spark = train.sparkSession
    d = len(columns)
    masks = spark.range(1, 2**d)
    bits = F.array_compact(F.array(*[
        F.when(F.col("id").bitwiseAND(1 << i) != 0, F.lit(i + 1))
        for i in range(d)
    ]))
    subsets = masks.select(bits.alias("subset"))
    if largest:
        subsets = subsets.where(F.size("subset") <= largest)
    return subsets.mapInPandas(evaluate, "features string, size bigint, rmse double")


def _coefficients(names: Sequence[str], values: Sequence[float], df: DataFrame) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def lasso(df: DataFrame, columns: Sequence[str], target: str, reg: float, binary: bool = False) -> DataFrame:
    """Non-zero L1 coefficients on standardised features; the largest one if all are zero."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import LinearRegression

    x = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(df.na.drop(subset=[*columns, target]))
    kind = LogisticRegression if binary else LinearRegression
    fit = kind(featuresCol="_x", labelCol=target, elasticNetParam=1.0, regParam=reg, maxIter=100).fit(x)
    scores = _coefficients(columns, fit.coefficients.toArray(), df)
    ranked = scores.withColumn("_top", F.max(F.abs("score")).over(Window.partitionBy()))
    none = F.col("_top") == 0
    first = F.row_number().over(Window.orderBy(F.abs("score").desc(), "feature")) == 1
    return ranked.withColumn("_first", first).where((F.col("score") != 0) | (none & F.col("_first"))).drop("_top", "_first")


def forest_importance(
    df: DataFrame, columns: Sequence[str], target: str, trees: int, depth: int, seed: int
) -> DataFrame:
    from pyspark.ml.regression import RandomForestRegressor

    x = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(df.na.drop(subset=[*columns, target]))
    fit = RandomForestRegressor(
        featuresCol="_x", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed
    ).fit(x)
    return _coefficients(columns, fit.featureImportances.toArray(), df)


def tree_select(scores: DataFrame, share: float = 0.5) -> DataFrame:
    """Features whose importance reaches the given quantile of all importances."""
    cut = scalar_row(scores.agg(F.expr(f"percentile(score, {share})").alias("q")))["q"]
    return scores.where(F.col("score") >= cut)


def permuted(df: DataFrame, ident: str, columns: Sequence[str], seed: int, prefix: str = "p_") -> DataFrame:
    """Each row with the columns of another row: rows at position p in the order of one hash
    take the values of position p in the order of another. Hash cells bound every task."""
    def ordered(which: int, names: list[str]) -> DataFrame:
        h = df.withColumn("_h", hash31(F.xxhash64(ident), which)).withColumn("_all", F.lit(1))
        p = positions(h, ["_all"], ["_h", ident], [idiv("_h", 1 << 11)], "_pos")
        return p.select("_pos", *names)

    here = ordered(seed, df.columns)
    there = ordered(seed + 1000003, list(columns)).withColumnsRenamed({c: f"{prefix}{c}" for c in columns})
    return here.join(there, "_pos").drop("_pos")


def linear_model(df: DataFrame, columns: Sequence[str], target: str) -> tuple[float, dict[str, float]]:
    x, xy, _, _ = gram(df, columns, target)
    b = solve(x, xy, range(1, len(columns) + 1))
    return float(b[0]), {c: float(v) for c, v in zip(columns, b[1:])}


def linear_score(intercept: float, weights: dict[str, float]) -> Column:
    return sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(float(intercept)))


def permutation_importance(
    df: DataFrame, ident: str, columns: Sequence[str], target: str, intercept: float,
    weights: dict[str, float], repeats: int, seed: int,
) -> DataFrame:
    """Mean rise of the squared error when one column is permuted. One join per repeat serves
    all features: only the changed term of the linear score is exchanged. A repeat is a job of its
    own, whose shuffle files go before the next one."""
    rows = []
    for r in range(repeats):
        both = permuted(df.select(ident, target, *columns), ident, columns, seed + 2 * r)
        base = F.col(target) - linear_score(intercept, weights)
        rise = [
            F.avg((base + F.lit(weights[c]) * (F.col(c) - F.col(f"p_{c}"))) ** 2 - base**2).alias(c)
            for c in columns
        ]
        with settled(both.agg(*rise), "rise") as one:
            rows.append(tuple(one.first()))
    table = df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns))
    return melt(table, [], columns).groupBy("feature").agg(F.avg("value").alias("score"), F.stddev("value").alias("std"))


def model_permutation(
    df: DataFrame, ident: str, columns: Sequence[str], target: str, score: Callable[[DataFrame], DataFrame],
    repeats: int = 20, seed: int = 0, rows: int = 1 << 14,
) -> DataFrame:
    """Mean rise of the absolute error when one column is permuted, for any fitted model: ``score`` adds ``pred`` to a
    table with ``columns``. ``std`` is over the repeats. Give held-out rows.

    A repeat deals the rows by a hash of ``ident`` (integers) to blocks of about ``rows`` and hands every row the values of
    the next one there, in an order by another hash: the shuffle needs no join and no order over all rows. All repeats
    are scored in one pass, a row once per repeat and column. Rows with a null in a column or the target
    are left out; an empty table has no result.
    """
    known = df.select(ident, target, *columns).na.drop(subset=[target, *columns])
    blocks = max(1, -(-known.count() // rows))
    turn = hash31(ident, seed) + F.col("_repeat") * 104729
    dealt = known.withColumn("_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    dealt = dealt.withColumns({"_block": F.pmod(hash31(turn, seed + 1), F.lit(blocks)), "_turn": hash31(turn, seed + 2)})
    w = Window.partitionBy("_repeat", "_block").orderBy("_turn", ident)
    values = F.struct(*columns)
    dealt = dealt.withColumn("_other", F.coalesce(F.lead(values).over(w), F.first(values).over(w)))
    # Number -1 is the row as it is.
    numbers = F.when(F.col("_repeat") == 0, F.sequence(F.lit(-1), F.lit(len(columns) - 1))).otherwise(F.sequence(F.lit(0), F.lit(len(columns) - 1)))
    changed = dealt.withColumn("_number", F.explode(numbers)).select(
        target, "_repeat", "_number",
        *[F.when(F.col("_number") == i, F.col("_other")[c]).otherwise(F.col(c)).alias(c) for i, c in enumerate(columns)],
    )
    errors = score(changed).groupBy("_repeat", "_number").agg(F.avg(F.abs(F.col(target) - F.col("pred"))).alias("_error"))
    found = errors.groupBy("_number").agg(F.avg("_error").alias("_mean"), F.stddev("_error").alias("std"))
    whole = F.max(F.when(F.col("_number") == -1, F.col("_mean"))).over(Window.partitionBy(F.lit(0)))
    names = F.array(*map(F.lit, columns))
    return found.withColumn("score", F.col("_mean") - whole).where(F.col("_number") >= 0).select(
        F.get(names, F.col("_number")).alias("feature"), "score", "std"
    )


def binomial_tail(hits: int, trials: int) -> float:
    """P(X >= hits) for X ~ Binomial(trials, 1/2), exact."""
    from math import comb

    return sum(comb(trials, k) for k in range(hits, trials + 1)) / 2.0**trials


def boruta(
    df: DataFrame, ident: str, columns: Sequence[str], target: str, rounds: int, trees: int,
    depth: int, seed: int, alpha: float = 0.05,
) -> DataFrame:
    """Hits against the best shadow column over several forests, both binomial tails with a
    correction for the number of features. A round's shuffle files go after it; its
    rows aren't written, as a forest's draws follow the partitions it is fitted on."""
    hits = dict.fromkeys(columns, 0)
    for r in range(rounds):
        both = permuted(df.select(ident, target, *columns), ident, columns, seed + 2 * r, "shadow_")
        shadows = [f"shadow_{c}" for c in columns]
        imp = {
            row["feature"]: row["score"]
            for row in forest_importance(both, [*columns, *shadows], target, trees, depth, seed + r).collect()
        }
        both = None
        collected(df.sparkSession)
        bar = max(imp[s] for s in shadows)
        for c in columns:
            hits[c] += int(imp[c] > bar)
    level = alpha / len(columns)
    rows = []
    for c in columns:
        up = binomial_tail(hits[c], rounds)
        down = binomial_tail(rounds - hits[c], rounds)
        verdict = "confirmed" if up <= level else "rejected" if down <= level else "tentative"
        rows.append((c, hits[c], up, verdict))
    return df.sparkSession.createDataFrame(rows, "feature string, hits bigint, p_value double, verdict string")


def shapley_linear(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Additive attributions w * (x - mean) of a linear model, columns ``phi_*``."""
    means = scalar_row(df.agg(*[F.avg(c).alias(c) for c in weights]))
    d = df.withColumn("_m", means)
    return d.withColumns({f"phi_{c}": F.lit(float(w)) * (F.col(c) - F.col(f"_m.{c}")) for c, w in weights.items()}).drop("_m")


def shapley_importance(attributed: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = attributed.agg(*[F.avg(F.abs(f"phi_{c}")).alias(c) for c in columns])
    return melt(one, [], columns).withColumnRenamed("value", "score")


def union_selected(lists: Sequence[DataFrame], fallback: Sequence[str], spark) -> DataFrame:
    """Distinct union of selected features; the fallback list when nothing was selected."""
    u = None
    for one in lists:
        u = one.select("feature") if u is None else u.unionByName(one.select("feature"))
    u = u.distinct()
    spare = spark.createDataFrame([(f,) for f in fallback], "feature string")
    some = scalar_row(u.agg(F.count(F.lit(1)).alias("n")))["n"]
    return u.unionByName(spare.where(some == 0)).distinct()


def ablation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """AUC of a linear score with all features, without one, and with only one, from one Gram
    matrix and two passes of scores (``roc_aucs``)."""
    z = zscored(df, columns)
    x, xy, _, _ = gram(z, columns, target)
    every = list(range(1, len(columns) + 1))
    configs = {"all": every}
    for i, c in zip(every, columns):
        configs[f"without {c}"] = [j for j in every if j != i]
        configs[f"only {c}"] = [i]
    scores = {}
    for name, keep in configs.items():
        b = solve(x, xy, keep)
        weights = {columns[j - 1]: float(v) for j, v in zip(keep, b[1:])}
        scores[name] = linear_score(float(b[0]), weights)
    return roc_aucs(z, target, scores)


def shapley_sampled(
    df: DataFrame, ident: str, columns: Sequence[str], predict: Callable[[DataFrame, str, str], DataFrame],
    draws: int, seed: int,
) -> DataFrame:
    """Sampled additive attributions ``phi_*`` for any model, averaged over ``draws``.

    Per draw a row meets one background row (a permutation join) and a hashed feature order;
    features switch from the background's value to the row's own one by one, and the change
    of the score belongs to the feature switched. ``predict(df, vector, out)`` adds a score of
    a vector column; it is called ``len(columns) + 1`` times per draw, each on all rows.
    """
    total = None
    for r in range(draws):
        both = permuted(df.select(ident, *columns), ident, columns, seed + 2 * r)
        ranks = F.array_sort(F.array(*[
            F.struct(F.xxhash64(F.col(ident), F.lit(seed + r), F.lit(c)).alias("h"), F.lit(i).alias("i"))
            for i, c in enumerate(columns)
        ]))
        both = both.withColumn("_order", F.transform(ranks, lambda s: s["i"]))
        both = both.withColumns({
            f"_k_{c}": F.array_position("_order", F.lit(i)) for i, c in enumerate(columns)
        })
        for step in range(len(columns) + 1):
            mixed = F.array(*[
                F.when(F.col(f"_k_{c}") <= step, F.col(c)).otherwise(F.col(f"p_{c}")) for c in columns
            ])
            both = predict(both.withColumn("_v", array_to_vector(mixed)), "_v", f"_f{step}").drop("_v")
        path = F.array(*[F.col(f"_f{s}") for s in range(len(columns) + 1)])
        both = both.withColumn("_path", path)
        gain = {
            f"phi_{c}": F.element_at("_path", (F.col(f"_k_{c}") + 1).cast("int"))
            - F.element_at("_path", F.col(f"_k_{c}").cast("int"))
            for c in columns
        }
        one = both.select(ident, *columns, *[g.alias(n) for n, g in gain.items()])
        total = one if total is None else total.unionByName(one)
    return total.groupBy(ident).agg(
        *[F.first(c).alias(c) for c in columns], *[F.avg(f"phi_{c}").alias(f"phi_{c}") for c in columns]
    )
