"""Splits and sampling by hashed ids: stable under repartitioning, retries and reruns."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash31, idiv, scalar_row, unit_hash
from .ordered import positions


def random_split(df: DataFrame, ident: str | Column, shares: dict[str, float], seed: int, out: str = "part") -> DataFrame:
    """Name each row's part by its hash fraction; the last part takes the rest."""
    u, edge, part = unit_hash(ident, seed), 0.0, None
    names = list(shares)
    for name in names[:-1]:
        edge += shares[name]
        part = F.when(u < edge, name) if part is None else part.when(u < edge, name)
    return df.withColumn(out, part.otherwise(names[-1]) if part is not None else F.lit(names[-1]))


def group_split(df: DataFrame, group: str, share: float, seed: int, out: str = "part") -> DataFrame:
    """Whole groups stay together: the hash is taken on the group id."""
    return random_split(df, group, {"train": share, "test": 1 - share}, seed, out)


def stratified_split(
    df: DataFrame, label: str, ident: str, share: float, seed: int, out: str = "part"
) -> DataFrame:
    """Exactly floor(share * n) test rows per class, chosen in hash order; null labels are a class of
    their own. Hash cells keep one class out of one task."""
    named = F.struct(F.col(label).isNull().alias("none"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("name"))
    h = df.withColumns({"_h": hash31(ident, seed), "_class": named})
    p = positions(h, ["_class"], ["_h", ident], [idiv("_h", 1 << 11)], "_pos", total="_size")
    test = F.col("_pos") <= F.floor(F.col("_size") * share)
    return p.withColumn(out, F.when(test, "test").otherwise("train")).drop("_h", "_class", "_pos", "_size")


def kfold(df: DataFrame, ident: str | Column, k: int, seed: int, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.pmod(hash31(ident, seed), F.lit(k)))


def repeated_samples(
    df: DataFrame, ident: str, repeats: int, share: float, seed: int, out: str = "sample"
) -> DataFrame:
    """``repeats`` samples of the given share; a row is copied only for samples it is in."""
    member = F.array_compact(F.array(*[
        F.when(unit_hash(ident, seed + i) < share, F.lit(i).cast("bigint")) for i in range(repeats)
    ]))
    return df.withColumn(out, F.explode(member))


def mask_n(df: DataFrame, value: str, ident: str, n: int, seed: int, out: str) -> DataFrame:
    """Hide the n valid cells of smallest (hash, id); the truth column stays. The n-th smallest
    pair is a scalar, so no join is needed."""
    h = df.withColumn("_h", F.struct(hash31(ident, seed).alias("h"), F.col(ident).alias("i")))
    edge = scalar_row(
        h.where(F.col(value).isNotNull()).select("_h").orderBy("_h").limit(n).agg(F.max("_h").alias("m"))
    )
    hidden = F.col(value).isNotNull() & (F.col("_h") <= edge["m"])
    return h.withColumn(out, F.when(~hidden, F.col(value))).drop("_h")


def normal_only(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label) == 0)


