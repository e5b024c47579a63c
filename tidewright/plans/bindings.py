"""Bindings of the given tables to the engine's data models (see FIXTURES.md)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import HOUR, hash31, idiv, micros
from ..operators.ordered import positions
from ..operators.resample import dense_grid
from ..session import settle

# Label windows [begin, end) with one label each. The third label lies on
# its window's begin, so no alarm can come before it (the late case).
WINDOWS = [
    ("2024-01-05 00:00:00", "2024-01-07 00:00:00", "2024-01-06 00:00:00"),
    ("2024-01-14 00:00:00", "2024-01-16 00:00:00", "2024-01-15 12:00:00"),
    ("2024-01-23 00:00:00", "2024-01-25 00:00:00", "2024-01-23 00:00:00"),
]
TRAIN_END = "2024-01-12 00:00:00"
FEATURES = ["qty", "price", "disc", "tax", "psize", "retail", "total"]
SENSORS = ["qty", "price", "disc", "tax"]
MACH_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


class Tables:
    """The given Parquet tables and the bindings built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def ser(self, masked: bool = False) -> DataFrame:
        value = F.col("value")
        if masked:
            value = F.when(F.col("event_id") % 10 != 3, value)
        return self.events.select(
            F.col("event_type").alias("key"), micros("ts").alias("t"), "event_id",
            value.alias("value"),
        )

    def ser_pos(self, masked: bool = False) -> DataFrame:
        """SER with its position per key; measured cells keep one type out of one task."""
        ser = self.ser(masked)
        return positions(ser, ["key"], ["t", "event_id"])

    def grid(self, masked: bool = False, total: bool = False) -> DataFrame:
        """Dense hourly grid: key, h (hour number), pos, n (count), v (mean or null)."""
        hourly = self.events.select(
            (F.lit("all") if total else F.col("event_type")).alias("key"),
            idiv(micros("ts"), HOUR).alias("h"),
            "value",
        )
        hourly = hourly.groupBy("key", "h").agg(
            F.count(F.lit(1)).alias("n"), F.avg("value").alias("v")
        )
        g = dense_grid(hourly, ["key"], "h", 1, zero=["n"])
        if masked:
            keep = F.pmod("pos", F.lit(10)) != 3
            g = g.withColumn("truth", F.col("v")).withColumn("v", F.when(keep, F.col("v")))
        return g

    def mach(self) -> DataFrame:
        """Lines of one supplier as the cycles of one machine, with rul = length - cycle."""
        cells = [F.col("l_shipdate"), idiv("l_orderkey", 1 << 30)]
        p = positions(self.lineitem, ["l_suppkey"], MACH_ORDER, cells, "cycle", total="ftime")
        return p.select(
            F.col("l_suppkey").alias("machine"), "cycle", "ftime",
            F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
            (F.col("ftime") - F.col("cycle")).alias("rul"),
        )

    def mach_scored(self) -> DataFrame:
        """MACH with a noisy deterministic RUL prediction."""
        noise = F.pmod(hash31(F.col("machine") * 100003 + F.col("cycle"), 1), F.lit(61)) - 30
        return self.mach().withColumn("pred", F.col("rul") + noise)

    def sales(self) -> DataFrame:
        return self.orders.join(
            self.customer, F.col("o_custkey") == F.col("c_custkey")
        ).select(
            F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("date"),
            F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("type"),
            F.col("c_nationkey").cast("bigint").alias("zone"),
        )

    def sales_month(self) -> DataFrame:
        """Zone by month: mean price, count; month number = year * 12 + month - 1."""
        return (
            self.sales()
            .groupBy("zone", (F.year("date") * 12 + F.month("date") - 1).cast("bigint").alias("m"))
            .agg(F.avg("price").alias("price"), F.count(F.lit(1)).alias("n"))
        )

    def panel(self) -> DataFrame:
        """Zone-year panel; label 1 when the mean price falls against the previous year."""
        p = (
            self.sales()
            .groupBy("zone", F.year("date").alias("year"))
            .agg(
                F.avg("price").alias("mean_price"),
                F.count(F.lit(1)).alias("n"),
                F.avg(F.when(F.col("type") == "1-URGENT", 1.0).otherwise(0.0)).alias("urgent"),
            )
        )
        # At most one row per zone and year: the group is bounded by the calendar.
        before = F.lag("mean_price").over(Window.partitionBy("zone").orderBy("year"))
        return p.withColumn("label", F.when(F.col("mean_price") < before, 1).otherwise(0))

    def feat_table(self, masked: bool = False) -> DataFrame:
        """FEAT written once, for queries that pass over it several times."""
        return settle(self.feat(masked), "feat")

    def feat(self, masked: bool = False) -> DataFrame:
        """Line features joined with part and order; y = 1 for finished orders."""
        line = self.lineitem
        qty = F.col("l_quantity")
        price = F.col("l_extendedprice")
        if masked:
            hidden = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(10)) == 3
            qty, price = F.when(~hidden, qty), F.when(~hidden, price)
        return (
            line.join(self.part, F.col("l_partkey") == F.col("p_partkey"))
            .join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").alias("oid"), F.col("l_linenumber").cast("bigint").alias("ln"),
                F.col("l_partkey").alias("pid"), F.col("l_suppkey").alias("sid"),
                qty.alias("qty"), price.alias("price"), F.col("l_discount").alias("disc"),
                F.col("l_tax").alias("tax"), F.col("p_size").cast("double").alias("psize"),
                F.col("p_retailprice").alias("retail"), F.col("o_totalprice").alias("total"),
                F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
                F.col("o_orderpriority").alias("grp"), F.year("o_orderdate").alias("year"),
            )
        )

    def scored(self) -> DataFrame:
        """Order rows with a continuous truth, a prediction, a class and a risk score."""
        noise = hash31("o_orderkey", 3)
        actual = F.col("o_totalprice") / 1000.0
        cls = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
        return self.orders.select(
            F.col("o_orderkey").alias("id"),
            actual.alias("actual"),
            (actual * 0.9 + F.pmod(noise, F.lit(101)) / 2.0).alias("pred"),
            cls.alias("y"),
            ((F.pmod(noise, F.lit(1000)) + cls * 150) / 1000.0).alias("score"),
            F.col("o_orderpriority").alias("grp"),
        )

    def signal(self) -> DataFrame:
        """Event signal used by the alarm queries (the value itself), over all types."""
        return self.events.select(
            micros("ts").alias("t"), "event_id", F.col("value").alias("signal")
        )

    def windows(self) -> DataFrame:
        """Label windows as rows (pos, begin, end, label) in microseconds."""
        rows = ", ".join(
            f"({i}, timestamp'{b}', timestamp'{e}', timestamp'{lab}')"
            for i, (b, e, lab) in enumerate(WINDOWS)
        )
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS w(pos, b, e, l)").select(
            F.col("pos").cast("bigint").alias("pos"), micros("b").alias("begin"),
            micros("e").alias("end"), micros("l").alias("label"),
        )


def h31(expr: str, seed: int = 0) -> str:
    """The portable hash as DuckDB text."""
    m, a = "2147483648", "1103515245"
    h = f"((((({expr}) % {m}) * {a}) + {seed * 7919 + 12345}) % {m})"
    swapped = f"(({h} // 32768) + ({h} % 32768) * 65536)"
    return f"((({swapped} % {m}) * {a} + 12345) % {m})"


def rnd(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


_WINDOW_ROWS = ", ".join(
    f"({i}, epoch_us(TIMESTAMP '{b}'), epoch_us(TIMESTAMP '{e}'), epoch_us(TIMESTAMP '{lab}'))"
    for i, (b, e, lab) in enumerate(WINDOWS)
)
_GRID = """
  SELECT s.key, s.h, s.pos, coalesce(a.n, 0) AS n, a.v FROM (
    SELECT key, unnest(range(lo, hi + 1)) AS h, unnest(range(1, hi - lo + 2)) AS pos FROM (
      SELECT {k} AS key, min(epoch_us(ts) // 3600000000) AS lo, max(epoch_us(ts) // 3600000000) AS hi
      FROM events GROUP BY 1)) s
  LEFT JOIN (SELECT {k} AS key, epoch_us(ts) // 3600000000 AS h, count(*) AS n, avg(value) AS v
             FROM events GROUP BY 1, 2) a ON a.key = s.key AND a.h = s.h"""
BINDING_SQL = {
    "ser": "SELECT event_type AS key, epoch_us(ts) AS t, event_id, value FROM events",
    "ser_masked": "SELECT event_type AS key, epoch_us(ts) AS t, event_id, "
    "CASE WHEN event_id % 10 <> 3 THEN value END AS value FROM events",
    "ser_pos": "SELECT *, row_number() OVER (PARTITION BY key ORDER BY t, event_id) AS pos FROM ser",
    "ser_pos_masked": "SELECT *, row_number() OVER (PARTITION BY key ORDER BY t, event_id) AS pos "
    "FROM ser_masked",
    "grid": _GRID.format(k="event_type"),
    "grid_total": _GRID.format(k="'all'"),
    "grid_masked": "SELECT key, h, pos, n, v AS truth, CASE WHEN pos % 10 <> 3 THEN v END AS v FROM grid",
    "mach": f"""SELECT machine, cycle, ftime, qty, price, disc, tax, ftime - cycle AS rul FROM (
      SELECT l_suppkey AS machine, row_number() OVER (PARTITION BY l_suppkey ORDER BY
        {", ".join(MACH_ORDER)}) AS cycle, count(*) OVER (PARTITION BY l_suppkey) AS ftime,
        l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax FROM lineitem)""",
    "mach_scored": f"SELECT *, rul + ({h31('machine * 100003 + cycle', 1)} % 61) - 30 AS pred FROM mach",
    "sales": """SELECT o_orderkey AS id, o_orderdate AS date, o_totalprice AS price,
      o_orderpriority AS type, CAST(c_nationkey AS BIGINT) AS zone
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "sales_month": """SELECT zone, year(date) * 12 + month(date) - 1 AS m, avg(price) AS price,
      count(*) AS n FROM sales GROUP BY 1, 2""",
    "panel": """SELECT zone, year, mean_price, n, urgent, CASE WHEN mean_price < lag(mean_price) OVER
      (PARTITION BY zone ORDER BY year) THEN 1 ELSE 0 END AS label FROM (
      SELECT zone, year(date) AS year, avg(price) AS mean_price, count(*) AS n,
        avg(CASE WHEN type = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS urgent
      FROM sales GROUP BY 1, 2)""",
    "feat": """SELECT l_orderkey AS oid, CAST(l_linenumber AS BIGINT) AS ln, l_partkey AS pid, l_suppkey AS sid,
      l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
      CAST(p_size AS DOUBLE) AS psize, p_retailprice AS retail, o_totalprice AS total,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_orderpriority AS grp,
      year(o_orderdate) AS year
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "feat_masked": """SELECT * REPLACE (
        CASE WHEN (oid * 7 + ln) % 10 <> 3 THEN qty END AS qty,
        CASE WHEN (oid * 7 + ln) % 10 <> 3 THEN price END AS price) FROM feat""",
    "scored": f"""SELECT id, actual, actual * 0.9 + (noise % 101) / 2.0 AS pred, y,
        (noise % 1000 + y * 150) / 1000.0 AS score, grp FROM (
      SELECT o_orderkey AS id, o_totalprice / 1000.0 AS actual, {h31("o_orderkey", 3)} AS noise,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_orderpriority AS grp FROM orders)""",
    "signal": "SELECT epoch_us(ts) AS t, event_id, value AS signal FROM events",
    "windows": f'SELECT CAST(pos AS BIGINT) AS pos, "begin", "end", label FROM (VALUES {_WINDOW_ROWS}) w(pos, "begin", "end", label)',
}


def with_bindings(sql: str) -> str:
    """Prefix ``sql`` with the binding CTEs it names, in dependency order."""
    needed: list[str] = []

    def visit(text: str):
        for name in BINDING_SQL:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(BINDING_SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    ctes = [f"{n} AS ({BINDING_SQL[n]})" for n in needed]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join([*ctes, body[5:]]) if ctes else body
    return ("WITH " + ", ".join(ctes) + "\n" if ctes else "") + body
