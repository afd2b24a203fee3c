"""Query registry, table access and the derived views used as inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skerry.workspace import pin

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
INDICATORS = ["revenue", "orders", "urgent"]

VIEW_SQL = {
    "v_obs": """SELECT event_id AS record_id, event_type AS station, CAST(ts AS DATE) AS obs_date, ts,
        CASE WHEN event_id % 50 = 7 THEN NULL ELSE value END AS temperature_c,
        CAST(user_id % 120 AS DOUBLE) AS humidity_pct, CAST(1000 + event_id % 60 AS DOUBLE) AS pressure_hpa
        FROM events""",
    "v_geo": """SELECT o_orderkey AS id, CAST((o_custkey * 37) % 180 - 90 AS DOUBLE) AS lat,
        CAST((o_custkey * 91) % 360 - 180 AS DOUBLE) AS lon, o_totalprice / 10000 AS depth,
        CAST(FLOOR(LOG10(o_totalprice) * 10) / 10 AS DOUBLE) AS magnitude, o_orderdate AS ts FROM orders""",
    "v_country": """SELECT n.n_nationkey AS country_key, n.n_name AS country, r.r_name AS region,
        CAST(COALESCE(c.cnt, 0) * 1000 AS BIGINT) AS population, CAST(COALESCE(s.cnt, 0) AS DOUBLE) AS area_km2
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (SELECT c_nationkey AS k, COUNT(*) AS cnt FROM customer GROUP BY c_nationkey) c ON c.k = n.n_nationkey
        LEFT JOIN (SELECT s_nationkey AS k, COUNT(*) AS cnt FROM supplier GROUP BY s_nationkey) s ON s.k = n.n_nationkey""",
    "v_ind": """SELECT country_key, year, 'revenue' AS indicator, CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM (SELECT c.c_nationkey AS country_key, CAST(YEAR(o.o_orderdate) AS INT) AS year, o.o_totalprice AS price
              FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) t GROUP BY country_key, year
        UNION ALL SELECT country_key, year, 'orders' AS indicator, CAST(COUNT(*) AS DOUBLE) AS value
        FROM (SELECT c.c_nationkey AS country_key, CAST(YEAR(o.o_orderdate) AS INT) AS year
              FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderpriority <> '5-LOW') t
        GROUP BY country_key, year
        UNION ALL SELECT country_key, year, 'urgent' AS indicator, CAST(COUNT(*) AS DOUBLE) AS value
        FROM (SELECT c.c_nationkey AS country_key, CAST(YEAR(o.o_orderdate) AS INT) AS year
              FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderpriority = '1-URGENT') t
        GROUP BY country_key, year""",
    "v_rates": """SELECT month, AVG(CASE WHEN p = '1-URGENT' THEN price END) AS urgent,
        AVG(CASE WHEN p = '2-HIGH' THEN price END) AS high, AVG(CASE WHEN p = '3-MEDIUM' THEN price END) AS medium,
        AVG(CASE WHEN p = '4-NOT SPECIFIED' THEN price END) AS unspecified, AVG(CASE WHEN p = '5-LOW' THEN price END) AS low
        FROM (SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month, o_orderpriority AS p, o_totalprice AS price
              FROM orders) t GROUP BY month""",
}


class Tables:
    """Lazy access to the tables of one scale factor and to the derived views."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def v_obs(self) -> DataFrame:
        """Weather-like observations with a missing temperature every 50th row."""
        return self.events.select(
            F.col("event_id").alias("record_id"),
            F.col("event_type").alias("station"),
            F.to_date("ts").alias("obs_date"),
            "ts",
            F.when(F.col("event_id") % 50 != 7, F.col("value")).alias("temperature_c"),
            (F.col("user_id") % 120).cast("double").alias("humidity_pct"),
            (1000 + F.col("event_id") % 60).cast("double").alias("pressure_hpa"),
        )

    @cached_property
    def v_geo(self) -> DataFrame:
        """Point events with a magnitude, spread over the globe."""
        return self.orders.select(
            F.col("o_orderkey").alias("id"),
            ((F.col("o_custkey") * 37) % 180 - 90).cast("double").alias("lat"),
            ((F.col("o_custkey") * 91) % 360 - 180).cast("double").alias("lon"),
            (F.col("o_totalprice") / 10000).alias("depth"),
            (F.floor(F.log10("o_totalprice") * 10) / 10).cast("double").alias("magnitude"),
            F.col("o_orderdate").alias("ts"),
        )

    @cached_property
    def v_country(self) -> DataFrame:
        """Country dimension with a population and an area."""
        customers = self.customer.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
        suppliers = self.supplier.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
        n = self.nation
        return (
            n.join(self.region, n.n_regionkey == F.col("r_regionkey"), "left")
            .join(customers, n.n_nationkey == F.col("c_nationkey"), "left")
            .join(suppliers, n.n_nationkey == F.col("s_nationkey"), "left")
            .select(
                F.col("n_nationkey").alias("country_key"),
                F.col("n_name").alias("country"),
                F.col("r_name").alias("region"),
                (F.coalesce("customers", F.lit(0)) * 1000).cast("bigint").alias("population"),
                F.coalesce("suppliers", F.lit(0)).cast("double").alias("area_km2"),
            )
        )

    @cached_property
    def yearly(self) -> DataFrame:
        """Order figures per nation and year.

        Orders are reduced to one row per customer and year before the join, so
        a customer holding a large share of the orders costs one row, not many.
        """
        per_customer = self.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
            # Whole cents add up exactly and much faster than wide decimals.
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
            F.count_if(F.col("o_orderpriority") != "5-LOW").alias("orders"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        )
        return (
            per_customer.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("c_nationkey").alias("country_key"), "year")
            .agg(
                (F.sum("cents") / 100.0).alias("revenue"),
                F.sum("orders").cast("double").alias("orders"),
                F.sum("urgent").cast("double").alias("urgent"),
            )
        )

    @cached_property
    def v_ind(self) -> DataFrame:
        """Long indicator facts by country and year; counts of zero have no row."""
        return self.yearly.unpivot(["country_key", "year"], INDICATORS, "indicator", "value").filter(
            (F.col("indicator") == "revenue") | (F.col("value") > 0)
        )

    @cached_property
    def pinned_ind(self) -> DataFrame:
        """`v_ind` computed once into the shared checkpoint folder.

        A row per nation, year and indicator, whatever the number of orders.
        For queries that use several indicators, which would otherwise each
        aggregate the orders again.
        """
        pin(self.spark)
        return self.v_ind.checkpoint()

    def indicator(self, name: str) -> DataFrame:
        """One indicator as (country_key, year, <name>)."""
        return self.pinned_ind.filter(F.col("indicator") == name).select(
            "country_key", "year", F.col("value").alias(name)
        )

    @cached_property
    def v_rates(self) -> DataFrame:
        """Wide monthly series of mean order prices, one column per priority."""
        names = ["urgent", "high", "medium", "unspecified", "low"]
        return self.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
            *[
                F.avg(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))).alias(n)
                for p, n in zip(PRIORITIES, names)
            ]
        )


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def _half_up(sql: str) -> str:
    """State the rounding rule: half away from zero on the decimal value.

    `ROUND` of a double alone multiplies in binary, where a tie such as
    38.37875 may fall to either side.
    """
    out, rest = "", sql
    while (start := rest.find("ROUND(")) >= 0:
        depth, comma, at = 1, -1, start + len("ROUND(")
        body = at
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[at], 0)
            if rest[at] == "," and depth == 1:
                comma = at
            at += 1
        inner = _half_up(rest[body:comma])
        out += f"{rest[:start]}CAST(ROUND(CAST({inner} AS DECIMAL(38,8)), {rest[comma + 1:at - 1].strip()}) AS DOUBLE)"
        rest = rest[at:]
    return out + rest


def round_half_up(value: Column, digits: int) -> Column:
    """The same rule for a query's output column; eight decimals absorb the noise of summing in another order."""
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


def _expand(sql: str) -> str:
    for name, text in VIEW_SQL.items():
        sql = sql.replace(f"@{name}", f"({text}) AS {name}")
    return _half_up(sql)


def query(oracle: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under its function name. `@v_obs` and the like stand for the views."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in REGISTRY:
            raise ValueError(f"duplicate query {build.__name__}")
        REGISTRY[build.__name__] = Query(build, _expand(oracle) if oracle else None)
        return build

    return register
