"""Results with one customer, order and product holding a third of the rows, and nothing broadcast."""

import duckdb
import pytest
from compare import difference, sql_connection

import __spark_entry__ as entry_point

HOT = {
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 8 ELSE o_custkey END AS o_custkey",
    "lineitem": """CASE WHEN hash(l_partkey, l_suppkey, l_extendedprice) % 3 = 0 THEN 6 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN hash(l_partkey, l_suppkey, l_extendedprice) % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey""",
}

NAMES = [
    "r01_acquisitions",
    "r03_first_purchase",
    "r04_repurchase",
    "r05_retention",
    "r07_debt_route",
    "r08_text_segment",
    "r09_sales_matrix",
    "r10_collections",
    "k19_trend",
    "k22_cohort",
    "j14_open_items",
    "a12_listagg",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory, sf_dir):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        replaced = f"* REPLACE ({HOT[name]})" if name in HOT else "*"
        con.execute(
            f"COPY (SELECT {replaced} FROM '{sf_dir}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)"
        )
    return str(folder)


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_rows(spark, skewed_dir, no_broadcast, name):
    df = entry_point.queries()[name](spark, skewed_dir)
    assert difference(df, sql_connection(skewed_dir), entry_point.oracle_sql()[name]) in (None, "empty")


def test_a_hot_key_is_split(spark, skewed_dir, no_broadcast):
    from rivulet.operators.joins import facts_of

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    orders = spark.read.parquet(f"{skewed_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    keys = orders.groupBy("o_custkey").count().select("o_custkey")
    joined = facts_of(orders, keys, "o_custkey")
    rows = joined.collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(rows) == orders.count()
    assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
