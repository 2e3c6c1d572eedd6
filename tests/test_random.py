"""The reports against the long SQL form on random tables with hot keys, nulls and repeats."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from conftest import final_plan
from fixture_domain import frame
from planledger.config import DAILY
from planledger.plans.charges import people

CUSTOMERS, ORDERS, LINES, PARTS = 24, 90, 330, 30
INT32 = ("n_nationkey", "n_regionkey", "c_nationkey", "p_size", "l_linenumber")
EPOCH = datetime(1997, 1, 1)


def write_tables(root, seed):
    """Driver-like tables in which subscriber 0 and part 0 hold a third of the rows."""
    rnd = random.Random(seed)

    def key(n):
        return 0 if rnd.random() < 1 / 3 else rnd.randrange(n)

    def day(n=1500):
        return EPOCH + timedelta(days=rnd.randrange(n))

    orders = [
        (k, key(CUSTOMERS), rnd.choice("OFP"), rnd.uniform(1, 9e4), day(),
         rnd.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]))
        for k in range(ORDERS)
    ]
    lines = [
        (rnd.randrange(ORDERS), key(PARTS), rnd.randrange(5), rnd.randint(1, 7),
         float(rnd.randint(1, 50)), 1.0, 0.0, rnd.choice([0.0, 0.05]), rnd.choice("ANR"),
         rnd.choice("OF"), day())
        for _ in range(LINES)
    ]
    lines += rnd.sample(lines, 40)
    data = {
        "nation": (["n_nationkey", "n_name", "n_regionkey"],
                   [(k, f"NATION_{k}", 0) for k in range(25)]),
        "customer": (["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                     [(k, f"C{k}", rnd.randrange(25), rnd.uniform(0, 9e3),
                       rnd.choice(["BUILDING", "FURNITURE", "MACHINERY"])) for k in range(CUSTOMERS)]),
        "part": (["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
                 [(k, rnd.choice(["red gps", "bolt"]), "B", rnd.choice(
                     ["PROMO", "SMALL", "LARGE", "STANDARD", "MEDIUM", "ECONOMY"]),
                   rnd.randint(1, 50), 900.0 + k) for k in range(PARTS)]),
        "orders": (["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority"], orders),
        "lineitem": (["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                      "l_shipdate"], lines),
        "events": (["event_id", "ts", "user_id", "event_type", "value", "props"],
                   [(k, datetime(2024, 1, 1) + timedelta(hours=rnd.randrange(900)), key(CUSTOMERS),
                     rnd.choice(["view", "click", "purchase", "signup"]),
                     round(rnd.uniform(0, 300), 2), "{}") for k in range(200)]),
    }
    for name, (names, rows) in data.items():
        columns = {
            column: pa.array(list(cells), pa.int32() if column in INT32 else None)
            for column, cells in zip(names, zip(*rows))
        }
        pq.write_table(pa.table(columns), f"{root}/{name}.parquet")


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_match_the_long_form(spark, tmp_path, seed):
    write_tables(tmp_path, seed)
    con = connect(str(tmp_path))
    for report in ("daily_snapshot", "monthly_close", "daily_snapshot_v2"):
        ok, note = compare(spark, con, str(tmp_path), report)
        assert ok and not note.startswith("0 rows"), f"{report}: {note}"


def test_a_customer_with_a_third_of_the_subscribers_is_split(spark, conf, tmp_path):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    n = 30000
    owner = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).cast("string")
    subs = spark.range(0, n, 1, 8).select(
        F.sha1(F.col("id").cast("string")).alias("subscriber_key"), owner.alias("customer_key"),
        F.lit("1376").alias("subscriber_status_key"),
        F.lit("1402").alias("calculated_payment_category_ke"),
        F.concat(F.lit("569"), F.col("id")).alias("primary_resource_value"),
        F.current_date().alias("original_activation_date"),
    )
    customers = spark.range(700).select(
        F.col("id").cast("string").alias("customer_key"), F.lit("3042").alias("customer_sub_type_key"),
        F.lit("1").alias("billing_cycle_key"), F.lit("r").alias("rut_id"),
        F.lit("n").alias("customer_legal_name"), F.lit("C").alias("customer_type_ind"),
        F.lit("INSERT").alias("dml_ind"),
    )
    sub_type = frame(spark, "customer_sub_type", [
        {"customer_sub_type_key": "3042", "customer_sub_type_desc": "Mediana"}])
    got = people(
        {"subscribers": subs, "customer": customers, "customer_sub_type": sub_type}, DAILY)
    assert "skew=true" in final_plan(got)
    assert got.count() == n
