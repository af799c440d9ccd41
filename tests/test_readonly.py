import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from lakemart.plans import kpi
from lakemart.plans.readonly import ReadOnlyError
from tests.conftest import rows


@pytest.fixture(scope="module")
def marts(spark):
    days = spark.createDataFrame([("2024-01-01", "n", 5), ("2024-01-02", "s", 7), ("2024-01-02", "n", 1)], "day string, region string, revenue int")
    return {"mart_days": days, "Mart_Homes": spark.createDataFrame([("n", [1, 2]), ("s", [3])], "region string, ids array<int>")}


READS = {
    "select count(*) as n from mart_days;": [(3,)],
    "table mart_days": [("2024-01-01", "n", 5), ("2024-01-02", "n", 1), ("2024-01-02", "s", 7)],
    "with d as (select region, sum(revenue) as r from mart_days group by 1), e as (select * from d) select r from e where region = 'n'": [(6,)],
    "select region from mart_homes h where exists (select 1 from mart_days d where d.region = h.region and revenue > 6)": [("s",)],
    "select h.region, i from mart_homes h lateral view explode(ids) t as i where i in (select max(revenue) - 4 from mart_days)": [("s", 3)],
    "select day, row_number() over w as k from mart_days window w as (order by day, region) order by 1, 2 limit 1": [("2024-01-01", 1)],
    "select * from (select day, region, revenue from mart_days) pivot (sum(revenue) for region in ('n', 's'))": [
        ("2024-01-01", 5, None), ("2024-01-02", 1, 7)],
    "select a.v from values (1), (2) as a(v) union all select id from range(1) except select 2": [(0,), (1,)],
    "select region from mart_days group by region having sum(revenue) > 6 intersect select region from mart_homes": [("s",)],
    "select transform(ids, x -> x + 1) as t, date_trunc('month', timestamp '2024-01-05') is null as d from mart_homes where region = 's'": [([4], False)],
    "with recursive t(n) as (select 1 union all select n + 1 from t where n < 3) select max(n) as n from t": [(3,)],
    "select m.x from mart_homes h, lateral (select h.region as x) m where h.region = 'n'": [("n",)],
}

REFUSED = [
    "create table x as select 1",
    "insert into mart_days select 'a', 'b', 1",
    "set spark.sql.shuffle.partitions = 1",
    "cache table mart_days",
    "drop view mart_days",
    "explain select 1",
    "describe mart_days",
    "select java_method('java.lang.System', 'setProperty', 'lakemart.test', 'x')",
    "select * from mart_days where revenue > 0 and Reflect('java.lang.System', 'exit', '1') = '1'",
    "select try_reflect('java.lang.System', 'exit', '1')",
    "select * from mart_days order by (select max(java_method('java.lang.System', 'exit', '1')) from mart_days)",
    "with a as (select reflect('java.lang.System', 'exit', '1') as x) select 1 as y",
    "select * from parquet.`/etc/passwd`",
    "select * from text.`/etc/passwd`",
    "select * from other_view",
    "select * from default.mart_days",
    "select * from spark_catalog.default.other_view",
    "select * from mart_days where region in (select region from other_view)",
    # The name of a WITH is no table outside its query.
    "select * from hidden where exists (with hidden as (select 1) select * from hidden)",
    "with a as (select * from hidden), hidden as (select 1) select * from a",
    "select identifier('java_' || 'method')('java.lang.System', 'exit', '1')",
    "select * from identifier('other_' || 'view')",
    "select transform(region) using 'cat' as b from mart_days",
    "select input_file_name() from mart_days",
    "select own_function(1)",
    "select * from read_files('/etc')",
    "select * from python_table('x')",
    "select max(1)) from mart_days; drop view mart_days",
]


@pytest.mark.parametrize("text", READS)
def test_queries_run(spark, marts, text):
    assert rows(kpi.sql(spark, text, marts)) == sorted(READS[text], key=str)


@pytest.mark.parametrize("text", REFUSED)
def test_anything_else_is_refused(spark, marts, text):
    spark.range(1).createOrReplaceTempView("other_view")
    spark.range(1).createOrReplaceTempView("hidden")
    spark.udf.register("own_function", lambda x: x, "int")
    with pytest.raises((ReadOnlyError, ParseException)):
        kpi.sql(spark, text, marts)
    assert spark._jvm.java.lang.System.getProperty("lakemart.test") is None


def test_a_user_function_cannot_hide_behind_a_built_in_name(spark):
    other = spark.newSession()
    other.udf.register("upper", lambda x: "own", "string")
    with pytest.raises(ReadOnlyError, match="UDF"):
        kpi.sql(other, "select upper(x) from v", {"v": other.createDataFrame([("a",)], "x string")})


def test_marts_may_hold_what_queries_may_not(spark, marts):
    own = F.udf(lambda x: x + "!", "string")
    made = {"mart_own": marts["mart_days"].withColumn("region", own("region"))}
    assert kpi.sql(spark, "select max(region) as r from mart_own", made).first().r == "s!"
