"""The cascade of travelling keys against the plain table-by-table plan."""

import datetime as dt
import random

import pytest

from lakemart.operators import contracts
from lakemart.operators.contracts import validate_all
from lakemart.sources.lake import Workspace
from lakemart.sources.model import TableContract
from tests.conftest import rows

CONTRACTS = {
    # Children stand before their parents, and one key column is not unique in its table.
    "lines": TableContract(
        "lines", unique=("id",), positive=("n",), foreign_keys={"order_id": ("orders", "id"), "code": ("codes", "code")}
    ),
    "orders": TableContract("orders", required=("id",), unique=("id",), foreign_keys={"person": ("people", "id")}),
    "people": TableContract("people", unique=("id",), allowed={"kind": ("a", "b")}),
    "codes": TableContract("codes", non_negative=("n",)),
    "notes": TableContract("notes", foreign_keys={"line": ("lines", "id"), "person": ("people", "id")}),
}
ORDER = dict.fromkeys(CONTRACTS, ["at"])


def tables(spark, seed):
    rng = random.Random(seed)

    def pick(*values):
        return rng.choice(values)

    n = rng.choice([0, 3, 25])
    data = {
        "people": ([(k, pick(*range(8), None), pick("a", "b", "z", None)) for k in range(n)], "at int, id long, kind string"),
        "orders": ([(k, pick(*range(9), None), pick(*range(10), None)) for k in range(n)], "at int, id long, person int"),
        "codes": ([(k, pick("1", "2", "03", "x", None), pick(-1, 0, 1, 1)) for k in range(n)], "at int, code string, n int"),
        "lines": (
            [(k, pick(*range(30), None), pick(*range(10), None), pick(1, 2, 3, 4, None), pick(0, 1, 2)) for k in range(2 * n)],
            "at int, id int, order_id long, code int, n int",
        ),
        "notes": ([(k, pick("1", "2", "03", "7", "x", None), pick(0.0, -0.0, 1.0, 99.0, None)) for k in range(n)],
                  "at int, line string, person double"),
    }
    return {name: spark.createDataFrame(*data[name]) for name in CONTRACTS}


@pytest.mark.parametrize("seed", range(4))
def test_keys_travel_as_in_the_plain_plan(spark, seed):
    raw = tables(spark, seed)
    plain = validate_all(raw, CONTRACTS, ORDER)
    fast = validate_all(raw, CONTRACTS, ORDER, Workspace(spark))
    for table in CONTRACTS:
        assert rows(fast[table].clean()) == rows(plain[table].clean()), table
        assert rows(fast[table].issues()) == rows(plain[table].issues()), table
        assert rows(fast[table].summary()) == rows(plain[table].summary()), table
        assert fast[table].unique == plain[table].unique


@pytest.mark.parametrize("hot", [2, 10_000])
def test_many_repeated_keys_are_ranked_like_few_are_looked_up(spark, monkeypatch, hot):
    raw = tables(spark, 1)
    plain = validate_all(raw, CONTRACTS, ORDER)
    monkeypatch.setattr(contracts, "_FEW", 0)
    monkeypatch.setattr(contracts, "_HOT", hot)
    fast = validate_all(raw, CONTRACTS, ORDER, Workspace(spark))
    for table in CONTRACTS:
        assert rows(fast[table].clean()) == rows(plain[table].clean()), table
        assert rows(fast[table].issues()) == rows(plain[table].issues()), table
    strict = contracts.annotate(raw["lines"], CONTRACTS["lines"], {}, ["order_id", "n"], Workspace(spark))
    lazy = contracts.annotate(raw["lines"], CONTRACTS["lines"], {}, ["order_id", "n"])
    assert rows(strict.issues()) == rows(lazy.issues())


def test_a_wide_table_with_many_repeated_keys_is_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(contracts, "_FEW", 0)
    space = Workspace(spark)
    lines = space.save(spark.range(2000).selectExpr("id as at", "id % 700 as id", "'x' as wide"), "lines")
    notes = space.save(spark.range(50).selectExpr("id as at", "id % 9 as line"), "notes")
    chosen = {
        "lines": TableContract("lines", unique=("id",)),
        "notes": TableContract("notes", foreign_keys={"line": ("lines", "id")}),
    }
    seen = []
    settle = contracts.settle
    monkeypatch.setattr(contracts, "settle", lambda results, store: seen.extend(results) or settle(results, store))
    validate_all({"lines": lines, "notes": notes}, chosen, {"lines": ["at"], "notes": ["at"]}, Workspace(spark))
    assert [result.table for result in seen] == ["lines", "notes"]
    plan = seen[0].annotated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_a_parent_without_a_required_column_loses_all_keys(spark):
    raw = tables(spark, 3) | {"people": tables(spark, 3)["people"].drop("kind")}
    strict = CONTRACTS | {"people": TableContract("people", required=("id", "kind"), unique=("id",))}
    plain = validate_all(raw, strict, ORDER)
    fast = validate_all(raw, strict, ORDER, Workspace(spark))
    assert fast["orders"].clean().count() == fast["people"].clean().count() == 0
    for table in strict:
        assert rows(fast[table].issues()) == rows(plain[table].issues()), table


def test_a_cycle_is_an_error(spark):
    loop = {
        "a": TableContract("a", foreign_keys={"b": ("b", "id")}),
        "b": TableContract("b", unique=("id",), foreign_keys={"a": ("a", "b")}),
    }
    raw = {"a": spark.createDataFrame([(1,)], "b int"), "b": spark.createDataFrame([(1, 1)], "id int, a int")}
    with pytest.raises(ValueError, match="cycle"):
        validate_all(raw, loop, {"a": ["b"], "b": ["id"]}, Workspace(spark))


def test_the_ledger_counts_hot_keys_before_its_shuffle(spark):
    space = Workspace(spark)
    raw = {
        "people": space.save(spark.range(1000).selectExpr("id", "'a' as kind", "id as at"), "people"),
        "orders": space.save(spark.range(100_000).selectExpr("id", "if(id % 3 = 0, 0, id % 1000) as person", "id as at"), "orders"),
    }
    chosen = {name: CONTRACTS[name] for name in raw}
    ledger = contracts.key_ledger(raw, chosen)
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2
    assert plan.count("FileScan") == 2
    assert "at#" not in "".join(line for line in plan.splitlines() if "ReadSchema" in line)


@pytest.mark.parametrize("seed", range(3))
def test_packed_keys_reject_the_same_rows(spark, monkeypatch, seed):
    raw = tables(spark, seed)
    plain = validate_all(raw, CONTRACTS, ORDER)
    monkeypatch.setattr(contracts, "_FEW", 0)
    packed = validate_all(raw, CONTRACTS, ORDER, Workspace(spark))
    for table in CONTRACTS:
        assert rows(packed[table].issues()) == rows(plain[table].issues()), table


def test_packed_keys_leave_the_wide_table_where_it_is(spark, monkeypatch):
    ids = [-(2**63), -65, -64, -1, 0, 1, 62, 63, 64, 2**40, 2**63 - 1]
    lost = spark.createDataFrame([(k,) for k in ids[::2]], "owner long")
    frame = spark.createDataFrame([(n, k) for n, k in enumerate([*ids, None, 2])], "n int, owner long")
    contract = TableContract("t", foreign_keys={"owner": ("p", "id")})
    assert contracts._packed(lost, Workspace(spark), "few") is lost  # few keys are left to the planner
    monkeypatch.setattr(contracts, "_FEW", 0)
    packed = contracts._packed(lost, Workspace(spark), "packed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = contracts.mark(frame, contract, ["n"], {"t_owner_orphans": packed})
        plan = result.annotated._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan
        assert rows(result.rejected(), "n") == [(n,) for n in (0, 10, 11, 2, 4, 6, 8)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    twice = lost.union(lost)
    assert contracts._packed(twice, Workspace(spark), "twice") is twice  # bits do not tell that a key is there twice
    monkeypatch.setattr(contracts, "_WORDS", 3)
    assert contracts._packed(lost, Workspace(spark), "apart") is lost  # too many words to be sent to every task


def test_returns_are_taken_from_written_lines(spark, tmp_path):
    from lakemart.plans import star_queries
    from lakemart.sources.star import _SCHEMAS

    day = dt.datetime(2024, 1, 1)
    data = {
        "part": [(1, "p", "b", "t", 1, 1.0), (2, "p", "b", "t", 1, 2.0), (2, "p", "b", "t", 1, 2.0)],
        "lineitem": [
            (k % 3, k % 4, 1, k % 2, 1.0, price, 0.0, 0.0, flag, "O", day)
            for k in range(6)
            for price, flag in ((1.0 + k, "R"), (9.0 + k, "N"))
        ],
    }
    for name, table in data.items():
        spark.createDataFrame(table, _SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    star = star_queries.StarTables(spark, str(tmp_path))
    lines = star_queries.written(star, Workspace(spark))
    returns = star_queries.raw_table(lines, "returns")
    assert all("raw_order_items" in name for name in returns.inputFiles())
    assert "Join" not in returns._jdf.queryExecution().executedPlan().toString()
    assert rows(lines.order_items) == rows(star.order_items)
    assert returns.count() == star_queries.raw_table(star, "returns").count()
