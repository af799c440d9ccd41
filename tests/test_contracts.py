import pytest

from lakemart.operators import contracts
from lakemart.operators.contracts import annotate, generations, validate_all
from lakemart.sources.lake import Workspace
from lakemart.sources.model import CONTRACTS, TABLES, TableContract
from tests.conftest import rows


def issue_rows(result, *keys):
    return rows(result.issues(*keys), "column_name", "issue_type", *keys, "value")


def test_required_rejects_null_and_empty_but_not_blanks(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, " ")], "n int, x string")
    result = annotate(frame, TableContract("t", required=("x",)), {}, ["n"])
    assert rows(result.clean(), "n") == [(1,), (4,)]
    assert issue_rows(result, "n") == [
        ("x", "missing_required_value", 2, None),
        ("x", "missing_required_value", 3, ""),
    ]


def test_missing_required_column_rejects_the_table_with_one_issue(spark):
    frame = spark.createDataFrame([(1, ""), (2, "b")], "n int, x string")
    result = annotate(frame, TableContract("t", required=("x", "y"), unique=("y",)), {}, ["n"])
    assert result.clean().count() == 0
    assert result.rejected().count() == 2
    assert issue_rows(result, "n") == [
        ("x", "missing_required_value", 1, ""),
        ("y", "missing_required_column", None, None),
    ]
    summary = result.summary().first()
    assert (summary.raw_rows, summary.clean_rows, summary.rejected_rows) == (2, 0, 2)
    assert (summary.validation_issues, summary.quality_score) == (2, 0.0)


def test_missing_column_survives_the_written_form(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n int, x string")
    done = validate_all({"t": frame}, {"t": TableContract("t", required=("x", "y"))}, {"t": ["n"]}, Workspace(spark))
    assert done["t"].clean().count() == 0
    assert issue_rows(done["t"], "n") == [("y", "missing_required_column", None, None)]


def test_unique_keeps_the_first_by_row_order_and_treats_nulls_as_equal(spark):
    data = [(3, "a"), (1, "a"), (2, "b"), (5, None), (4, None), (6, "a")]
    frame = spark.createDataFrame(data, "n int, k string")
    result = annotate(frame, TableContract("t", unique=("k",)), {}, ["n"])
    assert rows(result.clean(), "n") == [(1,), (2,), (4,)]
    assert issue_rows(result, "n") == [
        ("k", "duplicate_key", 3, "a"),
        ("k", "duplicate_key", 5, None),
        ("k", "duplicate_key", 6, "a"),
    ]


def test_unique_with_a_composite_row_order_that_holds_nulls(spark):
    data = [("x", None, 1), ("x", 2, 1), ("y", None, None)]
    frame = spark.createDataFrame(data, "k string, a int, b int")
    result = annotate(frame, TableContract("t", unique=("k",)), {}, ["a", "b"])
    assert result.clean().count() == 2
    assert result.rejected().count() == 1


def test_key_disappears_when_its_first_copy_breaks_another_rule(spark):
    frame = spark.createDataFrame([(1, "k", -5), (2, "k", 5)], "n int, k string, q int")
    result = annotate(frame, TableContract("t", unique=("k",), positive=("q",)), {}, ["n"])
    assert result.clean().count() == 0
    assert issue_rows(result, "n") == [("k", "duplicate_key", 2, "k"), ("q", "not_positive", 1, "-5")]


def test_number_rules_pass_nulls_and_unparsable_text(spark):
    data = [(1, "0"), (2, "-1"), (3, "abc"), (4, None), (5, "2.5"), (6, "NaN")]
    frame = spark.createDataFrame(data, "n int, q string")
    positive = annotate(frame, TableContract("t", positive=("q",)), {}, ["n"])
    assert rows(positive.rejected(), "n") == [(1,), (2,)]
    non_negative = annotate(frame, TableContract("t", non_negative=("q",)), {}, ["n"])
    assert rows(non_negative.rejected(), "n") == [(2,)]


def test_allowed_rejects_null_and_quotes_are_literal(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "it's"), (3, None), (4, "z")], "n int, s string")
    result = annotate(frame, TableContract("t", allowed={"s": ("a", "it's")}), {}, ["n"])
    assert rows(result.clean(), "n") == [(1,), (2,)]


def test_foreign_key_compares_across_types_and_rejects_null(spark):
    parent = spark.createDataFrame([("1",), ("2",)], "id string")
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (4, 2)], "n int, p bigint")
    contract = TableContract("child", foreign_keys={"p": ("parent", "id")})
    result = annotate(child, contract, {"parent": parent}, ["n"])
    assert rows(result.clean(), "n") == [(1,), (4,)]
    assert issue_rows(result, "n") == [
        ("p", "missing_fk:parent.id", 2, "9"),
        ("p", "missing_fk:parent.id", 3, None),
    ]


def test_foreign_key_is_skipped_without_parent_or_parent_column(spark):
    child = spark.createDataFrame([(1, 9)], "n int, p int")
    contract = TableContract("child", foreign_keys={"p": ("parent", "id")})
    other = spark.createDataFrame([(1,)], "x int")
    assert annotate(child, contract, {}, ["n"]).clean().count() == 1
    assert annotate(child, contract, {"parent": other}, ["n"]).clean().count() == 1


def test_empty_table_scores_full_marks(spark):
    frame = spark.createDataFrame([], "n int, x string")
    summary = annotate(frame, TableContract("t", required=("x",)), {}, ["n"]).summary().first()
    assert (summary.raw_rows, summary.clean_rows, summary.validation_issues, summary.quality_score) == (0, 0, 0, 100.0)


CHAIN = {
    "customers": TableContract("customers", non_negative=("balance",)),
    "orders": TableContract("orders", foreign_keys={"customer_id": ("customers", "customer_id")}),
    "items": TableContract(
        "items", unique=("item_id",), foreign_keys={"order_id": ("orders", "order_id")}
    ),
}
ORDER = {"customers": ["customer_id"], "orders": ["order_id"], "items": ["row"]}


def chain(spark):
    return {
        "customers": spark.createDataFrame([(1, 5), (2, -1)], "customer_id int, balance int"),
        "orders": spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "order_id int, customer_id int"),
        "items": spark.createDataFrame(
            [(1, "a", 10), (2, "a", 10), (3, "b", 11), (4, "c", 10)], "row int, item_id string, order_id int"
        ),
    }


def test_rejects_cascade_lazily_and_through_written_tables_alike(spark):
    for workspace in (None, Workspace(spark)):
        done = validate_all(chain(spark), CHAIN, ORDER, workspace)
        assert rows(done["orders"].clean(), "order_id") == [(10,)]
        assert rows(done["items"].clean(), "row") == [(1,), (4,)]
        assert rows(contracts.issue_counts(list(done.values()))) == [
            ("customers", "negative_value", 1),
            ("items", "duplicate_key", 1),
            ("items", "missing_fk:orders.order_id", 1),
            ("orders", "missing_fk:customers.customer_id", 2),
        ]
        summary = {r.table_name: r for r in contracts.contract_summary(list(done.values())).collect()}
        assert summary["orders"].quality_score == 33.33
        assert summary["items"].validation_issues == 2


def test_rejected_union_fills_absent_columns_with_nulls(spark):
    done = validate_all(chain(spark), CHAIN, ORDER)
    union = contracts.union_rejected(list(done.values()))
    assert union.columns == [
        "rejected_from", "customer_id", "balance", "order_id", "row", "item_id",
    ]
    assert union.where("rejected_from = 'items'").where("balance is null").count() == 2


def test_parents_come_before_children():
    level = {name: i for i, group in enumerate(generations(CONTRACTS)) for name in group}
    assert set(level) == set(TABLES)
    for name, contract in CONTRACTS.items():
        for parent, _ in contract.foreign_keys.values():
            assert level[parent] < level[name]


def test_hot_key_and_hot_null_are_flagged_row_by_row(spark):
    frame = spark.sql(
        "select id as n, if(id % 3 = 0, 'hot', if(id % 3 = 1, null, string(id))) as k from range(3000)"
    )
    result = annotate(frame, TableContract("t", unique=("k",)), {}, ["n"], Workspace(spark))
    assert result.clean().count() == 1000 + 2
    assert result.rejected().count() == 1998


def test_generations_do_not_depend_on_the_order_of_the_mapping():
    backwards = dict(reversed(CONTRACTS.items()))
    level = {name: i for i, group in enumerate(generations(backwards)) for name in group}
    for name, contract in CONTRACTS.items():
        assert all(level[parent] < level[name] for parent, _ in contract.foreign_keys.values())
    loop = {"a": TableContract("a", foreign_keys={"x": ("b", "x")}), "b": TableContract("b", foreign_keys={"x": ("a", "x")})}
    with pytest.raises(ValueError, match="cycle"):
        generations(loop)


def test_child_listed_before_its_parent_is_checked(spark):
    frames = {"items": spark.createDataFrame([(1, 7), (2, 8)], "n int, p int"), "parts": spark.createDataFrame([(7,)], "p int")}
    rules = {"items": TableContract("items", foreign_keys={"p": ("parts", "p")}), "parts": TableContract("parts")}
    done = validate_all(frames, rules, {"items": ("n",), "parts": ("p",)}, Workspace(spark))
    assert [r.n for r in done["items"].clean().collect()] == [1]


def test_more_rules_than_bits(spark):
    names = [f"c{k}" for k in range(130)]
    frame = spark.range(3).selectExpr("id", *[f"if(id = 1 and {k} >= 60, -1, 1) as {n}" for k, n in enumerate(names)])
    result = annotate(frame, TableContract("t", non_negative=tuple(names)), {}, ["id"])
    assert result.clean().columns == frame.columns
    assert [r.id for r in result.rejected().collect()] == [1]
    assert sorted(r.column_name for r in result.issues("id").collect()) == sorted(names[60:])
    assert result.summary().first().validation_issues == 70
