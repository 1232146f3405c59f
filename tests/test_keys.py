import pytest
from files import as_set
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from rowproof import CompareSpec, MissingKeys, compare
from rowproof.operators import keys as K
from rowproof.plans.report import first_key_side_by_side
from rowproof.spec import parse_keys


def both_plans(reference, delivered, keys):
    return [
        compare(reference, delivered, CompareSpec.of(keys, small_delivered=small))
        for small in (True, False)
    ]


def test_null_parts_match_nothing(spark):
    reference = spark.createDataFrame([(None, "n")] * 2 + [(1, "a"), (2, None)], "k int, j string")
    delivered = spark.createDataFrame([(None, "n")] * 2 + [(1, "a"), (2, None)], "k int, j string")
    for result in both_plans(reference, delivered, "k,j"):
        assert as_set(result.keys_present()) == [(1, "a")]
        assert as_set(result.keys_delivered_only()) == [(2, None), (None, "n")]
        assert as_set(result.keys_reference_only()) == [(2, None), (None, "n")]
        assert as_set(result.keys_status()) == sorted(
            [(1, "a", "both"), (2, None, "delivered_only"), (2, None, "reference_only"),
             (None, "n", "delivered_only"), (None, "n", "reference_only")], key=repr)
        row = result.summary().head()
        assert (row.common_keys, row.delivered_only_keys, row.reference_only_keys) == (1, 2, 2)
        assert as_set(result.match_percent()) == [(1, 2, 33.33, 66.67)]


def test_text_keys_against_numbers(spark):
    reference = spark.createDataFrame([(1,), (2,), (7,), (None,)], "k int")
    delivered = spark.createDataFrame(
        [("1",), ("01",), ("3",), ("03",), ("zz",), ("zz",), ("yy",), ("1.5",), (None,)], "K string"
    )
    for result in both_plans(reference, delivered, "k"):
        assert as_set(result.keys_present()) == [(1,)]
        assert as_set(result.keys_delivered_only()) == sorted(
            [("03",), ("zz",), ("yy",), ("1.5",), (None,)], key=repr)
        assert as_set(result.keys_reference_only()) == [(2,), (7,), (None,)]
        row = result.summary().head()
        assert (row.common_keys, row.delivered_only_keys, row.reference_only_keys) == (1, 5, 3)
        assert as_set(result.match_percent()) == [(1, 5, 16.67, 83.33)]
        statuses = {(r.k, r.status) for r in result.keys_status().collect()}
        assert ("1", "both") in statuses and ("03", "delivered_only") in statuses
        assert len(statuses) == 9


def test_numbers_match_only_when_equal(spark):
    reference = spark.createDataFrame([(1,), (2,)], "k int")
    delivered = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (3e10,)], "k double")
    for result in both_plans(reference, delivered, "k"):
        assert as_set(result.keys_present()) == [(1,), (2,)]
        assert as_set(result.keys_delivered_only()) == [(1.5,), (3e10,)]


def test_day_does_not_match_a_time_within_it(spark):
    reference = spark.sql("SELECT DATE'2024-01-01' AS k")
    delivered = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 00:00:00'), "
        "(TIMESTAMP_NTZ'2024-01-01 10:30:00') AS t(k)"
    )
    result = compare(reference, delivered, "k")
    assert result.keys_present().count() == 1
    assert result.keys_delivered_only().count() == 1


def test_smallest_spelling_is_one_delivered_row(spark):
    reference = spark.createDataFrame([(9, 9)], "a int, b int")
    delivered = spark.createDataFrame([("1", "01"), ("01", "1")], "a string, b string")
    for result in both_plans(reference, delivered, "a,b"):
        assert as_set(result.keys_delivered_only()) == [("01", "1")]


def test_empty_delivered_side(spark):
    reference = spark.createDataFrame([(1,)], "k int")
    delivered = spark.createDataFrame([], "k int")
    for result in both_plans(reference, delivered, "k"):
        row = result.summary().head()
        assert (row.reference_rows, row.delivered_rows, row.reference_only_keys) == (1, 0, 1)
        assert row.match_percent is None and row.non_match_percent is None
        assert as_set(result.match_percent()) == [(0, 0, None, None)]


def test_both_sides_empty(spark):
    empty = spark.createDataFrame([], "k int")
    row = compare(empty, empty, "k").summary().head()
    assert (row.reference_rows, row.delivered_rows, row.common_keys) == (0, 0, 0)


def test_names_in_any_case_and_with_dots(spark):
    reference = spark.createDataFrame([(1, 2)], ["Order.ID", "x"])
    delivered = spark.createDataFrame([(1, 2)], ["ORDER.id", "y"])
    result = compare(reference, delivered, ["order.Id"])
    assert result.keys_present().columns == ["order.id"]
    assert result.keys_present().count() == 1
    assert result.keys_status().head().status == "both"


def test_keys_may_be_named_like_result_columns(spark):
    names = ["status", "present", "n_reference", "on_delivered", "row_no", "__found"]
    reference = spark.createDataFrame([(1,) * 6, (2,) * 6], names)
    delivered = spark.createDataFrame([(1,) * 6, (3,) * 6], names)
    for small in (True, False):
        result = compare(reference, delivered, CompareSpec.of(names, small_delivered=small))
        assert result.summary().head().common_keys == 1
        assert result.match_percent().head().n_present == 1
        assert as_set(result.keys_delivered_only()) == [(3,) * 6]
        assert as_set(result.keys_present()) == [(1,) * 6]
        assert as_set(result.keys_found("known")) == [(*(1,) * 6, True), (*(3,) * 6, False)]
        assert result.keys_status("label").count() == 3
        assert as_set(first_key_side_by_side(result)) == [(1, "1", "3")]
        for refused in (result.keys_status, result.keys_found):
            with pytest.raises(ValueError, match="a key is named"):
                refused()


def test_found_keys_appear_as_delivered(spark):
    reference = spark.createDataFrame([(1,)], "k int")
    delivered = spark.createDataFrame([("01",), ("x",), ("01",)], "k string")
    for result in both_plans(reference, delivered, "k"):
        assert as_set(result.keys_found()) == [("01", True), ("x", False)]


def test_missing_and_repeated_keys(spark):
    one = spark.createDataFrame([(1, 2)], ["k", "x"])
    two = spark.createDataFrame([(1, 2)], ["k", "K"])
    with pytest.raises(MissingKeys, match="delivered side lacks key column.s. x"):
        compare(one, two, "x")
    with pytest.raises(MissingKeys, match="delivered side has key column.s. k more than once"):
        compare(one, two, "k")


def test_key_list():
    assert parse_keys(" P1 , p2,") == ("p1", "p2")
    for bad in ("", None, "a,,b", "a,A"):
        with pytest.raises(ValueError):
            parse_keys(bad)


def test_repeated_key_is_not_multiplied(spark):
    rows = [("one", i) for i in range(50)]
    side = spark.createDataFrame(rows, "k string, i int")
    result = compare(side, side, "k")
    assert result.keys_present().count() == 1


key_part = st.one_of(st.none(), st.integers(0, 4))
key_rows = st.lists(st.tuples(key_part, st.one_of(st.none(), st.sampled_from("ab"))), max_size=12)


@hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(key_rows, key_rows)
def test_results_agree_with_sets(spark, left, right):
    reference = spark.createDataFrame(left, "a int, b string")
    delivered = spark.createDataFrame(right, "a int, b string")
    usable = {r for r in left if None not in r}
    both = {r for r in right if r in usable}
    result = compare(reference, delivered, "a,b")
    status = {tuple(r) for r in result.keys_status().collect()}
    assert status == (
        {(*k, K.BOTH) for k in both}
        | {(*k, K.DELIVERED_ONLY) for k in set(right) - both}
        | {(*k, K.REFERENCE_ONLY) for k in set(left) - both}
    )
    for small in (True, False):
        frame = K.presence(result.pair, small)
        assert as_set(K.present_keys(frame, result.pair)) == sorted(both, key=repr)
        assert as_set(K.absent_keys(frame, result.pair)) == sorted(set(right) - both, key=repr)
    swapped = compare(delivered, reference, "a,b")
    assert as_set(swapped.keys_reference_only()) == as_set(result.keys_delivered_only())
    row = result.summary().head()
    assert row.common_keys + row.delivered_only_keys == len(set(right))
