"""Quality checks: the reference's own cases, counting units, NULL rules, fusion."""

import pytest

from ledgerline.operators import checks as Q


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_duplicates_counts_groups_not_rows(spark):
    # the reference's case: two equal rows → one failed group
    df = spark.createDataFrame([("ORD1", "C1"), ("ORD1", "C1")], ["order_id", "customer_id"])
    r = _one(Q.no_duplicates(df, ["order_id"], "duplicate_orders"))
    assert r.passed is False and r.failed_rows == 1
    df = spark.createDataFrame([("A",), ("A",), ("A",), ("B",), ("B",), (None,), (None,), ("C",)], "order_id string")
    assert _one(Q.no_duplicates(df, ["order_id"], "d")).failed_rows == 3  # A, B and the NULL key


def test_positive_passes_for_valid_amounts(spark):
    # the reference's case
    df = spark.createDataFrame([(1000.0,), (2500.0,)], ["payment_amount_mmk"])
    r = _one(Q.single(df, Q.positive("payment_amount_mmk", "payments_positive")))
    assert r.passed is True and r.failed_rows == 0


def test_sign_checks_and_nulls(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (5.0,)], "v double")
    rows = Q.run_row_checks(df, [Q.positive("v", "pos"), Q.non_negative("v", "nonneg")]).collect()
    got = {r.check_name: r.failed_rows for r in rows}
    assert got == {"pos": 2, "nonneg": 1}  # NULL passes both


def test_non_null_any_column_and_empty_list(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("c", "d"), (None, None)], "x string, y string")
    assert _one(Q.single(df, Q.non_null(["x", "y"], "nn"))).failed_rows == 3
    r = _one(Q.single(df, Q.non_null([], "none")))
    assert r.failed_rows == 0 and r.message == "Null check on []"


def test_valid_timestamp_counts_unparsed(spark):
    from ledgerline.functions.scalars import parse_timestamp

    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("garbage",), (None,)], "t string")
    parsed = df.select(parse_timestamp("t").alias("t"))  # ANSI on: try_cast, not an error
    assert _one(Q.single(parsed, Q.valid_timestamp("t", "ts"))).failed_rows == 2


def test_references_counts_orphan_rows_and_null_keys(spark):
    fact = spark.createDataFrame([("C1",), ("C1",), ("C9",), ("C9",), (None,)], "customer_id string")
    dim = spark.createDataFrame([("C1",), ("C2",)], "id string")
    r = _one(Q.references(fact, dim, "customer_id", "id", "ref"))
    assert r.failed_rows == 3 and r.message == "Reference check for customer_id"


def test_amount_match_is_strict(spark):
    from decimal import Decimal as D

    df = spark.createDataFrame(
        [(D("100.00"), D("101.00")), (D("100.00"), D("101.01")), (None, D("1.00"))], "a decimal(18,2), b decimal(18,2)"
    )
    assert _one(Q.single(df, Q.amount_match("a", "b", 1.0, "m"))).failed_rows == 1


def test_allowed_pairs_counts_distinct_bad_pairs(spark):
    df = spark.createDataFrame(
        [("Yangon", "Yangon Region"), ("Bogus", "X"), ("Bogus", "X"), ("Yangon", None), ("Bago", "Shan State")],
        "city string, region string",
    )
    r = _one(Q.allowed_pairs(df, "city", "region", Q.VALID_CITY_REGION_PAIRS, "pairs"))
    assert r.failed_rows == 3  # (Bogus, X) once, the NULL pair, the mismatched pair


def test_raise_lists_failed_checks(spark):
    df = spark.createDataFrame([(None,), ("x",)], "k string")
    results = Q.union_results([Q.single(df, Q.non_null(["k"], "keys")), Q.single(df, Q.non_null([], "empty"))])
    with pytest.raises(Q.QualityCheckError, match=r"Data quality checks failed: keys\(1\)$"):
        Q.raise_for_failed(results)


def test_row_checks_are_one_scan(spark):
    df = spark.range(100).selectExpr("id", "cast(id - 50 as double) AS v", "if(id % 7 = 0, null, id) AS w")
    out = Q.run_row_checks(df, [Q.positive("v", "a"), Q.non_negative("v", "b"), Q.non_null(["w"], "c")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1
    got = {r.check_name: r.failed_rows for r in out.collect()}
    assert got == {"a": 51, "b": 50, "c": 15}


def test_reconciliation_can_include_orders_without_items(spark):
    from decimal import Decimal as D

    orders = spark.createDataFrame([("O1", D("10.00")), ("O2", D("5.00"))], "order_id string, subtotal_amount_mmk decimal(18,2)")
    items = spark.createDataFrame([("O1", D("10.00"))], "order_id string, net_line_amount_mmk decimal(18,2)")
    assert Q.reconciliation(items, orders).count() == 1  # the reference's inner join hides O2
    both = Q.reconciliation(items, orders, include_orders_without_items=True)
    assert _one(Q.single(both, Q.amount_match("recalc_subtotal_mmk", "subtotal_amount_mmk", 1.0, "m"))).failed_rows == 1


def test_suite_names_every_check_once_in_order(spark):
    from decimal import Decimal as D

    orders = spark.createDataFrame(
        [("O1", "C1", None, "Yangon", "Yangon Region", D("1.00"))],
        "order_id string, customer_id string, order_timestamp timestamp_ntz, city string, region string, subtotal_amount_mmk decimal(18,2)",
    )
    items = spark.createDataFrame(
        [("O1", "P1", D("1.00"), 1, D("5.00"))],
        "order_id string, product_id string, unit_price_mmk decimal(18,2), quantity int, net_line_amount_mmk decimal(18,2)",
    )
    payments = spark.createDataFrame([(None, D("-1.00"))], "paid_at timestamp_ntz, payment_amount_mmk decimal(18,2)")
    deliveries = spark.createDataFrame([("Bago", None)], "city string, region string")
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    products = spark.createDataFrame([("P2",)], "product_id string")
    rows = Q.in_suite_order(Q.silver_suite(orders, orders, items, payments, deliveries, customers, products).collect())
    assert tuple(r.check_name for r in rows) == Q.SUITE_CHECKS
    failed = [r.check_name for r in rows if not r.passed]
    assert failed == ["orders_timestamp_valid", "payments_timestamp_valid", "deliveries_region_city_mapping",
                      "order_items_product_reference", "payment_amount_non_negative", "order_subtotal_reconciliation"]


def test_copy_count_from_dedupe_equals_raw_duplicate_check(spark):
    from ledgerline.operators.dedupe import keep_latest

    raw = spark.createDataFrame(
        [("A", "1"), ("A", "2"), ("A", "2"), ("B", "1"), ("B", "1"), (None, "x"), (None, "y"), ("C", "1"), (None, None)],
        "order_id string, v string",
    )
    deduped = keep_latest(raw, ["order_id"], copies="_copies")
    assert deduped.columns == ["order_id", "v", "_copies"]
    got = {r.order_id: (r.v, r._copies) for r in deduped.collect()}
    assert got == {"A": ("2", 3), "B": ("1", 2), None: ("y", 3), "C": ("1", 1)}
    fused = _one(Q.single(deduped, Q.duplicated_groups("_copies", ["order_id"], "d")))
    direct = _one(Q.no_duplicates(raw, ["order_id"], "d"))
    assert (fused.failed_rows, fused.message) == (direct.failed_rows, direct.message) == (3, direct.message)


def test_fused_suite_equals_suite_over_raw_orders(spark):
    from tests.conftest import SF_SMALL
    from ledgerline.plans import catalog as K

    s = K.LazySilver(spark, SF_SMALL)
    unfused = Q.silver_suite(
        K.raw(spark, SF_SMALL, "orders"), s["orders"], s["order_items"], s["payments"], s["deliveries"],
        s["customers"], s["products"], pairs=K.NATION_PAIRS,
    )
    fused = K.quality_report(spark, SF_SMALL)
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, unfused.collect()))
    dup = [r for r in fused.collect() if r.check_name == "orders_duplicates"]
    assert len(dup) == 1


def test_fused_duplicate_count_equals_raw_grouping_on_random_rows(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from ledgerline.operators.dedupe import keep_latest

    key = st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D"]))
    row = st.tuples(key, st.one_of(st.none(), st.sampled_from(["x", "y"])))

    @settings(max_examples=12, deadline=None)
    @given(st.lists(row, min_size=0, max_size=20))
    def check(rows):
        raw = spark.createDataFrame(rows, "order_id string, v string")
        fused = _one(Q.single(keep_latest(raw, ["order_id"], copies="_copies"), Q.duplicated_groups("_copies", ["order_id"], "d")))
        direct = _one(Q.no_duplicates(raw, ["order_id"], "d"))
        expected = sum(1 for k in {r[0] for r in rows} if sum(1 for r in rows if r[0] == k) > 1)
        assert fused.failed_rows == direct.failed_rows == expected

    check()


def test_reference_and_pair_checks_on_random_rows(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    val = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
    allowed = [("a", "a"), ("b", "c")]

    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.tuples(val, val), min_size=0, max_size=20), st.lists(val, min_size=0, max_size=4))
    def check(rows, dim_keys):
        df = spark.createDataFrame(rows, "x string, y string")
        dim = spark.createDataFrame([(k,) for k in dim_keys], "k string")
        orphans = _one(Q.references(df, dim, "x", "k", "r")).failed_rows
        known = {k for k in dim_keys if k is not None}
        assert orphans == sum(1 for x, _ in rows if x is None or x not in known)  # NULL never matches
        bad = _one(Q.allowed_pairs(df, "x", "y", allowed, "p")).failed_rows
        assert bad == len({(x, y) for x, y in rows if (x, y) not in allowed})  # distinct pairs, NULL fails

    check()


def test_reconciliation_and_amount_check_on_random_orders(spark):
    from decimal import Decimal as Dec

    from hypothesis import given, settings
    from hypothesis import strategies as st

    money = st.sampled_from([Dec("0.00"), Dec("0.99"), Dec("1.00"), Dec("1.01"), Dec("5.00")])
    orders_st = st.dictionaries(st.sampled_from(["O1", "O2", "O3"]), money, max_size=3)
    items_st = st.lists(st.tuples(st.sampled_from(["O1", "O2", "O3", "O4"]), money), max_size=8)

    @settings(max_examples=12, deadline=None)
    @given(orders_st, items_st, st.booleans())
    def check(orders, items, include_empty):
        o = spark.createDataFrame(list(orders.items()), "order_id string, subtotal_amount_mmk decimal(18,2)")
        i = spark.createDataFrame(items, "order_id string, net_line_amount_mmk decimal(18,2)")
        recon = Q.reconciliation(i, o, include_orders_without_items=include_empty)
        sums = {}
        for oid, amount in items:
            sums[oid] = sums.get(oid, Dec("0.00")) + amount
        expected = {oid: (sums.get(oid, Dec("0.00")), sub) for oid, sub in orders.items() if include_empty or oid in sums}
        assert {r.order_id: (r.recalc_subtotal_mmk, r.subtotal_amount_mmk) for r in recon.collect()} == expected
        gap = Q.amount_match("recalc_subtotal_mmk", "subtotal_amount_mmk", 1.0, "m")
        failed = _one(Q.single(recon, gap)).failed_rows
        assert failed == sum(1 for a, b in expected.values() if abs(a - b) > Dec("1.00"))  # strict

    check()


def test_fused_row_checks_equal_each_check_alone_on_random_rows(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    num = st.one_of(st.none(), st.sampled_from([-2.0, -0.5, 0.0, 0.5, 3.0]))

    @settings(max_examples=10, deadline=None)
    @given(st.lists(st.tuples(num, num), max_size=15))
    def check(rows):
        df = spark.createDataFrame(rows, "a double, b double")
        checks = [Q.non_null(["a", "b"], "nn"), Q.positive("a", "pos"), Q.non_negative("b", "nonneg")]
        fused = {r.check_name: r.failed_rows for r in Q.run_row_checks(df, checks).collect()}
        alone = {c.name: _one(Q.single(df, c)).failed_rows for c in checks}
        assert fused == alone == {
            "nn": sum(1 for a, b in rows if a is None or b is None),
            "pos": sum(1 for a, _ in rows if a is not None and a <= 0),
            "nonneg": sum(1 for _, b in rows if b is not None and b < 0),
        }

    check()
