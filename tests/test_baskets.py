import pytest
from pyspark.errors import PySparkException

from pointlake.operators import baskets as B
from pointlake.sources.transactions import parse_transactions, read_transactions

# Hand-derived from the fixture (FIXTURES.md §2).
EXPECTED = {
    "all": (39, [("22960", 7), ("21733", 4), ("22837", 4), ("37449", 4), ("21258", 3),
                 ("22865", 3), ("22961", 3), ("22969", 3), ("84879", 3), ("22632", 2),
                 ("84029E", 2), ("22633", 1)]),
    "United_Kingdom": (29, [("22837", 4), ("22960", 4), ("37449", 4), ("21258", 3),
                            ("22865", 3), ("21733", 2), ("22632", 2), ("84029E", 2),
                            ("84879", 2), ("22633", 1), ("22961", 1), ("22969", 1)]),
    "Italy": (11, [("22960", 4), ("21733", 2), ("22961", 2), ("22632", 1), ("22969", 1),
                   ("84879", 1)]),
    "Germany": (3, [("22960", 1), ("22969", 1), ("84029E", 1)]),
}


@pytest.mark.parametrize("country", list(EXPECTED))
def test_popularity_fixture(spark, fixture_path, country):
    txn = read_transactions(spark, fixture_path("transactions_50.csv"), partitions=3)
    assert txn.count() == 50
    n_pairs, listing = EXPECTED[country]
    pairs = B.product_customer_pairs(txn, country, on_error="fail")
    assert B.pair_count(pairs).first()[0] == n_pairs
    salted = B.product_customer_pairs_salted(txn, country, buckets=4, on_error="fail")
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, pairs.collect()))
    pop1 = B.product_popularity(pairs)
    pop2 = B.product_popularity_distinct(txn, country, on_error="fail")
    top = B.top_products(pop1, len(listing))
    assert [(r.product_id, r.popularity) for r in top.collect()] == listing
    by_product = [(r.product_id, r.popularity) for r in B.top_products(pop2, 0).collect()]
    assert by_product == sorted(listing)
    check = B.popularity_crosscheck(pop1, pop2).first()
    assert (check.n_products, check.n_mismatch) == (len(listing), 0)


def _txn(spark, lines, on_error="fail"):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return parse_transactions(df, on_error)


def test_return_row_with_bad_customer_is_ignored(spark):
    t = _txn(spark, ["T1,P1,d,-3,2010-12-01 08:26:00,1.0,,Italy",
                     "T2,P1,d,2,2010-12-01 08:26:00,1.0,7,Italy"])
    assert [tuple(r) for r in B.product_customer_pairs(t, "all", "fail").collect()] == [("P1", 7)]


def test_purchase_with_bad_customer_other_country_is_ignored(spark):
    t = _txn(spark, ["T1,P1,d,3,2010-12-01 08:26:00,1.0,,Germany",
                     "T2,P1,d,2,2010-12-01 08:26:00,1.0,7,Italy"])
    assert B.pair_count(B.product_customer_pairs(t, "Italy", "fail")).first()[0] == 1


def test_purchase_with_bad_customer_matching_country(spark):
    rows = ["T1,P1,d,3,2010-12-01 08:26:00,1.0,,Italy", "T2,P2,d,2,2010-12-01 08:26:00,1.0,7,Italy"]
    with pytest.raises(PySparkException):
        B.product_customer_pairs(_txn(spark, rows), "Italy", "fail").collect()
    kept = B.product_customer_pairs(_txn(spark, rows, "drop"), "Italy", "drop").collect()
    assert [tuple(r) for r in kept] == [("P2", 7)]


def test_purchase_without_country(spark):
    rows = ["T1,P1,d,3,2010-12-01 08:26:00,1.0,5,", "T2,P2,d,2,2010-12-01 08:26:00,1.0,7,Italy"]
    with pytest.raises(PySparkException):
        B.product_customer_pairs(_txn(spark, rows), "all", "fail").collect()
    kept = B.product_customer_pairs(_txn(spark, rows, "drop"), "all", "drop").collect()
    assert [tuple(r) for r in kept] == [("P2", 7)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["T1,P1,d,x,2010-12-01,1.0,5,Italy", "T,P3"])
def test_malformed_quantity_fails_or_drops(spark, ansi, bad):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [bad, "T2,P2,d,2,2010-12-01,1.0,7,Italy"]
        with pytest.raises(PySparkException):
            _txn(spark, rows).collect()
        with pytest.raises(PySparkException):
            B.pair_count(B.product_customer_pairs(_txn(spark, rows), on_error="fail")).collect()
        assert _txn(spark, rows, "drop").count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_negative_h_rejected(spark):
    pop = spark.createDataFrame([("a", 1)], "product_id string, popularity bigint")
    with pytest.raises(ValueError):
        B.top_products(pop, -1)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.sampled_from(["P1", "P2", "P3", "P4"]), st.integers(-3, 5),
                           st.integers(1, 6), st.sampled_from(["A", "B", "C"])),
                 min_size=1, max_size=40)


@settings(max_examples=5, deadline=None)
@given(_rows, st.sampled_from(["all", "A", "C"]))
def test_pair_and_popularity_plans_agree(spark, rows, country):
    txn = spark.createDataFrame(
        [(f"T{i}", p, q, c, ctry) for i, (p, q, c, ctry) in enumerate(rows)],
        "transaction_id string, product_id string, quantity int, customer_id int, country string")
    want = {(p, c) for (p, q, c, ctry) in rows if q > 0 and (country == "all" or ctry == country)}
    pairs = {tuple(r) for r in B.product_customer_pairs(txn, country).collect()}
    salted = {tuple(r) for r in B.product_customer_pairs_salted(txn, country, buckets=3).collect()}
    assert pairs == salted == want
    pop1 = {r.product_id: r.popularity for r in B.product_popularity(
        B.product_customer_pairs(txn, country)).collect()}
    pop2 = {r.product_id: r.popularity for r in B.product_popularity_distinct(txn, country).collect()}
    assert pop1 == pop2 == {p: sum(1 for (pp, _) in want if pp == p) for p in {p for p, _ in want}}
