"""FIXTURES.md section 5: Tables 2, 3a, 3b from given cells and population."""

import pytest

from covtab.operators import (
    coverage,
    coverage_table,
    crosstab,
    crosstab_table,
    known_by_org,
    publish_coverage,
    publish_crosstab,
    publish_rates,
    rate_crosstab,
)

DOMAIN = ("A", "B", "C", "D")


@pytest.fixture(scope="module")
def cells_pop(spark):
    cells = spark.createDataFrame(
        [("O1", "Org One", "A", 104), ("O1", "Org One", "B", 7), ("O2", "Org Two", "A", 23), ("O2", "Org Two", "C", 8)],
        "org_code string, org_name string, category string, n long")
    pop = spark.createDataFrame(
        [("O1", "Org One", 123), ("O2", "Org Two", 31), ("O4", "Org Four", 9), ("O5", None, 3)],
        "org_code string, org_name string, alive long")
    return cells, pop


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_table_2(spark, cells_pop):
    cells, pop = cells_pop
    t2 = publish_coverage(coverage_table(coverage(pop, known_by_org(cells))))
    assert _rows(t2) == sorted([
        ("Org Four", "O4", "0", "10", "10", "0.0"),
        ("Org One", "O1", "110", "125", "10", "0.88"),
        ("Org Two", "O2", "30", "30", "0", "1.0"),
        ("TOTAL", "ZZZTOTAL", "140", "165", "20", "0.848"),
    ])


def test_table_3a_3b(spark, cells_pop):
    cells, pop = cells_pop
    cov = coverage(pop, known_by_org(cells))
    t3a = crosstab_table(crosstab(cells, cov, DOMAIN), DOMAIN)
    assert _rows(publish_crosstab(t3a, DOMAIN)) == sorted([
        ("Org One", "O1", "105", "*", "0", "0", "0", "10"),
        ("Org Two", "O2", "25", "0", "10", "0", "0", "0"),
        ("TOTAL", "ZZZTOTAL", "125", "*", "10", "0", "0", "10"),
    ])
    t2 = coverage_table(cov)
    t3b = rate_crosstab(t3a, t2, DOMAIN)
    assert _rows(publish_rates(t3b, DOMAIN)) == sorted([
        ("Org One", "O1", "0.84", "*", "0.0", "0.0", "0.0", "0.08"),
        ("Org Two", "O2", "0.833", "0.0", "0.333", "0.0", "0.0", "0.0"),
        ("TOTAL", "ZZZTOTAL", "0.758", "*", "0.061", "0.0", "0.0", "0.061"),
    ])


def test_table_2_parity(spark, cells_pop):
    cells, pop = cells_pop
    t2 = publish_coverage(coverage_table(coverage(pop, known_by_org(cells), parity=True), parity=True))
    rows = {r.org_name: tuple(r) for r in t2.collect()}
    # Original behaviour: the org without known rows gets the total code and unknown 0.
    assert rows["Org Four"] == ("Org Four", "ZZZTOTAL", "0", "10", "0", "0.0")
    assert rows["TOTAL"][4] == "10"


def test_out_of_domain_counts_are_published(spark):
    """Known 35 is 20 in the domain and 15 in ``other``."""
    cells = spark.createDataFrame([("O1", "Org One", "A", 20), ("O1", "Org One", "Q", 13), ("O1", "Org One", None, 2)],
                                  "org_code string, org_name string, category string, n long")
    pop = spark.createDataFrame([("O1", "Org One", 50)], "org_code string, org_name string, alive long")
    row = crosstab(cells, coverage(pop, known_by_org(cells)), DOMAIN).first()
    assert (row.A, row.other, row.unknown) == (20, 15, 15)


def test_nameless_org_is_in_no_table(spark):
    cells = spark.createDataFrame([("O1", "Org One", "A", 30), ("O2", None, "A", 30)],
                                  "org_code string, org_name string, category string, n long")
    pop = spark.createDataFrame([("O1", "Org One", 40), ("O2", None, 90)], "org_code string, org_name string, alive long")
    cov = coverage(pop, known_by_org(cells))
    t3a = crosstab_table(crosstab(cells, cov, DOMAIN), DOMAIN)
    total = {r.org_name: r for r in rate_crosstab(t3a, coverage_table(cov), DOMAIN).collect()}
    assert set(total) == {"Org One", "TOTAL"} and total["TOTAL"].A == 0.75


def test_parity_total_keeps_rows_with_equal_labels(spark):
    from covtab.operators import with_total

    rows = [("X", "O1", 60, 100), ("X", "O1", 60, 50), (None, None, None, 5), ("Y", None, None, 7)]
    df = spark.createDataFrame(rows, "org_name string, org_code string, known long, alive long")
    got = sorted(tuple(r) for r in with_total(df, ["known", "alive"], parity=True).select("org_name", "org_code", "alive").collect())
    assert got == sorted([("X", "O1", 100), ("X", "O1", 50), ("TOTAL", "ZZZTOTAL", 5), ("Y", "ZZZTOTAL", 7), ("TOTAL", "ZZZTOTAL", 162)])
