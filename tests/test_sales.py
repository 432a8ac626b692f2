import pytest

from conftest import SF_SMALL, fixture
from corvid.operators import sales
from corvid.plans import oracle_sql
from corvid.plans.compare import compare_frames
from corvid.plans.inspect import plan_text
from corvid.sources import read_transactions, transactions


@pytest.fixture(scope="module")
def tx(spark):
    return read_transactions(spark, fixture("sales.csv")).cache()


@pytest.fixture(scope="module")
def sold():
    """(product, quantity, customer, country) rows of the file."""
    with open(fixture("sales.csv")) as f:
        cells = [line.split(",") for line in f.read().splitlines()]
    return [(c[1], int(c[3]), int(c[6]), c[7]) for c in cells]


def pairs(df):
    return [(r.product, r.popularity) for r in df.collect()]


@pytest.mark.parametrize("country", ["all", "Norland", "Nowhere"])
def test_file_matches_model(tx, sold, country):
    f = sales.sales_filtered(tx, country)
    want = {(p, c) for p, q, c, s in sold if q > 0 and country in ("all", s)}
    assert sales.product_customer_count(f).first().pairs == len(want)
    for H in (0, 1, 3, 50):
        assert pairs(sales.top_products(sales.popularity_reduced(f), H)) == popularity_model(sold, country, H)
    assert pairs(sales.products_listing(sales.popularity_grouped(f))) == popularity_model(sold, country, 0)


def test_orphans_fall_out_of_every_table_query(spark):
    """Transactions need their order, customer and nation."""
    from corvid.sources import tables

    keep = {"customer": "c_custkey % 10 <> 3", "orders": "o_orderkey % 7 <> 1", "nation": "n_nationkey <> 7"}
    real = tables.table
    tables.table = lambda s, d, n: real(s, d, n).filter(keep.get(n, "true"))
    try:
        got = sales.popularity_reduced(sales.sales_filtered(transactions(spark, SF_SMALL), "all", 10.0)).toPandas()
    finally:
        tables.table = real
    import duckdb

    con = duckdb.connect()
    for n in ("customer", "orders", "nation", "lineitem"):
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF_SMALL}/{n}.parquet' WHERE {keep.get(n, 'true')}")
    want = con.execute(oracle_sql.sales_sql("NATION_7", 10, 10.0)["popularity_reduced"]).df()
    ok, msg = compare_frames(got, want)
    assert ok, msg


def test_grouped_equals_reduced(tx):
    f = sales.sales_filtered(tx, "all")
    assert sorted(pairs(sales.popularity_grouped(f))) == sorted(pairs(sales.popularity_reduced(f)))


def test_quantity_threshold(spark):
    df = spark.createDataFrame(
        [("p", 0, "1", "X"), ("p", 2, "2", "X"), ("q", 5, "bad", "Y")],
        "product string, quantity int, customer string, country string",
    )
    # The bad customer value sits on a row the country filter drops.
    out = sales.popularity_reduced(sales.sales_filtered(df, "X"))
    assert pairs(out) == [("p", 1)]
    out = sales.popularity_reduced(sales.sales_filtered(df, "X", min_quantity=2))
    assert pairs(out) == []


def test_top_k_plan_and_pushdown(spark):
    df = sales.top_products_by_country(transactions(spark, SF_SMALL), "NATION_7", 10)
    text = plan_text(df)
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(n_name,NATION_7)" in text  # country filter reached the nation scan
    assert "GreaterThan(l_quantity,0.0)" in text  # quantity filter reached the lineitem scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def popularity_model(rows, country, H):
    pairs = {(p, c) for p, q, c, s in rows if q > 0 and (country == "all" or s == country)}
    pop = {}
    for p, _ in pairs:
        pop[p] = pop.get(p, 0) + 1
    items = list(pop.items())
    if H == 0:
        return sorted(items)
    items.sort(key=lambda x: x[0], reverse=True)  # product descending breaks ties
    items.sort(key=lambda x: x[1], reverse=True)  # stable: popularity descending first
    return items[:H]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top_products_match_model(spark, seed):
    import random

    rnd = random.Random(seed)
    products = ["10", "9", "100", "A1", "a1", "B"]
    rows = [
        (rnd.choice(products), rnd.choice([-1, 0, 1, 2]), str(rnd.randint(1, 6)), rnd.choice(["X", "Y"]))
        for _ in range(60)
    ]
    df = spark.createDataFrame(rows, "product string, quantity int, customer string, country string")
    for country in ("all", "X"):
        for H in (0, 1, 3, 10):
            pop = sales.popularity_reduced(sales.sales_filtered(df, country))
            assert pairs(sales.top_products(pop, H)) == popularity_model(
                [(p, q, int(c), s) for p, q, c, s in rows], country, H
            )


def _write(tmp_path, text):
    p = tmp_path / "tx.csv"
    p.write_text(text)
    return str(p)


def test_reader_fails_on_short_line_and_bad_quantity(spark, tmp_path):
    short = _write(tmp_path, "1,P,desc,2,2010-01-01 00:00:00,1.0,7\n")
    with pytest.raises(Exception):
        read_transactions(spark, short).collect()
    bad_q = tmp_path / "q"
    bad_q.mkdir()
    (bad_q / "tx.csv").write_text("1,P,desc,x,2010-01-01 00:00:00,1.0,7,Italy\n")
    with pytest.raises(Exception):
        sales.sales_filtered(read_transactions(spark, str(bad_q)), "all").collect()


def test_reader_has_no_quoting_and_parses_customer_late(spark, tmp_path):
    path = _write(
        tmp_path,
        '1,P,"quoted desc,2,2010-01-01 00:00:00,1.0,7,Italy\n'
        "2,Q,plain ,3,2010-01-01 00:00:00,1.0,oops,Germany\n",
    )
    tx = read_transactions(spark, path)
    rows = sorted((r.product, r.description) for r in tx.collect())
    assert rows == [("P", '"quoted desc'), ("Q", "plain ")]
    assert pairs(sales.popularity_reduced(sales.sales_filtered(tx, "Italy"))) == [("P", 1)]
    with pytest.raises(Exception):
        sales.popularity_reduced(sales.sales_filtered(tx, "Germany")).collect()


def test_reader_restates_empty_field_rules(spark, tmp_path):
    row = "{t},{p},d,{q},2010-01-01 00:00:00,1.0,{c},{s}\n"
    ok = tmp_path / "ok"
    ok.mkdir()
    (ok / "a.csv").write_text(row.format(t=1, p="", q=2, c=7, s="Italy") + row.format(t=2, p="P", q=1, c=7, s="Italy"))
    got = sorted(pairs(sales.popularity_reduced(sales.sales_filtered(read_transactions(spark, str(ok)), "all"))))
    assert got == [("", 1), ("P", 1)]
    for bad_q, bad_s in (("", "Italy"), ("1", "")):
        d = tmp_path / f"bad{bad_q}{bad_s}"
        d.mkdir()
        (d / "a.csv").write_text(row.format(t=3, p="R", q=bad_q, c=9, s=bad_s))
        with pytest.raises(Exception, match="empty quantity or no country"):
            sales.sales_filtered(read_transactions(spark, str(d)), "all").collect()
