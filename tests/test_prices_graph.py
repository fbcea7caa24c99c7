"""Market prices, product nodes, graph files, integrity check and MERGE."""

from __future__ import annotations

from basketgraph.operators import graph as g
from basketgraph.operators import prices as ops
from basketgraph.sources.files import read_market_prices, read_product_list
from basketgraph.sources.graph_files import read_graph_table, write_graph_table

from .conftest import rows

PRICE_HEADER = "Product,Date," + ",".join(f"c{i}" for i in range(2, 12)) + ",Spain\n"


def _price_row(name, month, price, n_cols=13):
    cells = [name, month] + ["x"] * 10 + [price]
    return ",".join(cells[:n_cols])


def _prices(spark, tmp_path):
    a = tmp_path / "prices-fruit.csv"
    b = tmp_path / "prices-dairy.csv"
    a.write_text(
        PRICE_HEADER
        + "\n".join(
            [
                _price_row("Apple", "2020/04", "1.0"),
                _price_row("Apple", "2020/05", "1.5"),
                _price_row("Apple", "2020/05", "1.7"),  # equal latest dates: highest price wins
                _price_row("Pear", "2020/05", ""),  # empty price: dropped
                _price_row("Pear", "2020/03", "2.0"),
                _price_row("Kiwi", "2020/05", "9.9"),  # name without product id
            ]
        )
        + "\n"
    )
    b.write_text(PRICE_HEADER + _price_row("Milk", "2020/01", "0.8") + "\n" + _price_row("Milk", "2020/02", "0.9", 12) + "\n")
    return read_market_prices(spark, [str(a), str(b)])


def _products(spark, tmp_path):
    p = tmp_path / "products.csv"
    p.write_text("ProductID,ProductName,Type\n1,Apple,Fruit\n2,Pear,Fruit\n3,Milk,Dairy\n4,Cheese,Dairy\n")
    return read_product_list(spark, str(p))


def test_latest_price_and_history(spark, tmp_path):
    obs, prods = _prices(spark, tmp_path), _products(spark, tmp_path)
    latest = rows(ops.latest_price(obs, key="product_name"), "product_name", "price")
    assert latest == [("Apple", 1.7), ("Kiwi", 9.9), ("Milk", 0.8), ("Pear", 2.0)]
    hist = ops.price_history(obs, prods, key="product_name")
    assert hist.count() == 5  # Kiwi has no id; the short Milk row and the empty Pear price are dropped
    assert ("P1", "20200501", 1.7) in rows(hist)


def test_product_nodes_override_and_fallback(spark, tmp_path):
    obs, prods = _prices(spark, tmp_path), _products(spark, tmp_path)
    market = ops.market_products(ops.latest_price(obs, key="product_name"), prods, key="product_name")
    lines = spark.createDataFrame(
        [("1", "apple desc"), ("4", ""), ("4", "CHEESE"), ("9", None)], "stock_code string, description string"
    )
    nodes = rows(ops.product_nodes(ops.sold_products(lines), market))
    # Milk (3) is priced but never sold: not a node. Cheese sold, not priced: price 0.
    assert nodes == [("P1", "Apple", 1.7), ("P4", "CHEESE", 0.0), ("P9", None, 0.0)]


def test_categories(spark, tmp_path):
    prods = _products(spark, tmp_path)
    edges = rows(ops.belongs_to_edges(prods, ops.category_nodes(prods)))
    assert edges == [("P1", "CAT_Fruit"), ("P2", "CAT_Fruit"), ("P3", "CAT_Dairy"), ("P4", "CAT_Dairy")]


def test_graph_file_round_trip(spark, tmp_path):
    p = tmp_path / "productNode.csv"
    p.write_text(':ID;nameproduct:string;marketpriceEU:double\nP1;"SET 2 ""RETRO"" TINS";1.5\nP2;plain;x\n')
    df = read_graph_table(spark, str(p))
    assert df.columns == ["id", "nameproduct", "marketpriceEU"]
    assert rows(df) == [("P1", 'SET 2 "RETRO" TINS', 1.5), ("P2", "plain", None)]
    out = tmp_path / "out"
    write_graph_table(df, str(out), single_file=True)
    again = read_graph_table(spark, str(out))
    assert rows(again) == rows(df)
    header = next(f for f in out.iterdir() if f.name.startswith("part-")).read_text().splitlines()[0]
    assert header == ":ID;nameproduct:string;marketpriceEU:double"


def test_integrity_reasons_and_counts(spark):
    nodes_o = spark.createDataFrame([("O1",), ("O2",)], "id string")
    nodes_p = spark.createDataFrame([("P1",), ("P2",)], "id string")
    edges = spark.createDataFrame(
        [("O1", "P1", 1), ("O1", "P1", 2), ("O9", "P1", 3), ("O1", "P9", 4), ("O9", "P9", 5)],
        "src string, dst string, line int",
    )
    valid = g.valid_edges(edges, nodes_o, nodes_p)
    rejected = g.rejected_edges(edges, nodes_o, nodes_p)
    assert valid.count() + rejected.count() == edges.count()
    assert rows(valid, "line") == [(1,), (2,)]  # parallel edges both kept
    assert rows(rejected, "line", "reason") == [(3, "missing_src"), (4, "missing_dst"), (5, "missing_both")]


def test_assemble_graph_report(spark):
    nodes = {
        "order": spark.createDataFrame([("O1",)], "id string"),
        "product": spark.createDataFrame([("P1",)], "id string"),
    }
    contains = spark.createDataFrame([("O1", "P1"), ("O1", "P2")], "src string, dst string")
    graph = g.assemble_graph(nodes, {"contains": g.EdgeSpec(contains, "order", "product")})
    assert graph.edges["contains"].count() == 1
    assert rows(graph.rejects) == [("contains", "O1", "P2", "missing_dst")]


def test_merge_edges_insert_if_absent(spark):
    existing = spark.createDataFrame([("P1", "C1")], "src string, dst string")
    new = spark.createDataFrame([("P1", "C1"), ("P2", "C1"), ("P2", "C1")], "src string, dst string")
    once = g.merge_edges(existing, new)
    twice = g.merge_edges(once, new)
    assert rows(once) == rows(twice) == [("P1", "C1"), ("P2", "C1")]


def test_latest_price_random_against_python(spark):
    import datetime as dt
    import random

    rnd = random.Random(11)
    obs = [
        (rnd.randrange(20), dt.date(2020, rnd.randint(1, 4), 1), float(rnd.randint(1, 6)))
        for _ in range(300)
    ]
    df = spark.createDataFrame(obs, "product_id long, price_date date, price double")
    expect = {}
    for k, d, p in obs:
        if k not in expect or (d, p) > expect[k]:
            expect[k] = (d, p)
    got = {r.product_id: (r.price_date, r.price) for r in ops.latest_price(df).collect()}
    assert got == expect


def test_price_rows_are_parsed_once(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(PRICE_HEADER + "\n".join([_price_row("Apple", "2020/04", "1.0"), _price_row("Pear", "2020/05", ""), _price_row('"a, ""b"""', "2020/05", "2.5"), "Milk,2020/01"]) + "\n")
    got = read_market_prices(spark, [str(path)])
    assert sorted((r.product_name, str(r.price_date), r.price) for r in got.collect()) == [("Apple", "2020-04-01", 1.0), ('a, "b"', "2020-05-01", 2.5)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
