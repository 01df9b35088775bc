"""Star schemas from files: declared types, unmatched and repeated keys, and measures on top."""

import pytest

from casework.operators import sales
from casework.sources import star

DEALS = [
    (1, 10, 7, "Proposal", 100.0, None, "2024-03-01", None, "2024-01-01", "Open"),
    (2, 10, 8, "Proposal", 200.0, 80.0, "2024-03-01", None, "2024-01-01", "Open"),
    (3, 99, None, "Closed Won", 50.0, None, "2024-02-01", "2024-01-11", "2024-01-01", "Won"),
    (4, None, 7, "Unknown", 10.0, None, None, None, "2024-01-01", "Open"),
]
TABLES = {
    "accounts": [(10, "Acme", "Energy", "A"), (11, "Bolt", "Health", "B")],
    "users": [(7, "Ada", "North"), (8, "Bo", "South")],
    "stage_probability": [("Proposal", 40.0), ("Closed Won", 100.0)],
}


def write(spark, folder, format, **changed):
    for table in (star.SALES.fact, *star.SALES.dimensions):
        rows = changed.get(table.name, DEALS if table is star.SALES.fact else TABLES.get(table.name))
        text = ", ".join(c if not c.endswith(" date") else c.removesuffix("date") + "string" for c in table.columns.split(", "))
        df = star.declared(spark.createDataFrame(rows, text), table.schema, table.name)
        df.write.format(format).option("header", "true").save(f"{folder}/{table.name}.{format}")
    return star.from_folder(spark, str(folder), format)


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
def test_sales_star(spark, tmp_path, format):
    read = write(spark, tmp_path, format)
    deals = star.sales_deals(read)
    got = {r.deal_id: (r.account_name, r.owner, r.probability) for r in deals.collect()}
    assert got == {1: ("Acme", "Ada", 40.0), 2: ("Acme", "Bo", 80.0), 3: (None, None, 100.0), 4: (None, "Ada", None)}
    total = sales.deal_measures(deals).first()
    assert (total.deals, total.weighted, total.unweighted, total.avg_cycle_days) == (4, 250.0, 360.0, 10.0)
    assert {tuple(r) for r in star.orphans(star.SALES, read).collect()} == {("accounts", 1, 1), ("users", 0, 1), ("stage_probability", 1, 0)}


def test_repeated_keys_and_missing_columns_are_errors(spark, tmp_path):
    read = write(spark, tmp_path, "parquet", users=[(7, "Ada", "North"), (7, "Ida", "South"), (None, "x", "y"), (None, "x", "y")])
    with pytest.raises(ValueError, match="users has 2 rows with user_id = 7"):
        star.read_star(star.SALES, read)
    lacking = star.Star(star.Table("accounts", "account_id long, region string"))
    with pytest.raises(ValueError, match="accounts lacks the columns region"):
        star.read_star(lacking, read)


def test_empty_tables_and_taken_names(spark, tmp_path):
    empty = write(spark, tmp_path / "empty", "parquet", **{t.name: [] for t in (star.SALES.fact, *star.SALES.dimensions)})
    assert star.sales_deals(empty).count() == 0
    assert all((r.orphans, r.keyless) == (0, 0) for r in star.orphans(star.SALES, empty).collect())
    frames = {"f": spark.createDataFrame([(1, "a")], "ID int, label string"), "d": spark.createDataFrame([("1", "b", 5)], "id string, label string, extra int")}
    named = star.Star(star.Table("f", "id long, label string"), (star.Dimension("d", "id long, label string", "id", "id"),))
    got = star.read_star(named, lambda name, schema: frames[name])
    assert got.columns == ["id", "label", "d_label"] and [tuple(r) for r in got.collect()] == [(1, "a", "b")]
