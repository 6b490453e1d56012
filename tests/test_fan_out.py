"""Several targets from one scan of their source."""

import pytest
from pyspark.sql import functions as F

import model
from medallion.operators.transform import fan_out_labelled
from medallion.sources import SourceRequest, open_source
from medallion.streaming import tables
from medallion.streaming.flows import Branch, Flow, FlowFailed, run_fan_out, run_flows
from medallion.streaming.tables import Target
from test_pipeline import Setup

ITEMS = [(i, f"n{i}", i * 1.5) for i in range(10)]


@pytest.fixture
def setup(spark, tmp_path):
    return Setup(spark, tmp_path)


def bronze(spark, root, rows=ITEMS, batch=0):
    target = Target(path=str(root / "bronze"))
    tables.append(spark.createDataFrame(rows, "id int, name string, price double"), target, "feed", batch)
    return open_source(SourceRequest(spark, "table", {"path": target.path}))


def branches_of(root, source, wanted):
    return [
        Branch(Flow(n, source, Target(path=str(root / n)), str(root / "cp" / n)), e, p) for n, (e, p) in wanted.items()
    ]


WANTED = {
    "cheap": (["id", "price"], ["price < 5"]),
    "names": (["upper(name) AS name", "id % 2 = 0 AS even"], ["name <> 'N3'", " "]),
    "nothing": (["id"], ["id > 100"]),
    "all": ([], []),
}


def expected(spark, root, name):
    rows = tables.read(spark, str(root / "bronze"))
    expressions, predicates = WANTED[name]
    shown = rows.selectExpr(*expressions) if expressions else rows
    for p in predicates:
        shown = shown.where(p) if p.strip() else shown
    return sorted(map(tuple, shown.collect()), key=repr)


def test_targets_with_columns_of_their_own(spark, tmp_path):
    source = bronze(spark, tmp_path)
    branches = branches_of(tmp_path, source, WANTED)
    for batch in (1, 2):
        run_fan_out(spark, "items", source, branches, str(tmp_path / "cp" / "fan"))
        for b in branches:
            found = tables.read(spark, b.flow.target.path)
            assert sorted(map(tuple, found.collect()), key=repr) == expected(spark, tmp_path, b.flow.name)
        bronze(spark, tmp_path, [(20 + batch, "late", 1.0)], batch)
    assert tables.read(spark, str(tmp_path / "cheap")).columns == ["id", "price"]
    assert not list((tmp_path / "cp" / "fan" / "staged").iterdir())


def test_one_scan(spark, tmp_path):
    rows = bronze(spark, tmp_path).read()
    plan = fan_out_labelled(rows, WANTED, own_columns=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_a_repeated_batch_goes_on(spark, tmp_path, monkeypatch):
    source = bronze(spark, tmp_path)
    branches = branches_of(tmp_path, source, WANTED)
    declare, seen = tables.declare_append, []

    def failing(spark, target, schema):
        seen.append(target.path)
        if target.path.endswith("nothing"):
            raise RuntimeError("lost")
        return declare(spark, target, schema)

    monkeypatch.setattr(tables, "declare_append", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_fan_out(spark, "items", source, branches, str(tmp_path / "cp" / "fan"))
    monkeypatch.setattr(tables, "declare_append", declare)
    run_fan_out(spark, "items", source, branches, str(tmp_path / "cp" / "fan"))
    for b in branches:
        found = tables.read(spark, b.flow.target.path)
        assert sorted(map(tuple, found.collect()), key=repr) == expected(spark, tmp_path, b.flow.name)


def test_columns_that_do_not_agree(spark):
    rows = spark.createDataFrame(ITEMS, "id int, name string, price double")
    with pytest.raises(ValueError, match="another type"):
        fan_out_labelled(rows, {"a": (["id AS x"], []), "b": (["name AS x"], [])}, own_columns=True)
    # a filter on the source's price, which the other branch has made something else
    with pytest.raises(ValueError, match="may mean"):
        fan_out_labelled(rows, {"a": (["id"], ["price > 3"]), "b": (["price * 2 AS price"], [])}, own_columns=True)
    found = fan_out_labelled(rows, {"a": (["id"], ["price > 3"]), "b": (["id AS other"], [])}, own_columns=True)
    assert found.where("target = 'a'").count() == 7


PROJECTIONS = [
    {"target_table": "items_clean", "select_exp": ["id", "price"]},
    {"target_table": "cheap", "select_exp": ["concat('n', id) AS name"], "where_clause": ["name <> 'n1'"]},
    {"target_table": "more", "select_exp": ["price"], "where_clause": ["price > 2"]},
]


def test_silver_tables_of_a_pipeline(setup, spark):
    """Two tables begin together; one that comes later reads everything from the start."""
    setup.write("projections.json", PROJECTIONS)
    setup.write("in/first.csv", "ts,id,price\n1,1,1.5\n1,2,2.5\n1,3,3.5\n")
    keys = ("data_flow_group", "bronze_database_dev", "bronze_table", "silver_database_dev",
            "silver_transformation_json_dev")
    other = {k: v for k, v in setup.record().items() if k in keys}
    setup.onboard(setup.record())
    setup.onboard({**other, "data_flow_id": "104", "silver_table": "cheap"}, layers=["silver"], overwrite=False)
    setup.run(fan_out=True)
    assert setup.rows("cheap") == [("n2",), ("n3",)] and len(setup.rows("items_clean")) == 3
    assert (setup.root / "checkpoints" / "fan_out" / "items" / "0").exists()
    setup.onboard({**other, "data_flow_id": "105", "silver_table": "more"}, layers=["silver"], overwrite=False)
    setup.write("in/later.csv", "ts,id,price\n2,4,9.5\n")
    setup.run(fan_out=True)
    assert setup.rows("cheap") == [("n2",), ("n3",), ("n4",)] and len(setup.rows("items_clean")) == 4
    assert setup.rows("more") == [(2.5,), (3.5,), (9.5,)]
    with pytest.raises(ValueError, match="run them together"):
        setup.run("silver", ids="'104'", fan_out=True)


def test_flows_have_pools_of_their_own(spark, tmp_path):
    """Settings of the thread reach the batches of a stream and end with it."""
    source = bronze(spark, tmp_path)
    seen = {}

    def look(name):
        def transform(df):
            seen[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            return df.withColumn("by", F.lit(name))

        return transform

    flows = [
        Flow(n, source, Target(path=str(tmp_path / n)), str(tmp_path / "cp" / n), transform=look(n)) for n in ("a", "b")
    ]
    run_flows(spark, flows)
    assert seen == {n: f"{tmp_path / n} {n}" for n in ("a", "b")}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert model.rows(tables.read(spark, str(tmp_path / "a")))[0][-1] == "a"
    with pytest.raises(FlowFailed):
        run_flows(spark, [Flow("c", source, Target(path=str(tmp_path / "c")), str(tmp_path / "cp" / "c"),
                               transform=lambda df: df.where("nowhere = 1"))])
