"""A whole rebuild: checks, generations and pages."""

import datetime
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from payx.catalog import Inputs
from payx.plans import rebuild


def document(path):
    """The document whose files, in the order of their names, are in a folder."""
    return json.loads("".join(f.read_text() for f in sorted(pathlib.Path(path).glob("part-*"))))


def test_rebuild_publishes_one_generation_after_another(spark, sf_dir, tmp_path):
    x, base, now = Inputs(spark, sf_dir), str(tmp_path), datetime.datetime(2024, 1, 1)
    p = x.p.where("day >= '2001-01-01'").persist()
    rebuild.rebuild(p, x.cancels, x.prices, base, "1", now)
    first = rebuild.current(spark, base, "metrics_daily").agg(F.sum("txn_count")).first()[0]
    assert first == p.count()
    page = document(f"{base}/generation=1/pages/economy")
    assert page["methodology_version"] == 1 and {"windows", "daily", "gas"} <= set(page["data"])
    with pytest.raises(ValueError, match="inconsistent"):
        rebuild.rebuild(p, x.cancels, x.prices.where("week < '2001-06-01'"), base, "2", now + datetime.timedelta(minutes=1))
    assert [r[0] for r in rebuild.published(spark, base).collect()] == ["1"]
    with pytest.raises(ValueError, match="has been published"):
        rebuild.rebuild(p, x.cancels, x.prices, base, "1", now)
    with pytest.raises(ValueError, match="not as of"):
        rebuild.rebuild(p, x.cancels, x.prices, base, "4", now + datetime.timedelta(minutes=1), datetime.date(1999, 1, 1))
    with pytest.raises(ValueError, match="would not be newer"):
        rebuild.rebuild(p, x.cancels, x.prices, base, "5", now - datetime.timedelta(hours=1))
    rebuild.rebuild(p, x.cancels, x.prices, base, "3", now + datetime.timedelta(hours=1))
    assert rebuild.current(spark, base, "mechanics_window").where("nonce_reuse is not null").count() == 1
    mechanics = document(f"{base}/generation=3/pages/mechanics")
    assert {"windows", "cost", "blocks", "velocity", "selectors"} <= set(mechanics["data"])
    assert rebuild.current(spark, base, "metrics_daily").agg(F.sum("txn_count")).first()[0] == first


def test_a_table_of_another_version_is_not_published(spark, sf_dir):
    p = Inputs(spark, sf_dir).p.where("day >= '2001-10-01'").persist()
    made = rebuild.stamp(p)
    one = p.groupBy("facilitator_known", "methodology_version").agg(F.max("day").alias("day"))
    rebuild.require({"a": one}, made)
    with pytest.raises(ValueError, match="another version"):
        rebuild.require({"a": one, "b": one.withColumn("methodology_version", F.lit(2))}, made)
    with pytest.raises(ValueError, match="not as of"):
        rebuild.require({"entity_day": one.where("not facilitator_known").withColumns({"facilitator_known": F.lit(True), "day": F.lit("1999-01-01").cast("date")})}, made)


def test_two_versions_have_no_stamp(spark, sf_dir):
    p = Inputs(spark, sf_dir).p.limit(10).withColumn("methodology_version", F.monotonically_increasing_id())
    with pytest.raises(ValueError, match="published"):
        rebuild.require({}, rebuild.stamp(p.withColumn("facilitator_known", F.lit(True))))


def test_nothing_is_current_at_first(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing is published"):
        rebuild.current(spark, str(tmp_path), "metrics_daily")


def test_what_goes_by_transaction_needs_no_shuffle_in_buckets(spark, sf_dir):
    from payx.operators import gas, graph
    from payx.sources.batches import store_by_transaction

    x = Inputs(spark, sf_dir)
    p = x.p.where("day < '1995-03-01'").persist()
    spark.sql("DROP TABLE IF EXISTS payments_by_transaction")
    stored = store_by_transaction(p, "payments_by_transaction", 4)
    made = {"transactions": gas.per_transaction, "costs": lambda p: gas.apportioned(p, x.prices), "graph": lambda p: graph.transaction_graph(p)[0]}
    for name, make in made.items():
        df = make(stored)
        columns = sorted(df.columns)
        rows = lambda d: sorted(str([r[c] for c in columns]) for r in d.collect())  # noqa: B023, E731
        assert rows(df) == rows(make(p)), name
        plan = make(stored.select(stored.columns))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(chain" not in plan and "Exchange hashpartitioning(tx_hash" not in plan, name
    spark.sql("DROP TABLE payments_by_transaction")


def test_every_version_in_one_pass(spark, sf_dir):
    from payx.operators import classify, cube

    x = Inputs(spark, sf_dir)
    got = cube.every_version_cube(x.raw, x.allow)
    assert sorted(r[0] for r in classify.versions(x.allow).collect()) == [1, 2]
    want = cube.daily_cube(classify.with_membership(x.raw, x.allow, 1)).unionByName(cube.daily_cube(classify.with_membership(x.raw, x.allow, 2)))
    rows = lambda d: sorted(str([r[c] for c in sorted(d.columns)]) for r in d.collect())
    assert rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("lineitem.parquet") == 1


def test_large_pages_are_written_in_parts(spark, tmp_path):
    n = 5000
    rows = spark.range(n).select(F.concat(F.lit("f"), F.lpad(F.xxhash64("id").cast("string"), 20, "0")).alias("facilitator"), F.concat(F.lit('a "quoted"\nline '), "id").alias("label"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"))
    ranks = spark.range(120).select(F.lit("all").alias("window_name"), (F.col("id") + 1).alias("rank"))
    twice = spark.createDataFrame([("x",)] * 3, "w string")
    made = spark.range(1).select(F.lit(1).alias("methodology_version"), F.lit("2024-01-01").cast("timestamp").alias("built_at"), F.lit("2024-01-01").cast("date").alias("data_through_day"))
    of = {"large": {"rows": (rows, ("facilitator",)), "ranks": (ranks, ("window_name", "rank")), "none": (ranks.where("rank < 0"), ("rank",)), "twice": (twice, ("w",))}, "empty": {"rows": (ranks.limit(0), ("rank",))}}
    rebuild.write_pages(of, made, str(tmp_path), 500)
    data = document(tmp_path / "pages/large")
    assert data["methodology_version"] == 1 and data["data_through_day"] == "2024-01-01"
    data = data["data"]
    want = sorted(rows.collect(), key=lambda r: r["facilitator"])
    assert [(r["facilitator"], r["label"], r.get("n")) for r in data["rows"]] == [tuple(r) for r in want]
    assert [r["rank"] for r in data["ranks"]] == list(range(1, 121)) and data["none"] == [] and data["twice"] == [{"w": "x"}] * 3
    assert document(tmp_path / "pages/empty")["data"] == {"rows": []}
    sizes = [len(f.read_text().splitlines()) for f in (tmp_path / "pages/large").glob("part-*")]
    assert len(sizes) == 11 and max(sizes) < 1000


def test_checks_make_payments_once_and_find_the_same_faults(spark, sf_dir, tmp_path):
    x = Inputs(spark, sf_dir)
    p, prices = x.p, x.prices.where("week < '1998-06-01'")
    got = rebuild.stored_violations(p, x.cancels, prices, str(tmp_path / "a"))
    q = p.where("day >= '1997-01-01'").persist()
    few = lambda made: sorted(tuple(r) for r in made.collect())
    found = few(rebuild.stored_violations(q, x.cancels, prices, str(tmp_path / "b")))
    assert found == few(rebuild.violations(q, rebuild.tables(q, x.cancels, prices), prices))
    assert {"price_coverage"} <= {check for check, _ in found}
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "orders.parquet" not in plan and "customer.parquet" not in plan
