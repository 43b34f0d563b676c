"""Pages of stored lists against lists that are ranked whole, and what a page reads."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from payx.catalog import Inputs
from payx.operators import graph, listing


@pytest.fixture(scope="module")
def some(spark):
    """A hot list of 5,000 rows, 300 short ones, and values that tie."""
    n = F.col("id")
    return spark.range(6200).select(F.when(n < 5000, "hot").otherwise(F.concat(F.lit("k"), n % 300)).alias("k"), (F.xxhash64("id") % 50).alias("v"), F.concat(F.lit("t"), n).alias("tie"), F.lit(None).cast("string").alias("other"))


@pytest.fixture(scope="module")
def stored(spark, some, tmp_path_factory):
    of = listing.Listing(str(tmp_path_factory.mktemp("lists") / "a"), ("k",), (("v", True), ("tie", False)), 100)
    listing.store(some, of, 7, F.sum("v").alias("sum_v"))
    return of


def ranked(some):
    return some.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "tie")))


def rows(df):
    return sorted(str(r.asDict()) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("key,offset,limit", [("hot", 0, 50), ("hot", 777, 50), ("hot", 690, 1500), ("hot", 4990, 50), ("hot", 6000, 50), ("k7", 0, 50), ("k7", 2, 1), ("none", 0, 5)])
def test_a_page_equals_the_ranked_list(spark, some, stored, key, offset, limit):
    want = ranked(some).where((F.col("k") == key) & (F.col("place") > offset) & (F.col("place") <= offset + limit))
    assert rows(listing.page(spark, stored, {"k": key}, offset, limit)) == rows(want)


def test_every_list_has_all_its_places(spark, some, stored):
    assert rows(listing.pages(spark, stored, 0, 10**6)) == rows(ranked(some))
    assert rows(listing.pages(spark, stored, 2, 3, F.col("k") != "hot")) == rows(ranked(some).where("k <> 'hot' and place between 3 and 5"))


def test_pages_follow_cursors_to_the_end(spark, some, stored):
    want = [(r["v"], r["tie"]) for r in ranked(some).where("k = 'hot'").orderBy("place").collect()]
    at = 3300
    for limit in (1, 130, 5000):
        got = listing.page_after(spark, stored, {"k": "hot"}, want[at], limit).collect()
        assert [(r["v"], r["tie"]) for r in got] == want[at + 1 : at + 1 + limit]
    # Cursors that are no row: before all, between rows, after all.
    first = listing.page_after(spark, stored, {"k": "hot"}, (10**6, ""), 3).collect()
    assert [(r["v"], r["tie"]) for r in first] == want[:3]
    between = listing.page_after(spark, stored, {"k": "hot"}, (want[at][0], want[at][1] + " "), 2).collect()
    assert [(r["v"], r["tie"]) for r in between] == want[at + 1 : at + 3]
    assert listing.page_after(spark, stored, {"k": "hot"}, (-(10**6), ""), 3).count() == 0


def test_every_list_after_its_own_cursor(spark, some, stored):
    whole = ranked(some)
    cursors = whole.where("place = 2 and k <> 'hot' or place = 2468 and k = 'hot'")
    want = whole.where("k <> 'hot' and place between 3 and 42 or k = 'hot' and place between 2469 and 2508").withColumn("place", F.col("place") - F.when(F.col("k") == "hot", 2468).otherwise(2))
    assert rows(listing.pages_after(spark, stored, cursors.select("k", "v", "tie"), 40)) == rows(want)


def test_totals_are_of_whole_lists(spark, some, stored):
    assert rows(listing.totals(spark, stored)) == rows(some.groupBy("k").agg(F.count(F.lit(1)).alias("total"), F.sum("v").alias("sum_v")))


def test_a_page_opens_the_files_of_its_range_only(spark, stored):
    assert len(spark.read.parquet(f"{stored.path}/rows").inputFiles()) == 7
    page = listing.page(spark, stored, {"k": "hot"}, 2000, 50)
    assert len(page.inputFiles()) == 1
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq" in plan and "Exchange" not in plan and "Window" not in plan


def test_nulls_are_refused_and_empty_lists_have_no_rows(spark, some, tmp_path):
    of = listing.Listing(str(tmp_path / "null"), ("k",), (("v", True), ("tie", False)))
    with pytest.raises(Exception, match="null in v"):
        listing.store(some.withColumn("v", F.when(F.col("v") != 3, F.col("v"))), of, 3)
    of = of._replace(path=str(tmp_path / "empty"))
    listing.store(some.limit(0), of, 3)
    assert listing.page(spark, of, {"k": "hot"}, 0, 10).count() == listing.pages(spark, of, 0, 10).count() == 0
    assert listing.page_after(spark, of, {"k": "hot"}, (1, ""), 10).count() == 0


def test_repeated_rows_keep_a_place_each(spark, tmp_path):
    of = listing.Listing(str(tmp_path / "twice"), ("k",), (("v", False),), 2)
    listing.store(spark.createDataFrame([("a", 1)] * 5 + [("a", 0)], "k string, v int"), of, 3)
    assert [r["place"] for r in listing.page(spark, of, {"k": "a"}, 0, 10).orderBy("place").collect()] == [1, 2, 3, 4, 5, 6]


def test_counterparties_of_one_subject(spark, sf_dir, tmp_path):
    x = Inputs(spark, sf_dir)
    lists = graph.counterparty_lists(str(tmp_path / "c"), "txns")
    graph.store_counterparties(x.edge, x.fedge, lists, 4)
    want = graph.counterparty_page(x.edge, x.fedge, x.labels, "payers", "all", "txns", 3, 20).persist()
    subject = want.groupBy("subject").count().orderBy(F.desc("count"), "subject").first()["subject"]
    got = graph.stored_counterparty_page(spark, lists, x.labels, "payers", "all", 3, 20, subject)
    assert got.count() > 0 and rows(got) == rows(want.where(F.col("subject") == subject))


def test_steps_are_stored_once_and_files_follow_the_rows(spark, sf_dir, stored, monkeypatch):
    from payx import catalog

    steps = spark.read.parquet(f"{stored.path}/steps")
    assert rows(steps) == rows(spark.read.parquet(f"{stored.path}/index").drop("base"))
    assert steps.agg(F.sum("n")).first()[0] == 6200
    x = Inputs(spark, sf_dir)
    monkeypatch.setattr(catalog, "FILE", 100)
    assert catalog.files(x, 3) == -(-3 * spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 100)
    monkeypatch.setattr(catalog, "FILE", 10**9)
    assert catalog.files(x, 3) == 4
