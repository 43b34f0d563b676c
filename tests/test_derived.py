"""State kept beside an ingest equals a computation from all payments."""

import os

import pytest
from pyspark.sql import functions as F

from payx.operators import classify, cube, entities, graph
from payx.schema import PAYMENT
from payx.sources import testdata
from payx.streaming import commits, derived


@pytest.fixture
def payments(spark, sf_dir):
    p = testdata.payments(spark, sf_dir).where("day between '1995-03-01' and '1995-04-20'")
    like = spark.createDataFrame([], PAYMENT).schema
    return p.select(*[(F.col(f.name) if f.name in p.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in like]).persist()


def rows(df):
    columns = sorted(df.columns)
    return sorted(str([r[c] for c in columns]) for r in df.collect())


def test_state_after_ten_batches_equals_a_full_computation(spark, sf_dir, payments, tmp_path, monkeypatch):
    base, path = str(tmp_path / "base"), str(tmp_path / "state")
    allow = testdata.allowlist(spark, sf_dir)
    order = F.when(F.col("day") < "1995-04-10", F.pmod(F.xxhash64("tx_hash"), F.lit(7))).otherwise(7 + F.pmod(F.xxhash64("tx_hash"), F.lit(3)))
    batches = payments.withColumn("b", order).persist()
    seen = {}
    for i in (0, 1, 2, 7, 3, 8, 4, 5, 6, 9):  # older days come after newer ones
        commit = commits.new_commit(i)
        commits.write(batches.where(F.col("b") == i).drop("b"), base, "payments", commit, "day")
        commits.append(spark, base, commit, i, spark.createDataFrame([(i, i + 1)], "from_block long, to_block long"))
        if i in (1, 5):
            continue  # two commits are taken up at once
        if i == 7:
            with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
                m.setattr(derived, "pair_days", lambda _: (_ for _ in ()).throw(OSError("lost")))
                derived.refresh(spark, base, allow, path)
        files = {os.path.join(d, f) for d, _, fs in os.walk(f"{path}/pair_days") for f in fs if f.endswith(".parquet")}
        derived.refresh(spark, base, allow, path)
        if i == 9:
            days = {str(r[0]) for r in batches.where("b = 9").select("day").distinct().collect()}
            after = {os.path.join(d, f): d.rsplit("day=")[-1] for d, _, fs in os.walk(f"{path}/pair_days") for f in fs if f.endswith(".parquet")}
            assert {after[f] for f in after if f not in files} == days and len(days) < len(set(after.values()))
    derived.refresh(spark, base, allow, path)  # nothing new: nothing done
    p = classify.with_membership(payments, allow)
    seen = derived.tables(spark, path)
    assert rows(seen["active_entities"]) == rows(cube.active_entities(p))
    assert rows(seen["payer_cohorts"]) == rows(cube.payer_cohorts(p))
    assert rows(seen["entity_aggregate"]) == rows(entities.entity_aggregate(p))
    assert rows(seen["entity_counterparties"]) == rows(graph.entity_counterparties(graph.edges(p), graph.facilitator_edges(p)))
    pairs = derived.read(spark, path, "pairs")
    assert pairs.count() == pairs.distinct().count() == p.select(derived.WHO).distinct().count()


def test_no_payments_no_state(spark, sf_dir, tmp_path):
    derived.refresh(spark, str(tmp_path / "none"), testdata.allowlist(spark, sf_dir), str(tmp_path / "state"))
    assert derived.read(spark, str(tmp_path / "state"), "pairs").count() == 0
