"""Full rebuild of all derived tables, all or nothing, and publication as JSON.

A rebuild writes every table under generation=<id>, in an order in which each is read back before others derive from
it, checks them, and adds a line to the log of generations last; readers take the newest line, so they see the old
generation until the new one is whole, and at no time none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.operators import checks, cube, entities, gas, graph, mechanics, pricing, reliability, series

Keep = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]
#: Rows in one file of a published page, about.
PART = 100_000


def tables(p: DataFrame, cancellations: DataFrame, prices: DataFrame, keep: Keep = lambda made: made) -> dict[str, DataFrame]:
    """All derived tables by name. Those that others derive from go through `keep` first, which may write and reread
    them; tables that go through it together don't depend on each other."""
    t = keep({
        "metrics_daily": cube.daily_cube(p), "window_stats": pricing.window_stats(p), "price_points": pricing.price_points(p), "gas_daily": gas.gas_daily(p, prices), "active_entities": cube.active_entities(p), "velocity": cube.velocity(p), "payer_cohorts": cube.payer_cohorts(p), "entity_aggregate": entities.entity_aggregate(p),
        "reliability_window": reliability.reliability_windows(p, cancellations), "reliability_daily": reliability.reliability_daily(p, cancellations), "mechanics_window": mechanics.with_hygiene(mechanics.mechanics_windows(p), p), "mechanics_batch": mechanics.batches(p), "mechanics_block": mechanics.blocks(p), "mechanics_selector": mechanics.selectors(p),
        "entity_edge": graph.edges(p), "facilitator_edge": graph.facilitator_edges(p), "entity_day": graph.entity_days(p), "entity_price_point": graph.entity_price_points(p), "entity_leaderboard": graph.leaderboard(p),
    })
    agg = t["entity_aggregate"]
    return t | keep({"price_point_daily": pricing.price_breadth(p, t["price_points"]), "entity_rank": entities.entity_rank(agg), "entity_buckets": entities.entity_buckets(agg), "concentration": entities.concentration(agg)})


def stamp(p: DataFrame, built_at: Column | None = None) -> DataFrame:
    """One row: newest day, number of versions and the version. Fails later if there is not exactly one (see require)."""
    return p.agg(F.max("day").alias("max_day"), F.max(F.when(F.col("facilitator_known"), F.col("day"))).alias("data_through_day"), F.count_distinct("methodology_version").alias("versions"), F.min("methodology_version").alias("methodology_version")).withColumn("built_at", F.current_timestamp() if built_at is None else built_at)


def violations(p: DataFrame, t: dict[str, DataFrame], prices: DataFrame) -> DataFrame:
    """All checks over a generation's tables."""
    economy = cube.window_economy(t["metrics_daily"])
    found = [
        checks.bands_equal_windows(economy), checks.buckets_equal_concentration(t["entity_buckets"], t["concentration"]), checks.concentration_equals_economy(t["concentration"], economy), checks.reliability_consistent(t["reliability_window"]),
        checks.settlements_equal_economy(t["reliability_window"], economy), checks.settlements_equal_economy(t["mechanics_window"], economy, "mechanics_equal_economy"), checks.batches_equal_settlements(t["mechanics_batch"], t["mechanics_window"]),
        checks.cube_equals_view(t["metrics_daily"], p), checks.days_equal_view(t["entity_day"], p), checks.edges_equal_view(t["entity_edge"], p), checks.facilitator_edges_equal_view(t["facilitator_edge"], p), checks.known_only(cube.facilitators(t["metrics_daily"]), p), checks.finite(economy, "txn_count", "volume_usdc"),
        gas.conservation(p, t["gas_daily"]).select("check", F.col("drift").cast("string").alias("detail")), gas.missing_weeks(p, prices).where("weeks > 0").select(F.lit("price_coverage").alias("check"), F.col("missing").alias("detail")),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


#: Columns of the tables that several checks read, or one check several times; of others each is read once.
READ_AGAIN = {
    "metrics_daily": None, "entity_aggregate": ("window_name", "role", "address", "txn_count", "volume_usdc"), "concentration": None,
    "reliability_window": ("window_name", "membership", "settlement_count", "windowed_count", "expired_count", "not_yet_valid_count"), "mechanics_window": ("window_name", "membership", "settlement_count", "type0_count", "type1_count", "type2_count"),
}
#: Columns of payments that no table is made from.
UNREAD = ("log_index", "amount_raw", "called_contract")


def stored_violations(p: DataFrame, cancellations: DataFrame, prices: DataFrame, root: str) -> DataFrame:
    """All checks over the tables of payments that are not stored yet.

    The payments are made once, below root, and so are the tables that are read again; other tables are made in the
    job that checks them.
    """
    spark = p.sparkSession
    p = _kept(spark, root, "payments", p.drop(*UNREAD))

    def keep(many: dict[str, DataFrame]) -> dict[str, DataFrame]:
        again = {name: df.select(*(READ_AGAIN[name] or df.columns)) for name, df in many.items() if name in READ_AGAIN}
        return many | dict(zip(again, together(lambda name: _kept(spark, root, name, again[name]), again), strict=True))

    return violations(p, tables(p, cancellations, prices, keep), prices)


Sections = dict[str, tuple[DataFrame, tuple[str, ...]]]


def sections(t: dict[str, DataFrame]) -> dict[str, Sections]:
    """The sections of each published page, and the columns that each is ordered by."""
    t = {name: df if name == "metrics_daily" else df.drop("methodology_version") for name, df in t.items()}
    daily = t["metrics_daily"]
    economy = cube.window_economy(daily)
    entity = entities.entity_page(t["entity_rank"], t["entity_buckets"], t["concentration"])
    costs = gas.gas_windows(t["gas_daily"])
    return {
        "economy": {"windows": (economy, ("window_name", "band")), "daily": (cube.daily_series(daily), ("day",)), "monthly": (cube.monthly_series(daily), ("month",)), "stats": (t["window_stats"], ("window_name", "membership")), "price_points": (pricing.price_point_shares(t["price_points"], economy), ("window_name", "rank")), "gas": (costs, ("window_name", "band")), "cohorts": (series.cohort_shares(t["payer_cohorts"]), ("window_name",))},
        "facilitators": {"rows": (cube.facilitators(daily), ("facilitator",))},
        "payees": {"entities": (entity.where("role = 'payee'"), ("window_name",))},
        "payers": {"entities": (entity.where("role = 'payer'"), ("window_name",))},
        "reliability": {"windows": (reliability.reliability_rates(t["reliability_window"]), ("window_name", "membership")), "daily": (reliability.reliability_series(t["reliability_daily"]), ("day",))},
        "mechanics": {"windows": (t["mechanics_window"], ("window_name", "membership")), "cost": (gas.breakeven_share(costs), ("window_name", "band")), "cost_per_dollar": (gas.cost_per_dollar_daily(t["gas_daily"]), ("day",)), "blocks": (t["mechanics_block"], ("window_name",)), "velocity": (cube.velocity_windows(t["velocity"]), ("window_name",)), "batches": (mechanics.batch_shares(t["mechanics_batch"]), ("window_name", "bucket_order")), "selectors": (mechanics.named_selectors(t["mechanics_selector"]), ("window_name", "membership", "rank"))},
    }


def page_lines(of: dict[str, Sections], made: DataFrame) -> DataFrame:
    """(page, section, kind, key, line): all pages as lines of JSON. A row of a section is a line, and none is gathered.

    The lines of a page in the order of section, kind, key and line are its document, but for commas between rows. Its
    head has the stamp; a section opens with kind 0, has its rows with kind 1 and closes with kind 2.
    """
    fixed, rows = [], []
    for page, parts in of.items():
        fixed.append((page, -1, 0, None))
        for i, (name, (df, order)) in enumerate(parts.items()):
            fixed += [(page, i, 0, f'{"," if i else ""}"{name}":['), (page, i, 2, "]")]
            row = F.to_json(F.struct(*order, *[c for c in df.columns if c not in order]))
            rows.append(df.select(F.lit(page).alias("page"), F.lit(i).alias("section"), F.lit(1).alias("kind"), _key(df, order).alias("key"), row.alias("line")))
        fixed.append((page, len(parts), 0, "}}"))
    stamp_ = F.to_json(F.struct("methodology_version", F.lit("known facilitators").alias("scope"), F.col("built_at").alias("generated_at"), "data_through_day"))
    head = F.concat(F.expr("left(__stamp, length(__stamp) - 1)"), F.lit(',"data":{'))
    lines = F.array(*[F.struct(F.lit(p).alias("page"), F.lit(i).alias("section"), F.lit(k).alias("kind"), F.lit("").alias("key"), (head if line is None else F.lit(line)).alias("line")) for p, i, k, line in fixed])
    return reduce(lambda a, b: a.unionByName(b), rows, made.withColumn("__stamp", stamp_).select(F.inline(lines)))


def _key(df: DataFrame, order: tuple[str, ...]) -> Column:
    """The columns of an order as one string that sorts like them; whole numbers there are ranks, never negative."""
    types = dict(df.dtypes)
    one = lambda c: F.lpad(F.col(c).cast("string"), 20, "0") if types[c] in ("int", "bigint") else F.col(c).cast("string")
    return F.concat_ws("\x1f", *[one(c) for c in order])


def write_pages(of: dict[str, Sections], made: DataFrame, root: str, part: int = PART) -> None:
    """Write each page as JSON text below root/pages, about `part` rows a file. The files of a page one after another, in
    the order of their names, are one document; small pages are one file.

    The lines of a page are made in one job and written once. Then they are sorted by ranges, so that no task holds more
    of them than a file does, and every row but the first of its section gets a comma. Pages are made side by side.
    """
    spark, order = made.sparkSession, ["section", "kind", "key", "line", "id"]

    def write(page: str) -> None:
        lines = _kept(spark, f"{root}/page_lines", page, page_lines({page: of[page]}, made).withColumn("id", F.monotonically_increasing_id()))
        first = F.min_by("id", F.struct("key", "line", "id")).alias("first")
        parts = lines.groupBy("section", "kind").agg(F.count(F.lit(1)).alias("n"), first).collect()  # three rows a section at most
        later = (F.col("kind") == 1) & ~F.col("id").isin([r["first"] for r in parts if r["kind"] == 1])
        own = lines.repartitionByRange(-(-sum(r["n"] for r in parts) // part), *order).sortWithinPartitions(*order)
        own.select(F.when(later, F.concat(F.lit(","), "line")).otherwise(F.col("line")).alias("value")).write.mode("overwrite").text(f"{root}/pages/{page}")

    together(write, of, len(of))


def page_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a page that has one section, read back from its text."""
    row = F.regexp_replace("value", "^,", "")
    return spark.read.text(path).where(~F.col("value").rlike(r'^(?:"|\]|\}|\{"methodology_version")')).select(F.from_json(row, schema).alias("r")).select("r.*")


def versions(t: dict[str, DataFrame]) -> DataFrame:
    """(table, methodology_version) of all stored tables."""
    parts = [df.select(F.lit(name).alias("table"), "methodology_version").distinct() for name, df in t.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def require(t: dict[str, DataFrame], made: DataFrame, as_of: dt.date | None = None) -> None:
    """Raises unless all tables that have rows have the one version of the stamp, which must have known rows, and the
    generation ends on the publication's day."""
    row = made.first()
    if row is None or row["versions"] != 1 or row["data_through_day"] is None:
        raise ValueError(f"can't be published: {row}")
    odd = versions(t).where(F.col("methodology_version") != row["methodology_version"]).limit(5).collect()
    if odd:
        raise ValueError(f"can't be published, tables of another version than {row['methodology_version']}: {odd}")
    ends = checks.tables_end_with_the_data(t, as_of or row["data_through_day"]).limit(5).collect()
    if ends:
        raise ValueError(f"can't be published, not as of {as_of or row['data_through_day']}: {ends}")


def rebuild(p: DataFrame, cancellations: DataFrame, prices: DataFrame, base: str, generation: str, built_at: dt.datetime, as_of: dt.date | None = None) -> None:
    """Write all tables of a generation, check them, and make it the current one. Violations raise and change nothing.

    A generation that is in the log is never written again, and built_at must be later than that of all before. as_of is the day that the publication is for, by default
    the newest known one; tables must end on it.
    """
    spark, root = p.sparkSession, f"{base}/generation={generation}"
    before = published(spark, base).agg(F.max("built_at").alias("newest"), F.max(F.col("generation") == generation).alias("there")).first()
    if before["there"]:
        raise ValueError(f"generation {generation} has been published")
    if before["newest"] is not None and before["newest"] >= built_at:
        raise ValueError(f"generation {generation} of {built_at} would not be newer than that of {before['newest']}")
    # All tables are made from one state of the payments, whatever is ingested in the meantime.
    p = _kept(spark, root, "payments", p)
    made = _kept(spark, root, "stamp", stamp(p, F.lit(built_at)))
    version = made.first()["methodology_version"]

    def keep(many: dict[str, DataFrame]) -> dict[str, DataFrame]:
        whole = {name: df if "methodology_version" in df.columns else df.withColumn("methodology_version", F.lit(version)) for name, df in many.items()}
        return dict(zip(whole, together(lambda name: _kept(spark, root, name, whole[name]), whole), strict=True))

    t = tables(p, cancellations, prices, keep)
    bad = violations(p, t, prices).limit(20).collect()
    if bad:
        raise ValueError(f"generation {generation} is inconsistent: {bad}")
    require(t, made, as_of)
    write_pages(sections(t), made, root)
    # One file, put in place by one rename: a reader sees it whole or not at all.
    spark.createDataFrame([(generation, built_at)], LOG).coalesce(1).write.mode("append").parquet(f"{base}/generations")


def together(do: Callable, names, jobs: int | None = None) -> list:
    """do(name) of all names, some jobs at a time, so that the short ones don't wait for each other's last tasks."""
    with ThreadPoolExecutor(jobs or JOBS) as pool:
        return list(pool.map(do, names))


#: Tables that are written at one time; pages, whose inputs are small, all are.
JOBS = 4
LOG = "generation string, built_at timestamp"


def _kept(spark: SparkSession, root: str, name: str, df: DataFrame) -> DataFrame:
    df.write.mode("overwrite").parquet(f"{root}/{name}")
    return spark.read.schema(df.schema).parquet(f"{root}/{name}")


def published(spark: SparkSession, base: str) -> DataFrame:
    """The generations that were published, none at first."""
    try:
        return spark.read.schema(LOG).parquet(f"{base}/generations")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def current(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A table of the generation that was published last."""
    newest = published(spark, base).orderBy(F.desc("built_at"), F.desc("generation")).first()
    if newest is None:
        raise ValueError(f"nothing is published in {base}")
    return spark.read.parquet(f"{base}/generation={newest['generation']}/{table}")
