"""All registered queries of the payment operators, over the given tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payx import oracles
from payx.functions import amounts, hexes, sqlfunctions
from payx.operators import checks, classify, cube, decode, entities, gas, graph, listing, mechanics, pairing, pricing, reliability, series
from payx.plans import rebuild
from payx.schema import AUTHORIZATION_USED, CONTRACT_LABELS
from payx.sources import folders, reference, testdata
from payx.sources.batches import selected
from payx.streaming import commits, derived, minutes

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


class Inputs:
    """Tables of one query run; lazy, each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def raw(self) -> DataFrame:
        return self._once("raw", lambda: testdata.payments(self.spark, self.sf_dir))

    @property
    def allow(self) -> DataFrame:
        return self._once("allow", lambda: testdata.allowlist(self.spark, self.sf_dir))

    @property
    def p(self) -> DataFrame:
        return self._once("p", lambda: classify.with_membership(self.raw, self.allow))

    @property
    def prices(self) -> DataFrame:
        return self._once("prices", lambda: testdata.weekly_prices(self.spark, self.sf_dir))

    @property
    def cancels(self) -> DataFrame:
        return self._once("cancels", lambda: classify.cancellations_with_membership(testdata.cancellations(self.spark, self.sf_dir), self.allow))

    @property
    def cube(self) -> DataFrame:
        return self._once("cube", lambda: cube.daily_cube(self.p))

    @property
    def economy(self) -> DataFrame:
        return self._once("economy", lambda: cube.window_economy(self.cube))

    @property
    def points(self) -> DataFrame:
        return self._once("points", lambda: pricing.price_points(self.p))

    @property
    def agg(self) -> DataFrame:
        return self._once("agg", lambda: entities.entity_aggregate(self.p))

    @property
    def rank(self) -> DataFrame:
        return self._once("rank", lambda: entities.entity_rank(self.agg))

    @property
    def gas(self) -> DataFrame:
        return self._once("gas", lambda: gas.gas_daily(self.p, self.prices))

    @property
    def days(self) -> DataFrame:
        return self._once("days", lambda: graph.entity_days(self.p))

    @property
    def edge(self) -> DataFrame:
        return self._once("edge", lambda: graph.edges(self.p))

    @property
    def fedge(self) -> DataFrame:
        return self._once("fedge", lambda: graph.facilitator_edges(self.p))

    @property
    def fine(self) -> tuple[DataFrame, DataFrame]:
        return self._once("fine", lambda: graph.fine_edges(self.p))

    @property
    def near(self) -> DataFrame:
        return self._once("near", lambda: graph.neighbors(*self.fine))

    @property
    def labels(self) -> DataFrame:
        return self._once("labels", lambda: classify.identities(self.signals, self.allow))

    @property
    def signals(self) -> DataFrame:
        """Names of suppliers and nations as identity signals of their addresses."""
        s = testdata.read(self.spark, self.sf_dir, "supplier").select(F.lit("base").alias("chain"), testdata.address("e", F.col("s_suppkey")).alias("address"), F.when(F.col("s_suppkey") % 3 == 0, "catalog").otherwise("basename").alias("source"), F.col("s_name").alias("label"), F.lit(None).cast("string").alias("url"))
        n = testdata.read(self.spark, self.sf_dir, "nation").select(F.lit("base").alias("chain"), testdata.address("f", F.col("n_nationkey")).alias("address"), F.when(F.col("n_nationkey") % 2 == 0, "manual").otherwise("other").alias("source"), F.concat(F.lit("manual "), "n_name").alias("label"), F.lit("https://example.org").alias("url"))
        more = s.where("label is not null").withColumn("source", F.lit("other")).withColumn("label", F.lower("label"))
        return s.unionByName(more).unionByName(n)

    @property
    def events(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return testdata.raw_events(self.spark, self.sf_dir)

    @property
    def assembled(self) -> DataFrame:
        return self._once("assembled", lambda: pairing.assembled(*self.events))

    @property
    def spoiled(self) -> DataFrame:
        """The events with malformed fields in transactions, blocks and logs, assembled under quarantine."""

        def make() -> DataFrame:
            logs, transactions, blocks = self.events
            number = lambda c: F.conv(F.right(c, F.lit(8)), 16, 10).cast("long")
            transactions = transactions.withColumn("gas_used", F.when(number("hash") % 41 == 0, "0xZZ").otherwise(F.col("gas_used")))
            blocks = blocks.withColumn("timestamp", F.when(F.col("number") % 37 == 0, "later").otherwise(F.col("timestamp")))
            logs = logs.withColumn("data", F.when((F.col("log_index") == 6) & (number("transaction_hash") % 43 == 0), "0x1").otherwise(F.col("data")))
            return pairing.assembled(logs, transactions, blocks, decode.quarantined(logs, transactions, blocks))

        return self._once("spoiled", make)

    @property
    def merged(self) -> dict[str, DataFrame]:
        """The kept state after three batches of payments by order, each merged into what was there."""

        def make() -> dict[str, DataFrame]:
            pairs, first, days = self.p.limit(0).select(derived.WHO), self.p.limit(0).select("payer", F.col("day").alias("first_day")), []
            for i in range(3):
                batch = self.p.where(F.pmod(F.xxhash64("tx_hash"), F.lit(3)) == i)
                pairs, first = pairs.unionByName(derived.new_pairs(pairs, batch)), first.unionByName(derived.new_first_days(first, batch))
                days.append(derived.pair_days(batch))
            return {"pairs": pairs, "first_days": first, "pair_days": union(*days)}

        return self._once("merged", make)

    @property
    def ticks(self) -> DataFrame:
        """Events as payments at a finer grain than a day."""
        e = testdata.read(self.spark, self.sf_dir, "events")
        return e.select(F.col("ts").cast("timestamp").alias("block_timestamp"), F.to_date("ts").alias("day"), (F.col("user_id") % 3 != 0).alias("facilitator_known"))


def _simple(name: str, make: Callable[[Inputs], DataFrame]) -> None:
    _REGISTRY[name] = lambda spark, sf_dir: make(Inputs(spark, sf_dir))


def union(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


_simple("src4_payments", lambda x: x.raw.select("chain", "tx_hash", "log_index", "day", "payer", "payee", "facilitator", "amount_usdc"))
_simple("src5_cancellations", lambda x: x.cancels.select("tx_hash", "authorizer", "transaction_from", "facilitator_known", "nonce"))
_simple("src6_dimensions", lambda x: union(x.allow.select("address", "since_version", "until_version"), testdata.denylist(x.spark, x.sf_dir).select(F.col("called_contract").alias("address"), "since_version", "until_version")))
_simple("src7_price_checks", lambda x: reference.price_violations(x.prices.select((F.date_add("week", F.when(F.dayofyear("week") % 5 == 0, 1).otherwise(0))).cast("string").alias("week"), F.when(F.dayofyear("week") % 7 == 0, "-1").otherwise(F.col("usd").cast("string")).alias("usd"), F.when(F.dayofyear("week") % 11 == 0, "").otherwise("cited").alias("citation"))))
_simple("src8_claim_checks", lambda x: reference.claim_violations(claims(x, broken=True)))
_simple("src9_label_checks", lambda x: reference.label_violations(x.signals.select(F.when(F.col("source") == "manual", "other").otherwise("base").alias("chain"), F.when(F.col("label").endswith("7"), F.col("label")).otherwise(F.upper(F.substring("address", 3, 40))).alias("a"), F.when(F.col("source") == "other", "").otherwise(F.col("label")).alias("label")).select("chain", F.when(F.length("a") == 40, F.concat(F.lit("0x"), "a")).otherwise(F.col("a")).alias("address"), "label")))
_simple("snk7_replace_by_source", lambda x: reference.replace_by_source(x.signals, x.allow.where("label is not null").select("chain", "address", "label", F.lit(None).cast("string").alias("url"))).select("address", "source", "label"))
_simple("src3_selection", lambda x: selected(x.events[0], (AUTHORIZATION_USED,), 2000, 3000).groupBy("transaction_hash").agg(F.count(F.lit(1)).alias("logs")))


def claims(x: Inputs, broken: bool = False) -> DataFrame:
    """Claims about totals, one for each nation and metric; `broken` ones break a rule each."""
    n = testdata.read(x.spark, x.sf_dir, "nation").select("n_nationkey", "n_name")
    windows = F.element_at(F.array(*[F.lit(w) for w in ("7d", "30d", "all")]), (F.col("n_nationkey") % 3 + 1).cast("int"))
    kind = F.when(F.col("n_nationkey") % 2 == 0, "txns").otherwise("volume")
    good = n.select(F.concat(F.lit("claim-"), "n_nationkey").alias("id"), F.col("n_name").alias("source"), F.lit("text").alias("claim_text"), (F.col("n_nationkey") * 1000 + 100).cast("string").alias("claimed_value"), F.lit("https://example.org").alias("source_url"), F.lit("known").alias("lens"), F.concat(F.lit("total_"), kind, F.lit("_"), windows).alias("measured_metric"), "n_nationkey")
    if not broken:
        return good.drop("n_nationkey")
    k = F.col("n_nationkey")
    return good.withColumns({"id": F.when(k % 10 == 1, "claim-1").otherwise(F.col("id")), "source_url": F.when(k % 10 == 2, "ftp://x").when(k % 10 == 3, "").otherwise(F.col("source_url")), "measured_metric": F.when(k % 10 == 4, "total_txns_1d").otherwise(F.col("measured_metric")), "lens": F.when(k % 10 == 5, "").otherwise(F.col("lens"))}).drop("n_nationkey")


# Decoding and pairing, on the payments written as raw events.
_simple("dec3_transfers", lambda x: decode.transfers(x.events[0]).select("transaction_hash", "log_index", "sender", "receiver", "value"))
_simple("dec4_authorizations", lambda x: decode.authorizations(x.events[0], AUTHORIZATION_USED).select("transaction_hash", "block_number", "log_index", "authorizer", "nonce"))
_simple("dec6_calls", lambda x: decode.with_call(x.events[1]).select("transaction_hash", "facilitator", "method_selector", "settlement_kind", "valid_after", "valid_before", "gas_used", "gas_limit", "gas_cost_wei", "max_fee_per_gas", "l1_fee"))
_simple("dec_rejects", lambda x: decode.rejects(x.events[0].withColumn("address", F.when(F.col("log_index") == 4, "0x12").otherwise(F.col("address"))), x.events[1], x.events[2]).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n")))
_simple("dec1_wide_quantities", lambda x: x.raw.select("tx_hash", "log_index", hexes.word_to_decimal(F.lpad(F.concat(F.lower(F.hex("amount_raw")), F.lit("0000000000000000")), 64, "0")).alias("shifted")))
_simple("pair2_assembled", lambda x: x.assembled.select("tx_hash", "log_index", "outcome", F.when(F.col("outcome") == "kept", F.col("payee")).alias("payee"), F.when(F.col("outcome") == "kept", F.col("amount_usdc")).alias("amount_usdc")))
_simple("pair5_stats", lambda x: pairing.assembly_stats(x.assembled))
_simple("pair6_all_lost", lambda x: pairing.all_lost(pairing.assembly_stats(x.assembled)))
_simple("pair4_fates", lambda x: pairing.fates(x.spoiled))
_simple("pair4_quarantine_reasons", lambda x: pairing.quarantine_reasons(x.spoiled))
_simple("pair4_spoiled_payments", lambda x: pairing.payments(x.spoiled).select("tx_hash", "log_index", "amount_usdc", "gas_cost_wei"))
_simple("dec12_self_settled", lambda x: pairing.payments(pairing.assembled(*own_payees(x))).groupBy("self_settled", "settlement_kind").agg(F.count(F.lit(1)).alias("n")))
_simple("str4_covered_blocks", lambda x: commits.islands(landed_ranges(x), "supplier"))
_simple("pair9_probe", lambda x: pairing.probe(x.assembled))
_simple("pair7_cancellations", lambda x: pairing.cancellations(*testdata.raw_cancellations(x.spark, x.sf_dir)))
_simple("pair9_probe_report", lambda x: pairing.probe_report(*x.events))
_simple("dec14_payment_rows", lambda x: pairing.payments(x.assembled).select("tx_hash", "log_index", "source", "protocol", "token_address", "token_decimals", "token_symbol", "tx_nonce", "effective_gas_price", "base_fee_per_gas", "block_hash", "transaction_index", "l1_gas_used", "l1_gas_price", F.length("input_calldata").alias("calldata_chars"), "value_hex"))
_simple("dec15_contract_labels", lambda x: labelled_contracts(x).groupBy("contract", "label").agg(F.count(F.lit(1)).alias("n")))
_simple("dq14_spoiled_stats", lambda x: checks.stats_add_up(pairing.assembly_stats(x.assembled).withColumn("kept", F.col("kept") + 1)))


def with_wide_amounts(p: DataFrame) -> DataFrame:
    """Payments of which those of one line number in three have amounts of some 240 bits, and one in three near 2**255."""
    plain = F.lower(F.hex("amount_raw"))
    kind = F.col("log_index") % 3
    word = F.when(kind == 0, F.lpad(F.concat(plain, F.lit("0" * 48)), 64, "0")).when(kind == 1, F.lpad(plain, 64, "7f")).otherwise(F.lpad(plain, 64, "0"))
    return p.withColumn("value_hex", word).withColumn("amount_raw", F.when(kind == 2, F.col("amount_raw")))


def twice(x: Inputs) -> DataFrame:
    """Events as payments with a name of their own, every third of them there twice."""
    e = testdata.read(x.spark, x.sf_dir, "events")
    ticks = e.select(F.lit("base").alias("chain"), F.col("event_id").cast("string").alias("tx_hash"), F.lit(0).alias("log_index"), F.col("ts").cast("timestamp").alias("block_timestamp"), (F.col("user_id") % 3 != 0).alias("facilitator_known"))
    return union(ticks, ticks.where(F.col("tx_hash").cast("long") % 3 == 0))


def by_sql_functions(x: Inputs) -> DataFrame:
    """Payments and payers by the steps of amounts and numbers, through the functions of the session."""
    sqlfunctions.register(x.spark)
    return x.spark.sql(
        """SELECT amount_band(usdc(amount_raw)) AS band, entity_bucket(n) AS payments_of_payer, batch_bucket(lines) AS batch, payment_membership(facilitator_known) AS membership, count(*) AS txn_count
        FROM (SELECT *, count(*) OVER (PARTITION BY payer) AS n, count(*) OVER (PARTITION BY tx_hash) AS lines FROM {p}) GROUP BY ALL""",
        p=x.p,
    )


def own_payees(x: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events whose transactions of even number are sent by the payee of their first payment."""
    logs, transactions, blocks = x.events
    first = x.raw.where("log_index = 1").select(F.col("tx_hash").alias("hash"), "payee")
    even = F.conv(F.right("hash", F.lit(8)), 16, 10).cast("long") % 2 == 0
    return logs, transactions.join(first, "hash").withColumn("from", F.when(even, F.col("payee")).otherwise(F.col("from"))), blocks


def landed_ranges(x: Inputs) -> DataFrame:
    """Ranges of days as blocks, one for each line of a supplier's parts, which overlap, touch and leave holes."""
    day = F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")).cast("long")
    return testdata.read(x.spark, x.sf_dir, "lineitem").select(F.col("l_suppkey").alias("supplier"), day.alias("from_block"), (day + F.col("l_orderkey") % 8).alias("to_block"))


def labelled_contracts(x: Inputs) -> DataFrame:
    """Contracts of payments, two of three of them known ones in upper case, with their labels."""
    known = [a for _, a in CONTRACT_LABELS]
    which = F.element_at(F.array(F.lit(known[0]), F.upper(F.lit(known[1])), F.col("called_contract")), (F.col("log_index") % 3 + 1).cast("int"))
    return x.raw.select(which.alias("contract"), amounts.contract_label(F.col("chain"), which).alias("label"))


# Classification.
_simple("cls2_membership", lambda x: x.p.groupBy("facilitator", "facilitator_known", "methodology_version").agg(F.count(F.lit(1)).alias("n")))
_simple("cls1_version_2", lambda x: classify.with_membership(x.raw, x.allow, 2).groupBy("facilitator", "facilitator_known").agg(F.count(F.lit(1)).alias("n")))
_simple("cls3_attribution", lambda x: classify.with_attribution(x.raw, x.allow, testdata.denylist(x.spark, x.sf_dir)).groupBy("attribution").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_usdc").alias("volume_usdc")))
_simple("cls5_identities", lambda x: x.labels.select("address", "source", "label"))
_simple("cls7_bands", lambda x: x.raw.groupBy(amounts.amount_band(F.col("amount_usdc")).alias("band")).agg(F.count(F.lit(1)).alias("n")))
_simple("gr14_query_kinds", lambda x: x.raw.select(F.explode(F.array("payer", "tx_hash", F.substring("payer", 1, 20))).alias("k")).groupBy(amounts.query_kind(F.col("k")).alias("kind")).agg(F.count(F.lit(1)).alias("n")))

# Cube, windows and series.
_simple("agg1_daily_cube", lambda x: x.cube)
_simple("set4_every_version", lambda x: cube.every_version_cube(x.raw, x.allow))
_simple("agg1_wide_cube", lambda x: cube.wide_cube(with_wide_amounts(x.p)))
_simple("agg2_attribution_cube", lambda x: cube.daily_cube(classify.with_attribution(x.raw, x.allow, testdata.denylist(x.spark, x.sf_dir)), "attribution"))
_simple("agg3_window_stats", lambda x: pricing.window_stats(x.p))
_simple("agg4_price_points", lambda x: x.points)
_simple("agg5_price_breadth", lambda x: pricing.price_breadth(x.p, x.points))
_simple("agg6_transactions", lambda x: gas.per_transaction(x.p))
_simple("agg7_gas_daily", lambda x: x.gas.select("day", "membership", "band", "txn_count", amounts.rounded(F.col("l2_gas_cost_wei").cast("double") / 1e18, 6).alias("l2_eth"), amounts.rounded(F.col("l1_fee_wei").cast("double") / 1e18, 6).alias("l1_eth"), amounts.rounded(F.col("cost_usd").cast("double"), 4).alias("cost_usd"), "breakeven_count", "volume_usdc"))
_simple("agg8_active_entities", lambda x: cube.active_entities(x.p))
_simple("agg9_velocity", lambda x: cube.velocity(x.ticks))
_simple("str5_minutes_velocity", lambda x: cube.velocity_of(minutes.counted(twice(x)).withColumn("day", F.to_date("minute"))))
_simple("cls8_sql_functions", lambda x: by_sql_functions(x))
_simple("pg9_velocity_windows", lambda x: cube.velocity_windows(cube.velocity(x.ticks)))
_simple("agg10_payer_cohorts", lambda x: cube.payer_cohorts(x.p))
_simple("str6_payer_cohorts", lambda x: derived.payer_cohorts(x.merged["pair_days"], x.merged["first_days"]))
_simple("str6_entity_aggregate", lambda x: entities.entity_aggregate(x.merged["pair_days"]))
_simple("str6_entity_counterparties", lambda x: derived.entity_counterparties(x.merged["pairs"]))
_simple("str6_active_entities", lambda x: cube.active_entities(x.merged["pair_days"]))
_simple("agg11_entity_aggregate", lambda x: x.agg)
_simple("agg12_entity_rank", lambda x: x.rank)
_simple("agg13_entity_buckets", lambda x: entities.entity_buckets(x.agg))
_simple("agg14_concentration", lambda x: entities.concentration(x.agg))
_simple("agg15_reliability_windows", lambda x: reliability.reliability_windows(x.p, x.cancels))
_simple("agg17_reliability_daily", lambda x: reliability.reliability_daily(x.p, x.cancels))
_simple("agg19_mechanics_windows", lambda x: mechanics.mechanics_windows(x.p))
_simple("agg20_hygiene", lambda x: mechanics.hygiene(x.p))
_simple("agg20_in_windows", lambda x: mechanics.with_hygiene(mechanics.mechanics_windows(x.p), x.p).select("window_name", "membership", "nonce_reuse", "nonce_reuse_in_block"))
_simple("agg21_batches", lambda x: mechanics.batches(x.p))
_simple("agg22_blocks", lambda x: mechanics.blocks(x.p))
_simple("agg23_selectors", lambda x: mechanics.selectors(x.p))
_simple("agg24_status", lambda x: cube.status(x.p, F.lit("2001-11-01").cast("timestamp")))
_simple("pg2_window_economy", lambda x: x.economy)
_simple("pg3_daily_series", lambda x: cube.daily_series(x.cube))
_simple("pg4_monthly_series", lambda x: cube.monthly_series(x.cube))
_simple("pg5_typical_payment", lambda x: pricing.typical_payment(pricing.window_stats(x.p), x.economy, x.cube))
_simple("pg6_price_point_shares", lambda x: pricing.price_point_shares(x.points, x.economy))
_simple("pg7_gas_windows", lambda x: gas.gas_windows(x.gas))
_simple("pg8_cost_per_dollar", lambda x: gas.cost_per_dollar_daily(x.gas))
_simple("pg10_excluded", lambda x: cube.excluded_totals(x.cube))
_simple("pg13_price_breadth_series", lambda x: pricing.price_breadth_series(pricing.price_breadth(x.p, x.points), x.points))
_simple("pg14_facilitators", lambda x: cube.facilitators(x.cube))
_simple("pg17_reliability_rates", lambda x: reliability.reliability_rates(reliability.reliability_windows(x.p, x.cancels)))
_simple("pg18_reliability_series", lambda x: reliability.reliability_series(reliability.reliability_daily(x.p, x.cancels)))
_simple("pg19_batch_shares", lambda x: mechanics.batch_shares(mechanics.batches(x.p)))
_simple("pg21_claims", lambda x: series.claims_resolved(claims(x), x.economy))
_simple("pg22_stamp", lambda x: rebuild.stamp(x.p, F.lit("2002-01-01").cast("timestamp")).select("max_day", "data_through_day", "versions", "methodology_version"))
_simple("dec15_named_selectors", lambda x: mechanics.named_selectors(mechanics.selectors(x.p)).select("window_name", "membership", "rank", "selector_hex", "method", "method_kind"))
_simple("top7_cancellation_attribution", lambda x: reliability.cancellation_attribution(x.cancels))
_simple("set1_missing_weeks", lambda x: gas.missing_weeks(x.p, x.prices.where(F.dayofyear("week") % 9 != 0)))
_simple("set4_versions", lambda x: two_versions(x))


def two_versions(x: Inputs) -> DataFrame:
    """Payments by version and membership in the cubes of two versions, and the number of versions among both."""
    other = cube.daily_cube(classify.with_membership(x.raw, x.allow, 2))
    rows = union(x.cube, other).groupBy("methodology_version", "membership").agg(F.sum("txn_count").alias("txn_count"))
    return rows.crossJoin(F.broadcast(checks.one_version(x.cube, other).select("versions")))


# Derived series.
_simple("cl2_moving_average", lambda x: series.moving_average(cube.daily_series(x.cube), "txn_count").select("day", "ma7"))
_simple("cl3_month_over_month", lambda x: series.month_over_month(cube.monthly_series(x.cube)))
_simple("cl4_peak_and_median", lambda x: series.peak_and_median(cube.daily_series(x.cube), "txn_count"))
_simple("cl1_trailing", lambda x: series.trailing(cube.daily_series(x.cube), 30))
_simple("cl6_momentum", lambda x: series.momentum(x.economy))
_simple("cl9_dense_bands", lambda x: series.dense_bands(x.economy))
_simple("cl11_other_types", lambda x: mechanics.other_types(mechanics.mechanics_windows(x.p)))
_simple("cl12_cohort_shares", lambda x: series.cohort_shares(cube.payer_cohorts(x.p)))
_simple("cl14_breadth_trend", lambda x: pricing.breadth_trend(pricing.price_breadth_series(pricing.price_breadth(x.p, x.points), x.points)))
_simple("cl15_concentration_shares", lambda x: entities.concentration_shares(entities.concentration(x.agg)))
_simple("cl15_breakeven_share", lambda x: gas.breakeven_share(gas.gas_windows(x.gas)))
_simple("cl17_dust_sinks", lambda x: entities.dust_sinks(x.rank))
_simple("cl19_role_order", lambda x: graph.role_order(graph.entity_summary(x.days)))

# Entity tables and graphs.
_simple("ent1_edges", lambda x: x.edge)
_simple("ent2_facilitator_edges", lambda x: x.fedge)
_simple("ent3_entity_days", lambda x: x.days)
_simple("ent4_entity_price_points", lambda x: graph.entity_price_points(x.p))
_simple("ent5_leaderboard", lambda x: graph.leaderboard(x.p))
_simple("top5_leaderboard_page", lambda x: graph.leaderboard_page(graph.leaderboard(x.p), "all", "payee", "known", "counterparties", x.labels).select("address", "rank", "distinct_counterparties", "label"))
_simple("ent6_entity_summary", lambda x: graph.entity_summary(x.days))
_simple("ent7_counterparties", lambda x: graph.entity_counterparties(*x.fine))
_simple("ent8_dataset_totals", lambda x: graph.dataset_totals(x.days))
_simple("ent9_headers", lambda x: graph.entity_headers(graph.entity_summary(x.days), graph.entity_counterparties(*x.fine), x.labels, x.signals).select("address", F.size("roles").alias("n_roles"), F.size("signals").alias("n_signals"), "label"))
_simple("ent9_header_roles", lambda x: graph.entity_headers(graph.entity_summary(x.days), graph.entity_counterparties(*x.fine), x.labels, x.signals).select("address", F.explode("roles").alias("r")).select("address", "r.*"))
_simple("ent9_header_signals", lambda x: graph.entity_headers(graph.entity_summary(x.days), graph.entity_counterparties(*x.fine), x.labels, x.signals).select("address", F.explode("signals").alias("s")).select("address", "s.*"))
_simple("gr2_densified", lambda x: graph.densified(x.days))
_simple("gr3_cadence", lambda x: graph.cadence(x.days))
_simple("gr4_merged_price_points", lambda x: graph.merged_price_points(graph.entity_price_points(x.p)))
_simple("gr5_counterparty_concentration", lambda x: graph.counterparty_concentration(*graph.plain_edges(x.p)))
_simple("gr6_fingerprints", lambda x: graph.fingerprints(graph.plain_days(x.p), graph.entity_price_points(x.p), *graph.plain_edges(x.p)).select("address", "role", "lens", "active_days", "span_days", F.size("price_points").alias("n_price_points"), F.get("price_points", F.lit(0))["amount_usdc"].alias("first_amount"), "distinct_amounts", "top1_share"))
_simple("gr6_fingerprint_points", lambda x: graph.fingerprints(graph.plain_days(x.p), graph.entity_price_points(x.p), *graph.plain_edges(x.p)).select("address", "role", "lens", F.explode("price_points").alias("p")).select("address", "role", "lens", "p.*"))
_simple("gr7_neighbors", lambda x: x.near)
_simple("top4_counterparty_page", lambda x: graph.counterparty_page(*x.fine, x.labels, "payers", "all", "txns", 40, 50))
_simple("top4_by_volume", lambda x: graph.counterparty_page(*x.fine, x.labels, "settled_payees", "known", "volume", 5, 50))
_simple("top4_by_last_seen", lambda x: graph.counterparty_page(*x.fine, x.labels, "payees", "all", "last_seen", 0, 50))
_simple("top6_payment_page", lambda x: graph.payment_page(x.p, 100, (3000, "0x" + "0" * 64, 0)))
_simple("top4_by_index", lambda x: counterparties_by_index(x))
_simple("top6_by_index", lambda x: payments_by_index(x))
_simple("gr8_by_index", lambda x: next_payments_by_index(x))
_simple("gr10_classes", lambda x: entities.classified(x.rank).select("window_name", "role", "address", "behavior"))
_simple("gr11_class_counts", lambda x: entities.class_counts(x.rank))
_simple("gr12_ghosts", lambda x: graph.ghosts(graph.first_counterparties(*x.fine)))
_simple("gr13_primary_edges", lambda x: graph.primary_edges(x.near))
_simple("gr9_transactions", lambda x: graph.transaction_graph(x.p)[0])
_simple("gr9_nodes", lambda x: graph.transaction_graph(x.p)[1])
_simple("gr9_edges", lambda x: graph.transaction_graph(x.p)[2])

#: Rows of a stored list's file, about: what a task sorts, whatever the size of the tables.
FILE = 1_000_000


def files(x: Inputs, lists: int) -> int:
    """Files of a stored list, in which a payment is in so many lists: as many as the session has partitions of a
    shuffle, or more for many payments, whose number Parquet keeps."""
    lines = testdata.read(x.spark, x.sf_dir, "lineitem").count()
    return max(int(x.spark.conf.get("spark.sql.shuffle.partitions")), -(-lines * lists // FILE))


def counterparties_by_index(x: Inputs) -> DataFrame:
    lists = graph.counterparty_lists(folders.shared(x.spark, "counterparties"), "volume")
    graph.store_counterparties(*x.fine, lists, files(x, 10))
    return graph.stored_counterparty_page(x.spark, lists, x.labels, "settled_payees", "known", 5, 50)


def payments_by_index(x: Inputs) -> DataFrame:
    feed = graph.payment_list(folders.shared(x.spark, "payments"))
    graph.store_payment_list(x.p, feed, files(x, 1))
    return graph.stored_payment_page(x.spark, feed, 100, (3000, "0x" + "0" * 64, 0))


def next_payments_by_index(x: Inputs) -> DataFrame:
    lists = graph.entity_payment_lists(folders.shared(x.spark, "entity-payments"))
    graph.store_entity_payments(x.p, lists, files(x, 3))
    return listing.pages_after(x.spark, lists, graph.next_cursors(listing.pages(x.spark, lists, 0, 50), 50), 50)


def published_facilitators(x: Inputs) -> DataFrame:
    """The facilitators' page, written as a document and read back."""
    root, rows = folders.shared(x.spark, "pages"), cube.facilitators(x.cube)
    made = rebuild.stamp(x.p, F.lit("2002-01-01").cast("timestamp"))
    rebuild.write_pages({"facilitators": {"rows": (rows, ("facilitator",))}}, made, root)
    schema = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes)
    return rebuild.page_rows(x.spark, f"{root}/pages/facilitators", schema)


_simple("snk5_published_facilitators", lambda x: published_facilitators(x))

# Checks: the violations of all tables, and that they are found where a table is spoiled.
_simple("dq_violations", lambda x: rebuild.stored_violations(x.p, x.cancels, x.prices, folders.shared(x.spark, "checks")))
_simple("dq1_spoiled_bands", lambda x: checks.bands_equal_windows(x.economy.withColumn("txn_count", F.when((F.col("band") == "mid") & (F.col("window_name") == "30d"), F.col("txn_count") + 1).otherwise(F.col("txn_count")))))
_simple("dq13_spoiled_classification", lambda x: checks.classification_keeps_rows(x.raw, x.p.where("facilitator_known")))
_simple("dq3_spoiled_concentration", lambda x: checks.concentration_equals_economy(entities.concentration(x.agg).withColumn("total_txns", F.col("total_txns") + F.when(F.col("role") == "payer", 1).otherwise(0)), x.economy))
_simple("dq5_spoiled_settlements", lambda x: checks.settlements_equal_economy(reliability.reliability_windows(x.p.withColumn("facilitator_known", F.expr("facilitator_known and day > '1995-01-01'")), x.cancels), x.economy))
_simple("dq6_spoiled_batches", lambda x: checks.batches_equal_settlements(mechanics.batches(x.p).where("batch_bucket <> '1'"), mechanics.mechanics_windows(x.p)))
_simple("dq8_spoiled_days", lambda x: checks.days_equal_view(x.days.withColumn("txn_count", F.col("txn_count") + F.when(F.col("role") == "payee", 1).otherwise(0)), x.p))
_simple("dq8_spoiled_edges", lambda x: union(checks.edges_equal_view(x.edge.where("facilitator_known or txn_count > 1"), x.p), checks.facilitator_edges_equal_view(x.fedge.where("role <> 'payer' or not facilitator_known"), x.p)))
_simple("dq9_spoiled_gas", lambda x: gas.conservation(x.p, x.gas.where("band <> 'mid'")).select("check", F.round(F.col("drift") / 1e15, 3).alias("drift")))
_simple("dq2_spoiled_buckets", lambda x: checks.buckets_equal_concentration(entities.entity_buckets(x.agg).where("not (window_name = 'all' and role = 'payee' and bucket <> '1')"), entities.concentration(x.agg)))
_simple("dq4_spoiled_reliability", lambda x: checks.reliability_consistent(reliability.reliability_windows(x.p, x.cancels).withColumn("windowed_count", F.when(F.col("membership") == "all", F.col("settlement_count") + 1).otherwise(F.col("windowed_count")))))
_simple("dq7_spoiled_cube", lambda x: checks.cube_equals_view(x.cube.where("band <> 'whale' or membership = 'known'"), x.p))
_simple("dq11_spoiled_publication", lambda x: checks.known_only(x.p.select("chain", "facilitator").distinct(), x.p))
_simple("dq12_finite", lambda x: checks.finite(gas.gas_windows(x.gas).withColumn("usd", F.when(F.col("band") == "mid", F.lit(float("nan"))).otherwise(F.col("usd"))), "usd", "txn_count"))
_simple("pg23_as_of", lambda x: checks.ends_with_the_data(x.p, "1990-01-01"))
_simple("gr1_timeline", lambda x: graph.timeline(x.days))
_simple("gr8_entity_payments", lambda x: graph.entity_payments(x.p))
_simple("gr8_next_page", lambda x: graph.entity_payments(x.p, 50, graph.next_cursors(graph.entity_payments(x.p), 50)))
_simple("pg15_entity_pages", lambda x: entities.entity_page(x.rank, entities.entity_buckets(x.agg), entities.concentration(x.agg)).select("window_name", "role", F.size("leaderboard").alias("rows"), F.get("leaderboard", F.lit(0))["address"].alias("first"), F.size("buckets").alias("buckets"), "concentration.total_entities"))
_simple("pg15_entity_page_rows", lambda x: entities.entity_page(x.rank, entities.entity_buckets(x.agg), entities.concentration(x.agg)).select("window_name", "role", F.explode("leaderboard").alias("l")).select("window_name", "role", "l.address", "l.txn_count", "l.volume_usdc", "l.distinct_counterparties", "l.distinct_amounts"))
_simple("cl13_units", lambda x: x.p.groupBy("tx_hash").agg(F.max(amounts.scaled(F.col("gas_cost_wei"), 18)).alias("eth"), F.max(amounts.scaled(F.col("max_fee_per_gas"), 9)).alias("gwei"), F.max(amounts.share(F.col("gas_used") * 100, F.col("gas_limit"), 2, None)).alias("pct_gas_used")))
_simple("dec16_explorer_links", lambda x: x.p.select("tx_hash", "chain").distinct().select("tx_hash", amounts.explorer_url(F.col("chain"), "tx", F.col("tx_hash")).alias("url")))
_simple("top9_display_slices", lambda x: union(x.points.where("window_name = 'all' and rank <= 12").select(F.lit("price").alias("slice"), F.col("amount_usdc").cast("string").alias("key"), "txn_count"), cube.facilitators(x.cube).orderBy(F.desc("volume_all"), "facilitator").limit(8).select(F.lit("facilitator").alias("slice"), F.col("facilitator").alias("key"), F.col("txns_all").alias("txn_count"))))


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return oracles.sql()
