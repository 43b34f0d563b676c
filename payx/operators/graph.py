"""Entity tables: edges, days, price points, leaderboard, neighbours, fingerprints and transaction graphs.

All are for every entity at once; a reader filters by address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payx.functions.amounts import share
from payx.operators import listing
from payx.operators.windows import PAIR, TRIPLE, anchor, first_by_any, in_windows, unpivot, with_lenses
from payx.schema import RECEIVE_SELECTORS, TRANSFER_SELECTORS


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("txn_count"), F.sum("amount_usdc").alias("volume_usdc"), F.min("block_timestamp").alias("first_seen"), F.max("block_timestamp").alias("last_seen")]


def _again() -> list[Column]:
    return [F.sum("txn_count").alias("txn_count"), F.sum("volume_usdc").cast("decimal(38,6)").alias("volume_usdc"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")]


def edges(p: DataFrame) -> DataFrame:
    """(chain, payer, payee, known) -> payments, volume, first and last time."""
    return p.groupBy("chain", "payer", "payee", "facilitator_known").agg(*_sums())


def facilitator_edges(p: DataFrame) -> DataFrame:
    """(chain, facilitator, role and address of a counterparty, known) -> the same; a payment counts on both sides."""
    sides = F.array(F.struct(F.lit("payer").alias("role"), F.col("payer").alias("counterparty")), F.struct(F.lit("payee").alias("role"), F.col("payee").alias("counterparty")))
    fine = p.groupBy("chain", "facilitator", "payer", "payee", "facilitator_known").agg(*_sums())  # summed before rows double
    return fine.withColumn("__s", F.explode(sides)).select("*", "__s.*").groupBy("chain", "facilitator", "role", "counterparty", "facilitator_known").agg(*_again())


def fine_edges(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payments summed once by all parties, in the form of `edges` and of `facilitator_edges`, whose rows they may split.

    For tables that sum edges again: both sides read one shuffle.
    """
    fine = p.groupBy("chain", "facilitator", "payer", "payee", "facilitator_known").agg(*_sums())
    sides = F.array(*[F.struct(F.lit(c).alias("role"), F.col(c).alias("counterparty")) for c in ("payer", "payee")])
    return fine, fine.withColumn("__s", F.explode(sides)).select("*", "__s.*").drop("__s")


def plain_edges(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payments in the form of `fine_edges`, not summed: for tables that sum by fewer columns, partly before their shuffle."""
    rows = p.select("chain", "facilitator", "payer", "payee", "facilitator_known", F.lit(1).cast("long").alias("txn_count"), F.col("amount_usdc").alias("volume_usdc"), F.col("block_timestamp").alias("first_seen"), F.col("block_timestamp").alias("last_seen"))
    sides = F.array(*[F.struct(F.lit(c).alias("role"), F.col(c).alias("counterparty")) for c in ("payer", "payee")])
    return rows, rows.withColumn("__s", F.explode(sides)).select("*", "__s.*").drop("__s")


def plain_days(p: DataFrame) -> DataFrame:
    """Payments in the form of `entity_days`, not summed, for tables that sum them again."""
    return unpivot(p, *TRIPLE).select("chain", "address", "role", "day", "facilitator_known", F.lit(1).cast("long").alias("txn_count"), F.col("amount_usdc").alias("volume_usdc"))


def entity_days(p: DataFrame) -> DataFrame:
    """(chain, address, role, day, known) -> payments and volume."""
    return unpivot(p, *TRIPLE).groupBy("chain", "address", "role", "day", "facilitator_known").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount_usdc").alias("volume_usdc"))


def entity_price_points(p: DataFrame, top: int = 64) -> DataFrame:
    """The `top` amounts of (chain, address, role, known) by payments, and the number of distinct ones."""
    key = ["chain", "address", "role", "facilitator_known"]
    x = unpivot(p, *TRIPLE).groupBy(*key, "amount_usdc").agg(F.count(F.lit(1)).alias("txn_count"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("txn_count"), "amount_usdc"))
    first = x.withColumn("amount_rank", place).where(F.col("amount_rank") <= top)
    # Totals ask for the payments too, so that they are read from the same shuffle as the ranks.
    total = x.groupBy(key).agg(F.count(F.lit(1)).alias("total_distinct_amounts"), F.sum("txn_count").alias("__n")).where("__n > 0").drop("__n")
    return first.join(total, key)


def leaderboard(p: DataFrame, top: int = 500) -> DataFrame:
    """(window, role, lens) -> the union of the `top` by volume, payments and counterparties; windows end with the newest day."""
    pairs = p.groupBy("day", "payer", "payee", "facilitator_known").agg(*_sums())
    x = with_lenses(in_windows(unpivot(pairs, *PAIR), anchor(p)))
    key = ["window_name", "role", "lens", "address"]
    x = x.groupBy(*key, "counterparty").agg(*_again()).groupBy(key).agg(F.count(F.lit(1)).alias("distinct_counterparties"), *_again())
    return first_by_any(x, ["window_name", "role", "lens"], ["volume_usdc", "txn_count", "distinct_counterparties"], top)


def leaderboard_page(board: DataFrame, window: str, role: str, lens: str, sort: str, labels: DataFrame | None = None, cap: int = 500) -> DataFrame:
    """The first `cap` rows of one leaderboard with rank and label; sort is volume, txns or counterparties."""
    column = {"volume": "volume_usdc", "txns": "txn_count", "counterparties": "distinct_counterparties"}[sort]
    x = board.where((F.col("window_name") == window) & (F.col("role") == role) & (F.col("lens") == lens)).orderBy(F.desc(column), "address").limit(cap)
    x = x.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(column), "address")))
    return x.join(labels.select("address", "label"), "address", "left") if labels is not None else x


def entity_summary(days: DataFrame) -> DataFrame:
    """(address, role, lens) -> payments, active days, first and last day, volume."""
    x = with_lenses(days).groupBy("address", "role", "lens", "day").agg(F.sum("txn_count").alias("n"), F.sum("volume_usdc").alias("v"))
    return x.groupBy("address", "role", "lens").agg(F.sum("n").alias("txn_count"), F.count(F.lit(1)).alias("active_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("v").cast("decimal(38,6)").alias("volume_usdc"))


def entity_counterparties(edge: DataFrame, facilitator_edge: DataFrame) -> DataFrame:
    """(address, role, lens) -> distinct counterparties, from the edge tables. Each pair is one row for both lenses until it is counted."""
    known = F.max("facilitator_known").alias("known")
    pairs, settled = edge.groupBy("payer", "payee").agg(known), facilitator_edge.groupBy("facilitator", "counterparty").agg(known)
    sides = F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("address")) for r in ("payer", "payee")])
    x = pairs.select("known", F.explode(sides).alias("s")).select("s.*", "known").unionByName(settled.select(F.lit("facilitator").alias("role"), F.col("facilitator").alias("address"), "known"))
    x = x.groupBy("address", "role").agg(F.count(F.lit(1)).alias("all"), F.count_if("known").alias("known"))
    lenses = F.array(*[F.struct(F.lit(lens).alias("lens"), F.col(lens).alias("distinct_counterparties")) for lens in ("all", "known")])
    return x.select("address", "role", F.explode(lenses).alias("l")).select("address", "role", "l.*").where("distinct_counterparties > 0")


def dataset_totals(days: DataFrame) -> DataFrame:
    """Payments, volume, payers and newest day of each lens, from the payers' days."""
    x = with_lenses(days.where("role = 'payer'"))
    return x.groupBy("lens").agg(F.sum("txn_count").alias("txn_count"), F.sum("volume_usdc").cast("decimal(38,6)").alias("volume_usdc"), F.count_distinct("address").alias("payers"), F.max("day").alias("max_day"))


def entity_headers(summary: DataFrame, counterparties: DataFrame, labels: DataFrame, signals: DataFrame) -> DataFrame:
    """One row for each address with days or signals: its roles and lenses nested, label, signals."""
    x = summary.join(counterparties, ["address", "role", "lens"], "left")
    roles = x.groupBy("address").agg(F.sort_array(F.collect_list(F.struct("role", "lens", "txn_count", "volume_usdc", "active_days", "distinct_counterparties"))).alias("roles"))
    said = signals.groupBy("address").agg(F.sort_array(F.collect_list(F.struct("source", "label"))).alias("signals"))
    return roles.join(said, "address", "full").join(labels.select("address", "label"), "address", "left")


LIST = ["direction", "subject", "lens"]


_OF = ("txn_count", "volume_usdc", "first_seen", "last_seen")


def _both_lenses(x: DataFrame, *keys: str) -> DataFrame:
    """Sums of rows with facilitator_known by keys, one row for lenses all and known: known_* are null where none is known."""
    total = {"txn_count": F.sum, "volume_usdc": lambda c: F.sum(c).cast("decimal(38,6)"), "first_seen": F.min, "last_seen": F.max}
    return x.groupBy(*keys).agg(*[how(c).alias(f"all_{c}") for c, how in total.items()], *[how(F.when(F.col("facilitator_known"), F.col(c))).alias(f"known_{c}") for c, how in total.items()])


def _listed(x: DataFrame, *sides: tuple[Column | str, str, str]) -> DataFrame:
    """Rows of both lenses as those of lists: for each side (direction, subject, counterparty)."""
    lens = lambda name: F.struct(F.lit(name).alias("lens"), *[F.col(f"{name}_{c}").alias(c) for c in _OF])
    own = F.array(*[F.struct((F.lit(d) if isinstance(d, str) else d).alias("direction"), F.col(a).alias("subject"), F.col(b).alias("counterparty")) for d, a, b in sides])
    x = x.withColumn("__s", F.explode(own)).withColumn("__l", F.explode(F.when(F.col("known_txn_count").isNull(), F.array(lens("all"))).otherwise(F.array(lens("all"), lens("known")))))
    return x.select("__s.direction", "__s.subject", "__l.lens", "__s.counterparty", *[f"__l.{c}" for c in _OF])


def counterparties(edge: DataFrame, facilitator_edge: DataFrame) -> DataFrame:
    """Every counterparty of every entity in five directions and both lenses: payments, volume, first and last time.

    Pairs are summed as one row for both directions and lenses, and only then made into rows of lists.
    """
    settled = _both_lenses(facilitator_edge, "facilitator", "role", "counterparty")
    by = _both_lenses(facilitator_edge, "facilitator", "counterparty")
    x = _listed(_both_lenses(edge, "payer", "payee"), ("payees", "payer", "payee"), ("payers", "payee", "payer"))
    return x.unionByName(_listed(by, ("facilitators", "counterparty", "facilitator"))).unionByName(_listed(settled, (F.concat(F.lit("settled_"), "role", F.lit("s")), "facilitator", "counterparty")))


def _with_totals(some: DataFrame, every: DataFrame) -> DataFrame:
    """Some rows of `every` with the number of counterparties in their list and their share of its volume.

    The totals ask for the columns that the rows have too, so that both are read from the same shuffles.
    """
    totals = every.groupBy(LIST).agg(F.count(F.lit(1)).alias("total_counterparties"), F.sum("volume_usdc").alias("__v"), F.sum("txn_count").alias("__n"), F.max("last_seen").alias("__t"))
    return some.join(totals.where("__n > 0 and __t is not null").drop("__n", "__t"), LIST).withColumn("share", share(F.col("volume_usdc"), F.col("__v"))).drop("__v")


def first_counterparties(edge: DataFrame, facilitator_edge: DataFrame, top: int = 50) -> DataFrame:
    """The `top` counterparties of every list by volume, with their rank."""
    place = F.row_number().over(Window.partitionBy(LIST).orderBy(F.desc("volume_usdc"), "counterparty"))
    return counterparties(edge, facilitator_edge).drop("first_seen").withColumn("rank", place).where(F.col("rank") <= top)


def neighbors(edge: DataFrame, facilitator_edge: DataFrame, top: int = 50) -> DataFrame:
    """Top counterparties of every entity in five directions and both lenses, with share of volume and total number."""
    return _with_totals(first_counterparties(edge, facilitator_edge, top), counterparties(edge, facilitator_edge))


def counterparty_page(edge: DataFrame, facilitator_edge: DataFrame, labels: DataFrame, direction: str, lens: str, sort: str, offset: int, limit: int) -> DataFrame:
    """Rows offset+1 to offset+limit of every subject's whole list in one direction; sort is volume, txns or last_seen."""
    column = SORTS[sort]
    x = counterparties(edge, facilitator_edge).where((F.col("direction") == direction) & (F.col("lens") == lens))
    place = F.row_number().over(Window.partitionBy(LIST).orderBy(F.desc(column), "counterparty"))
    page = _with_totals(x.withColumn("place", place).where(F.col("place") <= offset + limit).where(F.col("place") > offset), x)
    return _named(page, labels)


def _named(page: DataFrame, labels: DataFrame) -> DataFrame:
    names = labels.select(F.col("address").alias("counterparty"), "label")
    return page.join(names, "counterparty", "left").select("subject", "place", "counterparty", "label", "txn_count", "volume_usdc", "share", "first_seen", "last_seen", "total_counterparties")


SORTS = {"volume": "volume_usdc", "txns": "txn_count", "last_seen": "last_seen"}


def counterparty_lists(path: str, sort: str) -> listing.Listing:
    """Where the counterparties of all entities are stored in one order: volume, txns or last_seen."""
    return listing.Listing(path, tuple(LIST), ((SORTS[sort], True), ("counterparty", False)))


def store_counterparties(edge: DataFrame, facilitator_edge: DataFrame, to: listing.Listing, files: int) -> None:
    listing.store(counterparties(edge, facilitator_edge), to, files, F.sum("volume_usdc").alias("__v"))


def stored_counterparty_page(spark: SparkSession, of: listing.Listing, labels: DataFrame, direction: str, lens: str, offset: int, limit: int, subject: str | None = None) -> DataFrame:
    """The same as counterparty_page from stored lists, of one subject, whose files alone are read, or of all."""
    if subject is None:
        page = listing.pages(spark, of, offset, limit, (F.col("direction") == direction) & (F.col("lens") == lens))
    else:
        page = listing.page(spark, of, {"direction": direction, "lens": lens, "subject": subject}, offset, limit)
    totals = listing.totals(spark, of).where((F.col("direction") == direction) & (F.col("lens") == lens)).withColumnRenamed("total", "total_counterparties")
    if subject is not None:
        totals = totals.where(F.col("subject") == subject)
    return _named(page.join(totals, LIST).withColumn("share", share(F.col("volume_usdc"), F.col("__v"))), labels)


NEWEST = (("block_number", True), ("tx_hash", True), ("log_index", True))


def payment_list(path: str) -> listing.Listing:
    """Where all payments are stored as one list, newest first."""
    return listing.Listing(path, ("feed",), NEWEST)


def store_payment_list(p: DataFrame, to: listing.Listing, files: int) -> None:
    listing.store(p.select(F.lit("all").alias("feed"), *(c for c, _ in NEWEST), "payer", "payee", "amount_usdc"), to, files)


def stored_payment_page(spark: SparkSession, of: listing.Listing, limit: int, cursor: tuple[int, str, int] | None = None) -> DataFrame:
    """The same as payment_page from the stored list."""
    key = {"feed": "all"}
    x = listing.page(spark, of, key, 0, limit + 1) if cursor is None else listing.page_after(spark, of, key, cursor, limit + 1)
    return x.drop("feed", "place")


def entity_payment_lists(path: str) -> listing.Listing:
    """Where the payments of every (chain, address, role) are stored, newest first."""
    return listing.Listing(path, ("chain", "address", "role"), NEWEST)


def store_entity_payments(p: DataFrame, to: listing.Listing, files: int) -> None:
    order = [c for c, _ in NEWEST]
    x = unpivot(p.select("chain", *order, "payer", "payee", "facilitator", "amount_usdc"), *TRIPLE)
    listing.store(x.select("chain", "address", "role", *order, "counterparty", "amount_usdc"), to, files)


def payment_page(p: DataFrame, limit: int, cursor: tuple[int, str, int] | None = None) -> DataFrame:
    """The `limit`+1 newest payments before a cursor (block, transaction, log): a row beyond limit is the next cursor."""
    x = p
    if cursor:
        b, t, i = cursor
        x = x.where((F.col("block_number") < b) | (F.col("block_number") == b) & ((F.col("tx_hash") < t) | (F.col("tx_hash") == t) & (F.col("log_index") < i)))
    return x.orderBy(F.desc("block_number"), F.desc("tx_hash"), F.desc("log_index")).limit(limit + 1).select("block_number", "tx_hash", "log_index", "payer", "payee", "amount_usdc")


def entity_payments(p: DataFrame, limit: int = 50, before: DataFrame | None = None) -> DataFrame:
    """The `limit` newest payments of every (chain, address, role), or, with cursors, those before an entity's own.

    before has a cursor (block_number, tx_hash, log_index) for each (chain, address, role); entities without one have no
    further page. The cursor of the next page is the last row of this one.
    """
    key, order = ["chain", "address", "role"], ["block_number", "tx_hash", "log_index"]
    x = unpivot(p.select("chain", *order, "payer", "payee", "facilitator", "amount_usdc"), *TRIPLE)
    if before is not None:
        x = x.join(before.select(*key, F.struct(*order).alias("__before")), key).where(F.struct(*order) < F.col("__before"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    return x.withColumn("place", place).where(F.col("place") <= limit).select(*key, "place", *order, "counterparty", "amount_usdc")


def next_cursors(page: DataFrame, limit: int) -> DataFrame:
    """Cursors behind the pages that are full."""
    return page.where(F.col("place") == limit).select("chain", "address", "role", "block_number", "tx_hash", "log_index")


def _lens_days(days: DataFrame) -> DataFrame:
    """(address, role, lens, day) -> payments and volume. One shuffle: all rows of an entity meet, at most a few for each day."""
    x = with_lenses(days.repartition("address", "role"))
    return x.groupBy("address", "role", "lens", "day").agg(F.sum("txn_count").alias("txn_count"), F.sum("volume_usdc").cast("decimal(38,6)").alias("volume_usdc"))


def timeline(days: DataFrame) -> DataFrame:
    """(address, role, lens, day) -> payments and volume, days with payments only."""
    return _lens_days(days)


def densified(days: DataFrame) -> DataFrame:
    """Every day from an entity's first to its last in a role and lens, with zeros in gaps.

    Each day with payments brings the empty ones up to the next, so the rows that are filled in are never shuffled.
    """
    key = ["address", "role", "lens"]
    following = F.coalesce(F.date_sub(F.lead("day").over(Window.partitionBy(key).orderBy("day")), 1), F.col("day"))
    # Days are counted from the one with payments: whole numbers take a fraction of the time of a sequence of dates.
    x = _lens_days(days).withColumn("until", following).withColumn("after", F.explode(F.sequence(F.lit(0), F.datediff("until", "day"))))
    own = lambda c, kind: F.when(F.col("after") == 0, F.col(c)).otherwise(F.lit(0).cast(kind)).alias(c)
    return x.select(*key, F.date_add("day", F.col("after")).alias("day"), own("txn_count", "long"), own("volume_usdc", "decimal(38,6)"))


def cadence(days: DataFrame) -> DataFrame:
    """(address, role, lens) -> active days, span in days, lower median of payments a day, share of the busiest day."""
    lenses, key = ("all", "known"), ["address", "role"]
    x = days.groupBy(*key, "day").agg(F.sum("txn_count").alias("all"), F.sum(F.when(F.col("facilitator_known"), F.col("txn_count"))).alias("known"))

    def of(lens: str) -> Column:
        day = F.when(F.col(lens).isNotNull(), F.col("day"))
        median = F.expr(f"percentile_disc(0.5) within group (order by `{lens}`)").cast("long")
        return F.struct(F.lit(lens).alias("lens"), F.count(lens).alias("active_days"), (F.datediff(F.max(day), F.min(day)) + 1).alias("span_days"), median.alias("median_per_day"), share(F.max(lens), F.sum(lens)).alias("top_day_share")).alias(lens)

    # A day is one row for both lenses until it is counted.
    return x.groupBy(key).agg(*[of(lens) for lens in lenses]).select(*key, F.explode(F.array(*lenses)).alias("l")).select(*key, "l.*").where("active_days > 0")


def merged_price_points(points: DataFrame, top: int = 16) -> DataFrame:
    """(address, role, lens) -> the `top` amounts, merged from the stored ones; the distinct total is known for lens known only."""
    key = ["address", "role", "lens"]
    # An entity has at most the stored number of points for each chain and side: they meet in one shuffle for sums and ranks.
    x = with_lenses(points.repartition("address", "role")).groupBy(*key, "amount_usdc").agg(F.sum("txn_count").alias("txn_count"), F.max("total_distinct_amounts").alias("d"))
    x = x.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("txn_count"), "amount_usdc"))).where(F.col("rank") <= top)
    return x.withColumn("total_distinct_amounts", F.when(F.col("lens") == "known", F.col("d"))).drop("d")


def counterparty_concentration(edge: DataFrame, facilitator_edge: DataFrame) -> DataFrame:
    """(address, role, lens) -> share of volume with the first and the first three counterparties.

    Pairs are summed as one row for both sides and lenses; totals and ranks read the same sums.
    """
    role = lambda name, own, other: F.struct(F.lit(name).alias("role"), F.col(own).alias("address"), F.col(other).alias("o"))
    sums = [F.sum("volume_usdc").alias("all"), F.sum(F.when(F.col("facilitator_known"), F.col("volume_usdc"))).alias("known")]
    pairs = edge.groupBy("payer", "payee").agg(*sums).withColumn("s", F.explode(F.array(role("payer", "payer", "payee"), role("payee", "payee", "payer"))))
    settled = facilitator_edge.groupBy("facilitator", "counterparty").agg(*sums).withColumn("s", role("facilitator", "facilitator", "counterparty"))
    key = ["address", "role", "lens"]
    lenses = F.explode(F.array(*[F.struct(F.lit(lens).alias("lens"), F.col(lens).cast("decimal(38,6)").alias("v")) for lens in ("all", "known")]))
    x = pairs.select("s.*", "all", "known").unionByName(settled.select("s.*", "all", "known")).withColumn("l", lenses).select("address", "role", "l.lens", "o", "l.v").where("v is not null")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("v"), "o"))
    first = x.withColumn("r", place).where("r <= 3").groupBy(key).agg(F.sum(F.when(F.col("r") == 1, F.col("v"))).alias("one"), F.sum("v").alias("three"))
    total = x.groupBy(key).agg(F.sum("v").alias("v"))
    return first.join(total, key).select(*key, share(F.col("one"), F.col("v")).alias("top1_share"), share(F.col("three"), F.col("v")).alias("top3_share"))


def fingerprints(days: DataFrame, points: DataFrame, edge: DataFrame, facilitator_edge: DataFrame) -> DataFrame:
    """Cadence, first amounts and concentration of every (address, role, lens)."""
    key = ["address", "role", "lens"]
    amounts = merged_price_points(points).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "amount_usdc", "txn_count"))).alias("price_points"), F.max("total_distinct_amounts").alias("distinct_amounts"))
    return cadence(days).join(amounts, key, "left").join(counterparty_concentration(edge, facilitator_edge), key, "left")


def ghosts(near: DataFrame, cap: int = 10) -> DataFrame:
    """Neighbours of lens all that are not among those of lens known, the first `cap` of each subject and direction."""
    x = near.groupBy("direction", "subject", "counterparty").agg(F.max(F.when(F.col("lens") == "all", F.col("volume_usdc"))).alias("volume_usdc"), F.bool_or(F.col("lens") == "known").alias("__known"))
    order = Window.partitionBy("direction", "subject").orderBy(F.desc("volume_usdc"), "counterparty")
    x = x.where("volume_usdc is not null and not __known").withColumn("place", F.row_number().over(order))
    return x.where(F.col("place") <= cap).select("direction", "subject", "counterparty", "volume_usdc", "place")


def primary_edges(near: DataFrame) -> DataFrame:
    """Each subject's edge with the highest share in lens known; ties by direction and counterparty."""
    x = near.where("lens = 'known'")
    order = Window.partitionBy("subject").orderBy(F.desc("share"), "direction", "counterparty")
    return x.withColumn("r", F.row_number().over(order)).where("r = 1").select("subject", "direction", "counterparty", "share")


def role_order(summary: DataFrame) -> DataFrame:
    """Roles of each address by payments in lens all, and its primary one (payer before payee before facilitator)."""
    x = summary.where("lens = 'all'")
    order = Window.partitionBy("address").orderBy(F.desc("txn_count"), "role")
    first = F.when(F.array_contains("r", "payer"), "payer").when(F.array_contains("r", "payee"), "payee").otherwise("facilitator")
    return x.withColumn("role_rank", F.row_number().over(order)).join(x.groupBy("address").agg(F.collect_set("role").alias("r")).select("address", first.alias("primary_role")), "address").select("address", "role", "role_rank", "txn_count", "primary_role")


def transaction_graph(p: DataFrame, cap: int = 128) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transactions, nodes, edges) of all transactions.

    A transaction has `events` payments, of which the first `cap` are drawn; paid_total is over all. It is decodable if
    it has one event and a direct method; self_settled if any payee is the facilitator.
    """
    w = Window.partitionBy("chain", "tx_hash")
    x = p.withColumns({"event_no": F.row_number().over(w.orderBy("log_index")), "events": F.count(F.lit(1)).over(w)})
    direct = F.col("method_selector").isin(*TRANSFER_SELECTORS, *RECEIVE_SELECTORS)
    tx = x.groupBy("chain", "tx_hash").agg(F.max("events").alias("events"), F.sum("amount_usdc").alias("paid_total"), F.bool_or(F.col("payee") == F.col("facilitator")).alias("self_settled"), (F.max("events") == 1).alias("one"), F.bool_and(direct).alias("direct"))
    tx = tx.select("chain", "tx_hash", "events", "paid_total", "self_settled", (F.col("one") & F.col("direct")).alias("decodable"), (F.col("events") > cap).alias("truncated"))
    drawn = x.where(F.col("event_no") <= cap).withColumn("event_id", F.concat_ws(":", F.lit("ev"), "tx_hash", "log_index"))
    party = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("id")) for r in ("payer", "payee", "facilitator")]))
    addresses = drawn.select("tx_hash", party.alias("s")).groupBy("tx_hash", F.col("s.id").alias("id")).agg(F.array_join(F.sort_array(F.collect_set("s.role")), ",").alias("roles"))
    nodes = tx.select("tx_hash", F.col("tx_hash").alias("id"), F.lit("tx").alias("kind"), F.lit(None).cast("string").alias("roles"))
    nodes = nodes.unionByName(drawn.select("tx_hash", F.col("event_id").alias("id"), F.lit("event").alias("kind"), F.lit(None).cast("string").alias("roles"))).unionByName(addresses.select("tx_hash", "id", F.lit("address").alias("kind"), "roles"))
    link = lambda kind, a, b: drawn.select("tx_hash", F.lit(kind).alias("kind"), F.col(a).alias("from_id"), F.col(b).alias("to_id"))
    lines = link("emits", "tx_hash", "event_id").unionByName(link("pays", "payer", "event_id")).unionByName(link("pays", "event_id", "payee")).unionByName(link("settles", "facilitator", "tx_hash"))
    return tx, nodes, lines.dropDuplicates()
