"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1]. Its integral, scaled to the
source's target, is the cumulative token demand D(t). Documents of a source stand in a fixed
pseudo-random order (repeated while the target exceeds the source), so each copy has a cumulative
token offset c, and its training position is the t with D(t) = c. Sorting by position mixes the
sources in the proportions of the schedules at every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueflow.llm.common import SPACE, free_names, row_key
from venueflow.session import materialize

MAX_EPOCHS = 3
WEIGHT_CYCLE = (1, 2, 3)
RAMP_CYCLE = (0.5, 0.0, -0.5)  # slope of a source's schedule: weight(t) = weight * (1 + ramp * (2 t - 1))
COPIES = 4096  # equal rows that stand together in a source's order
SLICE_DIGITS = 4  # a source's order is cut into 16^4 slices; sums run inside a slice, over slice sums before it


def size(text: Column) -> Column:
    """Words of a text; null has none."""
    body = F.coalesce(text, F.lit(""))
    return F.size(F.array_remove(F.split(body, SPACE), "")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, ramp: the words each source shall give.

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and share all words. A target
    stops at MAX_EPOCHS times its source; the excess goes to the rest by weight. Sources reach that
    stop in order of size per weight, so running sums over this order give the share that remains.
    The windows run over one row per source, in one task: sources are named collections, few beside
    the documents (a million of them would be a few seconds' work).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(WEIGHT_CYCLE)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (nth + 1).cast("int"))
    per = per.select("*", pick(WEIGHT_CYCLE).alias("weight"), pick(RAMP_CYCLE).alias("ramp"))
    most = MAX_EPOCHS * F.col("source_size")
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = Window.orderBy(most / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*", most.alias("most"), F.sum("source_size").over(everything).alias("total"), F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(most).over(filled), F.lit(0)).alias("most_before"),
        F.coalesce(F.sum("weight").over(filled), F.lit(0)).alias("weight_before"),
    )
    stops = F.col("most") * (F.col("weights") - F.col("weight_before")) < F.col("weight") * (F.col("total") - F.col("most_before"))
    per = per.select("*", stops.alias("stops"))
    over = lambda c: F.sum(F.when(F.col("stops"), F.col(c)).otherwise(0)).over(everything)
    share = F.col("weight") * (F.col("total") - over("most")).cast("double") / (F.col("weights") - over("weight")).cast("double")
    return per.select("source", "source_size", F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share).alias("target"), "ramp")


def positions(c: Column, target: Column, ramp: Column) -> Column:
    """The t in [0, 1] at which the demand ``target * ((1 - ramp) t + ramp t^2)`` reaches ``c``."""
    u = F.least(F.lit(1.0), F.greatest(F.lit(0.0), c / target))
    # Solved without cancellation, so that it also holds for ramps near zero.
    return 2 * u / ((1 - ramp) + F.sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * u))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", key: Column | None = None) -> DataFrame:
    """One row per document: key, doc_id, source, size, source_size, target, taken, copies, begins, ramp.

    A document is taken in every whole epoch its source's target holds, and once more if its middle
    lies before the rest; so taken words miss a target by half a document at most. The order within a
    source is that of a hash of id, size and text; reruns agree. Equal rows are counted first and stand
    in the order in groups of ``COPIES``, each at a place of its own, so neither a missing or repeated
    id nor a text that fills the table gathers rows. Sums run in two steps, over slices of that order
    and inside each slice, so no source meets in one task. Null texts have size 0, sources may be
    null, rows repeated or without id count on their own, and an empty table gives an empty one.
    """
    body = F.coalesce(docs[text], F.lit(""))
    place = F.md5(F.concat_ws(":", F.coalesce(docs[doc_id].cast("string"), F.lit("")), size(body).cast("string"), F.md5(body)))
    rows = docs.select(
        (key if key is not None else F.lit(None).cast("long")).alias("key"), docs[doc_id].alias("doc_id"), docs[source].alias("source"),
        size(docs[text]).alias("size"), place.alias("place"),
    )
    equal = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    units = equal.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES).cast("int"))).alias("group"))
    units = units.withColumn("n", F.least(F.lit(COPIES), F.col("n") - F.col("group") * COPIES).cast("int"))
    units = units.withColumn("spot", F.md5(F.concat_ws(":", "place", F.col("group").cast("string")))).drop("place", "group")
    units = materialize(units.withColumn("slice", F.substring("spot", 1, SLICE_DIGITS)), "mix-sizes")
    plan = _slice_plan(units.select("source", "slice", (F.col("size") * F.col("n")).alias("size")))
    within = Window.partitionBy("source", "slice").orderBy("spot", F.col("doc_id").asc_nulls_last(), "size", "key").rowsBetween(Window.unboundedPreceding, -1)
    rows = units.withColumn("ahead", F.coalesce(F.sum(F.col("size") * F.col("n")).over(within), F.lit(0)))
    rows = rows.join(plan, rows["source"].eqNullSafe(plan["slice_source"]) & (rows["slice"] == plan["slice_name"]))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("nth"))
    begins = F.col("slice_begins") + F.col("ahead") + F.col("nth") * F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    extra = F.when((F.col("size") > 0) & (begins + F.col("size") / 2 < rest), 1).otherwise(0)
    rows = rows.withColumn("begins", begins)
    rows = rows.withColumn("copies", F.least(epochs + extra, F.lit(MAX_EPOCHS)).cast("long"))
    return rows.select(
        "key", "doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "begins", "ramp"
    )


def _slice_plan(rows: DataFrame) -> DataFrame:
    """Where each slice of a source begins, beside the source's target.

    Slice sums add up in two steps of at most 256 rows a group: slices of a block, blocks of a source.
    """
    per_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")).withColumn("block", F.substring("slice", 1, SLICE_DIGITS // 2))
    per_block = per_slice.groupBy("source", "block").agg(F.sum("slice_size").alias("block_size"))
    earlier = lambda by, along: Window.partitionBy(*by).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.withColumn("block_begins", F.coalesce(F.sum("block_size").over(earlier(["source"], "block")), F.lit(0)))
    targets = source_targets(rows)
    blocks = per_block.join(targets, per_block["source"].eqNullSafe(targets["source"])).select(
        per_block["source"].alias("block_source"), F.col("block").alias("block_name"), "block_begins", "source_size", "target", "ramp"
    )
    per_slice = per_slice.withColumn("in_block", F.coalesce(F.sum("slice_size").over(earlier(["source", "block"], "slice")), F.lit(0)))
    same = per_slice["source"].eqNullSafe(blocks["block_source"]) & (per_slice["block"] == blocks["block_name"])
    return per_slice.join(blocks, same).select(
        F.col("source").alias("slice_source"), F.col("slice").alias("slice_name"), (F.col("block_begins") + F.col("in_block")).alias("slice_begins"),
        "source_size", "target", "ramp",
    )


def with_positions(mixed: DataFrame) -> DataFrame:
    """``mixed`` with ``first_position``: where in training the first copy stands (null if not taken)."""
    first = positions(F.col("begins").cast("double"), F.col("target"), F.col("ramp"))
    return mixed.withColumn("first_position", F.when(F.col("taken") > 0, first))


def training_order(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents in training order: one row per copy taken, range-sorted by position; same columns.

    Documents not taken go. Wholly equal rows are first counted and then mixed one by one.
    """
    (own, seat) = free_names(docs, "row_key", "seat")
    keyed = docs.withColumn(own, row_key(docs))
    mixed = mix(keyed, doc_id, source, text, keyed[own]).filter("taken > 0")
    steps = mixed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("epoch"))
    at = positions((F.col("begins") + F.col("epoch") * F.col("source_size")).cast("double"), F.col("target"), F.col("ramp"))
    seats = steps.select(F.col("key").alias("plan_key"), F.col("doc_id").alias("plan_id"), at.alias(seat))
    # Equal rows have one key and are kept once; every seat takes that row, one by one.
    one = keyed.dropDuplicates([own, doc_id])
    placed = seats.join(one, (one[own] == seats["plan_key"]) & one[doc_id].eqNullSafe(seats["plan_id"]))
    placed = placed.select(*[one[c] for c in docs.columns], one[own], seats[seat])
    return placed.orderBy(seat, own).select(*docs.columns)


def sql() -> str:
    """The same mix in DuckDB."""
    cycle = "[" + ", ".join(map(str, WEIGHT_CYCLE)) + "]"
    ramps = "[" + ", ".join(map(str, RAMP_CYCLE)) + "]"
    return rf"""
    WITH w0 AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             md5(coalesce(text, '')) AS said FROM documents),
    p0 AS (SELECT doc_id, source, size, md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR), said)) AS place FROM w0),
    n0 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, place) - 1 AS nth FROM p0),
    s AS (SELECT doc_id, source, size, nth, md5(concat_ws(':', place, CAST(nth // {COPIES} AS VARCHAR))) AS place FROM n0),
    per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
    w AS (SELECT *, {MAX_EPOCHS} * source_size AS most,
                 {cycle}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHT_CYCLE)} + 1] AS weight,
                 CAST({ramps}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(RAMP_CYCLE)} + 1] AS DOUBLE) AS ramp FROM per),
    f AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
                 coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(weight) OVER o, 0) AS weight_before
          FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    g AS (SELECT *, most * (weights - weight_before) < weight * (total - most_before) AS stops FROM f),
    t AS (SELECT source, source_size, ramp, CASE WHEN stops THEN CAST(most AS DOUBLE) ELSE
                 weight * CAST(total - sum(CASE WHEN stops THEN most ELSE 0 END) OVER () AS DOUBLE)
                 / CAST(weights - sum(CASE WHEN stops THEN weight ELSE 0 END) OVER () AS DOUBLE) END AS target FROM g),
    r AS (SELECT s.*, source_size, target, ramp,
                 coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id NULLS LAST, size, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
          FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM r),
    p AS (SELECT *, CAST(least(epochs + CASE WHEN size > 0 AND begins + size / 2 < target - epochs * source_size THEN 1 ELSE 0 END, {MAX_EPOCHS}) * size AS BIGINT) AS taken FROM e)
    SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN
           2 * least(1.0, begins / target) / ((1 - ramp) + sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * least(1.0, begins / target))) END AS first_position
    FROM p
    """
