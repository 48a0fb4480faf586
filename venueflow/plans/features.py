"""Train and test feature frames from the input tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import date_int, make_id
from venueflow.operators import encode, profiles
from venueflow.operators.baseline import enrich_with_calendar
from venueflow.plans.forecast import parse_targets
from venueflow.session import bounded_side, materialize

# Columns that identify a row and are never features.
IDENTITY = ("id", "store_id", "visit_date", "visitors")
GROUPED = {
    "weekday": (("area_name", "dow"), ("genre_name", "dow")),
    "month": (("area_name", "month", "dow"), ("genre_name", "month", "dow")),
}


def store_features(stores: DataFrame, targets: DataFrame, tokens: int = 10) -> DataFrame:
    """Attributes of the stores to predict, with genre and area as codes and word codes."""
    wanted = profiles.only_known(stores, targets, "store_id")
    return encode.encode_tokens(wanted, {"genre_name": "/", "area_name": "-"}, tokens)


def weekday_calendar_codes(calendar: DataFrame) -> DataFrame:
    """Calendar with the day name as its alphabetical code."""
    return encode.label_encode(calendar, ["day_of_week"])


def weekday_profiles(history: DataFrame, measure: str = "visitors") -> DataFrame:
    """One row per store with history: a map from weekday to that weekday's profile (7 entries)."""
    by_weekday = profiles.profile(history, ["store_id", "dow"], measure)
    values = [c for c in by_weekday.columns if c not in ("store_id", "dow")]
    entry = F.struct("dow", F.struct(*values).alias("profile"))
    return by_weekday.groupBy("store_id").agg(F.map_from_entries(F.collect_list(entry)).alias("weekdays"))


def store_table(
    history: DataFrame, stores: DataFrame, wanted: DataFrame, how: str, tokens: int
) -> tuple[DataFrame, list[str]]:
    """Everything known per store in one row, and the names of the weekday profile columns.

    Attributes and profiles are given for the stores to predict only. The store's own code covers
    the training stores: the predicted ones with history, or all with history for ``how='left'``.
    """
    weekly = materialize(weekday_profiles(history), "weekly")
    # One row per store, written: Spark's estimate of targets made by exploding dates is far too small.
    wanted = materialize(wanted.select("store_id").distinct(), "wanted")
    asked = bounded_side(wanted)
    attributes = store_features(stores, asked, tokens)
    table = wanted.join(attributes, "store_id", "left")
    table = table.withColumn("is_target", F.lit(True))
    table = table.join(bounded_side(weekly), "store_id", "left" if how == "inner" else "full")
    if how == "left":
        table = table.withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    fitted_on = profiles.only_known(weekly, asked, "store_id") if how == "inner" else weekly
    codes = bounded_side(encode.fit_label_codes(fitted_on.select("store_id"), ["store_id"]))
    table = table.join(codes.select(F.col("label").alias("store_id"), F.col("code").alias("store_code")), "store_id", "left")
    table = table.withColumn("weekdays", F.when(F.col("is_target"), F.col("weekdays")))
    profile_columns = [f.name for f in weekly.schema["weekdays"].dataType.valueType.fields]
    return materialize(table, "stores"), profile_columns


def feature_frames(
    visits: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    targets: DataFrame,
    reservations_a: DataFrame,
    reservations_b: DataFrame,
    relation: DataFrame,
    how: str = "inner",
    far_only: bool = True,
    grouped: str | None = None,
    tokens: int = 10,
    unseen: str = "error",
) -> tuple[DataFrame, DataFrame]:
    """(train, test), one row per store and date with every feature column, sentinel-filled.

    ``how='inner'`` drops history of stores outside the targets, ``'left'`` keeps it. ``grouped``
    adds area and genre profiles per weekday (``'weekday'``) or month and weekday (``'month'``). A target store without any history fails the
    job, or gets the next free code with ``unseen='keep'``.
    """
    wanted = parse_targets(targets)
    history = profiles.date_parts(visits)
    horizon = profiles.date_parts(wanted.drop("id"))

    table, profile_columns = store_table(history, stores, wanted, how, tokens)
    days = materialize(weekday_calendar_codes(calendar), "days")
    own_b = profiles.translate_partner_ids(reservations_b, bounded_side(relation))
    bookings = bounded_side(materialize(profiles.paired_reservation_features(reservations_a, own_b, far_only=far_only), "bookings"))

    group_tables = []
    if grouped:
        grains = {"area_" if keys[0] == "area_name" else "genre_": keys for keys in GROUPED[grouped]}
        placed = bounded_side(table.filter("is_target").select("store_id", *[keys[0] for keys in grains.values()]), table)
        merged = materialize(profiles.profiles_at(history, grains, side=placed), "group-profiles")
        group_tables = [(keys, bounded_side(profiles.at_grain(merged, prefix, keys, prefix=prefix), merged)) for prefix, keys in grains.items()]
    next_code = table.select(F.max("store_code") + 1)

    def frame(rows: DataFrame, side: DataFrame, join: str) -> DataFrame:
        out = enrich_with_calendar(rows, days, "visit_date")
        # One join brings attributes, weekday profiles and code of a store.
        out = profiles.attach(out, bounded_side(side, table), ["store_id"], join)
        today = F.element_at("weekdays", F.col("dow"))
        out = out.withColumns({c: today.getField(c) for c in profile_columns})
        if unseen == "error":
            message = F.concat(F.lit("store without history: "), F.col("store_id"))
            code = F.coalesce("store_code", F.raise_error(message).cast("int"))
        else:
            code = F.coalesce("store_code", next_code.scalar())
        out = out.withColumn("store_code", code).drop("weekdays", "is_target")
        for keys, grouped_profile in group_tables:
            out = profiles.attach(out, grouped_profile, keys)
        out = profiles.attach(out, bookings, ["store_id", "visit_date"])
        out = profiles.reservation_totals(out)
        # Maxima over the stores this frame holds, from the store table instead of the joined rows.
        held = side if join == "left" else side.filter(F.col("weekdays").isNotNull())
        out = profiles.distance_to_max(out, {"latitude": "var_max_lat", "longitude": "var_max_long"}, held)
        out = out.withColumns(
            {
                "lon_plus_lat": F.col("longitude") + F.col("latitude"),
                "date_int": date_int("visit_date"),
                "id": make_id("store_id", "visit_date"),
            }
        )
        return encode.fill_sentinel(out)

    predicted = table.filter("is_target")
    train = frame(history, predicted if how == "inner" else table, how)
    return train, frame(horizon, predicted, "left")


def model_columns(train: DataFrame, also_exclude: Sequence[str] = ()) -> list[str]:
    return encode.feature_columns(train, [*IDENTITY, *also_exclude])
