"""Contracts of the location mapping (by version and time) and of external signals, and look-ups in both."""

from __future__ import annotations

import datetime as dt
import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
# States that the tables may have.
VERIFICATION = ["unverified", "verified", "needs_review", "rejected"]
LOCATION_STATES = ["pending", "matched", "not_found", "needs_review"]
GRAINS = {"weather": ["owner_user_id", "location", "signal_date", "observation_kind"], "promotion": ["owner_user_id", "location", "item", "signal_date"], "availability": ["owner_user_id", "location", "item", "signal_date"]}


def _count(test: Column, name: str) -> Column:
    return F.count(F.when(F.coalesce(test, F.lit(False)), 1)).alias(name)


def location_contract_check(m: DataFrame) -> DataFrame:
    """One row with the number of violations of each rule."""
    repeated = m.groupBy("owner_user_id", "branch_id", "valid_from").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("version_not_unique"))
    pair = c("latitude").isNull() != c("longitude").isNull()
    return m.agg(
        _count(c("valid_to") < c("valid_from"), "valid_range"), _count(pair, "coordinate_pair"), _count((F.abs("latitude") > 90) | (F.abs("longitude") > 180), "coordinate_bounds"),
        _count((c("distance_meters") < 0) | F.isnan("distance_meters"), "distance"), _count(F.coalesce(F.trim("source_type"), F.lit("")) == "", "source_type"), _count(F.coalesce(F.trim("source_reference"), F.lit("")) == "", "source_reference"),
        _count(~c("verification_status").isin(*VERIFICATION), "verification_status"),
        _count((c("verification_status") == "verified") & (c("verified_at").isNull() | (F.coalesce(F.trim("verified_by"), F.lit("")) == "")), "verified_without_proof"), _count(~c("location_status").isin(*LOCATION_STATES), "location_status"),
    ).crossJoin(repeated)


def location_current(m: DataFrame) -> DataFrame:
    return m.where((c("verification_status") == "verified") & c("valid_to").isNull())


def _segments(versions: pd.DataFrame) -> pd.DataFrame:
    """Of the versions of one branch, which holds from when to when (NaT: still): on each day the one that began last of those that
    cover it (of equal begins the largest station). One sweep over begins and ends."""
    rows = [(a, None if pd.isna(b) else b, s or "") for a, b, s in zip(versions["valid_from"], versions["valid_to"], versions["station_id"], strict=True) if not pd.isna(a) and (pd.isna(b) or b >= a)]
    rows.sort(key=lambda r: (r[0], r[2]))
    day = dt.timedelta(1)
    edges = sorted({r[0] for r in rows} | {r[1] + day for r in rows if r[1] is not None and r[1] < dt.date.max})
    out: list[list] = []
    open_: list[tuple[int, int]] = []  # the place of each version that has begun, the last first
    k = 0
    for at in edges:
        while k < len(rows) and rows[k][0] <= at:
            heapq.heappush(open_, (-k, k))
            k += 1
        while open_ and rows[open_[0][1]][1] is not None and rows[open_[0][1]][1] < at:
            heapq.heappop(open_)
        if out and out[-1][1] is None:
            out[-1][1] = at - day
        if open_:
            station = rows[open_[0][1]][2]
            if out and out[-1][2] == station and out[-1][1] == at - day:
                out[-1][1] = None
            else:
                out.append([at, None, station])
    if out and out[-1][1] is None and open_ and rows[open_[0][1]][1] is not None:
        out[-1][1] = rows[open_[0][1]][1]
    ids = versions[["owner_user_id", "branch_id"]].iloc[:1]
    return pd.DataFrame([(*ids.iloc[0], *r) for r in out], columns=["owner_user_id", "branch_id", "begins", "ends", "station_id"])


def location_segments(m: DataFrame) -> DataFrame:
    """owner_user_id, branch_id, begins, ends (null: open), station_id: which verified version holds when. A branch's segments don't overlap,
    and at most one is open, however the versions overlap. A branch's versions (one an import) are swept in one place."""
    v = m.where((c("verification_status") == "verified") & c("owner_user_id").isNotNull() & c("branch_id").isNotNull()).select("owner_user_id", "branch_id", "valid_from", "valid_to", "station_id")
    kind = {f.name: f.dataType.simpleString() for f in v.schema}
    return v.groupBy("owner_user_id", "branch_id").applyInPandas(_segments, f"owner_user_id {kind['owner_user_id']}, branch_id {kind['branch_id']}, begins date, ends date, station_id string")


def location_as_of(fact: DataFrame, m: DataFrame) -> DataFrame:
    """Fact rows with the location of their day, if any, each once. A segment that has ended is found by branch and month, of which it
    covers few days (a branch has 31 segments in a month at most); the open one by branch. So the work grows with the rows
    and the months, not with rows times versions."""
    segments = location_segments(m).withColumnRenamed("station_id", "__station")
    month = lambda d: F.trunc(d, "month")
    ended = segments.where("ends is not null").withColumn("__month", F.explode(F.sequence(month("begins"), month("ends"), F.expr("interval 1 month"))))
    still = segments.where("ends is null").select(c("owner_user_id").alias("__owner"), c("branch_id").alias("__branch"), c("begins").alias("__begins"), c("__station").alias("__open"))
    f, e = fact.withColumn("__month", month("business_date")).alias("f"), ended.alias("e")
    on = [c(f"f.{k}") == c(f"e.{k}") for k in ("owner_user_id", "branch_id", "__month")]
    out = f.join(e, [*on, c("f.business_date").between(c("e.begins"), c("e.ends"))], "left").select("f.*", "e.__station")
    out = out.join(still, (c("owner_user_id") == c("__owner")) & (c("branch_id") == c("__branch")) & (c("business_date") >= c("__begins")), "left")
    return out.select(*fact.columns, F.nullif(F.coalesce("__station", "__open"), F.lit("")).alias("station_id"))


def location_replace_import(current: DataFrame, batch: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """The mapping after an import, and its audit row for each owner: rows of the batch, open versions before, closed ones, inserted
    ones, and both as JSON (an owner's branches, one by one in order). Open versions of the batch's branches end the day before."""
    keys = batch.select("owner_user_id", "branch_id").distinct().withColumn("__new", F.lit(True))
    marked = current.join(keys, ["owner_user_id", "branch_id"], "left")
    closing = c("__new") & c("valid_to").isNull()
    after = marked.withColumn("valid_to", F.when(closing, F.date_sub(F.lit(day).cast("date"), 1)).otherwise(c("valid_to"))).select(*current.columns).unionByName(batch.select(*current.columns))
    snapshot = lambda name: F.to_json(F.array_sort(F.collect_list(F.struct("branch_id", "station_id", c("valid_from").cast("string").alias("valid_from"))))).alias(name)
    owners = batch.select("owner_user_id").distinct()
    before = marked.join(owners, "owner_user_id", "left_semi").groupBy("owner_user_id").agg(F.count(F.when(c("valid_to").isNull(), 1)).alias("previous_current"), F.count(F.when(closing, 1)).alias("closed"), snapshot("previous_mappings"))
    new = batch.groupBy("owner_user_id").agg(F.count("*").alias("row_count"), F.count("*").alias("inserted"), snapshot("imported_mappings"))
    audit = new.join(before, "owner_user_id", "left").withColumns({k: F.coalesce(k, F.lit(0)) for k in ("previous_current", "closed")}).withColumn("previous_mappings", F.coalesce("previous_mappings", F.lit("[]")))
    return after, audit


def signal_upsert(current: DataFrame, new: DataFrame, kind: str) -> DataFrame:
    """One row for each grain, null keys equal; new rows win, of several the latest ``updated_at``, then the largest values."""
    grain = GRAINS[kind]
    both = current.withColumn("__order", F.lit(0)).unionByName(new.withColumn("__order", F.lit(1)))
    values = [k for k in current.columns if k not in grain]
    return both.groupBy(*grain).agg(F.max_by(F.struct(*values), F.struct("__order", "updated_at", *(k for k in values if k != "updated_at"))).alias("v")).select(*grain, "v.*")


def signal_contract_check(weather: DataFrame, availability: DataFrame) -> DataFrame:
    return weather.agg(_count(~c("observation_kind").isin("forecast", "actual"), "weather_kind"), _count(c("signal_date").isNull(), "weather_date")).crossJoin(availability.agg(_count(c("item").isNull(), "availability_item"), _count(c("signal_date").isNull(), "availability_date")))


PLACE, ITEM = ("location",), ("location", "product_no")
#: Of each signal, the keys that a row of it may be bound to, and the kind of weather.
SIGNALS = {"weather_forecast": (PLACE, "forecast"), "weather_actual": (PLACE, "actual"), "promotion": (ITEM, None), "availability": (ITEM, None)}


def _product(item: Column) -> Column:
    """The key of a product in a map; all products are the empty text."""
    return F.coalesce(F.concat(F.lit("="), item), F.lit(""))


def scope_maps(weather: DataFrame | None = None, promotion: DataFrame | None = None, availability: DataFrame | None = None) -> DataFrame:
    """owner_user_id, business_date, location (null: all places) and for each signal a map of product to value. Each signal is read
    once, and all are shuffled together once, by owner, day and place. Of several values of one scope the largest counts."""
    base = [c("owner_user_id"), c("signal_date").alias("business_date"), c("location")]
    parts = []
    if weather is not None:
        kind = c("observation_kind")
        parts.append(weather.select(*base, F.lit("").alias("item"), F.when(kind == "forecast", "weather_forecast").when(kind == "actual", "weather_actual").alias("signal"), "value"))
    parts += [df.select(*base, _product(c("item")).alias("item"), F.lit(name).alias("signal"), "value") for name, df in (("promotion", promotion), ("availability", availability)) if df is not None]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    place = ["owner_user_id", "business_date", "location"]
    best = every.where("signal is not null").repartition(*place).groupBy(*place, "signal", "item").agg(F.max("value").alias("value"))
    maps = (F.map_from_entries(F.collect_list(F.when(c("signal") == name, F.struct("item", "value")))).alias(name) for name in SIGNALS)
    return best.groupBy(*place).agg(*maps)


def with_signals(fact: DataFrame, maps: DataFrame, names: list[str]) -> DataFrame:
    """``fact`` with the values of some signals for the row's day and scope. A null key of a signal holds for all values of it; of the
    signals that fit, the one with most own keys counts, and of equally many the one with a place of its own. The fact is joined with
    its own place's maps and with those for all places, whatever the number of signals; the scope is looked up in the maps."""
    own = maps.where("location is not null").select("owner_user_id", "business_date", "location", *(c(n).alias(f"__own_{n}") for n in names))
    wide = maps.where("location is null").select("owner_user_id", "business_date", *(c(n).alias(f"__all_{n}") for n in names))
    out = fact.join(own, ["owner_user_id", "business_date", "location"], "left").join(wide, ["owner_user_id", "business_date"], "left")
    for n in names:
        at = [_product(c("product_no")), F.lit("")] if SIGNALS[n][0] == ITEM else [F.lit("")]
        out = out.withColumn(n, F.coalesce(*(F.try_element_at(c(f"__{side}_{n}"), key) for side in ("own", "all") for key in at)))
    return out.select(*fact.columns, *names)


FORECAST, RETROSPECTIVE = ["weather_forecast", "promotion"], ["weather_forecast", "promotion", "weather_actual", "availability"]


def forecast_frame(fact: DataFrame, maps: DataFrame) -> DataFrame:
    """Only what is known ahead: forecasts and promotions. fact: with the column location; maps: scope_maps of the signals."""
    return with_signals(fact, maps, FORECAST)


def retrospective_frame(fact: DataFrame, maps: DataFrame) -> DataFrame:
    """The forecast frame with what is known afterwards: actual weather and availability."""
    return with_signals(fact, maps, RETROSPECTIVE)
