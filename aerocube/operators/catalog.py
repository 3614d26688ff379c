"""The collection catalog: who sees what, states, and copies of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import coverage_dir
from .ground import numbered


def top_recent(df: DataFrame, n: int, id_: str = "id") -> DataFrame:
    """The n rows with the highest ids, in ascending order."""
    return df.orderBy(F.desc(id_)).limit(n).orderBy(id_)


def by_name(df: DataFrame, use_case: int | None = None) -> DataFrame:
    """Collections (of a use case) in the order of their names."""
    return (df if use_case is None else df.filter(F.col("use_case_id") == use_case)).orderBy("name")


def days_in_order(df: DataFrame, t: str) -> DataFrame:
    """(day, n): how many rows start on each day, in order; sorted after the counts are made, so few rows are."""
    return df.groupBy(F.date_format(t, "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n")).orderBy("day")


def last_item(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(1)


def visible_open(df: DataFrame, user: Column, open_access: str = "AO", closed_ipr: str = "I00") -> DataFrame:
    """Open collections that are neither the user's own nor of the closed kind; unknown owners and kinds stay."""
    return df.filter((F.col("access") == open_access) & ~F.col("uploaded_by").eqNullSafe(user) & ~F.col("ipr").eqNullSafe(F.lit(closed_ipr)))


def visible_mine(df: DataFrame, user: Column) -> DataFrame:
    return df.filter(F.col("uploaded_by") == user)


def visible_group(df: DataFrame, group: str) -> DataFrame:
    return df.filter(F.col("group") == group)


def visible_usecase(df: DataFrame, bridge: DataFrame, use_case: int) -> DataFrame:
    """Collections of a use case through (collection_id, use_case_id)."""
    ids = bridge.filter(F.col("use_case_id") == use_case).select(F.col("collection_id").alias("id"))
    return df.join(ids, "id", "left_semi")


def use_cases(bridge: DataFrame, cases: DataFrame) -> DataFrame:
    """(collection_id, use_case): the names of each collection's use cases, from (collection_id, use_case_id) and (id, name)."""
    return bridge.distinct().join(cases.select(F.col("id").alias("use_case_id"), F.col("name").alias("use_case")), "use_case_id").select("collection_id", "use_case")


def visible_union(*lists: DataFrame) -> DataFrame:
    """Lists one after the other; a collection that is in several is listed several times."""
    return reduce(DataFrame.unionByName, lists)


def visible_to(df: DataFrame, user: int, admin: bool, **options) -> DataFrame:
    """All for an administrator, else own and open ones."""
    return df if admin or user == 1 else visible_union(visible_mine(df, F.lit(user)), visible_open(df, F.lit(user), **options))


def user_profiles(users: DataFrame, profiles: DataFrame, key: str = "user_id") -> DataFrame:
    """users with their profile; a user without one is left out. Profiles should be one per user."""
    return users.join(profiles, key)


def distinct_outputs(outputs: DataFrame, path: str) -> DataFrame:
    """The folders that outputs went to, each once."""
    return outputs.select(path).filter(F.col(path).isNotNull()).distinct()


def queue_pick(df: DataFrame, *keys: str) -> DataFrame:
    """The next item of each state: the smallest id."""
    return df.groupBy(*keys).agg(F.min("id").alias("id"))


def same_bbox(df: DataFrame, *keys: str) -> DataFrame:
    """Whether all granules of a collection share one box, and so can be animated."""
    box = F.struct("north", "west", "south", "east")
    return df.groupBy(*keys).agg((F.count_distinct(box) == 1).alias("same_bbox"))


def clone_rows(df: DataFrame, first_id: Column, **overrides: Column) -> DataFrame:
    """df and a copy of each row under a new id, with some columns replaced."""
    copies = df.withColumns({c: v.cast(df.schema[c].dataType) for c, v in overrides.items()}).withColumn("id", first_id + F.col("id"))
    return df.unionByName(copies.select(df.columns))


def fan_rows(uploads: DataFrame, outputs: DataFrame, first_id: int, status: str) -> DataFrame:
    """uploads (id, name, location, coverage_id, status, ...) after each brought forth some outputs (id, coverage_id, location).

    An upload with one output takes its coverage and location. With several it takes those of the last one by coverage, and for each
    other one a copy of its row is added under a new id after first_id; names then get the output's collection (coverage_dir)
    appended. Uploads without outputs stay. Repeated outputs count once; new ids are those of ground.numbered()."""
    outputs = outputs.select("id", "coverage_id", "location").distinct()
    counts = outputs.groupBy("id").agg(F.count("*").alias("n"), F.max("coverage_id").alias("last"))
    made = outputs.withColumnsRenamed({"coverage_id": "to", "location": "at"}).join(counts, "id")
    # of one coverage's several locations the greatest is the upload's own
    own = made.filter(F.col("to") == F.col("last")).groupBy("id").agg(F.max("at").alias("at"), F.first("to").alias("to"), F.first("n").alias("n"))
    extra = made.join(own.select("id", F.col("to").alias("own_to"), F.col("at").alias("own_at")), "id").filter((F.col("to") != F.col("own_to")) | ~F.col("at").eqNullSafe(F.col("own_at")))
    extra = numbered(extra.withColumn("key", F.concat_ws("/", F.col("id").cast("string"), "to", "at")), "key", first_id, "new_id")
    name = F.when(F.col("n") > 1, F.concat("name", F.lit(" "), coverage_dir(F.col("to")))).otherwise(F.col("name"))
    changed = {"status": F.when(F.col("to").isNotNull(), F.lit(status)).otherwise(F.col("status")), "location": F.when(F.col("to").isNotNull(), F.col("at")).otherwise(F.col("location")), "name": F.when(F.col("to").isNotNull(), name).otherwise(F.col("name")), "coverage_id": F.coalesce("to", "coverage_id")}
    first = uploads.join(own, "id", "left").withColumns(changed).select(uploads.columns)
    more = uploads.join(extra, "id").withColumns(changed).withColumn("id", F.col("new_id").cast(uploads.schema["id"].dataType)).select(uploads.columns)
    return first.unionByName(more)


def update_rows(df: DataFrame, changes: DataFrame) -> DataFrame:
    """df with the status, location and coverage_id of changes (by id) where given; a name there is appended. Of several changes
    of one id the greatest by their columns counts, so rows don't multiply."""
    changes = changes.groupBy("id").agg(F.max(F.struct(*[c for c in changes.columns if c != "id"])).alias("c")).select("id", "c.*")
    new = changes.select("id", *[F.col(c).alias(f"new_{c}") for c in changes.columns if c != "id"])
    out = df.join(new, "id", "left")
    for c in changes.columns:
        if c == "name":
            out = out.withColumn("name", F.concat("name", F.coalesce("new_name", F.lit(""))))
        elif c != "id":
            out = out.withColumn(c, F.coalesce(f"new_{c}", c))
    return out.select(df.columns)


#: (from, event, to): the states of an uploaded product.
TRANSITIONS = [
    ("uploading", "fetched", "processing"),
    ("uploading", "fetch_failed", "Download_Error"),
    ("processing", "converted", "processed"),
    ("processing", "failed", "Processing_Error"),
    ("processing", "unknown_format", "Error_Processor_not_found"),
    ("processed", "loaded", "mwcs_processed"),
    ("processed", "load_failed", "mwcs_Error"),
    ("mwcs_processed", "synced", "Available"),
    ("mwcs_processed", "sync_failed", "Sync_Error"),
    ("reprocess", "reprocessed", "processed"),
]


def advance(items: DataFrame, events: DataFrame) -> DataFrame:
    """items (id, status) after each one's event (id, event); an event that doesn't fit a state changes nothing. Of several
    events of one id the first by name that fits counts."""
    table = items.sparkSession.createDataFrame(TRANSITIONS, "status string, event string, next string")
    moved = items.join(events.select("id", "event").distinct(), "id").join(F.broadcast(table), ["status", "event"])
    moved = moved.groupBy("id").agg(F.min_by("next", "event").alias("next"))
    return items.join(moved, "id", "left").select("id", F.coalesce("next", "status").alias("status"))


def follow(items: DataFrame, events: DataFrame) -> DataFrame:
    """(id, status, since, path, rejected) of items (id, status) after all their events (id, t, event), in the order of t, then of name.

    path: the states an item was in, as structs (status, since, seconds), the first without a beginning and the last without an
    end. rejected: the events that didn't fit the state they met, as structs (t, event); they change nothing. An event that is
    repeated counts once; those without a time or name don't count. Events may come in any order: an item's are sorted before
    they are folded. An item has some dozen of them."""
    table = F.create_map(*[F.lit(x) for a, e, b in TRANSITIONS for x in (f"{a}|{e}", b)])
    known = events.filter("t is not null and event is not null").groupBy("id").agg(F.sort_array(F.collect_set(F.struct("t", "event"))).alias("all"))
    nothing = F.array().cast("array<struct<t:timestamp,event:string>>")
    start = F.struct(F.col("status").alias("status"), F.array(F.struct(F.col("status").alias("status"), F.lit(None).cast("timestamp").alias("since"))).alias("path"), nothing.alias("rejected"))

    def step(s, e):
        to = F.try_element_at(table, F.concat(s["status"], F.lit("|"), e["event"]))
        moved = F.concat(s["path"], F.array(F.struct(to.alias("status"), e["t"].alias("since"))))
        lost = F.concat(s["rejected"], F.array(F.struct(e["t"].alias("t"), e["event"].alias("event"))))
        return F.struct(F.coalesce(to, s["status"]).alias("status"), F.when(to.isNotNull(), moved).otherwise(s["path"]).alias("path"), F.when(to.isNull(), lost).otherwise(s["rejected"]).alias("rejected"))

    rows = items.select("id", "status").join(known, "id", "left")
    rows = rows.select("id", F.aggregate(F.coalesce("all", nothing), start, step).alias("s"))
    path = F.col("s.path")
    spent = F.transform(path, lambda p, i: F.struct(p["status"].alias("status"), p["since"].alias("since"), (F.unix_seconds(F.get(path, i + 1)["since"]) - F.unix_seconds(p["since"])).alias("seconds")))
    return rows.select("id", "s.status", F.element_at(path, -1)["since"].alias("since"), spent.alias("path"), F.col("s.rejected").alias("rejected"))
