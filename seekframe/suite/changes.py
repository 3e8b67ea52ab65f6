"""Change feeds: the event table read as saves, deletes and restores of users."""

from pyspark.sql import functions as F

from seekframe.operators.soft_delete import delete_rows, force_delete_rows, restore_rows
from seekframe.session import shared_dir
from seekframe.sources.tables import table
from seekframe.spec import SearchSpec
from seekframe.streaming.changes import final_documents, last_actions, relevant_change, with_actions
from seekframe.streaming.sync import apply_changes, sync_stream
from seekframe.suite.registry import case
from seekframe.suite.tables import ORDERS, new_catalog, orders

USERS = SearchSpec(
    "users",
    "user_id",
    {"band": lambda c: F.floor(c("value") / 10)},
    deleted="deleted",
    should_index=lambda c: c("value") >= 5,
)
KEPT = USERS.with_(keep_deleted=True)


def feed(events):
    """seq, ts, op, before, after of each event. The row's own JSON number stands
    for the value before the change."""
    op = (
        F.when(F.col("event_type") == "signup", "insert")
        .when(F.col("event_type").isin("view", "purchase"), "update")
        .when(F.col("event_type") == "click", "restore")
        .when(F.col("value") < 10, "hard_delete")
        .otherwise("soft_delete")
    )
    prior = F.get_json_object("props", "$.k").cast("double") / 4
    gone = F.when(F.col("op") == "soft_delete", F.col("ts"))
    before = F.struct("user_id", prior.alias("value"), F.when(F.col("op") == "restore", F.col("ts")).alias("deleted"))
    after = F.struct("user_id", "value", gone.alias("deleted"))
    return events.withColumn("op", op).select(
        F.col("event_id").alias("seq"),
        "ts",
        "op",
        F.when(F.col("op") != "insert", before).alias("before"),
        F.when(F.col("op") != "hard_delete", after).alias("after"),
    )


_FEED = """
WITH f AS (SELECT event_id AS seq, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 4 AS prior,
    CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type IN ('view', 'purchase') THEN 'update'
         WHEN event_type = 'click' THEN 'restore' WHEN value < 10 THEN 'hard_delete' ELSE 'soft_delete' END AS op
    FROM events),
e AS (SELECT *, op = 'insert' OR prior >= 5 AS was, value >= 5 AS now,
    op = 'insert' OR floor(prior / 10) <> floor(value / 10) AS changed FROM f),
s AS (SELECT *, CASE WHEN now THEN 'upsert' WHEN was THEN 'delete' ELSE 'skip' END AS sync FROM e),
a AS (SELECT *, CASE WHEN op IN ('insert', 'update') THEN CASE WHEN changed THEN sync ELSE 'skip' END
    WHEN op = 'soft_delete' THEN CASE WHEN was THEN {soft} ELSE 'skip' END
    WHEN op = 'hard_delete' THEN 'delete' ELSE sync END AS action FROM s),
l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS r FROM a WHERE action <> 'skip')
"""
_DROP = _FEED.format(soft="'delete'")
_KEEP = _FEED.format(soft="sync")


def _feed(spark, folder):
    return feed(table(spark, folder, "events"))


@case("cdc_actions", _DROP + "SELECT seq, op, action FROM a")
def cdc_actions(spark, folder):
    return with_actions(_feed(spark, folder), USERS).select("seq", "op", "action")


@case("cdc_last", _DROP + "SELECT user_id AS key, action, op, seq FROM l WHERE r = 1")
def cdc_last(spark, folder):
    return last_actions(_feed(spark, folder), USERS).select("key", "action", "op", "seq")


@case(
    "cdc_final_docs",
    _DROP + "SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS band FROM l WHERE r = 1 AND action = 'upsert'",
)
def cdc_final_docs(spark, folder):
    return final_documents(_feed(spark, folder), USERS)


@case(
    "cdc_soft_delete",
    _KEEP
    + """SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS band, CASE WHEN op = 'soft_delete' THEN 1 ELSE 0 END AS __soft_deleted
         FROM l WHERE r = 1 AND action = 'upsert'""",
)
def cdc_soft_delete(spark, folder):
    """Soft-deleted rows stay, flagged."""
    return final_documents(_feed(spark, folder), KEPT)


@case("cdc_restore", _DROP + "SELECT seq, action FROM a WHERE op = 'restore'")
def cdc_restore(spark, folder):
    return with_actions(_feed(spark, folder).where("op = 'restore'"), USERS).select("seq", "action")


@case("cdc_update_gate", _DROP + "SELECT seq, changed FROM e WHERE op = 'update'")
def cdc_update_gate(spark, folder):
    updates = _feed(spark, folder).where("op = 'update'")
    return updates.select("seq", relevant_change(updates, USERS).alias("changed"))


@case(
    "cdc_stream",
    _KEEP
    + """SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS band, CASE WHEN op = 'soft_delete' THEN 1 ELSE 0 END AS __soft_deleted
         FROM l WHERE r = 1 AND action = 'upsert'""",
)
def cdc_stream(spark, folder):
    """The feed as a stream, ending in the same index as the batch query."""
    events = table(spark, folder, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events.parquet*")
    catalog = new_catalog(spark)
    catalog.create("users", "user_id", language="simple", buckets=4)
    sync_stream(feed(stream), catalog, "users", KEPT, shared_dir(spark)).awaitTermination()
    return catalog.open("users").docs()


@case(
    "sync_late",
    _DROP + "SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS band FROM l WHERE r = 1 AND action = 'upsert'",
)
def sync_late(spark, folder):
    """Half of the changes come one batch late, after newer ones of the same users: the newer ones stay."""
    changes, index = _feed(spark, folder), new_catalog(spark).create("users", "user_id", language="simple", buckets=4)
    index = apply_changes(index, changes.where("seq % 2 = 0"), USERS, ("feed", 0))
    index = apply_changes(index, changes.where("seq % 2 = 1"), USERS, ("feed", 1))
    return index.docs()


def _orders_hit(spark, folder):
    """Orders, and the keys of those with a returned item."""
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return orders(spark, folder), returned


def _at():
    return F.lit("2001-02-03 04:05:06").cast("timestamp_ntz")


_RETURNED = "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"


@case(
    "soft_delete_rows",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey IN {_RETURNED} THEN TIMESTAMP '2001-02-03 04:05:06'
            WHEN o_orderstatus = 'F' THEN o_orderdate END AS deleted FROM orders""",
)
def soft_delete_rows(spark, folder):
    rows, keys = _orders_hit(spark, folder)
    return delete_rows(rows, ORDERS, keys, _at()).table.select("o_orderkey", "deleted")


@case(
    "restore_rows",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey NOT IN {_RETURNED} AND o_orderstatus = 'F' THEN o_orderdate END AS deleted
        FROM orders""",
)
def restored(spark, folder):
    rows, keys = _orders_hit(spark, folder)
    return restore_rows(rows, ORDERS, keys, _at()).table.select("o_orderkey", "deleted")


@case("force_delete_rows", f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN {_RETURNED}")
def force_deleted(spark, folder):
    rows, keys = _orders_hit(spark, folder)
    return force_delete_rows(rows, ORDERS, keys, _at()).table.select("o_orderkey")


@case(
    "delete_sync",
    f"""SELECT o_orderkey, o_orderstatus, 'upsert' AS action FROM orders WHERE o_orderkey IN {_RETURNED} AND o_orderstatus <> 'P'
        UNION ALL SELECT o_orderkey, o_orderstatus, 'skip' FROM orders WHERE o_orderkey IN {_RETURNED} AND o_orderstatus = 'P'""",
)
def delete_sync(spark, folder):
    """What a soft delete asks of an index that keeps trashed rows of open and finished orders."""
    spec = ORDERS.with_(keep_deleted=True, should_index=lambda c: c("o_orderstatus") != "P")
    rows, keys = _orders_hit(spark, folder)
    acted = with_actions(delete_rows(rows, spec, keys, _at()).changes, spec)
    return acted.select("before.o_orderkey", "before.o_orderstatus", "action")
