"""What Spark is asked to do: pruning, pushdown, early limits, no products, no whole group in one task."""

import re

from pyspark.sql import functions as F

from tidewire import operators as op
from tidewire.plans import numbered
from tidewire.plans.joins import copied_to_pieces, dealt_to_pieces, hot_keys
from tidewire.sources import page_objects
from workloads.catalog import QUERIES
from workloads.triggering import located
from workloads.views import table


def physical(df) -> str:
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan =="):]


def test_body_is_not_read_unless_used(spark, sf):
    plan = physical(QUERIES["retrieved_routes"](spark, sf))
    assert "text:string" not in plan and "html:string" not in plan
    fetched = op.retrieve_lenient(located(spark, sf), table(spark, sf, "objects")).select("trigger_id", "body")
    assert "text:string" in physical(fetched)


def test_trigger_filter_is_below_the_join(spark, sf):
    wanted = op.filter_key_affix(located(spark, sf), suffix=".txt")
    plan = physical(op.retrieve_lenient(wanted, table(spark, sf, "objects")).select("trigger_id"))
    join = plan.index("SortMergeJoin") if "SortMergeJoin" in plan else plan.index("BroadcastHashJoin")
    assert plan.index("EndsWith") > join


def test_filter_after_retrieval_also_moves_below_the_join(spark, sf):
    found = op.retrieve_lenient(located(spark, sf), table(spark, sf, "objects")).where(F.col("key").startswith("en/"))
    plan = physical(found.select("trigger_id"))
    assert plan.index("StartsWith") > plan.index("Join")


def test_expiry_and_policy_reach_the_scan(spark, sf):
    for name in ("expire_triggers",):
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", physical(QUERIES[name](spark, sf)))
    new = op.deliver_policy(table(spark, sf, "messages"), "new", F.lit("2024-01-15").cast("timestamp_ntz"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts", physical(new))


def test_top_rows_per_group_are_cut_before_the_shuffle(spark, sf):
    for name in ("dedupe_triggers", "limit_batch", "retained_last_value", "dedupe_by_message_id_forever"):
        plan = physical(QUERIES[name](spark, sf))
        assert re.search(r"Exchange hashpartitioning(?s:.*?)WindowGroupLimit [^\n]*Partial", plan), name


def test_no_products(spark, sf):
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "retrieve_stream")):
            continue  # run as streams
        plan = physical(fn(spark, sf))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_large_inputs_are_not_gathered_by_group(spark, sf):
    messages = table(spark, sf, "messages").select("event_type", "seq", "raw")
    plan = physical(numbered(messages, ["event_type"], ["seq"], "p", "t", rows_per_slice=100))
    # windows run over the counts of slices; rows meet those by group and slice
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("raw" not in line and "_group" in line for line in windows)
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("_slice" in line or "_group" in line for line in wide)
    assert "SinglePartition" not in plan


def test_wide_rows_are_dealt_out_once(spark, sf):
    """The range exchange comes before the write; afterwards the rows are only scanned, or meet the small counts."""
    messages = table(spark, sf, "messages").select("event_type", "seq", "raw")
    plan = physical(numbered(messages, ["event_type"], ["seq"], "p", rows_per_slice=100))
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning") <= 4


def test_bodies_are_not_sorted_to_be_paged(spark, sf):
    for name in ("page_objects", "page_objects_sliced"):
        objects = table(spark, sf, "objects")
        per_slice = 100 if name.endswith("sliced") else None
        plan = physical(page_objects(objects, 50, rows_per_slice=per_slice).select("key", "page", "body"))
        assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan and not [x for x in plan.splitlines() if "Sort [" in x and "body" in x]
        assert all("body" not in x for x in plan.splitlines() if "Window [" in x)


def test_expressions_stay_in_the_jvm(spark, sf):
    python = {"apply_processor_arrow"} | {
        f"{name}{form}" for name in ("batch_by_count_or_time", "dedupe_by_message_id") for form in ("", "_sliced")}
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "retrieve_stream")):
            continue
        plan = physical(fn(spark, sf))
        assert ("MapInArrow" in plan) == (name in python), name
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_hot_location_is_split_in_the_join(spark, sf):
    """A third of all triggers point to one object; the join splits that partition at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    triggers = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000).alias("n"), F.col("id").alias("trigger_id"),
        F.md5(F.col("id").cast("string")).alias("note"),
    ).select(F.lit("b").alias("bucket"), F.concat(F.lit("k"), "n").alias("key"), "trigger_id", "note")
    objects = spark.range(2000).select(F.lit("b").alias("bucket"), F.concat(F.lit("k"), "id").alias("key"), F.lit("x").alias("body"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = op.retrieve_lenient(triggers, objects)
        assert found.count() == 60_000
        joined = found.groupBy("body").agg(F.sum("trigger_id").alias("s"))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_payloads_do_not_pass_through_python(spark, sf):
    messages = table(spark, sf, "messages").select("queue", "seq", "ts", "raw")
    plan = physical(op.batch_by_count_or_time(messages, ["queue"], ["seq"], "ts", 3))
    (line,) = [x for x in plan.splitlines() if "MapInArrow" in x]
    assert "raw" not in line


def test_nothing_is_broadcast_by_force(spark, sf):
    for name in ("order_triggers_sliced", "consumer_lag_sliced", "dedupe_by_message_id_sliced"):
        text = QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert "ResolvedHint" not in text and "strategy=broadcast" not in text


def test_hot_keys_are_joined_in_pieces(spark):
    rows = spark.range(0, 30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5000).alias("k"), "id")
    names = spark.range(0, 5000).select(F.col("id").alias("k"), F.concat(F.lit("name"), "id").alias("name"))
    hot = hot_keys(rows.where("k is not null").groupBy("k").agg(F.count("id").alias("n")), ["k"], "n")
    (found,) = hot.collect()
    assert found.k == 0 and 341 <= found._pieces <= 400
    dealt = dealt_to_pieces(rows, hot, ["k"], ["id"])
    joined = dealt.join(copied_to_pieces(names, hot, ["k"]), ["k", "_piece"], "left")
    assert joined.groupBy("k", "_piece").count().agg(F.max("count")).head()[0] < 100
    assert sorted(joined.select("id", "name").collect()) == sorted(rows.join(names, "k", "left").select("id", "name").collect())


def test_no_rows_have_no_hot_keys(spark):
    none = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("n"))
    hot = hot_keys(none, ["k"], "n")
    assert hot.count() == 0 and copied_to_pieces(dealt_to_pieces(none, hot, ["k"], ["n"]).drop("_piece"), hot, ["k"]).count() == 0
