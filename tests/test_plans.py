
import re

import pytest
from pyspark.sql import functions as F

from billflow.plans import bindings as B
from billflow.plans import registry as RG
from billflow.operators import gates as G
from billflow.operators import matching as M
from billflow.operators.joins import hot_keys, null_safe_left_join, planner_broadcasts, unique_left_join
from tests.conftest import SF_SMALL


def plan(df):
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _subtree_has(node, cls):
    return node.getClass().getSimpleName() == cls or any(_subtree_has(c, cls) for c in _children(node))


def shuffles_over_parquet(df):
    """Shuffle exchanges that have a parquet scan somewhere below them."""
    root = df._jdf.queryExecution().executedPlan()
    if root.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        root = root.initialPlan()
    found, stack = 0, [root]
    while stack:
        n = stack.pop()
        if n.getClass().getSimpleName() == "ShuffleExchangeExec" and _subtree_has(n, "FileSourceScanExec"):
            found += 1
        stack.extend(_children(n))
    return found


def test_scrub_never_shuffles_attendance(spark):
    df = RG.q_scrub_straightforward(spark, SF_SMALL)
    p = plan(df)
    assert "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") >= 4
    # exchanges exist only over the in-memory rule tables, never over a data scan
    assert shuffles_over_parquet(df) == 0


def test_code_gate_is_broadcast_joins_over_one_scan(spark):
    df = G.code_gate(B.attendance(spark, SF_SMALL), B.rules(spark))
    p = plan(df)
    assert p.count("BroadcastHashJoin") == 2  # (status, code) hits and listed statuses
    assert p.count("FileScan parquet") == 1
    assert shuffles_over_parquet(df) == 0


def test_scrub_filters_reach_the_scan(spark):
    df = RG.q_scrub_straightforward(spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>" in p


def test_state_current_is_one_aggregation(spark):
    df = RG.q_state_current(spark, SF_SMALL)
    p = plan(df)
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert shuffles_over_parquet(df) == 1  # the helper does see data shuffles


def test_line_history_is_cut_by_a_date_range_at_the_scan(spark, scratch):
    lines = M.with_dos_date(B.service_lines(spark, SF_SMALL))
    lines.write.parquet(f"{scratch}/lines")
    lines.write.partitionBy("dos_date").parquet(f"{scratch}/by_day")
    cases = RG.cases(spark, SF_SMALL)
    days = M.dos_range(cases)
    flat = plan(M.service_match(cases, spark.read.parquet(f"{scratch}/lines"), days))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(dos_date,2026-11-26\)", flat)
    parts = plan(M.service_match(cases, spark.read.parquet(f"{scratch}/by_day"), days))
    assert re.search(r"PartitionFilters: \[[^]]*dos_date#\d+ >= 2026-11-26", parts)


def test_cases_off_the_lookback_days_keep_their_lines(spark):
    cases = RG.cases(spark, SF_SMALL).limit(20)
    old = cases.withColumn("date_time", F.lit("01/02/2020, 10:00 AM ET"))
    odd = cases.withColumn("date_time", F.lit("soon ET"))
    both = old.unionByName(odd)
    lines = both.select(F.col("item_id").alias("line_id"), "client_id", F.regexp_replace("date_time", " ET", "").alias("dos_text"),
                        "service_type", *[F.lit("x").alias(c) for c in ("place_of_service", "amount", "units", "dx_text")],
                        F.lit(0).alias("position"))
    with_range = M.service_match(both, lines, M.dos_range(both)).filter("svc_found").count()
    assert with_range == M.service_match(both, lines).filter("svc_found").count() > 0


def test_lookback_reaches_the_scan(spark, scratch):
    B.attendance(spark, SF_SMALL).write.parquet(f"{scratch}/att")
    p = plan(G.business_day_lookback(spark.read.parquet(f"{scratch}/att"), B.ASOF))
    assert "StringStartsWith(date_time,11/26/2026)" in p


def test_hot_and_null_keys_are_dealt_over_salts(spark):
    """With broadcasting off, a client with most of the cases does not fill one partition."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    for k, v in zip(old, ("-1", "false", "64")):
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        cases = spark.range(6000).select(i.alias("item_id"), F.when(i % 3 == 0, "hot").when(i % 3 == 1, i.cast("string"))
                                         .alias("client_id"))
        reg = spark.range(3).select(F.when(F.col("id") == 0, "hot").otherwise("x").alias("client_id"), F.lit("Active").alias("tab"),
                                    *[F.lit("v").alias(c) for c in M.REGISTRY_FIELDS[1:]])
        out = M.registry_match(cases, reg)
        assert out.count() == 6000 and out.filter("reg_found").count() == 2000
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 1200  # the hot client has 2000 rows, and as many have none
        assert "_left_salt" in out._jdf.queryExecution().optimizedPlan().toString()
        assert max(sizes) < 300 and min(sizes) > 0  # in fact dealt over all tasks
        assert list(hot_keys(cases, [F.col("client_id")]).values()) == [64]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cold_keys_are_not_copied(spark):
    """Only the measured hot keys' rows are repeated on the other side, by their counts."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(old, ("-1", "100")):
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        key = F.when(i % 20 == 0, "warm").when(i % 3 == 0, "hot").when(i % 7 == 0, None).otherwise(i.cast("string"))
        left = spark.range(30000).select(i.alias("item_id"), key.alias("k"), F.lit(1).alias("one"))
        keys = left.select("k").where("k is not null").distinct()
        right = keys.select(F.col("k").alias("rk"), F.lit(1).alias("rone"), F.concat(F.lit("v"), "k").alias("v"))
        on = [(F.col("k"), "rk"), (F.col("one"), "rone")]
        tasks = sorted(hot_keys(left, [k for k, _ in on]).values())
        assert tasks[-1] == 100 and tasks[:-1] == [20]  # a third of the rows and a twentieth
        out = unique_left_join(left, right, on, "item_id")
        joined = [p for p in plan_nodes(out) if p.nodeName() == "Join"]
        copied = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, joined[0].children().apply(1)).count()
        assert copied == keys.count() - 2 + 100 + 20
        got = out.select("item_id", "k", "v").collect()
        assert len(got) == 30000 and all(r.v == (r.k and "v" + r.k) for r in got)
        assert hot_keys(left.limit(0), [F.col("k")]) == {}
        with pytest.raises(TypeError):
            unique_left_join(left, right, [(F.col("item_id"), "rk")], "item_id")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        plain = unique_left_join(left, spark.range(9).select(F.col("id").alias("rid")), [(F.col("item_id"), "rid")], "item_id")
        assert "_left_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()  # broadcast: nothing to deal
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan_nodes(df):
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        yield node
        todo += [node.children().apply(i) for i in range(node.children().size())]


def test_remittance_text_is_built_and_split_once(spark):
    """However many fields are tested and read, one split stands in the plan (and the two branches of the text)."""
    for key in ("remit_date_window", "doc_name", "sanitise_text"):
        p = RG.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert p.count("split(") == 1, (key, p)
        # the rows' own text has a whole and a short form; a document's name is one more
        assert p.count("concat_ws(") == (3 if key == "doc_name" else 2), (key, p)


def test_sides_that_the_planner_takes_for_small_are_not_broadcast(spark, scratch):
    """The estimate of an exploded side misses its copies; what counts is its measured size."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "65536")
    try:
        spark.range(20).write.parquet(f"{scratch}/few")
        few = spark.read.parquet(f"{scratch}/few")
        many = few.select(F.explode(F.sequence(F.col("id") * 1000, F.col("id") * 1000 + 999)).alias("rk"), F.lit("v" * 50).alias("v"))
        left = spark.range(0, 40000, 2).select(F.col("id").alias("item_id"), F.col("id").alias("k"))
        assert "BroadcastHashJoin" in left.join(many, F.col("k") == F.col("rk"), "left")._jdf.queryExecution().executedPlan().toString()
        for out in (unique_left_join(left, many, [(F.col("k"), "rk")], "item_id"), null_safe_left_join(left, many, "k", "rk")):
            assert out.filter("v is not null").count() == 10000 and out.count() == 20000
            assert "BroadcastHashJoin" not in plan(out)
        small = few.withColumnRenamed("id", "rk")
        assert planner_broadcasts(small) and "BroadcastHashJoin" in plan(unique_left_join(left, small, [(F.col("k"), "rk")], "item_id"))
        # few rows that hold much text
        assert not planner_broadcasts(few.select(F.repeat(F.lit("x"), (F.col("id") * 1000).cast("int")).alias("v"), F.col("id").alias("rk")))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cases_and_claims_are_made_once(spark):
    """What is measured and then joined is read back, not made again from the given tables."""
    first = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in first(RG.q_exception_tagging(spark, SF_SMALL))
    ann = RG.q_pending_annotations(spark, SF_SMALL)
    assert first(ann).count("FileScan parquet") == 1  # the invoices
    assert first(RG.q_invoice_annotate(spark, SF_SMALL)).count("FileScan parquet") == 1
    assert "o_orderpriority" not in first(RG.q_registry_candidates(spark, SF_SMALL))
