
from cartwheel.plans import catalog

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_join_has_equi_key(spark):
    p = _plan(catalog.order_interval_join(spark, SF))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_lookups_join_on_the_native_key(spark):
    p = _plan(catalog.lookup_snowflake(spark, SF))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "cast(sku_id" not in p and "cast(tm_id" not in p and "cast(spu_id" not in p


def _below_aggregate(df):
    """The optimized plan under its topmost aggregate."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    top = next(k for k, x in enumerate(lines) if "Aggregate " in x)
    depth = lines[top].index("Aggregate ")
    under = []
    for x in lines[top + 1:]:
        if len(x) - len(x.lstrip(" :+-")) <= depth:
            break
        under.append(x)
    return "\n".join(under)


def test_statistics_join_no_dimension_below_the_aggregate(spark):
    # an order with its details; the customer gives it its province
    assert _below_aggregate(catalog.province_stats(spark, SF)).count("Join ") == 2
    for name in ("product_stats", "product_stats_dims", "gmv_by_day"):
        below = _below_aggregate(catalog.REGISTRY[name](spark, SF))
        # orders with details once, and their payments
        assert below.count("Join ") == 2 and below.count("l_orderkey") > 0, name
        assert "p_partkey" not in below and "c_custkey" not in below and "n_nationkey" not in below, name


def test_no_single_partition_window(spark):
    for name in ("order_wide", "product_stats_dims", "gmv_by_day", "lookup_snowflake", "visitor_stats"):
        assert "SinglePartition" not in _plan(catalog.REGISTRY[name](spark, SF)), name


def test_visitor_statistics_in_one_pass(spark):
    p = _plan(catalog.visitor_stats(spark, SF))
    assert p.count("Scan parquet") <= 3 and "SortAggregate" not in p
    for name in ("visitor_union", "unique_visit", "new_visitor_repair", "user_jump", "cdc_current_state", "dim_upsert"):
        assert "SortAggregate" not in _plan(catalog.REGISTRY[name](spark, SF)), name


def test_repair_shuffles_flagged_rows_only(spark, tmp):
    """Rows whose flag is not set are in no join and no aggregate."""
    from cartwheel.operators import logsplit
    spark.createDataFrame([("m", "1", 1, 1, "x")], "mid string, is_new string, ts long, seq long, more string").write.parquet(tmp + "/rows")
    df = logsplit.repair_new_visitor(spark.read.parquet(tmp + "/rows"), "mid", "is_new", "ts", "seq")
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    assert plan[0].startswith("Union")
    top, = [k for k, x in enumerate(plan) if "Join " in x]
    under = []
    for x in plan[top + 1:]:
        if depth(x) <= depth(plan[top]):
            break
        under.append(x)
    # each of its inputs, the rows and the first one per device, is of flagged rows
    assert sum("Relation" in x for x in under) == 2 == sum("Filter" in x and "= 1)" in x for x in under)
    # lines that cannot be flagged are not even parsed for it
    lines = catalog.log_page(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert lines.count("RLIKE") >= 3


def test_gmv_of_a_day_is_a_range(spark, tmp):
    from cartwheel.operators import stats
    spark.createDataFrame([("2024-01-01 00:00:00", 1)], "stt string, order_amount int").write.mode("overwrite").parquet(tmp + "/gmv")
    p = _plan(stats.gmv(spark.read.parquet(tmp + "/gmv"), 20240101))
    assert "GreaterThanOrEqual(stt,2024-01-01)" in p and "LessThan(stt,2024-01-02)" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = _plan(catalog.route_fact(spark, SF))
    p2 = _plan(catalog.payment_interval_join(spark, SF))
    assert "EqualTo(o_orderstatus,F)" in p2
    # payment columns only: the join output needs no customer key
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in p2
    assert "o_orderpriority" not in p and "o_orderpriority" not in p2


def test_no_python_udf_in_batch_queries(spark):
    for name in ("visitor_stats", "keyword_stats", "product_stats", "cdc_current_state"):
        p = _plan(catalog.REGISTRY[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_rules_go_to_the_changes(spark):
    """The changes of a table stay where they are read; no task gets all changes of one kind."""
    for name in ("route_as_of", "route_fact", "route_dim", "route_prune_columns", "route_unmatched"):
        p = _plan(catalog.REGISTRY[name](spark, SF))
        assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p and "hashpartitioning(tableName" not in p, name
