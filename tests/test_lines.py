"""What hangs on lines gives the same sums whether or not it names its transaction; and how often it travels."""

from pyspark.sql import functions as F

from checks.queries import stored_transactions
from tallyspark.operators.deltas import checksums
from tallyspark.plans.sales import addon_costs, line_summaries, product_summary, sales_raw
from tallyspark.plans.tax import line_taxes, tax_raw
from tallyspark.session import RUNTIME_CONF
from tallyspark.sources.sample_tables import FILES, SampleTables
from tallyspark.sources.tables import TRANSACTION_CHILDREN, Source, id_ranges

# Line 2 is there twice, line 3 hangs on nothing, line 9 has no transaction, one line has no id.
LINES = [(1, 10), (2, 10), (2, 10), (3, 10), (4, 11), (5, 12), (9, None), (None, 12), (None, 13)]


def details(spark):
    rows = spark.createDataFrame(LINES, "detail_id long, transaction_id long")
    return rows.withColumns({"product_tax": F.expr("cast(detail_id + 0.5 AS decimal(18,4))"),
                             "total_product_tax": F.expr("cast(if(detail_id = 5, NULL, 2) AS decimal(18,4))")})


def both_ways(spark, rows, make):
    children = spark.createDataFrame(rows, "id long, detail_id long, transaction_id long, quantity long, cost long").selectExpr(
        "id", "detail_id", "transaction_id", "cast(quantity AS decimal(6,2)) quantity", "cast(1.5 AS decimal(6,2)) material_quantity",
        "cast(cost AS decimal(18,4)) unit_cost")
    one, two = make(details(spark), children), make(details(spark), children.drop("transaction_id"))
    three = make(details(spark), children, False)
    return [sorted(map(tuple, df.collect()), key=str) for df in (one, two, three)]


CHILDREN = [(1, 1, 10, 2, 3), (2, 1, 10, 1, 1), (3, 2, 10, 1, 5), (None, 4, 11, None, 1), (5, 5, 12, 1, None), (6, 9, None, 1, 1),
            (7, None, 12, 1, 7), (8, 77, 10, 1, 9)]


def test_addon_costs_by_transaction(spark):
    one, two, three = both_ways(spark, CHILDREN, addon_costs)
    assert one == two == three and len(one) == 4


def test_line_taxes_by_transaction(spark):
    def make(lines, extends, whole=True):
        # A transaction is extended or not; unknown counts as not.
        return line_taxes(lines, extends, whole).filter("transaction_id IS NOT NULL").withColumn("extended", F.coalesce("extended", F.lit(False)))
    one, two, three = both_ways(spark, CHILDREN, make)
    assert one == two == three and len(one) == 4


def test_a_batch_limits_what_hangs_on_its_lines(spark):
    tables = SampleTables(spark, "/root/testdata/sf0.001").source()
    ids = spark.createDataFrame([(5,), (6,)], "id long")
    near = tables.near_ids([(0, 50)], {"details": "transaction_id"})
    assert {r[0] for r in near.addons.select(F.max("transaction_id") <= 50).collect()} == {True}
    of = tables.of_transactions(ids)
    assert {r[0] for r in of.detail_extends.select("transaction_id").collect()} <= {5, 6}
    lone = Source({"details": lambda: details(spark), "addons": lambda: details(spark).select("detail_id")})
    assert sorted(r[0] for r in lone.of_transactions(spark.createDataFrame([(10,)], "id long")).addons.collect()) == [1, 2, 2, 3]


def test_lines_travel_once_to_a_full_tax_mart(spark):
    """Lines with their extensions, the transactions and what those are made of: no exchange by line."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tax_raw(SampleTables(spark, "/root/testdata/sf0.001").source())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [line for line in plan.splitlines() if "hashpartitioning(" in line and "detail_id" in line.split("hashpartitioning(")[1].split(")")[0]]


def test_products_and_addons_of_lines_in_one_pass(spark):
    def make(lines, addons, whole=True):
        lines = lines.withColumns({"quantity": F.expr("cast(if(detail_id = 3, NULL, 2.5) AS decimal(8,2))"),
                                   "unit_cost": F.expr("cast(detail_id AS decimal(8,2))"), "total_price": F.expr("cast(7 AS decimal(8,2))")})
        found = line_summaries(lines, addons, whole)
        if len(found) == 2:
            # Summed one by one, and joined as the star does.
            found = [product_summary(lines).join(addon_costs(lines, addons), "transaction_id", "left").na.fill(0, ["hpp_addon"])]
        return found[0].filter("transaction_id IS NOT NULL").select("transaction_id", "product", "hpp_product", "gross_sales", "hpp_addon")
    one, two, three = both_ways(spark, CHILDREN, make)
    assert one == two == three and len(one) == 4


def test_lines_are_read_once_for_products_and_addons(spark):
    """Four tables hang on a transaction: payments, lines, add-ons and commissions."""
    plan = sales_raw(SampleTables(spark, "/root/testdata/sf0.001").source())._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [l_orderkey" in line for line in plan.splitlines()) == 4


def test_lines_of_a_batch_are_cut_down_where_they_are_scanned(spark, tmp_path):
    """Every scan of the lines asks the filter of the batch's ids, before anything is shuffled."""
    bloom = {k: v for k, v in RUNTIME_CONF.items() if "bloomFilter" in k}
    conf = {**bloom, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    source = SampleTables(spark, "/root/testdata/sf0.001").source()
    source.transactions.filter("id % 10 = 3").write.parquet(f"{tmp_path}/batch")
    batch = spark.read.schema(source.transactions.schema).parquet(f"{tmp_path}/batch")
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for raw, scans in ((sales_raw, 4), (tax_raw, 3)):
            lines = raw(source, batch)._jdf.queryExecution().optimizedPlan().toString().splitlines()
            asked = [line for line in lines if "might_contain" in line and "xxhash64(l_orderkey" in line]
            assert len(asked) == scans
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_an_id_of_a_line_is_made_after_it_met_its_part(spark, tmp_path):
    """The id repeats the line's own columns, so it isn't shuffled to the parts with them; null columns stay part of it."""
    line = {"l_orderkey": 1, "l_partkey": 2, "l_suppkey": 3, "l_linenumber": 4, "l_quantity": 5.0, "l_extendedprice": 6.25,
            "l_discount": 0.1, "l_tax": 0.2, "l_returnflag": "A", "l_linestatus": "F", "l_shipdate": None}
    rows = [line, {**line, "l_suppkey": None, "l_quantity": None}, {**line, "l_partkey": None}]
    part = {"p_partkey": 2, "p_name": "n", "p_brand": "b", "p_type": "PROMO", "p_size": 7, "p_retailprice": 8.5}
    for name, data in (("lineitem", rows), ("part", [part])):
        spark.createDataFrame(data, FILES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    source = SampleTables(spark, str(tmp_path)).source()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for lines, ids in ((source.details, {(1, 4, 2, 3, 500, 625), (1, 4, 2, None, None, 625), (1, 4, None, 3, 500, 625)}),
                           (source.addons, {(1, 4, 2, 3, 500, 625), (1, 4, 2, None, None, 625)})):
            plan = lines._jdf.queryExecution().executedPlan().toString()
            assert plan.count("named_struct(") == 1 and plan.index("named_struct(") < plan.index("Exchange hashpartitioning(part")
            found = [tuple(r["detail_id"]) for r in lines.select("detail_id").collect()]
            assert set(found) == ids and len(found) == len(ids)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_meet_their_addons_where_they_were_dealt(spark):
    """Only the add-ons are grouped by line. The lines are dealt by their transaction alone and join them there."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": RUNTIME_CONF.get(
        "spark.sql.requireAllClusterKeysForCoPartition", "true")}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        execution = sales_raw(SampleTables(spark, "/root/testdata/sf0.001").source())._jdf.queryExecution()
        assert "Union" not in execution.optimizedPlan().toString()
        by_line = [line for line in execution.executedPlan().toString().splitlines()
                   if "hashpartitioning(" in line and "detail_id" in line.split("hashpartitioning(")[1].split(")")[0]]
        assert len(by_line) <= 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_children_of_a_batch_read_their_lines_once(spark, tmp_path):
    """They are made of the batch's lines, kept once. A batch of most transactions has no lines copied."""
    source, kept = SampleTables(spark, "/root/testdata/sf0.001").source(), []

    def keep(df, name):
        kept.append(name)
        path = f"{tmp_path}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    batch = source.transactions.filter("id % 10 = 3")
    near = source.narrowed(batch, id_ranges(batch), keep).near_ids(id_ranges(batch), TRANSACTION_CHILDREN)
    assert kept == []
    assert not [f for f in near.payments.inputFiles() + near.commissions.inputFiles() if str(tmp_path) not in f]
    assert kept == ["lineitem"]
    for raw in (sales_raw, tax_raw):
        assert sorted(map(str, raw(near, batch).collect())) == sorted(map(str, raw(source, batch).collect()))
    assert source.narrowed(source.transactions, id_ranges(source.transactions), keep).details.count() == source.details.count()
    assert kept == ["lineitem"]


def test_earlier_transactions_are_read_once(spark):
    """Two scans of the orders: for themselves and for the heads of the split bills."""
    plan = stored_transactions(SampleTables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [o_orderkey" in line for line in plan.splitlines()) == 2


def test_a_digest_tells_nulls_from_values_and_by_column(spark):
    rows = [(1, None, 5), (2, 5, None), (3, None, None), (4, 0, 5), (5, 5, 5)]
    found = checksums(spark.createDataFrame(rows, "id long, a long, b long").select("a", "b", F.col("id").alias("k")).withColumn("k", F.col("k") * 0),
                      {"a": F.col("a"), "b": F.col("b")}).collect()
    assert len({r["digest"] for r in found}) == 5
    plan = checksums(spark.createDataFrame(rows, "id long, a long, b long"), {"id": F.col("id")})._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan


def test_an_id_of_a_line_is_made_after_the_line_was_dealt(spark):
    """Neither a full mart nor a batch shuffles the id, or what else repeats the line's own columns, beside these."""
    source = SampleTables(spark, "/root/testdata/sf0.001").source()
    ids = source.transactions.filter("id % 3 = 1").select("id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in ("details", "addons"):
            for lines in (source.dealt(table), source.of_transactions(ids).near_ids([(0, 10**9)], TRANSACTION_CHILDREN).__getattr__(table)):
                plan = lines._jdf.queryExecution().executedPlan().toString()
                assert plan.count("named_struct(") == 1 and plan.index("named_struct(") < plan.index("Exchange hashpartitioning(transaction_id")
        assert sorted(map(str, source.dealt("addons").collect())) == sorted(map(str, source.addons.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_transactions_are_dealt_without_the_columns_that_flags_are_made_of(spark):
    source = SampleTables(spark, "/root/testdata/sf0.001").source()
    plan = sales_raw(source)._jdf.queryExecution().optimizedPlan()
    facts = [line for line in plan.toString().splitlines() if "AS settled" in line]
    assert len(facts) == 1 and "AS is_refund" in facts[0] and "AS count_transaction" in facts[0]
