"""No task reads much more than the others when one key holds half of 300,000 rows.

Broadcasts are off and partitions are not merged, so every join that could meet a hot key shuffles. The
rows that each task read from a shuffle are taken from Spark's own counters.
"""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from skuloom.operators import completeness, quality, sync
from skuloom.operators.joins import join_normalised

N = 300_000
LARGE = 100_000


@pytest.fixture(params=["adaptive", "fixed"])
def shuffled(request, spark):
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.enabled": str(request.param == "adaptive").lower(),
    }
    for name, value in values.items():
        spark.conf.set(name, value)
    yield spark
    for name in values:
        spark.conf.unset(name)


def rows_read(spark, df) -> list[list[int]]:
    """Shuffled rows read by each task, for every stage of one run of ``df``."""
    context = spark.sparkContext
    tag = f"sizes-{id(df)}"
    context.addJobTag(tag)
    df.write.format("noop").mode("overwrite").save()
    context.removeJobTag(tag)
    tracker, store = context._jsc.sc().statusTracker(), context._jsc.sc().statusStore()
    found = []
    for job in tracker.getJobIdsForTag(tag):
        for stage in tracker.getJobInfo(job).get().stageIds():
            tasks = store.taskList(stage, 0, 10_000)
            metrics = [tasks.apply(k).taskMetrics() for k in range(tasks.size())]
            found.append([m.get().shuffleReadMetrics().recordsRead() for m in metrics if m.isDefined()])
    return found


def assert_even(spark, df) -> None:
    large = [rows for rows in rows_read(spark, df) if sum(rows) >= LARGE]
    assert large, "no stage shuffled the rows"
    for rows in large:
        rows = [n for n in rows if n]  # a union has tasks of its other branches in the same stage
        assert len(rows) >= 8
        assert max(rows) <= 2 * median(rows), sorted(rows)


def ids(spark):
    """Half of the rows have one key, the others a thousand."""
    hot = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000))
    return spark.range(N, numPartitions=8).withColumn("k", hot)


def test_join_normalised(shuffled):
    right = shuffled.range(1000).select(F.concat(F.lit("K"), "id").alias("r"))
    right = right.unionByName(shuffled.range(1).select(F.lit(" HOT").alias("r")))
    joined = join_normalised(ids(shuffled), right, "k", "r")
    assert joined.count() == N
    assert_even(shuffled, joined)


def test_images_by_owner(shuffled):
    rows = ids(shuffled).select(F.col("k").alias("sku"), F.col("id").cast("string").alias("img"), F.lit("v").alias("v"))
    stage = rows.where("img % 3 > 0")
    changes = sync.sync_by_owner(rows, stage, "sku", ["sku", "img"])
    assert {r.op: r["count"] for r in changes.groupBy("op").count().collect()} == {"U": N * 2 // 3, "=": N // 3}
    assert_even(shuffled, changes)


def products(spark):
    """One attribute each; half of them have the same id."""
    value = F.struct(F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("uom"),
                     F.lit(None).cast("string").alias("valueId"), F.lit(None).cast("string").alias("subValue"))
    attribute = F.struct(F.col("k").alias("id"), F.lit(None).cast("string").alias("name"), F.array(value).alias("values"))
    return ids(spark).select(
        F.col("id").cast("string").alias("sku"), F.lit("n").alias("name"), F.col("id").cast("string").alias("brand"),
        F.lit(None).cast("string").alias("updateDate"), F.array(attribute).alias("attributes"))


def rules(spark):
    return ids(spark).select(F.col("k").alias("id_atributo_entrada")).distinct()


def test_attribute_checks(shuffled):
    docs, known = products(shuffled), rules(shuffled)
    bad = docs.withColumn("attributes", F.transform("attributes", lambda a: a.withField(
        "values", F.transform(a["values"], lambda v: v.withField("value", F.concat(v["value"], F.lit("x")))))))
    for found in (quality.invalid_numbers(bad, known), quality.attribute_name_findings(docs, known),
                  quality.attribute_findings(bad, known, known)):
        assert found.count() >= N
        assert_even(shuffled, found)


def test_completeness(shuffled):
    """Half of the products hang below one node, half of the stored values belong to one attribute."""
    rows = ids(shuffled)
    primary = rows.select(F.col("id").cast("string").alias("sku"),
                          F.struct(F.array("k").alias("primary")).alias("hierarchies"))
    rule = F.struct(F.col("k").alias("field"), F.lit(True).alias("required"))
    nodes = rows.select("k").distinct().select(F.col("k").alias("_id"), F.array(rule).alias("attributes"))
    shown = rows.select(F.col("id").cast("string").alias("sku"), F.lit("status_exib_site").alias("atributo"), F.lit("sim").alias("valor"))
    stored = rows.select(F.col("id").cast("string").alias("sku"), F.col("k").alias("atributo"), F.lit("v").alias("valor"))
    matrix = completeness.completeness(primary, nodes, stored.unionByName(shown))
    assert matrix.where("preenchido = 'Sim'").count() == N
    assert_even(shuffled, matrix)
