"""The fare model on prices that follow from the inputs, and on prices that do not."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripflow import Settings
from tripflow.operators.boosting import _edges, boost
from tripflow.operators.encoding import fit_encodings, fold_sums
from tripflow.operators.histograms import Block, grow, leaf_medians, range_counts, sign_counts, summary
from tripflow.session import shared_folder
from tripflow.sources.files import list_files

SETTINGS = replace(Settings(), boosting_rounds=40, learning_rate=0.3, boosting_patience=3)


@pytest.fixture(scope="module")
def inputs(spark):
    rows = spark.range(900).selectExpr(
        "cast(id % 24 as double) as hour", "cast((id * 7919) % 50 as double) as zone", "id % 10 = 0 as held_back", "id"
    )
    return VectorAssembler(inputCols=["hour", "zone"], outputCol="features").transform(rows)


def test_rounds_lower_the_error_until_they_do_not(spark, inputs):
    price = 1000 + 20 * F.col("zone") + F.when(F.col("hour") < 6, 700).otherwise(0)
    rows = inputs.select("features", price.cast("bigint").alias("cents"), "held_back")
    found = boost(rows, replace(SETTINGS, boosting_rounds=12))
    assert found.trained == 12 and len(found.trees) == len(found.values) == 12
    spread = rows.agg(F.avg(F.abs(F.col("cents") - F.lit(found.start)))).first()[0]
    assert found.held_back_error < 0.25 * spread


def test_patience_ends_training_where_nothing_can_be_learned(spark, inputs):
    noise = inputs.select("features", (F.abs(F.xxhash64("id")) % 5000).alias("cents"), "held_back")
    found = boost(noise, SETTINGS)
    assert found.trained < 40 and found.trained - len(found.values) >= SETTINGS.boosting_patience
    assert boost(noise.limit(0), SETTINGS).values == []
    constant = boost(inputs.select("features", F.lit(5).cast("bigint").alias("cents"), "held_back"), SETTINGS)
    assert constant.start == 5 and constant.held_back_error == 0


def test_rounds_write_no_rows_and_trees_are_those_of_spark(spark, inputs):
    """The inputs are binned once: no round writes rows of its own. Its first tree splits as Spark's own does."""
    price = 1000 + 20 * F.col("zone") + F.when(F.col("hour") < 6, 700).otherwise(0)
    rows = inputs.select("features", price.cast("bigint").alias("cents"), "held_back")
    left_by = lambda: set(list_files(spark, shared_folder(spark), "boosting-*"))
    before = left_by()
    found = boost(rows, replace(SETTINGS, boosting_rounds=2))
    assert left_by() == before
    signs = rows.where("not held_back").select("features", F.signum(F.col("cents") - F.lit(found.start)).alias("sign"))
    own = DecisionTreeRegressor(featuresCol="features", labelCol="sign", maxDepth=6, maxBins=255).fit(signs)
    both = found.trees[0].setPredictionCol("ours").transform(own.setPredictionCol("spark").transform(signs))
    error = lambda c: F.sum(F.pow(F.col("sign") - F.col(c), 2)).alias(c)
    assert found.trees[0].depth <= 6
    leaves = found.trees[0].setLeafCol("leaf").transform(signs)
    ours = leaves.withColumn("ours", F.avg("sign").over(Window.partitionBy("leaf")))
    assert ours.agg(error("ours")).first()[0] <= both.agg(error("spark")).first()[0] + 1e-6


def _blocks_of(residual, bins):
    half = len(residual) // 2
    return [Block(False, bins[:, at], residual[at]) for at in (slice(0, half), slice(half, None))]


def test_leaf_medians_are_exact_over_any_spread():
    random = np.random.default_rng(1)
    for width in (0.0, 3.0, 1e4, 1e9):
        residual, bins = random.normal(0, 1, 1001) * width, random.integers(0, 9, (2, 1001)).astype(np.uint8)
        blocks, sizes = _blocks_of(residual, bins), [9, 9]
        look = summary(blocks, sizes, False)
        tree = grow(look.root, sizes, 3, lambda tree, nodes: sign_counts(blocks, tree, nodes, sizes))
        medians = leaf_medians(tree, look.least, look.most, lambda *asked: range_counts(blocks, tree, *asked))
        units, at = Block(False, bins, residual).units(), tree.place(bins)
        assert medians == [float(np.median(units[at == leaf])) for leaf in tree.leaves()]
        assert [tree.counts[leaf].sum() for leaf in tree.leaves()] == [(at == leaf).sum() for leaf in tree.leaves()]


def test_inputs_with_more_values_than_bins_are_cut_at_their_quantiles(spark):
    rows = spark.range(4000).selectExpr(
        "cast(id as double) as a", "cast(id % 300 as double) as b", "cast(id % 3 as double) as c", "id * 3 as cents", "false as held_back"
    )
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    edges, n = _edges(rows.select(vector_to_array("features").alias("f")))
    assert [len(e) <= 254 for e in edges] == [True] * 3 and len(edges[0]) > 200 and len(edges[1]) > 200
    assert list(edges[2]) == [0.5, 1.5] and n == 4000
    found = boost(rows.select("features", "cents", "held_back"), replace(SETTINGS, boosting_rounds=6))
    assert found.trained == 6 and found.held_back_error < 900


def test_codes_are_those_of_sums_taken_row_by_row(spark):
    rows = spark.range(400).selectExpr(
        "cast(id as string) as event_id", "id * id % 977 as quoted_cents", "cast(id % 7 as double) as pickup_zone_id",
        "cast(id % 5 as double) as dropoff_zone_id", "cast(id % 7 * 1000 + id % 5 as double) as zone_pair",
    )
    kept = {r["category"]: r["code"] for r in fit_encodings(rows).where("feature = 'pickup_zone_id'").collect()}
    overall = rows.agg(F.avg("quoted_cents"), F.var_pop("quoted_cents")).first()
    for zone, n, mean, spread in rows.groupBy("pickup_zone_id").agg(
        F.count("*"), F.avg("quoted_cents"), F.var_pop("quoted_cents")
    ).collect():
        weight = n * overall[1] / (n * overall[1] + spread)
        assert kept[int(zone)] == pytest.approx((weight * mean + (1 - weight) * overall[0]) / 100)
    assert kept[None] == pytest.approx(overall[0] / 100)
    assert fit_encodings(rows).exceptAll(fit_encodings(rows, fold_sums(rows, SETTINGS))).isEmpty()
