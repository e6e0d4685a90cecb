"""The fare model: target-encoded zones and the clock into boosted trees of Spark ML.

Boosting for absolute loss: each tree is grown on the signs of the residuals, its leaves then quote the exact median of
the residuals that fall into them. Rows held back from the trees decide how many rounds are kept: training ends
once `boosting_patience` rounds in a row have not lowered their mean absolute error.
"""

from __future__ import annotations

import json
import operator
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.once import with_once
from tripflow.functions.order_stats import exact_median
from tripflow.operators.baselines import global_median, pair_medians, quote_by_global, quote_by_pair
from tripflow.operators.encoding import cross_fitted_codes, encode, encode_training, fit_encodings, fold_sums
from tripflow.operators.evaluation import regression_report
from tripflow.operators.features import ENCODED, SAMPLE_COLUMNS, bucket_of_100, features, holdout_split
from tripflow.operators.histograms import (
    BLOCK_ROWS,
    MOST_BINS,
    RESIDUAL_UNITS,
    Summary,
    Tree,
    grow,
    leaf_medians,
    moved,
    pack,
    range_counts,
    sign_counts,
    summary,
    unpack,
)
from tripflow.schemas import AVERAGE, DOUBLE, LONG, TEXT, struct_of
from tripflow.session import scratch, settled, shared_folder, ship_package
from tripflow.settings import Settings
from tripflow.sources.files import remove_folder

MODEL_VERSION = "boosted-2"
TREE_DEPTH = 6
# Rounds between two checkpoints of the residuals.
CHECKPOINT_ROUNDS = 10
_CLOCK = ("hour", "day_of_week", "month")
_INPUTS = [f"{name}_code" for name in ENCODED] + [*_CLOCK, "passengers", "passengers_missing"]
_ENCODINGS = struct_of({"feature": TEXT, "category": LONG, "code": DOUBLE})


@dataclass
class Rounds:
    """What boosting learned: the starting quote and, per kept round, a tree and a value (in cents) per leaf."""

    start: float
    trees: list[DecisionTreeRegressionModel] | GBTRegressionModel = field(default_factory=list)
    values: list[list[float]] = field(default_factory=list)
    trained: int = 0
    held_back_error: float | None = None


@dataclass
class FareModel:
    version: str
    encodings: DataFrame
    pipeline: PipelineModel
    rounds: Rounds

    def amount(self, rows: DataFrame) -> DataFrame:
        """The rows with `predicted_amount`: the starting quote plus the value of the row's leaf in every tree."""
        rows, cents = self.pipeline.transform(rows), F.lit(self.rounds.start)
        if self.rounds.values:
            rows = _ensemble(self.rounds.trees).setLeafCol("_leaves").transform(rows)
            values = F.from_json(F.lit(json.dumps(self.rounds.values)), "array<array<double>>")
            steps = F.zip_with(vector_to_array("_leaves"), values, lambda leaf, value: F.get(value, leaf.cast("int")))
            cents = F.aggregate(steps, cents, lambda total, step: total + step)
        return rows.withColumn("predicted_amount", F.round(cents / 100, 2).try_cast(AVERAGE))

    def quote(self, trips: DataFrame) -> DataFrame:
        """Trips with flattened zones plus `predicted_amount`, rounded to cents."""
        whole = trips.select("*", F.struct(*trips.columns).alias("_trip"))
        rows = _numeric(encode(features(whole, keep=["_trip"]), self.encodings))
        return self.amount(rows).select("_trip.*", "predicted_amount")

    def card(self) -> dict:
        """What the model's card says about its training."""
        return {
            "rounds_trained": self.rounds.trained,
            "rounds_kept": len(self.rounds.values),
            "held_back_error_cents": self.rounds.held_back_error,
        }

    def save(self, path: str, metadata: dict) -> None:
        self.encodings.write.mode("overwrite").parquet(f"{path}/encodings")
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.rounds.values:
            _ensemble(self.rounds.trees).write().overwrite().save(f"{path}/trees")
        spark = self.encodings.sparkSession
        learned = {"start": self.rounds.start, "values": self.rounds.values}
        text = json.dumps({**metadata, **self.card(), "model_version": self.version, **learned})
        card = spark.createDataFrame([(text,)], "value string")
        card.coalesce(1).write.mode("overwrite").text(f"{path}/card")


def load_model(spark: SparkSession, path: str) -> tuple[FareModel, dict]:
    card = json.loads(spark.read.text(f"{path}/card").first()["value"])
    encodings = spark.read.schema(_ENCODINGS).parquet(f"{path}/encodings")
    trees = GBTRegressionModel.load(f"{path}/trees") if card["values"] else []
    rounds = Rounds(card["start"], trees, card["values"], card["rounds_trained"], card["held_back_error_cents"])
    return FareModel(card["model_version"], encodings, PipelineModel.load(f"{path}/pipeline"), rounds), card


def _ensemble(trees: list[DecisionTreeRegressionModel] | GBTRegressionModel) -> GBTRegressionModel:
    """The trees as one Spark model, which finds a row's leaf in all of them at once and can be saved."""
    if isinstance(trees, GBTRegressionModel):
        return trees
    context = SparkSession.getActiveSession().sparkContext
    kind = context._jvm.org.apache.spark.ml.regression
    array = context._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    weights = context._gateway.new_array(context._jvm.double, len(trees))
    for k, tree in enumerate(trees):
        array[k], weights[k] = tree._java_obj, 1.0
    return GBTRegressionModel(kind.GBTRegressionModel(f"fares-{trees[0].uid}", array, weights))


def _numeric(rows: DataFrame) -> DataFrame:
    """Trees here need a value in every cell: a missing party size becomes a flag and an imputed value."""
    return rows.withColumn("passengers", F.col("passenger_count")).withColumn(
        "passengers_missing", F.col("passenger_count").isNull().cast("double")
    )


def _feature_rows(rows: DataFrame) -> DataFrame:
    return features(rows, keep=("event_id", "quoted_cents", "quoted_amount"))


def _edges(seen: DataFrame) -> tuple[list[np.ndarray], int]:
    """Where each input is cut into bins, and the number of rows. It is cut between all of its values, or at its quantiles where
    it has more than MOST_BINS."""
    inputs = len(seen.select("f").first()["f"])
    each = [F.get("f", F.lit(k)) for k in range(inputs)]
    shares = F.array(*(F.lit(k / MOST_BINS) for k in range(1, MOST_BINS)))
    # Where the estimate is above twice the bins, there surely are more values than bins.
    distinct = [F.approx_count_distinct(v, 0.02).alias(f"d{k}") for k, v in enumerate(each)]
    known = seen.agg(F.count(F.lit(1)).alias("n"), *distinct).first()
    few = [known[f"d{k}"] <= 2 * MOST_BINS for k in range(inputs)]
    found = seen.agg(*(
        (F.collect_set(v) if few[k] else F.percentile_approx(v, shares, 20_000)).alias(f"v{k}") for k, v in enumerate(each)
    )).first()
    edges = []
    for k in range(inputs):
        values = np.unique(np.array(found[f"v{k}"], float))
        if few[k] and len(values) <= MOST_BINS:
            edges.append((values[1:] + values[:-1]) / 2)
        else:
            edges.append(values if not few[k] else values[np.linspace(0, len(values) - 1, MOST_BINS + 1).astype(int)[1:-1]])
    return edges, known["n"]


def _blocks(rows: DataFrame, edges: list[np.ndarray], start: float, n: int) -> RDD:
    """The rows as blocks of bins and residuals, dealt evenly and kept: every pass of every round reads them."""
    spark, inputs = rows.sparkSession, len(edges)
    ship_package(spark)
    packed = rows.select("f", "cents", "held_back").mapInArrow(pack(edges, start), "held boolean, bins binary, residual binary")
    tasks = min(2 * spark.sparkContext.defaultParallelism, 1 + n // BLOCK_ROWS)
    dealt = packed.rdd.map(lambda row: unpack(row, inputs)).repartition(tasks)
    return dealt.persist(StorageLevel.MEMORY_AND_DISK)


def _total(blocks: RDD, count, add=operator.add):
    """What `count` finds in the blocks of each task, added up; by executors first where tasks are many."""
    parts = blocks.getNumPartitions()
    return blocks.mapPartitions(lambda part: [count(part)]).treeReduce(add, depth=1 if parts <= 64 else 2)


def boost(rows: DataFrame, settings: Settings) -> Rounds:
    """Boosted trees over (features, cents, held_back).

    The inputs are binned once and kept, as bytes beside each row's residual. A level of a tree is one pass over them, as is
    a narrowing of the leaves' medians; what the passes count, per node or leaf, comes to the driver. Every few rounds the
    residuals go to the checkpoint folder: that cuts the lineage, and a lost executor costs these rounds at most.
    """
    spark = rows.sparkSession
    seen = rows.where(~F.col("held_back"))
    if seen.isEmpty():
        return Rounds(0.0)
    shared_folder(spark)
    start = float(exact_median(seen, "cents").first()["median"])
    inputs = with_once(rows, "f", vector_to_array("features")).select("f", "cents", "held_back")
    edges, n = _edges(inputs.where(~F.col("held_back")))
    sizes = [len(e) + 1 for e in edges]
    # Without rows to hold back, the rows that the trees see decide.
    judges_held = not rows.where("held_back").isEmpty()
    look = lambda blocks: _total(blocks, lambda part: summary(part, sizes, judges_held), Summary.plus)
    now = _blocks(inputs, edges, start, n)
    state, trees, saved = look(now), [], None
    found, least, best = Rounds(start), state.error / state.judged, 0
    while found.trained < settings.boosting_rounds and found.trained - best < settings.boosting_patience:
        at_nodes = lambda tree, nodes: _total(now, lambda part: sign_counts(part, tree, nodes, sizes))
        tree = grow(state.root, sizes, TREE_DEPTH, at_nodes)
        in_ranges = lambda *asked: _total(now, lambda part: range_counts(part, tree, *asked))
        medians = leaf_medians(tree, state.least, state.most, in_ranges)
        values = [settings.learning_rate * m / RESIDUAL_UNITS for m in medians]
        trees.append(tree)
        found.values.append(values)
        found.trained += 1
        before, now = now, _moved(now, tree, values)
        keep = found.trained % CHECKPOINT_ROUNDS == 0
        if keep:
            now.checkpoint()
        state = look(now)
        before.unpersist()
        if keep:
            saved, old = now.getCheckpointFile(), saved
            if old:
                remove_folder(spark, old)
        error = state.error / state.judged
        if error < least:
            least, best = error, found.trained
    now.unpersist()
    if saved:
        remove_folder(spark, saved)
    found.trees = [_spark_tree(tree, edges, values) for tree, values in zip(trees[:best], found.values)]
    found.values, found.held_back_error = found.values[:best], least
    return found


def _moved(blocks: RDD, tree: Tree, values: list[float]) -> RDD:
    steps = np.zeros(len(tree.child))
    steps[tree.leaves()] = values
    return blocks.map(lambda block: moved(block, tree, steps)).persist(StorageLevel.MEMORY_AND_DISK)


def _spark_tree(tree: Tree, edges: list[np.ndarray], values: list[float]) -> DecisionTreeRegressionModel:
    """The tree as Spark's model, which numbers leaves from left to right as well."""
    context = SparkSession.getActiveSession().sparkContext
    jvm, kind = context._jvm, context._jvm.org.apache.spark.ml
    left_to_right = iter(values)

    def node_of(number: int):
        below, at, above = (int(n) for n in tree.counts[number])
        n, s = below + at + above, above - below
        stats = context._gateway.new_array(jvm.double, 3)
        stats[0], stats[1], stats[2] = float(n), float(s), float(below + above)
        spread = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, n)
        if tree.is_leaf(number):
            return kind.tree.LeafNode(next(left_to_right), spread.calculate(), spread)
        left, right = (node_of(child) for child in tree.child[number])
        parted = sum(side.impurity() * int(tree.counts[child].sum()) for side, child in zip((left, right), tree.child[number]))
        k = tree.feature[number]
        split = kind.tree.ContinuousSplit(k, float(edges[k][tree.edge[number]]))
        return kind.tree.InternalNode(s / n, spread.calculate(), spread.calculate() - parted / n, left, right, split, spread)

    made = kind.regression.DecisionTreeRegressionModel(f"fare-tree-{uuid.uuid4().hex[:12]}", node_of(0), len(edges))
    return DecisionTreeRegressionModel(made)


def fit_fare_model(train: DataFrame, settings: Settings, version: str = MODEL_VERSION) -> FareModel:
    """Encodings, inputs and trees; a tenth of the training rows is held back to choose the number of rounds.

    Encodings are written to the shared folder, because scoring reads them long after the training rows are gone.
    """
    spark = train.sparkSession
    rows = settled(_feature_rows(train), "fare-rows")
    encodings = f"{scratch(spark, 'fare-model')}/encodings"
    sums = fold_sums(rows, settings)
    fit_encodings(rows, sums).write.parquet(encodings)
    encoded = _numeric(encode_training(rows, cross_fitted_codes(rows, settings, sums), settings)).select(
        *_INPUTS, F.col("quoted_cents").alias("cents"), (bucket_of_100(settings.seed + 2) < 10).alias("held_back")
    )
    encoded = settled(encoded, "fare-inputs")
    inputs = [c if c != "passengers" else "passengers_filled" for c in _INPUTS]
    pipeline = Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=["passengers"], outputCols=["passengers_filled"]),
            VectorAssembler(inputCols=inputs, outputCol="features"),
        ]
    ).fit(encoded)
    ready = pipeline.transform(encoded).select("features", "cents", "held_back")
    return FareModel(version, spark.read.schema(_ENCODINGS).parquet(encodings), pipeline, boost(ready, settings))


def score_holdout(model: FareModel, held: DataFrame) -> DataFrame:
    rows = _numeric(encode(_feature_rows(held), model.encodings))
    return model.amount(rows).select("predicted_amount", F.col("quoted_amount").cast(AVERAGE).alias("actual_amount"))


def baseline_holdout(train: DataFrame, held: DataFrame) -> DataFrame:
    """Holdout rows quoted by both price tables, one row per (row, table)."""
    everywhere = global_median(train)
    outcome = [F.col("predicted_amount"), F.col("quoted_amount").cast(AVERAGE).alias("actual_amount")]
    by_global = quote_by_global(held, everywhere).select(F.lit("global_median").alias("model"), *outcome)
    by_pair = quote_by_pair(held, pair_medians(train), everywhere).select(
        F.lit("zone_pair_median").alias("model"), *outcome
    )
    return by_global.unionByName(by_pair)


def compare_on_holdout(rows: DataFrame, settings: Settings, model: FareModel | None = None) -> DataFrame:
    """One report line per candidate on the same holdout. Both price tables and all quotes read the rows: give them settled."""
    train, held = holdout_split(rows.select(*SAMPLE_COLUMNS), settings)
    scored = baseline_holdout(train, held)
    if model is not None:
        boosted = score_holdout(model, held).select(F.lit("gradient_boosting").alias("model"), "*")
        scored = scored.unionByName(boosted)
    return regression_report(scored, ["model"])

