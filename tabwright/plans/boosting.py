"""Fitting Spark's gradient-boosted trees from rows kept as small codes, over all cores."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession

from tabwright.functions import trees as tree_functions
from tabwright.functions.trees import (
    Block,
    Layout,
    Settings,
    Tree,
    best_splits,
    boost_here,
    drawn_rows,
    encode_rows,
    grow,
    histogram,
    layout_of,
    leaves_of,
    moved_block,
    places,
    route,
    variance,
)
from tabwright.session import work_path
from tabwright.sources import tables

# Sent along with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(tree_functions)

#: nodes of which one task settles the splits
NODES_PER_TASK = 64
#: bytes of histograms that the driver adds up itself; more meet in tasks
TO_DRIVER = 2**25


def blocks(ready: DataFrame, label: str, features: str, layout: Layout) -> RDD:
    """``ready`` as blocks of at most ``ROWS_PER_TASK`` rows, in its order and partitions."""
    most, dtype = tables.ROWS_PER_TASK, np.uint8 if layout.sizes.max() <= 256 else np.uint32

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offset, held = 0, []

        def block():
            codes = np.concatenate([c for c, _ in held], axis=1)
            kept = np.concatenate([y for _, y in held]).astype(np.int8)
            held.clear()
            row = {"start": [offset], "codes": [codes.tobytes()], "label": [kept.tobytes()]}
            return len(kept), pa.RecordBatch.from_pydict(row)

        for batch in batches:
            if batch.num_rows:
                held.append(encode_rows(batch, layout, dtype))
            if sum(len(y) for _, y in held) >= most:
                n, out = block()
                yield out
                offset += n
        if held:
            yield block()[1]

    def unpacked(part: int, rows) -> Iterator[Block]:
        for row in rows:
            y = np.frombuffer(row["label"], np.int8)
            codes = np.frombuffer(row["codes"], dtype).reshape(len(layout.sizes), len(y))
            yield part, row["start"], codes, y, np.zeros(len(y))

    schema = "start bigint, codes binary, label binary"
    return ready.select(label, features).mapInArrow(encode, schema).rdd.mapPartitionsWithIndex(unpacked)


def boost_spread(rows: RDD, settings: Settings) -> list[Tree]:
    """Tree by tree over all cores: tasks add up histograms, which meet node by node to be split."""
    trees, layout, cores = [], settings.layout, max(1, rows.context.defaultParallelism)
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    drawn = None
    try:
        for number in range(settings.trees):
            drawn = kept.map(lambda b, number=number: drawn_rows(b, settings, number)).coalesce(cores)
            drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)

            def search(tree, group, subsets, stats, impurity, root, drawn=drawn):
                router, place = tree.router(layout), places(tree, group)
                ranges = [(i, min(i + NODES_PER_TASK, len(group))) for i in range(0, len(group), NODES_PER_TASK)]

                def histograms(held):
                    hist = None
                    for codes, residual in held:
                        own = histogram(codes, residual, place[route(codes, router)], len(group), layout, False)
                        hist = own if hist is None else np.add(hist, own, out=hist)
                    if hist is not None:
                        for i, (start, end) in enumerate(ranges):
                            yield i, hist[:, start:end].copy()

                def settled(pairs):
                    by_range = {}
                    for i, hist in pairs:
                        by_range[i] = by_range[i] + hist if i in by_range else hist
                    for i, hist in by_range.items():
                        part = slice(*ranges[i])
                        figures = subsets[part], stats[:, part], impurity[part], settings.least, settings.least_gain
                        yield i, best_splits(hist, *figures, layout, root)

                found, size = drawn.mapPartitions(histograms), 24 * len(group) * layout.offsets[-1]
                if len(ranges) > 1 or size * cores > TO_DRIVER:
                    found = dict(found.partitionBy(min(cores, len(ranges)), lambda i: i).mapPartitions(settled).collect())
                else:
                    found = dict(settled(found.collect()))
                return tuple(np.concatenate(a, axis=-1) for a in zip(*(found[i] for i in range(len(ranges)))))

            tree = grow(settings, settings.seed + number, search)
            trees.append(tree)
            drawn.unpersist()
            if number + 1 < settings.trees:
                router, leaves = tree.router(layout), leaves_of(tree)
                moved = kept.map(
                    lambda b, router=router, leaves=leaves, number=number: moved_block(b, settings, router, leaves, number)
                ).persist(StorageLevel.MEMORY_AND_DISK)
                moved.count()
                kept.unpersist()
                kept = moved
        return trees
    finally:
        kept.unpersist()
        if drawn is not None:
            drawn.unpersist()


# --- the model -----------------------------------------------------------------------

NODE_DATA = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _node_rows(tree: Tree, layout: Layout) -> list[dict]:
    """The nodes as Spark stores them, by depth first; leaves of one parent that say the same are one leaf."""
    n = len(tree.left)
    merged = [left < 0 for left in tree.left]
    says = [tree.prediction(i) for i in range(n)]
    # children are made after their parents
    for node in range(n - 1, -1, -1):
        left = tree.left[node]
        if left >= 0 and merged[left] and merged[left + 1] and says[left] == says[left + 1]:
            merged[node], says[node] = True, says[left]
    rows, stack = [], [(0, None, None)]
    while stack:
        node, parent, side = stack.pop()
        at, left = len(rows), tree.left[node]
        if parent is not None:
            rows[parent][side] = at
        stats = tree.stats[node]
        impurity = float(variance(stats)) if left >= 0 or tree.valid[node] else -1.0
        row = {
            "id": at, "prediction": says[node], "impurity": impurity, "impurityStats": [float(x) for x in stats],
            "rawCount": int(stats[0]), "gain": -1.0, "leftChild": -1, "rightChild": -1,
            "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1},
        }
        rows.append(row)
        if not merged[node]:
            f, cut = tree.split[node]
            number = layout.code[f] == 0
            row["gain"] = tree.gain[node]
            row["split"] = {
                "featureIndex": f,
                "leftCategoriesOrThreshold": [float(layout.thresholds[f][cut]) if number else float(cut)],
                "numCategories": -1 if number else 2,
            }
            stack += [(left + 1, at, "rightChild"), (left, at, "leftChild")]
    return rows


TREE_PARAMS = {
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth",
    "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed",
}


def _model_of(
    trees: list[Tree], settings: Settings, spark: SparkSession, estimator: GBTClassifier
) -> GBTClassificationModel:
    """Written as Spark stores a model and read back."""
    path, features = work_path(spark, "trees"), len(settings.layout.code)
    given = {p.name: v for p, v in estimator._paramMap.items()}
    default = {p.name: v for p, v in estimator._defaultParamMap.items()}

    def about(kind: str, uid: str, names: Iterable[str], **more: int) -> str:
        chosen = [{k: v for k, v in params.items() if k in names} for params in (given, default)]
        shared = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        return json.dumps({"class": kind, **shared, "uid": uid, "paramMap": chosen[0], "defaultParamMap": chosen[1], **more})

    whole = about(
        "org.apache.spark.ml.classification.GBTClassificationModel", estimator.uid, {*given, *default},
        numFeatures=features, numTrees=len(trees),
    )
    single = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    each = [
        (i, about(single, f"dtr_{uuid.uuid4().hex[:12]}", TREE_PARAMS), settings.step if i else 1.0)
        for i in range(len(trees))
    ]
    rows = [{"treeID": i, "nodeData": row} for i, tree in enumerate(trees) for row in _node_rows(tree, settings.layout)]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(rows, NODE_DATA).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


class BoostedTrees(GBTClassifier):
    """Spark's classifier, fitted from rows as codes where its parameters allow that.

    ``one_hot`` has what the names of a one-hot column's slots begin with. Case weights, a validation column
    and slots of more than two values are left to Spark."""

    one_hot: tuple[str, ...] = ()

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        settings = None
        if not (self.isDefined("weightCol") or self.isDefined("validationIndicatorCol")):
            settings, rows = self._settings(dataset)
        if settings is None:
            return super()._fit(dataset)
        found = blocks(dataset, self.getLabelCol(), self.getFeaturesCol(), settings.layout)
        if rows <= tables.ROWS_PER_TASK:
            grown = found.coalesce(1).mapPartitions(lambda held: [vars(t) for t in boost_here(list(held), settings)])
            trees = [Tree(**t) for t in grown.collect()]
        else:
            trees = boost_spread(found, settings)
        return self._copyValues(_model_of(trees, settings, dataset.sparkSession, self))

    def _settings(self, dataset: DataFrame) -> tuple[Settings | None, int]:
        """What Spark itself finds out before it grows trees: thresholds, bins, features per node."""
        self._transfer_params_to_java()
        spark, java = dataset.sparkSession, self._java_obj
        impl, util = spark._jvm.org.apache.spark.ml.tree.impl, spark._jvm.org.apache.spark.ml.util
        old = spark._jvm.org.apache.spark.mllib.tree
        helper = getattr(getattr(util, "DatasetUtils$"), "MODULE$")
        none = spark._jvm.scala.Option.empty()
        instances = helper.extractInstances(java, dataset._jdf, spark._jvm.scala.Option.apply(2) or none)
        column = dataset._jdf.schema().apply(self.getFeaturesCol())
        algo = old.configuration.Algo
        categories = util.MetadataUtils.getCategoricalFeatures(column)
        strategy = java.getOldBoostingStrategy(categories, algo.Classification()).treeStrategy().copy()
        strategy.setAlgo(algo.Regression())
        strategy.setImpurity(getattr(getattr(old.impurity, "Variance$"), "MODULE$"))
        data = impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, self.getFeatureSubsetStrategy())
        splits = getattr(getattr(impl, "RandomForest$"), "MODULE$").findSplits(instances, data, self.getSeed())
        thresholds: list[np.ndarray | None] = []
        for f in range(data.numFeatures()):
            if data.isContinuous(f):
                thresholds.append(np.array([s.threshold() for s in splits[f]], dtype=np.float64))
            elif data.numBins()[f] == 2:
                thresholds.append(None)
            else:
                return None, 0
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        named = {a["idx"]: a.get("name", "") for group in attributes.values() for a in group}
        layout = layout_of([named.get(f, "") for f in range(len(thresholds))], thresholds, self.one_hot)
        settings = Settings(
            trees=self.getMaxIter(),
            depth=self.getMaxDepth(),
            least=data.minInstancesPerNode(),
            least_gain=data.minInfoGain(),
            step=self.getStepSize(),
            share=self.getSubsamplingRate(),
            kept=data.numFeaturesPerNode(),
            memory=self.getMaxMemoryInMB() * 1024 * 1024,
            seed=self.getSeed(),
            bins=np.array(list(data.numBins()), dtype=np.int64),
            layout=layout,
        )
        return settings, int(data.numExamples())
