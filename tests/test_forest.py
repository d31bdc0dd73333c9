import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors

from lagline.operators import forest, learning


def rows(spark, n=3000, kinds=30, width=40, seed=1):
    rng = np.random.default_rng(seed)
    data = []
    for _ in range(n):
        k, hour, z = int(rng.integers(0, kinds)), float(rng.integers(0, 24)), round(float(rng.normal()), 2)
        y = float(rng.random() < 0.1 + 0.5 * (k % 3 == 0) + 0.3 * (hour > 12) * (z > 0))
        data.append((y, Vectors.sparse(width, {k: 2.5, width - 2: hour, width - 1: z})))
    return spark.createDataFrame(data, ["delay_indicator", "features"]).persist()


def test_one_tree_of_all_rows_and_slots_equals_sparks(spark, monkeypatch):
    """Without bags and with every slot at every node nothing is random, so trees have to agree."""
    df = rows(spark, 600, 5, 8)
    monkeypatch.setattr(forest, "_bag", lambda block, tree: np.ones(len(block[1]), np.uint8))
    monkeypatch.setattr(forest.math, "sqrt", lambda v: v)
    ours = forest.SparseForest("delay_indicator", 1, 3, bins=200).fit(df)
    theirs = RandomForestClassifier(
        labelCol="delay_indicator", numTrees=1, maxDepth=3, maxBins=200, bootstrap=False, featureSubsetStrategy="all", seed=1
    ).fit(df)
    assert ours.totalNumNodes == theirs.totalNumNodes and ours.trees[0].depth == 3
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())
    a, b = ([list(r[0]) for r in m.transform(df).select("probability").collect()] for m in (ours, theirs))
    assert np.array(a) == pytest.approx(np.array(b))


def test_forest_is_as_good_as_sparks_saves_and_repeats(spark, tmp_path):
    df = rows(spark)
    ours, again = (learning.wide_forest(trees=20).fit(df) for _ in range(2))
    theirs = learning.forest(trees=20).fit(df)
    auc = lambda m: BinaryClassificationEvaluator(labelCol="delay_indicator").evaluate(m.transform(df))
    assert auc(ours) == auc(again) and auc(ours) > auc(theirs) - 0.02
    assert ours.getNumTrees == 20 and ours.numFeatures == 40
    ours.save(str(tmp_path / "model"))
    assert auc(RandomForestClassificationModel.load(str(tmp_path / "model"))) == auc(ours)


def test_rows_cost_their_non_zero_slots(spark):
    """A dense copy of these rows would take 12 GB."""
    df = rows(spark, 1000, 1_000_000, 3_000_000)
    model = forest.SparseForest("delay_indicator", 2, 2).fit(df)
    assert model.numFeatures == 3_000_000


def test_labels_are_binary(spark):
    df = spark.createDataFrame([(2.0, Vectors.dense(1.0))], ["delay_indicator", "features"])
    with pytest.raises(ValueError, match="labels"):
        learning.wide_forest().fit(df)


def test_split_points_are_midpoints_and_count_zeros():
    found = forest.split_points(np.array([0, 0, 2, 2, 2]), np.array([1.0, 3.0, 5.0, 5.0, 5.0]), 3, 4)
    assert [p.tolist() for p in found] == [[0.5, 2.0], [], [], []]


def test_sparse_vector_holds_what_the_vector_holds(spark):
    wide = Vectors.sparse(1_000_000, {7: 0.1234567, 8: 0.0, 999_999: -2.0})
    df = spark.createDataFrame([(wide,), (Vectors.dense(0.0, 1.5, 0.0),)], ["features"])
    got = [r[0].asDict() for r in df.select(learning.sparse_vector("features", 6)).collect()]
    assert got == [
        {"size": 1_000_000, "indices": [7, 999_999], "values": [0.123457, -2.0]}, {"size": 3, "indices": [1], "values": [1.5]},
    ]


def test_entries_are_the_runs_from_their_heads():
    assert forest._entries(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert forest._entries(np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_classifiers_share_the_one_hot_stages(spark, sf, monkeypatch):
    """Both classifiers fit the encoding once; the forest keeps no vectors of the test rows."""
    from lagline.plans import catalog, catalog_models

    catalog.forget()
    fitted = []
    plain = learning.train
    monkeypatch.setattr(learning, "train", lambda stages, df: fitted.append(1) or plain(stages, df))
    monkeypatch.setattr(learning, "wide_forest", lambda trees=50: forest.SparseForest("delay_indicator", 2, 2))
    for kind in ("Logistic Regression", "Random Forest"):
        model, scored = catalog_models._baseline(spark, sf, kind, "web")
        assert model.transform(catalog_models._labelled(spark, sf, "web")[1]).count() == scored.count()
    assert len(fitted) == 1 and "features" not in scored.columns
    catalog.forget()


def test_a_forest_samples_rows_before_they_are_encoded(spark, monkeypatch):
    """The same forest as on encoded rows; only sampled rows are encoded beside the one pass over all."""
    from pyspark.ml import PipelineModel, Transformer
    from pyspark.sql import functions as F

    monkeypatch.setattr(forest, "SAMPLE", 100)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def same(x):
        seen.add(1)
        return x

    class Counted(Transformer):
        def _transform(self, dataset):
            return dataset.withColumn("z", same("x"))

    df = spark.range(4000).selectExpr("CAST(id % 7 < 3 AS double) AS delay_indicator", "CAST(id % 50 AS double) AS x").repartition(8).persist()
    encode = PipelineModel([Counted(), *learning.hashed([], ["z"], "error")])
    df.count()
    model = learning.wide_forest(trees=3).on(encode).fit(df)
    assert seen.value < 4000 + 1000
    assert model.toDebugString.split("\n")[1:] == learning.wide_forest(trees=3).fit(encode.transform(df)).toDebugString.split("\n")[1:]


def test_blocks_do_not_depend_on_the_batches_that_spark_cuts(spark):
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"a": list(range(a, b))}) for a, b in ((0, 3), (3, 3), (3, 11), (11, 12))]
    got = [b.column(0).to_pylist() for b in forest._of_size(iter(batches), 5)]
    assert got == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9], [10, 11]]
    assert list(forest._of_size(iter([]), 5)) == []


def test_both_cities_run_at_the_same_time(spark, sf):
    """Parts of either city wait for each other, so one after the other they never end."""
    from threading import Barrier

    from lagline.plans import catalog_models

    meet = Barrier(2, timeout=60)

    def part(city):
        meet.wait()
        return spark.createDataFrame([(len(city),)], "n int")

    assert sorted(catalog_models._cities_at_once(spark, part).collect()) == [(3, "web"), (7, "freight")]
