"""The SVM's random features are cached once, by the solver, not a second time by the frame that it reads."""

from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from cohortlab.models import classifiers


def test_features_are_not_cached_twice(spark, monkeypatch):
    seen = []

    class Spy(LinearSVC):
        def fit(self, dataset, params=None):
            plan = dataset._jdf.queryExecution().withCachedData()
            seen.append((dataset.storageLevel.useMemory, classifiers.VEC in plan.toString().split("InMemoryRelation")[-1]))
            return super().fit(dataset, params)

    monkeypatch.setattr(classifiers, "LinearSVC", Spy)
    monkeypatch.setattr(classifiers, "SVM_MAX_ITER", 3)
    df = spark.range(0, 300, 1, 2).select((F.col("id") % 17).cast("double").alias("a b"), (F.col("id") % 5).cast("double").alias("c"),
                                 (F.col("id") % 17 > 8).cast("int").alias("target"))
    f = classifiers.fit("svm", df, ["a b", "c"])
    assert seen == [(False, False)]  # the cached relation holds the plain columns
    assert f.transform(df).where("p1 BETWEEN 0 AND 1").count() == 300
