import re
from pathlib import Path

import numpy as np
import pytest
from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import riskbook
from riskbook.catalog import QUERIES, model_queries
from riskbook.catalog.loans import loans
from riskbook.operators import features as X
from riskbook.operators import models, tuning
from riskbook.plans import exploration, training
from riskbook.sources.session import wide_rows


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    table = training.model_table(loans(spark, sf_dir).drop("half_missing", "raw_amount"))
    return training.split(X.add_weight(training.stored(table)))


@pytest.fixture(scope="module")
def fitted(parts):
    chosen = {n: models.estimator(n) for n in models.MODELS}
    chosen["forest"] = models.forest(maxDepth=4)
    return training.fit_models(parts[0], chosen)


def test_features_hold_no_function_of_the_label(parts, fitted):
    names = X.feature_names(fitted["logistic"].transform(parts[1]))
    assert X.WEIGHT not in names and X.LABEL not in names and training.SPLIT_POINT not in names
    assert len(names) == len(set(names)) and "gradeVec_A" in names and "emp_lengthIndex" in names


def test_a_weight_among_the_features_gives_the_label_away(parts):
    train, test = parts
    leaky = training.fit_models(train, {"f": models.forest(maxDepth=3)}, include_weight=True)["f"]
    scored = leaky.transform(test)
    assert X.WEIGHT in X.feature_names(scored)


def test_probabilities_have_two_classes_and_sum_to_one(parts, fitted):
    for name in ("logistic", "bayes", "forest", "boosted"):
        scored = fitted[name].transform(parts[1]).select(vector_to_array("probability").alias("p"))
        bad = scored.where((F.size("p") != 2) | (F.abs(F.col("p")[0] + F.col("p")[1] - 1) > 1e-9))
        assert bad.count() == 0
    assert "probability" not in fitted["svm"].transform(parts[1]).columns


def test_models_that_share_encoders_are_compared_on_rows_encoded_once(parts, fitted, monkeypatch):
    chosen = {name: fitted[name] for name in ("logistic", "bayes", "svm")}
    own, calls = StringIndexerModel.transform, []
    monkeypatch.setattr(StringIndexerModel, "transform", lambda self, *a: calls.append(self.uid) or own(self, *a))
    together = {r["model"]: r.asDict() for r in training.compare_models(chosen, parts[1]).collect()}
    assert len(calls) == len(set(calls)) == 2
    for name, model in chosen.items():
        assert training.compare_models({name: model}, parts[1]).first().asDict() == together[name]


def test_same_seed_same_model(parts, fitted):
    again = training.fit_models(parts[0], {"forest": models.forest(maxDepth=4)})["forest"]
    trees = [models.rules_text(m).split("\n", 1)[1] for m in (again, fitted["forest"])]
    assert trees[0] == trees[1] and "If (feature" in trees[0]


def test_weights_change_predictions(parts):
    fitted = training.fit_models(
        parts[0], {"with": models.logistic(), "without": models.logistic(weight=None)}
    )
    bad = {n: m.transform(parts[1]).where("prediction = 1").count() for n, m in fitted.items()}
    assert bad["with"] > bad["without"]


def test_importances_sum_to_one(parts, fitted):
    table = models.importances(fitted["forest"], fitted["forest"].transform(parts[1]))
    assert abs(table.agg(F.sum("importance")).first()[0] - 1) < 1e-9


def test_comparison_has_one_row_per_model(parts, fitted):
    rows = training.compare_models(fitted, parts[1]).collect()
    assert [r["model"] for r in rows] == list(models.MODELS)
    assert all(r["correct"] + r["wrong"] == r["total"] for r in rows)
    assert all(0 <= r["area_under_roc"] <= 1 for r in rows)


def test_bayes_parameters_are_plain_sums(parts):
    columns = ["loan_amnt", "int_rate", "dti"]
    points = X.assembler(columns).transform(parts[0].withColumn("label", F.col(X.LABEL).cast("double")))
    model = models.bayes().fit(points)
    ours = models.bayes_parameters(parts[0], columns, X.LABEL, X.WEIGHT).collect()
    for row in ours:
        at = (row[X.LABEL], columns.index(row["feature"]))
        assert np.isclose(model.theta.toArray()[at], row["theta"], atol=1e-10)
        assert np.isclose(model.pi.toArray()[at[0]], row["pi"], atol=1e-10)


def test_grids_have_the_stated_sizes():
    sizes = {n: tuning.grid_size(g) for n, g in tuning.GRIDS.items()}
    assert sizes == {"logistic": 27, "bayes": 3, "forest": 32, "boosted": 27, "svm": 9}
    assert set(tuning.MEASURES) == set(models.MODELS) == set(tuning.GRIDS)


@pytest.mark.parametrize("refit", [False, True])
def test_cross_validation_ranks_its_grid(parts, refit):
    search = tuning.cross_validate(
        parts[0], models.bayes(), {"smoothing": [1.0, 50.0]}, "accuracy", folds=2,
        key=["loan_amnt", "installment"], refit_encoders=refit,
    )
    rows = search.table.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert rows[0]["mean_accuracy"] >= rows[1]["mean_accuracy"]
    assert {r["parameters"] for r in rows} == {"smoothing=1.0", "smoothing=50.0"}
    best = tuning.best_parameters(search.fitted, ["smoothing", "maxDepth"])
    assert rows[0]["parameters"] == f"smoothing={best['smoothing']}" and "maxDepth" not in best
    assert "prediction" in search.model.transform(parts[1]).columns


@pytest.mark.parametrize(
    "name, grid",
    [
        ("bayes", {"smoothing": [1.0, 2.0, 50.0]}),
        ("boosted", {"maxDepth": [2, 3], "maxIter": [1, 3], "stepSize": [0.1, 1.0]}),
        ("logistic", {"regParam": [0.01, 1.0], "elasticNetParam": [1.0], "maxIter": [1, 3, 40]}),
        ("svm", {"regParam": [0.1], "maxIter": [2, 100, 150]}),
        ("forest", {"maxDepth": [2, 3], "impurity": ["gini"]}),
    ],
)
def test_searches_with_fewer_fits_give_the_numbers_of_all_fits(parts, name, grid):
    key = ["loan_amnt", "installment"]
    ours = tuning.tune(name, parts[0], key, folds=3, grid=grid)
    measure = tuning.MEASURES[name]
    theirs = tuning.cross_validate(parts[0], models.estimator(name), grid, measure, folds=3, key=key)
    found, expected = ({r["parameters"]: r[f"mean_{measure}"] for r in s.table.collect()} for s in (ours, theirs))
    assert set(found) == set(expected) and len(found) == tuning.grid_size(grid)
    assert all(np.isclose(found[p], expected[p], atol=1e-9) for p in expected)
    assert "prediction" in ours.model.transform(parts[1]).columns
    assert set(tuning.best_parameters(ours.fitted, list(grid))) == set(grid)


def test_shared_runs_are_fewer(parts, monkeypatch):
    """Boosted models of fewer steps are not fitted, and neither are linear ones beyond their convergence."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression

    fits = []
    for kind in (GBTClassifier, LogisticRegression):
        monkeypatch.setattr(kind, "fit", lambda self, rows, f=kind.fit: fits.append(self) or f(self, rows))
    key = ["loan_amnt", "installment"]
    tuning.tune("boosted", parts[0], key, folds=2, grid={"maxDepth": [2], "maxIter": [1, 2, 3], "stepSize": [0.1]})
    assert len(fits) == 2 + 1  # one a fold, and the best on all rows
    fits.clear()
    tuning.tune("logistic", parts[0], key, folds=2, grid={"regParam": [1.0], "elasticNetParam": [1.0], "maxIter": [50, 100, 200]})
    assert len(fits) == 2 + 1


def test_model_table_partitions_follow_its_rows(spark, sf_dir):
    assert [training.parts_for(n) for n in (0, 1, 25_000, 25_001, 10**6, 10**8, 5 * 10**10)] == [1, 1, 1, 2, 40, 100, 50_000]
    raw = loans(spark, sf_dir).drop("half_missing", "raw_amount")
    first = training.stored(training.model_table(raw.repartition(3)))
    second = training.stored(training.model_table(raw.repartition(11)))
    assert first.count() == second.count()
    # floats are added in another order; the layout itself is the same
    for table in (first, second):
        rows = table.select(training.SPLIT_POINT, F.input_file_name().alias("f")).collect()
        assert len({r["f"] for r in rows}) == training.parts_for(len(rows))
        points = [r[training.SPLIT_POINT] for r in rows]
        assert points == sorted(points)


def test_grade_model_predicts_many_classes(parts):
    model = training.grade_model(parts[0], models.forest(maxDepth=4))
    rows = parts[1].drop(X.LABEL).withColumnRenamed("grade", "grade_label")
    assert model.transform(rows).agg(F.countDistinct("label")).first()[0] == 7


def test_every_exploration_report_runs(spark, sf_dir):
    prepared = exploration.prepare(loans(spark, sf_dir))
    found = exploration.reports(prepared)
    assert len(found) == 34
    for name, report in found.items():
        assert report().count() > 0, name


def test_stored_table_does_not_depend_on_how_it_arrived(spark):
    rows = spark.range(500).select("id", (F.hash("id") % 1000 / 1000).alias(training.SPLIT_POINT))
    read = [training.stored(rows.repartition(n), 4).select("id").collect() for n in (2, 8)]
    assert read[0] == read[1]


def test_unreadable_numbers_and_dates_cost_their_rows(spark, sf_dir):
    raw = loans(spark, sf_dir).drop("half_missing", "raw_amount")
    text = raw.withColumns({"dti": F.col("dti").cast("string"), "issue_d": F.date_format("issue_d", "MM/dd/yyyy")})
    spoilt = text.withColumns(
        {
            "dti": F.when(F.pmod(F.hash("id"), F.lit(7)) == 0, "x").otherwise(F.col("dti")),
            "issue_d": F.when(F.pmod(F.hash("id"), F.lit(5)) == 0, "soon").otherwise(F.col("issue_d")),
        }
    )
    whole = training.model_table(raw, ["id"])
    left = training.model_table(spoilt, ["id"])
    expected = training.model_table(raw.where("pmod(hash(id), 7) <> 0 AND pmod(hash(id), 5) <> 0"), ["id"]).count()
    assert left.count() == expected < whole.count()


def test_grids_are_registered_in_full(spark, sf_dir, monkeypatch):
    searched = {}

    def record(name, train, key, folds=tuning.FOLDS, grid=None, **options):
        searched[name] = (tuning.grid_size(grid or tuning.GRIDS[name]), folds, options)
        return tuning.Search(train.withColumns({"mean_accuracy": F.lit(0.5), "std_accuracy": F.lit(0.5)}), None, None)

    monkeypatch.setattr(tuning, "tune", record)
    monkeypatch.setattr(model_queries, "table", lambda df: df.withColumn(training.SPLIT_POINT, F.lit(0)))
    for name in ("cv_table", "cv_table_bayes", "cv_table_forest", "cv_table_boosted", "cv_table_svm"):
        QUERIES[name](spark, sf_dir)
    sizes = {"logistic": 27, "bayes": 3, "forest": 32, "boosted": 27, "svm": 9}
    assert searched == {name: (size, 10, {}) for name, size in sizes.items()}


def test_method_limit_is_put_back(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "1234")
    with pytest.raises(RuntimeError):
        with wide_rows(spark):
            assert spark.conf.get(key) == "8000"
            raise RuntimeError
    assert spark.conf.get(key) == "1234"
    spark.conf.set(key, "8000")


def test_library_code_stays_distributed():
    """Rows reach the driver only where their number has a stated bound."""
    allowed = {
        "operators/cleaning.py": 1,  # one row per column
        "operators/features.py": 1,  # refused above a stated number of values
        "operators/lookup.py": 1,  # at most the broadcast limit
    }
    root = Path(riskbook.__file__).parent
    for path in root.rglob("*.py"):
        if path.relative_to(root).parts[0] == "llm":  # has tests and rules of its own
            continue
        text = path.read_text()
        fetches = re.findall(r"\.(?:collect|toPandas|toArrow|toLocalIterator)\(", text)
        assert len(fetches) == allowed.get(str(path.relative_to(root)), 0), path
        forbidden = ("localCheckpoint", "crossJoin", ".rdd", "udf(", "applyInPandas")
        assert not [w for w in forbidden if w in text], path

def test_encoded_rows_come_in_parts_of_bounded_rows(spark, sf_dir, monkeypatch):
    """What a task of a learner holds does not grow with the table: files are of bounded rows, few of them packed together."""
    monkeypatch.setattr(training, "FILE_ROWS", 200)
    monkeypatch.setattr(training, "TASK_ROWS", 200)
    table = X.add_weight(training.stored(training.model_table(loans(spark, sf_dir).drop("half_missing", "raw_amount"))))
    train, _ = training.split(table)
    encoder = models.encoding_pipeline(train).fit(train)
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    vectors = training.encoded(encoder, train, ["label", "features"], StorageLevel.DISK_ONLY)
    try:
        sizes = [r["count"] for r in vectors.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == train.count() and max(sizes) <= 400
    finally:
        vectors.unpersist()
    assert spark.conf.get(key) == before


def test_components_encode_their_rows_once(spark, sf_dir, monkeypatch):
    kept, own = [], training.encoded
    monkeypatch.setattr(training, "encoded", lambda *a: kept.append(own(*a)) or kept[-1])
    found = {r["measure"]: r["value"] for r in QUERIES["pca_whole_vector"](spark, sf_dir).collect()}
    assert len(kept) == 1 and not kept[0].is_cached and found["components"] == found["variance"]


def test_bayes_search_keeps_the_rows_of_a_fold_together(parts, monkeypatch):
    """A scan of one fold then reads its blocks only; each of them is scored in one step."""
    seen, own = [], tuning.bayes_metrics

    def watched(split, *rest):
        place = F.monotonically_increasing_id()
        rows = split.rows.select(F.spark_partition_id().alias("p"), place.alias("i"), "fold").collect()
        seen.extend((r["p"], r["i"], r["fold"]) for r in rows)
        return own(split, *rest)

    monkeypatch.setattr(tuning, "bayes_metrics", watched)
    tuning.tune("bayes", parts[0], ["loan_amnt", "installment"], folds=3, grid={"smoothing": [1.0]})
    assert [(p, f) for p, _, f in sorted(seen)] == sorted((p, f) for p, _, f in seen)


def test_logistic_models_fitted_side_by_side_are_the_librarys(parts, monkeypatch):
    """All folds and settings share a pass, and every limit of iterations gives the library's model."""
    from pyspark.ml.classification import LogisticRegression

    fits, passes = [], []
    key = ["loan_amnt", "installment"]
    grid = {"regParam": [0.001, 0.01, 1.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [1, 3, 10]}
    theirs = tuning.cross_validate(parts[0], models.logistic(), grid, folds=2, key=key)
    own_fit, own_pass = LogisticRegression.fit, tuning.lockstep.losses
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, rows: fits.append(self) or own_fit(self, rows))
    monkeypatch.setattr(tuning.lockstep, "losses", lambda *a: passes.append(len(a[2])) or own_pass(*a))
    ours = tuning.tune("logistic", parts[0], key, folds=2, grid=grid)
    found, expected = ({r["parameters"]: tuple(r[2:]) for r in s.table.collect()} for s in (ours, theirs))
    assert len(found) == 27 and set(found) == set(expected)
    assert all(np.allclose(found[p], expected[p], atol=1e-9) for p in expected)
    assert len(fits) == 1 and len(passes) < 40 and passes[0] == 18


def test_minimiser_takes_steps_until_nothing_changes():
    """On a bowl with an absolute penalty the minimum is known: each coordinate moved towards zero by its penalty."""
    from riskbook.operators.lockstep import minimise

    centre, l1 = np.array([3.0, -0.2, 1.0]), np.array([0.5, 0.5, 0.0])
    for penalty, expected in ((None, centre), (l1, np.array([2.5, 0.0, 1.0]))):
        run = minimise(np.zeros(3), 50, 1e-12, penalty)
        x = next(run)
        with pytest.raises(StopIteration) as end:
            while True:
                x = run.send((0.5 * float((x - centre) @ (x - centre)), x - centre))
        assert np.allclose(end.value.value[-1], expected, atol=1e-5)


def test_support_vectors_fitted_side_by_side_are_the_librarys(parts, monkeypatch):
    from pyspark.ml.classification import LinearSVC

    fits = []
    key = ["loan_amnt", "installment"]
    grid = {"regParam": [0.001, 0.01, 0.1, 1.0, 5.0], "maxIter": [1, 2, 6]}
    theirs = tuning.cross_validate(parts[0], models.svm(), grid, folds=2, key=key)
    own_fit = LinearSVC.fit
    monkeypatch.setattr(LinearSVC, "fit", lambda self, rows: fits.append(self) or own_fit(self, rows))
    ours = tuning.tune("svm", parts[0], key, folds=2, grid=grid)
    found, expected = ({r["parameters"]: tuple(r[2:]) for r in s.table.collect()} for s in (ours, theirs))
    assert len(found) == 15 and set(found) == set(expected) and len(fits) == 1
    assert all(np.allclose(found[p], expected[p], atol=1e-9) for p in expected)


def test_grown_trees_are_the_librarys(parts, monkeypatch):
    """On the rows they were fitted to; elsewhere slots that split these alike may stand for each other."""
    from pyspark.ml.classification import GBTClassifier

    from riskbook.operators import boosting

    encoder = models.encoding_pipeline(parts[0]).fit(parts[0])
    rows = encoder.transform(parts[0]).select("label", "features").persist()
    chosen = models.boosted(maxDepth=4, maxIter=4, stepSize=0.5)
    fits, own_fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, r: fits.append(self) or own_fit(self, r))
    assert boosting.fit_any(chosen, rows).getNumTrees == 4 and len(fits) == 1  # few rows
    monkeypatch.setattr(boosting, "MANY_ROWS", 0)
    grown, theirs = boosting.fit_any(chosen, rows), own_fit(chosen, rows)
    assert len(fits) == 1 and grown.treeWeights == theirs.treeWeights
    found, expected = (
        np.array([r[0] for r in m.transform(rows).select(vector_to_array("rawPrediction")[1]).collect()]) for m in (grown, theirs)
    )
    assert np.allclose(found, expected, atol=1e-9) and np.std(found) > 0
    gains = [sum(t.featureImportances.toArray()) for t in grown.trees]
    assert np.allclose(gains, 1) and grown.totalNumNodes > 40
    rows.unpersist()


def test_boosted_search_reads_the_rows_once_a_level(parts, monkeypatch):
    """All folds and step sizes of a depth share its passes; the library fits the best model alone."""
    from pyspark.ml.classification import GBTClassifier

    from riskbook.operators import boosting

    fits, passes = [], []
    own_fit, own_pass = GBTClassifier.fit, boosting.counted
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, rows: fits.append(self) or own_fit(self, rows))
    monkeypatch.setattr(boosting, "counted", lambda *a: passes.append(len(a[2])) or own_pass(*a))
    grid = {"maxDepth": [2, 3], "maxIter": [1, 2], "stepSize": [0.01, 0.1, 1.0]}
    assert tuning.tune("boosted", parts[0], ["loan_amnt", "installment"], folds=3, grid=grid).table.count() == 12
    assert len(fits) == 1 and passes == [3] * 2 + [9] * 2 + [3] * 3 + [9] * 3


def test_thresholds_are_the_librarys():
    from riskbook.operators.boosting import thresholds

    assert thresholds(np.array([1.0, 1, 1, 1]), 4).tolist() == []
    assert thresholds(np.array([1.0, 2, 2, 4]), 4).tolist() == [1.5, 3.0]
    assert thresholds(np.arange(10.0), 4).tolist() == [1.5, 3.5, 5.5, 7.5]
    assert thresholds(np.array([0.0] * 97 + [1, 2, 3]), 2).tolist() == [0.5, 1.5]


def test_searches_keep_parts_of_bounded_rows_on_disk(spark, sf_dir, monkeypatch):
    """A task of a search sorts and keeps no more rows as the table grows."""
    monkeypatch.setattr(training, "FILE_ROWS", 200)
    monkeypatch.setattr(tuning, "TASK_ROWS", 200)
    table = model_queries.table(loans(spark, sf_dir)).drop(training.SPLIT_POINT)
    seen = []

    def watched(split, model, points, *rest):
        sizes = [r["count"] for r in split.rows.groupBy(F.spark_partition_id()).count().collect()]
        seen.append((sum(sizes), max(sizes), split.rows.storageLevel.useMemory))
        return np.zeros((split.folds, len(points)))

    monkeypatch.setattr(tuning, "bayes_metrics", watched)
    monkeypatch.setattr(tuning, "shared_metrics", watched)
    for name in ("bayes", "logistic", "svm"):
        tuning.tune(name, table, model_queries.FOLD_KEY, grid={"maxIter": [1]} if name != "bayes" else None)
    assert {total for total, _, _ in seen} == {table.count()}
    assert all(most <= 400 and not memory for _, most, memory in seen) and len(seen) == 3
