import pickle
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.catalog import training
from gridpanel.plans import compare, evaluate, models, solvers, splits, studies, trees
from gridpanel.plans.demo_panel import results_from_lineitem

SMALL = models.Settings(
    linear_iterations=20, svm_iterations=10, trees=5, max_depth=4, boosting_rounds=4, kernel_features=8
)
FEATURES = ["previous_race_pos", "previous_year_pos", "qualy_pos"]


@pytest.fixture(scope="module")
def planted(spark):
    """Finishing position follows the qualifying one, with noise."""
    draw = random.Random(3)
    rows = []
    for i in range(600):
        qualifying = draw.randint(1, 20)
        position = min(20, max(1, qualifying + draw.choice([-1, 0, 0, 1])))
        rows.append((i, draw.randint(1, 21), draw.randint(1, 21), qualifying, position))
    df = spark.createDataFrame(rows, "position_id bigint, previous_race_pos int, previous_year_pos int, qualy_pos int, position int")
    return df.withColumn("label", (F.col("position") <= 10).cast("double"))


@pytest.mark.parametrize("k, size, first_train", [(5, 714, 715), (20, 204, 205)])
def test_fold_sizes(spark, k, size, first_train):
    folds = splits.expanding_window(spark.range(4285), k, ["id"])
    assert (folds.test_size, folds.first_test_row(1)) == (size, first_train)
    counts = {r.test_fold: r["count"] for r in folds.rows.groupBy("test_fold").count().collect()}
    assert counts == {0: first_train, **{f: size for f in range(1, k + 1)}}
    assert folds.train(k).count() == 4285 - size and folds.test(2).agg(F.min("row_index")).first()[0] == first_train + size


def test_too_few_rows_for_the_folds(spark):
    with pytest.raises(ValueError):
        splits.expanding_window(spark.range(3), 5, ["id"])


def test_holdout_share_and_stability(spark):
    parts = splits.holdout(spark.range(20_000), "id").groupBy("part").count().collect()
    share = {r.part: r["count"] for r in parts}["test"] / 20_000
    assert 0.18 < share < 0.22
    again = splits.holdout(spark.range(20_000).repartition(7), "id").filter("part = 'test'").agg(F.sum("id")).first()[0]
    assert again == splits.holdout(spark.range(20_000), "id").filter("part = 'test'").agg(F.sum("id")).first()[0]


def test_holdout_says_nothing_about_the_key(spark):
    # keys that end in the class, as minted ones do
    keys = spark.range(20_000).selectExpr("cast(id * 20 + id % 20 as int) AS key", "id % 20 AS label")
    parts = splits.holdout(keys, "key").groupBy("label").agg(F.avg(F.expr("int(part = 'test')")).alias("share")).collect()
    assert len(parts) == 20 and all(0.15 < r.share < 0.25 for r in parts)


def test_scaling_centres_and_handles_constants(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "a int, b int")
    scaled = models.fit_scaling(df, ["a", "b"]).apply(df).orderBy("a").collect()
    assert [round(r.a_scaled, 6) for r in scaled] == [-1.224745, 0.0, 1.224745]
    assert [r.b_scaled for r in scaled] == [0.0, 0.0, 0.0]


def test_report_by_hand(spark):
    rows = [(0.0, 0.0, 3), (0.0, 1.0, 1), (1.0, 1.0, 2), (2.0, 0.0, 4)]
    counts = spark.createDataFrame(rows, "label double, prediction double, n bigint")
    got = {r["class"]: r for r in evaluate.classification_report(counts, []).collect()}
    assert got["0"].precision == pytest.approx(3 / 7) and got["0"].recall == pytest.approx(3 / 4)
    assert got["1"].f1_score == pytest.approx(0.8)
    assert (got["2"].precision, got["2"].recall, got["2"].f1_score, got["2"].support) == (0.0, 0.0, 0.0, 4)
    assert got["accuracy"].f1_score == pytest.approx(0.5)
    assert got["macro avg"].recall == pytest.approx((0.75 + 1.0 + 0.0) / 3)
    assert got["weighted avg"].recall == pytest.approx((4 * 0.75 + 2 * 1.0) / 10)


@pytest.mark.parametrize("kind", compare.CLASS_MODELS)
def test_class_models_find_the_signal(planted, kind):
    counts = compare.on_holdout(planted, FEATURES, (kind,), SMALL)
    (row,) = evaluate.accuracy(counts, ["model"]).collect()
    assert row.model == kind and row.accuracy > 0.8


def test_position_models_beat_chance(planted):
    # four classes, none of them zero
    exact = planted.withColumn("label", F.ceil(F.col("position") / 5).cast("double"))
    counts = compare.on_holdout(exact, FEATURES, settings=SMALL)
    got = {r.model: r.accuracy for r in evaluate.accuracy(counts, ["model"]).collect()}
    assert set(got) == set(compare.POSITION_MODELS)
    assert all(value > 0.4 for value in got.values()), got
    assert {r["s"] for r in counts.groupBy("model").agg(F.sum("n").alias("s")).collect()} == {
        splits.holdout(exact, "position_id").filter("part = 'test'").count()
    }


def test_folds_and_feature_sets(planted):
    folds = splits.expanding_window(planted, 2, ["position_id"])
    sets = {"base": FEATURES, "qualifying": ["qualy_pos"]}
    counts = compare.over_folds(folds, sets, ("logistic", "forest"), SMALL)
    mean = {(r.feature_set, r.model): (r.accuracy, r.folds) for r in compare.mean_accuracy(counts).collect()}
    assert set(mean) == {(s, m) for s in sets for m in ("logistic", "forest")}
    assert all(a > 0.8 and n == 2 for a, n in mean.values())
    assert compare.final_report(counts, 2).filter("class = 'accuracy'").count() == 4


def test_podium_study_on_the_derived_panel(spark, folder):
    sets = {"base": FEATURES}
    counts = studies.podium_finish(results_from_lineitem(spark, folder), 2, sets, ("logistic", "boosted"), SMALL)
    mean = {r.model: r.accuracy for r in compare.mean_accuracy(counts).collect()}
    assert set(mean) == {"logistic", "boosted"} and all(value > 0.5 for value in mean.values())


def test_queries_run_whole_studies(spark, folder, monkeypatch):
    """Folds, kinds, feature sets and settings are those of the full studies; nothing is trained here."""
    asked = []

    def run(study, parallelism=4):
        asked.append((study.folds, study.kinds, tuple(study.sets), study.settings))
        return spark.createDataFrame([], compare.COUNTS)

    monkeypatch.setattr(compare, "run", run)
    full, points = models.Settings(), models.Settings(svm_c=1.2)
    sets = tuple(models.FEATURE_SETS)
    wanted = {
        "model_compare": (1, compare.POSITION_MODELS, ("all",), full),
        "svm_kernel_features": (1, ("kernel_svm",), ("all",), full),
        "gbt_regress_round": (1, ("boosted_regression",), ("all",), full),
        "svm_linear": (1, ("linear_svm",), ("all",), points),
        "points_folds": (5, compare.CLASS_MODELS, ("base+sprint",), points),
        "points_fold_support": (5, compare.CLASS_MODELS, ("base+sprint",), points),
        "planted_ablation": (20, compare.CLASS_MODELS, sets, full),
        "ablation": (20, compare.CLASS_MODELS, sets, models.Settings(boosting_seed=42)),
    }
    for name, want in wanted.items():
        asked.clear()
        training.QUERIES[name](spark, folder)
        assert asked == [want], name


def test_defaults_are_full_size():
    s = models.Settings()
    assert (s.trees, s.max_depth, s.boosting_rounds, s.boosting_depth, s.tree_rows) == (100, 30, 100, 3, 20_000)


def test_a_stopped_study_goes_on_where_it_ended(planted, tmp_path, monkeypatch):
    folds = splits.expanding_window(planted, 4, ["position_id"])
    started = []
    grown, solved = compare._grown, compare._solved

    def counting(inner, after):
        def call(study, what, *rest):
            started.append(what if inner is solved else rest[0])
            if len(started) > after:
                raise RuntimeError("lost")
            return inner(study, what, *rest)

        return call

    sets = {"base": FEATURES}
    study = compare.fold_study(folds, sets, ("logistic", "forest"), SMALL, str(tmp_path))
    monkeypatch.setattr(compare, "_grown", counting(grown, 3))
    monkeypatch.setattr(compare, "_solved", counting(solved, 3))
    with pytest.raises(RuntimeError):
        compare.run(study, parallelism=1)
    assert started[:4] == ["logistic", 1, 2, 3]
    started.clear()
    monkeypatch.setattr(compare, "_grown", counting(grown, 99))
    monkeypatch.setattr(compare, "_solved", counting(solved, 99))
    again = compare.fold_study(splits.expanding_window(planted, 4, ["position_id"]), sets, ("logistic", "forest"), SMALL, str(tmp_path))
    counts = compare.run(again, parallelism=1)
    assert again.ledger == study.ledger and started == [3, 4]
    whole = compare.over_folds(folds, sets, ("logistic", "forest"), SMALL)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, whole.collect()))
    other = compare.fold_study(splits.expanding_window(planted.where("position_id > 0"), 4, ["position_id"]), sets, ("logistic", "forest"), SMALL, str(tmp_path))
    assert other.ledger != study.ledger


def _arrays(df, features):
    rows = df.select("label", *features).collect()
    return np.array([[float(r[f]) for f in features] for r in rows]), np.array([r.label for r in rows])


def _solve(df, found, settings=models.Settings()):
    rows = df.withColumn("block", F.lit(0)).select("block", "label", *[F.col(f).cast("double") for f in FEATURES])
    solvers.solve(rows.repartition(3), FEATURES, found, settings.gradient_tolerance, settings.svm_gap)


def test_logistic_and_softmax_end_at_the_optimum(planted):
    design = solvers.Design((0, 1, 2))
    bands = planted.withColumn("label", F.ceil(F.col("position") / 5).cast("double"))
    one = solvers.Binary(design, 1, (1.0, 0.0), 1.0, hinge=False)
    many = solvers.Multinomial(design, 1, np.array([1.0, 2.0, 3.0, 4.0]), 1.0)
    _solve(planted, [one])
    _solve(bands, [many])
    assert one.converged and many.converged and one.passes < 30
    x, y = _arrays(planted, FEATURES)
    z = np.hstack([x, np.ones((len(x), 1))])
    chance = 1 / (1 + np.exp(-z @ one.point))
    gradient = z.T @ (chance - y) + np.append(one.point[:-1], 0.0)
    assert np.abs(gradient).max() < 1e-4
    # Spark ML on the same penalty gives the same answers
    predicted = models.fit("logistic", planted, FEATURES, 600)(planted, "p").select("p").collect()
    assert (np.array([r.p for r in predicted]) == solvers.Signs(one).predict(x)).mean() > 0.995
    xb, yb = _arrays(bands, FEATURES)
    found = (solvers.Softmax(many).predict(xb) == yb).mean()
    spark_ml = models.fit("multinomial", bands, FEATURES, 600)(bands, "p").select(F.avg(F.expr("double(p = label)"))).first()[0]
    assert abs(found - spark_ml) < 0.02


@pytest.mark.parametrize("c", [0.05, 1.2])
def test_svm_gap_bounds_the_distance_to_the_optimum(planted, c):
    x, y = _arrays(planted, FEATURES)
    mean, deviation = x.mean(axis=0), x.std(axis=0)
    svm = solvers.Binary(solvers.Design((0, 1, 2)), 1, (1.0, 0.0), c, hinge=True, shift=mean, scale=deviation)
    _solve(planted, [svm])
    assert svm.converged and 0 <= svm.residual <= models.Settings().svm_gap
    sign = np.where(y == 1, 1.0, -1.0)
    z = np.hstack([(x - mean) / deviation, np.ones((len(x), 1))])

    def primal(w):
        return 0.5 * w[:-1] @ w[:-1] + c * np.maximum(0, 1 - sign * (z @ w)).sum()

    raw = svm.point
    w = np.append(raw[:-1] * deviation, raw[-1] + raw[:-1] @ mean)
    reached = primal(w)
    rng = np.random.default_rng(0)
    best = reached
    for scale in (1.0, 0.1, 0.01, 0.001):
        for _ in range(3000):
            other = w + scale * rng.normal(size=len(w))
            best = min(best, primal(other))
    assert reached <= best * (1 + 1.1e-3)


def test_kernel_features_reproduce_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    design = solvers.nystroem((0, 1, 2), x, 0.3)
    z = design.apply(x)[:, :-1]
    assert np.allclose(z @ z.T, solvers.rbf(x, x, 0.3), atol=1e-5)


def test_forest_equals_a_plain_tree_where_it_must():
    """One tree on all rows and columns: each split is the best one, leaves are pure or cannot be split."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (300, 3)).astype(float)
    y = rng.integers(0, 3, 300).astype(float)
    forest = trees.grow_forest(x, y, (0, 1, 2), range(1), 1, 30, bootstrap=False)

    def gini(labels):
        share = np.unique(labels, return_counts=True)[1] / len(labels)
        return len(labels) * (1 - (share**2).sum())

    def check(node, rows):
        labels = y[rows]
        if forest.left[node] == 0:
            assert len(set(labels)) == 1 or len(np.unique(x[rows], axis=0)) == 1
            return
        f, border = forest.feature[node], forest.edges[forest.feature[node]][forest.bin[node]]
        low = x[rows, f] < border
        best = min(
            gini(labels[x[rows, g] <= v]) + gini(labels[x[rows, g] > v]) for g in range(3) for v in np.unique(x[rows, g])[:-1]
        )
        assert gini(labels[low]) + gini(labels[~low]) == pytest.approx(best)
        check(forest.left[node], rows[low])
        check(forest.left[node] + 1, rows[~low])

    check(0, np.arange(300))
    shares = {tuple(r): y[(x == r).all(axis=1)] for r in x}
    for row, labels in shares.items():
        assert np.allclose(forest.votes(np.array([row]))[0], [(labels == c).mean() for c in forest.classes])


def test_trees_of_a_forest_do_not_depend_on_their_task():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 9, (200, 4)).astype(float)
    y = (x[:, 0] + rng.integers(0, 4, 200) > 5).astype(float)
    whole = trees.grow_forest(x, y, (0, 1, 2, 3), range(6), 48, 30, bootstrap=True).votes(x)
    parts = [trees.grow_forest(x, y, (0, 1, 2, 3), range(a, a + 2), 48, 30, bootstrap=True).votes(x) for a in (0, 2, 4)]
    assert np.allclose(whole, sum(parts))


def test_boosting_lowers_the_loss_and_handles_one_class():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 20, (400, 3)).astype(float)
    y = 2 * x[:, 0] + rng.normal(0, 0.1, 400)
    model = trees.boost(x, y, (0, 1, 2), 100, 3, 0.1, regression=True)
    assert ((model.score(x) - y) ** 2).mean() < 0.05 * y.var()
    same = trees.boost(x, np.ones(400), (0, 1, 2), 100, 3, 0.1, regression=False)
    assert (same.predict(x) == 1).all()


def test_folds_that_split_no_race(spark):
    rows = spark.range(100).selectExpr("id", "cast(id / 7 as int) AS race")
    folds = splits.unsplit(splits.expanding_window(rows, 4, ["id"]), ["race"])
    got = folds.rows.groupBy("race").agg(F.countDistinct("test_fold").alias("n"), F.min("test_fold").alias("f"), F.min("id").alias("i")).collect()
    assert all(r.n == 1 for r in got) and all(r.f == max(0, (r.i - 20) // 20 + 1) for r in got)
    assert folds.test(2).count() + folds.train(2).count() == folds.train(3).count()


def test_defaults_leave_the_end_to_the_models(planted, monkeypatch):
    s = models.Settings()
    assert (s.max_depth, s.linear_iterations, s.multinomial_iterations) == (30, 1000, 100_000)
    seen = {}
    for name in ("LogisticRegression", "LinearSVC"):
        estimator = getattr(models, name)

        class Watched(estimator):
            def fit(self, dataset, params=None, own=name):
                model = super().fit(dataset, params)
                seen[own] = (model.summary().totalIterations if own == "LinearSVC" else model.summary.totalIterations, self.getMaxIter())
                return model

        monkeypatch.setattr(models, name, Watched)
    classes = planted.withColumn("label", F.ceil(F.col("position") / 5).cast("double"))
    models.fit("multinomial", classes, FEATURES, 600)
    models.fit("linear_svm", planted, FEATURES, 600)
    assert seen["LogisticRegression"][1] == 100_000 and seen["LinearSVC"][1] == s.svm_iterations
    assert all(done < most for done, most in seen.values()), seen


def test_equal_rows_are_solved_and_tested_as_one(spark, planted, monkeypatch):
    many = planted.crossJoin(spark.range(30).withColumnRenamed("id", "copy")).withColumn("position_id", F.col("position_id") * 30 + F.col("copy"))
    study = compare.holdout_study(many, FEATURES, ("logistic",), SMALL)
    assert study.cells.count() <= 2 * 600 < study.rows.count() == 18_000
    read = []
    inner = solvers.one_pass
    monkeypatch.setattr(solvers, "one_pass", lambda rows, *rest: read.append(rows.count()) or inner(rows, *rest))
    counts = compare.run(study)
    assert read and max(read) <= 1200
    assert counts.agg(F.sum("n")).first()[0] == study.rows.where("block = 1").count()


def test_copies_weigh_as_rows(spark, planted):
    rows = planted.select(F.lit(0).alias("block"), "label", *FEATURES, (F.col("position_id") % 4 + 1).alias("copies"))
    spread = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")
    design = solvers.Design((0, 1, 2))
    models_ = {0: solvers.Binary(design, 1, (1.0, 0.0), 1.0, True), 1: solvers.Binary(design, 1, (1.0, 0.0), 1.0, False), 2: solvers.Multinomial(design, 1, np.array([0.0, 1.0]), 1.0)}
    points = {0: np.full(4, 0.01), 1: np.full(4, 0.02), 2: np.linspace(-0.02, 0.02, 8)}
    one, other = (solvers.one_pass(df, FEATURES, models_, points) for df in (rows, spread))
    assert all(np.allclose(one[i], other[i]) for i in models_)


def test_grown_trees_do_not_come_to_the_driver(spark, planted):
    study = compare.holdout_study(planted, FEATURES, ("forest", "boosted"), SMALL)
    study = study._replace(samples=compare._samples(study))
    found = compare._grown(study, ("forest", "boosted"), 1)
    x, label = compare._training_rows(study, 1)
    forest, boosted = found["all", 1, "forest"], found["all", 1, "boosted"]
    assert max(len(pickle.dumps(m)) for m in found.values()) < 2000
    own = trees.grow_forest(x, label, (0, 1, 2), range(5), SMALL.seed, SMALL.max_depth, bootstrap=True)
    assert (forest.predict(x) == own.classes[own.votes(x).argmax(axis=1)]).all()
    made = trees.boost(x, label, (0, 1, 2), SMALL.boosting_rounds, SMALL.boosting_depth, SMALL.boosting_rate, False)
    assert (boosted.predict(x) == made.predict(x)).all()


def test_training_rows_of_every_fold_are_those_with_the_smallest_hashes(planted):
    study = compare.fold_study(splits.expanding_window(planted, 4, ["position_id"]), {"base": FEATURES}, ("forest",), models.Settings(tree_rows=50))
    study = study._replace(samples=compare._samples(study))
    for fold in (1, 4):
        x, label = compare._training_rows(study, fold)
        want = study.rows.where(F.col("block") < fold).orderBy("draw").limit(50).collect()
        assert x.tolist() == [[r[f] for f in study.features] for r in want] and label.tolist() == [r.label for r in want]


@pytest.fixture(scope="module")
def races(spark):
    """Twelve entities, thirty meetings; a lucky one in five changes its place."""
    draw = random.Random(11)
    rows = []
    for season, no in ((2001 + m // 10, 1 + m % 10) for m in range(30)):
        for name, code in (("Race", 0), ("Qualifying", 4), ("Sprint", 5)):
            meeting = season * 100 + no
            for place, driver in enumerate(sorted(range(1, 13), key=lambda d: d + draw.choice([0, 0, 0, 0, 6])), 1):
                rows.append(((meeting * 10 + code) * 100 + place, driver, place, name, meeting, f"M{no}", season, no))
    return spark.createDataFrame(
        rows, "position_id bigint, driver_number int, position int, session_name string, meeting_id bigint, meeting_name string, season int, no int"
    )


ALL_ROWS = [("ablation", 20), ("model_compare", 1), ("planted_ablation", 20), ("planted_folds", 5), ("planted_positions", 1)]


@pytest.mark.parametrize("name, fold", ALL_ROWS)
def test_trees_of_a_query_grow_on_all_training_rows(spark, races, monkeypatch, name, fold):
    studied = []
    monkeypatch.setattr(training, "results_from_lineitem", lambda *_: races)
    monkeypatch.setattr(compare, "run", lambda study, parallelism=4: studied.append(study) or spark.createDataFrame([], compare.COUNTS))
    training.QUERIES[name](spark, "")
    # rows are read 40 at a time
    study = studied[0]._replace(settings=replace(SMALL, tree_rows=40))
    study = study._replace(samples=compare._samples(study))
    kinds = tuple(k for k in study.kinds if k in compare.TREES)
    found = compare._grown(study, kinds, fold)
    assert {(chosen, kind) for chosen, _, kind in found} == {(chosen, kind) for chosen in study.sets for kind in kinds}
    x, label = _arrays(study.rows.where(F.col("block") < fold).orderBy("draw", "label", *study.features), study.features)
    assert len(x) > 200
    for (chosen, _, kind), model in found.items():
        columns = study.columns(chosen)
        if kind in ("tree", "forest"):
            own = trees.grow_forest(x, label, columns, range(SMALL.trees if kind == "forest" else 1), SMALL.seed, SMALL.max_depth, kind == "forest")
            want = own.classes[own.votes(x).argmax(axis=1)]
        else:
            want = trees.boost(x, label, columns, SMALL.boosting_rounds, SMALL.boosting_depth, SMALL.boosting_rate, kind == "boosted_regression").predict(x)
        assert (model.predict(x) == want).all(), (chosen, kind)


def test_counts_do_not_depend_on_how_many_rows_are_read_at_a_time(planted):
    whole, pieces = (compare.on_holdout(planted, FEATURES, ("tree", "forest", "boosted"), replace(SMALL, tree_rows=n)) for n in (20_000, 30))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.collect()))


@pytest.mark.parametrize("columns", [3, 10])
def test_trees_are_the_same_whatever_is_held_at_once(monkeypatch, columns):
    """Ten columns of more than 256 values do not fit one number as a key."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, columns)) if columns == 10 else rng.integers(0, 15, (1500, columns)).astype(float)
    y = (x[:, 0] + rng.integers(0, 6, 1500) > 3).astype(float)
    mine = tuple(range(columns))
    whole = trees.gather(lambda: [(x, y)], mine)
    assert (whole.codes[whole.place] == trees.to_bins(x, whole.edges)).all() and (whole.classes[whole.y[whole.place]] == y).all()
    assert all(len(e) == (255 if columns == 10 else 14) for e in whole.edges)
    rows = np.bincount(np.random.default_rng([1, 0]).integers(0, 1500, 1500), minlength=1500)
    assert (whole.drawn(np.random.default_rng([1, 0])) == np.bincount(whole.place, rows, len(whole.y))).all()
    forest = trees.grow(whole, range(3), 1, 30, bootstrap=True)
    monkeypatch.setattr(trees, "DRAWN", 100)
    monkeypatch.setattr(trees, "WEIGHTS", 200)
    parts = trees.gather(lambda: ((x[a : a + 70], y[a : a + 70]) for a in range(0, 1500, 70)), mine)
    assert all((a == b).all() for a, b in zip(whole[2:], parts[2:], strict=True)) and all((a == b).all() for a, b in zip(whole.edges, parts.edges, strict=True))
    again = trees.grow(parts, range(3), 1, 30, bootstrap=True)
    assert all((getattr(forest, f) == getattr(again, f)).all() for f in ("feature", "bin", "left", "ends", "of", "share"))
    monkeypatch.setattr(trees, "TOGETHER", 2 * len(whole.y))
    assert trees.together(whole, range(3, 8)) == [range(3, 5), range(5, 7), range(7, 8)]
