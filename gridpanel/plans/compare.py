"""Model comparison on a shared split, over folds and over feature sets.

Rows are staged once with a block number: fold f trains on all blocks before f
and is tested on block f (a hold-out is one fold). Rows with the same block, label
and features become one cell with their number; solvers and tests read the cells,
whose number is bounded where features are ranks. Linear models and SVMs of all
folds and feature sets are solved together (``solvers``); trees are grown by
Spark tasks, fold by fold (``trees``). Finished models go to the tasks that hold
the test rows, which send back counts of (label, prediction) pairs.

Results are written to a ledger folder as each part of a study ends: one part
per linear kind, one per fold of the tree kinds. A study that is started again
with the same ledger, data and settings does only the parts that are missing.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.plans import models, solvers, trees
from gridpanel.plans.evaluate import accuracy, classification_report, fold_mean, last_fold
from gridpanel.plans.splits import Folds, holdout
from gridpanel.scratch import exists, open_folder, release, scratch_path, stage

POSITION_MODELS = ("multinomial", "tree", "forest", "boosted_regression", "kernel_svm")
CLASS_MODELS = ("logistic", "forest", "linear_svm", "boosted")
LINEAR = ("logistic", "linear_svm", "multinomial", "kernel_svm")
TREES = ("tree", "forest", "boosted", "boosted_regression")
SLICE = 10
#: Rows of a file of ordered rows, about.
ORDERED = 250_000
#: Cells a task tests at once.
TESTED = 100_000
#: Goes into a ledger's name, so that results of other ways to fit are never taken for these.
FITS = "trees on all rows"
COUNTS = "feature_set string, fold int, model string, label double, prediction double, n bigint"
CERTIFICATES = "feature_set string, fold int, model string, train_rows bigint, passes int, residual double, converged boolean"


class Study(NamedTuple):
    """Staged rows (block, label, draw, features), their cells (block, label, copies, features) and what is compared on them."""

    rows: DataFrame
    cells: DataFrame
    features: list[str]
    sets: dict[str, list[str]]
    folds: int
    kinds: tuple[str, ...]
    settings: models.Settings
    ledger: str
    #: the rows as tree models read them
    samples: Ordered | None = None

    def columns(self, name: str) -> tuple[int, ...]:
        return tuple(self.features.index(f) for f in self.sets[name])

    def part(self, kind: str, name: str) -> str:
        return f"{self.ledger}/{kind}/part={name}"


def _study(rows: DataFrame, sets: dict[str, list[str]], folds: int, kinds: tuple[str, ...], settings: models.Settings, ledger: str | None) -> Study:
    """rows: block, label, key (unique), features."""
    features = sorted({f for chosen in sets.values() for f in chosen})
    numbers = [F.col(f).cast("double").alias(f) for f in features]
    staged = stage(rows.select(F.col("block").cast("int"), F.col("label").cast("double"), F.xxhash64("key").alias("draw"), *numbers), "study")
    if ledger is not None:
        # a digest of the rows, so that results of other data are never taken for these
        digest = staged.agg(F.count("*"), F.sum(F.xxhash64("block", "label", "draw", *features).cast("decimal(38,0)"))).first()
        what = repr((tuple(digest), sorted(sets.items()), folds, settings, FITS))
        ledger = f"{ledger.rstrip('/')}/{hashlib.sha256(what.encode()).hexdigest()[:16]}"
    return Study(staged, _cells(staged, features), features, sets, folds, kinds, settings, ledger or scratch_path(rows.sparkSession, "ledger"))


def _cells(rows: DataFrame, features: list[str]) -> DataFrame:
    """Distinct rows and how often they occur."""
    return stage(rows.groupBy("block", "label", *features).agg(F.count("*").alias("copies")), "cells")


def _dealt(cells: DataFrame, features: list[str]) -> DataFrame:
    """Cells in even partitions, cached: a pass computes far more than it reads, and few small files would make few tasks."""
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, "block", *features).sortWithinPartitions("block", "label", *features).persist()


def holdout_study(
    labelled: DataFrame,
    features: list[str],
    kinds: tuple[str, ...] = POSITION_MODELS,
    settings: models.Settings = models.Settings(),
    key: str = "position_id",
    ledger: str | None = None,
) -> Study:
    """One hashed hold-out; the feature set is called ``all``."""
    split = holdout(labelled.select(F.col(key).alias("key"), *features, "label"), "key")
    rows = split.withColumn("block", F.when(F.col("part") == "train", 0).otherwise(1))
    return _study(rows, {"all": features}, 1, kinds, settings, ledger)


def fold_study(
    folds: Folds,
    feature_sets: dict[str, list[str]],
    kinds: tuple[str, ...] = CLASS_MODELS,
    settings: models.Settings = models.Settings(),
    ledger: str | None = None,
) -> Study:
    rows = folds.rows.withColumnsRenamed({"test_fold": "block", "row_index": "key"})
    return _study(rows, feature_sets, folds.count, kinds, settings, ledger)


def on_holdout(labelled: DataFrame, features: list[str], kinds: tuple[str, ...] = POSITION_MODELS, settings: models.Settings = models.Settings(), key: str = "position_id", ledger: str | None = None) -> DataFrame:
    """Confusion counts (model, label, prediction, n) on one hashed hold-out."""
    return run(holdout_study(labelled, features, kinds, settings, key, ledger)).drop("feature_set", "fold")


def over_folds(folds: Folds, feature_sets: dict[str, list[str]], kinds: tuple[str, ...] = CLASS_MODELS, settings: models.Settings = models.Settings(), ledger: str | None = None) -> DataFrame:
    """Confusion counts (feature_set, fold, model, label, prediction, n)."""
    return run(fold_study(folds, feature_sets, kinds, settings, ledger))


def run(study: Study, parallelism: int = 4) -> DataFrame:
    """Confusion counts of all parts; those the ledger holds already are not done again."""
    spark = study.rows.sparkSession
    grown = tuple(k for k in study.kinds if k in TREES)
    jobs: list[tuple[str, Callable[[], dict]]] = [(kind, lambda kind=kind: _solved(study, kind)) for kind in study.kinds if kind in LINEAR]
    if grown:
        name = "-".join(grown)
        jobs += [(f"{name}-{fold}", lambda fold=fold: _grown(study, grown, fold)) for fold in range(1, study.folds + 1)]

    def work(job: tuple[str, Callable[[], dict]]) -> None:
        name, fit = job
        if not exists(spark, study.part("counts", name) + "/_SUCCESS"):
            _confusion(study, fit(), name)

    study = study._replace(cells=_dealt(study.cells, study.features))
    if grown and not all(exists(spark, study.part("counts", name) + "/_SUCCESS") for name, _ in jobs):
        study = study._replace(samples=_samples(study))
    try:
        _in_threads(study.rows, work, jobs, parallelism)
    finally:
        study.cells.unpersist()
        if study.samples is not None:
            release(spark, study.samples.folder)
    return spark.read.schema(COUNTS).parquet(*[study.part("counts", name) for name, _ in jobs])


def certificates(study: Study) -> DataFrame:
    """How each linear model and SVM of a finished study ended: passes over the rows, what was left, whether that is within bounds."""
    spark = study.rows.sparkSession
    return spark.read.schema(CERTIFICATES).parquet(*[study.part("certificates", kind) for kind in study.kinds if kind in LINEAR])


def _in_threads(df: DataFrame, call: Callable, arguments: Iterable, parallelism: int) -> list:
    """Results of the calls; up to ``parallelism`` run, as Spark jobs, at a time."""
    run_ = inheritable_thread_target(df.sparkSession)(call)
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(run_, arguments))


def _solved(study: Study, kind: str) -> dict[tuple[str, int, str], object]:
    """Linear models of one kind, for every feature set and fold; their certificates are written."""
    s = study.settings
    stats = _block_sums(study)
    wanted: dict[tuple[str, int], list] = {}
    votes: dict[tuple[str, int], list[float]] = {}
    for name in study.sets:
        columns = study.columns(name)
        designs = solvers.Design(columns)
        for fold in range(1, study.folds + 1):
            mean, deviation, classes, variance = stats(columns, fold)
            if kind == "logistic":
                found = [solvers.Binary(designs, fold, (1.0, 0.0), s.c, hinge=False)]
            elif kind == "linear_svm":
                found = [solvers.Binary(designs, fold, (1.0, 0.0), s.svm_c, hinge=True, shift=mean, scale=np.where(deviation > 0, deviation, 1.0))]
            elif kind == "multinomial":
                found = [solvers.Multinomial(designs, fold, np.array(classes), s.c)]
            else:
                found = solvers.pairs(solvers.nystroem(columns, _landmarks(study, columns), 1.0 / (len(columns) * (variance or 1.0))), fold, classes, s.svm_c)
                votes[name, fold] = classes
            wanted[name, fold] = found
    every = [m for found in wanted.values() for m in found]
    solvers.solve(study.cells, study.features, every, s.gradient_tolerance, s.svm_gap, s.newton_passes)
    ends = [
        (name, fold, kind, max((m.rows for m in found), default=0), max((m.passes for m in found), default=0), max((m.residual for m in found), default=0.0), all(m.converged for m in found))
        for (name, fold), found in wanted.items()
    ]
    study.rows.sparkSession.createDataFrame(ends, CERTIFICATES).coalesce(1).write.mode("overwrite").parquet(study.part("certificates", kind))
    wrap = {"multinomial": lambda n, f, m: solvers.Softmax(m[0]), "kernel_svm": lambda n, f, m: solvers.Votes(m, votes[n, f])}
    return {(n, f, kind): wrap.get(kind, lambda n, f, m: solvers.Signs(m[0]))(n, f, m) for (n, f), m in wanted.items()}


def _block_sums(study: Study) -> Callable:
    """Mean and deviation of columns, classes, and the variance of all entries, of the rows a fold trains on; one aggregate."""
    moments = [F.sum(p).alias(f"{f}_{k}") for f in study.features for k, p in (("x", F.col("copies") * F.col(f)), ("xx", F.col("copies") * F.col(f) * F.col(f)))]
    # a row per block, with as many labels as there are classes
    found = study.cells.groupBy("block").agg(F.sum("copies").alias("n"), F.collect_set("label").alias("labels"), *moments).collect()

    def of(columns: tuple[int, ...], fold: int):
        mine = [r for r in found if r["block"] < fold]
        n = max(sum(r["n"] for r in mine), 1)
        x = np.array([sum(r[f"{study.features[c]}_x"] or 0.0 for r in mine) for c in columns]) / n
        xx = np.array([sum(r[f"{study.features[c]}_xx"] or 0.0 for r in mine) for c in columns]) / n
        classes = sorted({label for r in mine for label in r["labels"]})
        return x, np.sqrt(np.maximum(xx - x * x, 0.0)), classes, float(xx.mean() - x.mean() ** 2)

    return of


def _landmarks(study: Study, columns: tuple[int, ...]) -> np.ndarray:
    """Rows of the first block, which every fold trains on, with the smallest hashes."""
    names = [study.features[c] for c in columns]
    chosen = study.rows.where("block = 0").orderBy("draw", *names).limit(study.settings.kernel_features).select(*names).collect()
    return np.unique(np.array([list(r) for r in chosen], np.float64).reshape(len(chosen), len(names)), axis=0)


class Ordered(NamedTuple):
    """All rows of a study in order of their hashes, in files that tasks read."""

    folder: str
    features: list[str]
    #: rows that are read at a time
    piece: int

    def pieces(self, fold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Features and labels of all rows that a fold trains on, ``piece`` rows at a time."""
        store, root = open_folder(self.folder)
        # part files are numbered in the order of the rows
        names = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("part-"))
        held = None
        for name in names:
            with store.open_input_file(name) as file:
                for batch in pq.ParquetFile(file).iter_batches(self.piece, columns=["block", "label", *self.features]):
                    found = pa.Table.from_batches([batch]).filter(pc.less(batch.column("block"), fold))
                    held = found if held is None else pa.concat_tables([held, found])
                    if held.num_rows >= self.piece:
                        yield self._arrays(held.slice(0, self.piece))
                        held = held.slice(self.piece)
        if held is not None and held.num_rows:
            yield self._arrays(held)

    def _arrays(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.stack([np.asarray(table.column(f)) for f in self.features], axis=1), np.asarray(table.column("label"))


def _samples(study: Study) -> Ordered:
    """All rows in order of their hashes, sorted once; a fold's bootstraps are drawn from its rows in that order."""
    by = ["draw", "label", *study.features]
    parts = -(-study.rows.count() // ORDERED) or 1
    folder = scratch_path(study.rows.sparkSession, "ordered")
    study.rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).write.parquet(folder)
    return Ordered(folder, study.features, study.settings.tree_rows)


def _training_rows(study: Study, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the first piece of the rows that a fold trains on; trees grow on all pieces."""
    return next(study.samples.pieces(fold), (np.empty((0, len(study.features))), np.empty(0)))


def _grown(study: Study, kinds: tuple[str, ...], fold: int) -> dict[tuple[str, int, str], object]:
    """Tree models of one fold, on all its training rows: a task per feature set makes cells of them, then every task
    grows some trees of one model and writes them to files.

    Rows, cells and deep trees are large, so only the files' names come to the driver.
    """
    spark, s, ordered = study.rows.sparkSession, study.settings, study.samples
    folder = scratch_path(spark, f"trees-{fold}")
    sets = {name: study.columns(name) for name in study.sets}

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                name = _put(folder, f"cells-{i}", trees.gather(lambda: ordered.pieces(fold), list(sets.values())[i]))
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([name])], ["id", "name"])

    found = {row["id"]: row["name"] for row in spark.range(0, len(sets), 1, len(sets)).mapInArrow(collect, "id long, name string").collect()}
    specs = []
    for i, name in enumerate(sets):
        for kind in kinds:
            slices = [range(a, min(a + SLICE, s.trees)) for a in range(0, s.trees, SLICE)] if kind == "forest" else [range(1)]
            specs += [(name, kind, found[i], part) for part in slices]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                _, kind, file, part = specs[i]
                cells = _get(folder, file)
                if kind in ("tree", "forest"):
                    made = (trees.grow(cells, some, s.seed, s.max_depth, bootstrap=kind == "forest") for some in trees.together(cells, part))
                else:
                    made = [trees.boost_cells(cells, s.boosting_rounds, s.boosting_depth, s.boosting_rate, kind == "boosted_regression")]
                names = [_put(folder, str(i), model) for model in made]
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([names])], ["id", "names"])

    rows = spark.range(0, len(specs), 1, len(specs)).mapInArrow(grow, "id long, names array<string>").collect()
    models_: dict[tuple[str, int, str], list[str]] = {}
    for row in sorted(rows, key=lambda r: r["id"]):
        name, kind, _, _ = specs[row["id"]]
        models_.setdefault((name, fold, kind), []).extend(row["names"])
    return {key: Grown(folder, names, key[2] in ("tree", "forest")) for key, names in models_.items()}


def _put(folder: str, label: str, what: object) -> str:
    """Writes a file with a name of its own, so that a task that runs again spoils none; returns its name."""
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    name = f"{label}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{root}/{name}", compression="zstd") as stream:
        pickle.dump(what, stream, pickle.HIGHEST_PROTOCOL)
    return name


def _get(folder: str, name: str) -> object:
    store, root = open_folder(folder)
    with store.open_input_stream(f"{root}/{name}", compression="zstd") as stream:
        return pickle.load(stream)


class Grown(NamedTuple):
    """Trees of one model in files, read one file at a time."""

    folder: str
    names: list[str]
    votes: bool

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.votes:
            return _get(self.folder, self.names[0]).predict(x)
        total = 0
        for name in self.names:
            forest = _get(self.folder, name)
            total = total + forest.votes(x)
        return forest.classes[total.argmax(axis=1)]


def _together(batches: Iterator[pa.RecordBatch], rows: int = TESTED) -> Iterator[pa.RecordBatch]:
    """Batches of a task joined up to ``rows`` rows, so that models are read a few times only."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _confusion(study: Study, fitted: dict[tuple[str, int, str], object], part: str) -> None:
    """Writes confusion counts of models on the test rows of their folds; counts are combined before they are shuffled."""
    spark = study.rows.sparkSession
    by_fold: dict[int, list] = {}
    for (name, fold, kind), model in fitted.items():
        by_fold.setdefault(fold, []).append((name, kind, model))
    sent = spark.sparkContext.broadcast(by_fold)
    features = study.features

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            x = np.stack([np.asarray(batch.column(f)) for f in features], axis=1)
            block, label, copies = (np.asarray(batch.column(c)) for c in ("block", "label", "copies"))
            for fold in np.unique(block).tolist():
                mine = block == fold
                for name, kind, model in sent.value.get(fold, []):
                    pairs, place = np.unique(np.stack([label[mine], model.predict(x[mine])]), axis=1, return_inverse=True)
                    size = pairs.shape[1]
                    n = np.zeros(size, np.int64)
                    np.add.at(n, place.ravel(), copies[mine])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * size), pa.array([fold] * size, pa.int32()), pa.array([kind] * size), pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n)],
                        ["feature_set", "fold", "model", "label", "prediction", "n"],
                    )

    tested = study.cells.where(F.col("block").isin(sorted(by_fold))).select("block", "label", "copies", *features)
    # every task reads the models of its folds, and several folds run at a time
    tested = tested.coalesce(max(1, spark.sparkContext.defaultParallelism // min(study.folds, 4)))
    counts = tested.mapInArrow(count, COUNTS).groupBy("feature_set", "fold", "model", "label", "prediction").agg(F.sum("n").alias("n"))
    counts.coalesce(1).write.mode("overwrite").parquet(study.part("counts", part))
    sent.destroy()
    for folder in {model.folder for model in fitted.values() if isinstance(model, Grown)}:
        release(spark, folder)


def mean_accuracy(counts: DataFrame) -> DataFrame:
    """Mean accuracy over folds per feature set and model."""
    by = ["feature_set", "model"]
    return fold_mean(accuracy(counts, [*by, "fold"]), by)


def final_report(counts: DataFrame, folds: int) -> DataFrame:
    """Per-class report of the last fold per feature set and model."""
    return classification_report(last_fold(counts, folds), ["feature_set", "model"])
