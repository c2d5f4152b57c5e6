"""Training jobs: split, select features, cross-validate, fit, test, record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.operators import boosting, extratrees, foldstats, foldtrees, forests, logistic, metrics, ordered, perceptron, preprocess, sampling
from ledgerlark.operators.features import add_calendar_flags, add_merchant_risk, add_training_features
from ledgerlark.operators.history import Entity, add_behaviour
from ledgerlark.operators.models import (
    IDLE, LABEL, WEIGHT, Family, best_round, family, importance_table, layered, pick_features,
)
from ledgerlark.operators.noise import add_fold_noise, add_sample_noise
from ledgerlark.operators.normalise import normalise
from ledgerlark.operators.profile import check_positives
from ledgerlark.operators.sampling import HashOrder, add_class_weight, class_weights, mark_folds, mark_split
from ledgerlark.operators.scoring import ScoringModel, TreeModel
from ledgerlark.schema import HIGH_RISK_MERCHANTS
from ledgerlark.session import materialise

ROW_ID = "transaction_id"
SCORES = 64               # of a row, by models that grow in the same passes
BOOST_ROWS = 40_000       # of a partition at least, where trees are boosted: a pass over fewer rows costs less than starting its tasks
HELD_OUT = "is_test"


@dataclass
class Trained:
    model: ScoringModel | TreeModel | boosting.Boosted | extratrees.ExtraForest
    metrics: dict[str, float]
    params: dict
    fold_metrics: DataFrame | None = None
    fold_scores: DataFrame | None = None      # (id, fold, label, score) of every training row, by a model of the other folds
    importances: DataFrame | None = None
    features: list[str] = field(default_factory=list)
    codes: preprocess.Fitted | None = None    # codes of categories, where the model itself does not hold them


def training_rows(transactions: DataFrame) -> DataFrame:
    """Normalised rows with all row-wise features."""
    return add_training_features(normalise(transactions))


def behaviour_rows(transactions: DataFrame, entity: Entity = Entity(), merchants: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    """Normalised rows with what the card did before, for the behaviour model."""
    rows = add_behaviour(normalise(transactions), entity)
    return add_merchant_risk(add_calendar_flags(rows, entity.time), merchants, null_as=0)


def rows_for(transactions: DataFrame, spec: Family, settings: dict | None = None) -> DataFrame:
    """The family's feature rows; ``high_risk_merchants`` in the settings replaces the known list."""
    if spec.name != "behaviour":
        return training_rows(transactions)
    return behaviour_rows(transactions, merchants=(settings or {}).get("high_risk_merchants", HIGH_RISK_MERCHANTS))


def spread(rows: DataFrame, row_id: str) -> DataFrame:
    """The rows over all cores, in an order that only their ids decide: a table in one small file would be trained on by one task."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, row_id).sortWithinPartitions(row_id)


def prepare(rows: DataFrame, spec: Family, settings: dict, order: HashOrder) -> DataFrame:
    """Id, features, label, hold-out flag and fold of every row.

    The narrow feature rows are written once with flag and fold; all later passes (folds, candidates) read that table and hash no id
    again. Noise and down-sampling touch training rows only; the hold-out keeps its prevalence.
    """
    kept = materialise(spread(rows.select(order.row_id, *spec.numeric, *spec.categorical, LABEL), order.row_id), "training")
    check_positives(kept, LABEL)
    if settings.get("test_size"):
        kept = mark_split(kept, settings["test_size"], LABEL, order, HELD_OUT)
    else:
        kept = kept.withColumn(HELD_OUT, F.lit(False))
    train, test = kept.filter(~F.col(HELD_OUT)), kept.filter(HELD_OUT)
    if settings.get("negative_ratio"):
        train = sampling.downsample_negatives(train, settings["negative_ratio"], LABEL, order)
    if settings.get("n_folds"):
        train = mark_folds(train, settings["n_folds"], LABEL, order)
    else:
        train = train.withColumn("fold", F.lit(0))
    both = materialise(train.unionByName(test.withColumn("fold", F.lit(-1))), "marked")
    train, test = both.filter(~F.col(HELD_OUT)), both.filter(HELD_OUT)
    if settings.get("sample_noise"):
        noisy = add_sample_noise(train, spec.numeric, settings["sample_noise"], order.row_id, order.seed)
        both = materialise(noisy.unionByName(test, allowMissingColumns=True), "noisy")
    return both


def _label_counts(train: DataFrame) -> dict[int, int]:
    return {r[LABEL]: r["count"] for r in train.groupBy(LABEL).count().collect()}


class FoldLessons:
    """What the rows outside each fold, and all rows, teach: label counts and preprocessing, worked out together at first use.

    The same for all candidates of a search, so one object serves them all.
    """

    def __init__(self, train: DataFrame, spec: Family, settings: dict, features: list[str] | None = None):
        self.train, self.spec, self.settings, self.features = train, spec, settings, features
        self.grown: foldtrees.Grown | None = None             # the trees of the last candidate
        self.asked: list[dict] = []                           # parameters of all candidates to come
        self._ready: dict[str, foldtrees.Grown] = {}
        self.perceptrons: perceptron.Perceptrons | None = None
        self.forest: TreeModel | None = None                  # of all rows
        self._blocks: foldtrees.Blocks | None = None

    @cached_property
    def labels(self) -> list[dict[int, int]]:
        k, counts = self.settings["n_folds"], self.train.groupBy("fold", LABEL).count().collect()
        return [{v: n for v in {r[LABEL] for r in counts} if (n := sum(r["count"] for r in counts if r["fold"] != m and r[LABEL] == v))}
                for m in range(k + 1)]

    @cached_property
    def fits(self) -> list[preprocess.Fitted]:
        numeric, categorical = _chosen(self.spec, self.features)
        categorical = [] if self.settings.get("ordered") else categorical
        return foldstats.fit_folds(self.train, numeric, categorical, "fold", self.settings["n_folds"], self.settings.get("scale", True))

    def blocks(self, order: HashOrder) -> foldtrees.Blocks:
        """The binned rows that trees of all folds and candidates are grown on; those of all rows too, unless they stop by other rows."""
        if self._blocks is None:
            models = self.settings["n_folds"] + (0 if self.settings.get("patience") else 1)
            self._blocks = fold_blocks(self.train, self.spec, self.settings, self.fits[:models], self.fits[-1], self.features, order)
        return self._blocks

    def grow(self, params: dict, order: HashOrder) -> foldtrees.Grown:
        """The trees of a candidate. Those to come that weigh rows alike are grown in the same passes, so many that a row has at most ``SCORES`` scores."""
        if _told(params) not in self._ready:
            blocks, spec, settings = self.blocks(order), self.spec, self.settings
            labels, together, models = self.labels[:len(blocks.lessons)], [params], {_told(params, "iterations")}
            weights = [_weights(spec, params, None, counts)[0] for counts in labels]
            for other in self.asked:
                more = models | {_told(other, "iterations")}
                if (_told(other) not in [*self._ready, *map(_told, together)] and len(more) * len(labels) <= SCORES and _grown_together(spec, other, settings, self.fits)
                        and _boosts(spec, other) and [_weights(spec, other, None, counts)[0] for counts in labels] == weights):
                    together, models = [*together, other], more
            self._ready |= dict(zip(map(_told, together), _grown(blocks, spec, together, settings, labels, settings["seed"])))
        return self._ready.pop(_told(params))


def _told(params: dict, *without: str) -> str:
    return repr(sorted((k, v) for k, v in params.items() if k not in IDLE and k not in without))


def _chosen(spec: Family, features: list[str] | None) -> tuple[list[str], list[str]]:
    return tuple([c for c in group if features is None or c in features] for group in (spec.numeric, spec.categorical))


def _weights(spec: Family, params: dict, train: DataFrame, counts: dict[int, int] | None = None) -> tuple[dict[int, float], float]:
    """(weight by label, sum of weights)."""
    counts = _label_counts(train) if counts is None else counts
    chosen = params.get("class_weight")
    if isinstance(chosen, dict):
        weights = {int(k): float(v) for k, v in chosen.items()}
    else:
        weights = class_weights(spec.weight, counts.get(0, 0), counts.get(1, 0), params.get("scale_pos_weight", 1.0))
    return weights, sum(weights.get(k, 1.0) * n for k, n in counts.items())


def side_by_side(train: DataFrame, spec: Family, params: dict, labels: list[dict[int, int]], folds: int, parallelism: int) -> tuple[int, int | None]:
    """Folds to fit at a time and partitions of each: the small folds of a boosting family fill the cores together, in few tasks each."""
    if not isinstance(spec.build(params, 0, {"weight_sum": 1.0, "width": 1}), GBTClassifier):
        return min(parallelism, folds), None
    cores, parts = train.sparkSession.sparkContext.defaultParallelism, max(1, *(sum(n.values()) // BOOST_ROWS for n in labels[:folds]))
    if parts >= cores:
        return min(parallelism, folds), None
    return min(folds, max(parallelism, 2 * cores // parts)), parts


def fit_model(train: DataFrame, spec: Family, params: dict, settings: dict, seed: int,
              features: list[str] | None = None, validation: DataFrame | None = None,
              fitted: preprocess.Fitted | None = None, labels: dict[int, int] | None = None,
              order: HashOrder | None = None, parts: int | None = None) -> ScoringModel:
    """Preprocessing fitted on ``train``, then the classifier on ``parts`` partitions at most; ``validation`` rows stop boosting early.

    ``fitted`` and ``labels`` are what ``train`` is already known to teach, see ``FoldLessons``. With the setting ``ordered`` a category
    is the label's mean: over the rows before it in ``order`` while training, over all of ``train`` afterwards.

    Boosting runs all its rounds, the losses on the validation rows tell the best one, and if that is not the last, the
    model is fitted again with so many rounds. Rounds are seeded one by one, so the trees are the same.
    """
    numeric, categorical = _chosen(spec, features)
    by_target = bool(settings.get("ordered") and categorical)
    fitted = fitted or preprocess.fit(train, numeric, [] if by_target else categorical, scale=settings.get("scale", True))
    weights, weight_sum = _weights(spec, params, train, labels)
    def ready(rows: DataFrame) -> DataFrame:
        return preprocess.transform(add_class_weight(rows, weights, LABEL, WEIGHT), fitted).select("features", LABEL, WEIGHT)

    if by_target:
        codes = materialise(ordered.target_statistics(train, categorical, LABEL, ordered.PRIOR), "statistics")
        fitted = replace(fitted, categorical=categorical, modes={}, labels={}, code_table=codes, unseen=ordered.PRIOR)
        order = order or HashOrder(ROW_ID, seed)
        coded = ordered.ordered_statistics(train.select(order.row_id, *numeric, *categorical, LABEL), categorical, LABEL, order, ordered.PRIOR)
        weighted = add_class_weight(materialise(coded, "ordered"), weights, LABEL, WEIGHT)
        known = preprocess.stages(fitted).transform(weighted).select("features", LABEL, WEIGHT)
    else:
        known = ready(train)
    info = {"weight_sum": weight_sum, "width": len(numeric) + len(categorical)}
    estimator = spec.build(params, seed, info)
    known = known.coalesce(parts) if parts else known
    classifier = estimator.fit(known)
    if validation is not None:
        rounds = best_round(classifier.evaluateEachIteration(ready(validation)), settings["patience"])
        if rounds < classifier.getNumTrees:
            classifier = estimator.copy({estimator.maxIter: rounds}).fit(known)
    return ScoringModel.of(fitted, classifier)


def _grown_together(spec: Family, params: dict, settings: dict, fits: Sequence[preprocess.Fitted]) -> bool:
    """Whether the models are trees that ``foldtrees`` grows: of few levels, on codes that a task can hold, over rows that are the same for all of them."""
    if settings.get("fold_noise") or (any(f.joined for f in fits) and not settings.get("ordered")):
        return False
    if isinstance(spec.build(params, 0, {"weight_sum": 1.0, "width": 1}), DecisionTreeClassifier) and params["criterion"] != "gini":
        return False
    return _boosts(spec, params) is not None and bool(params["max_depth"]) and params["max_depth"] <= foldtrees.LEVELS


def _boosts(spec: Family, params: dict) -> bool | None:
    """True for boosted trees, False for a single one, None for neither."""
    kind = spec.build(params, 0, {"weight_sum": 1.0, "width": 1})
    return True if isinstance(kind, GBTClassifier) else False if isinstance(kind, DecisionTreeClassifier) else None


def fold_blocks(rows: DataFrame, spec: Family, settings: dict, fits: Sequence[preprocess.Fitted], whole: preprocess.Fitted,
                features: list[str] | None, order: HashOrder, bins: int = 64) -> foldtrees.Blocks:
    """Blocks of ``rows`` for models that leave out fold 0, 1, ... and have learnt ``fits``; ``whole`` knows the categories of all of them."""
    numeric, categorical = _chosen(spec, features)
    n, models = len(numeric), len(fits)
    medians = [[f.medians.get(c, np.nan) for c in numeric] for f in fits]
    if settings.get("ordered") and categorical:
        table = ordered.fold_statistics(rows.select(order.row_id, *numeric, *categorical, LABEL, "fold"), categorical, LABEL, order, "fold", models, ordered.PRIOR)
        columns = [*numeric, *(name for c in categorical for name in (*[f"{c}_code{m}" for m in range(models)], f"{c}_held"))]
        places = [[*range(n), *(n + j * (models + 1) + m for j in range(len(categorical)))] for m in range(models + 1)]
        lessons = [foldtrees.Lesson({}, places[m], places[-1], np.array(medians[m] + [np.nan] * len(categorical))) for m in range(models)]
        bounding = places[-2]
    else:
        places = preprocess.Fitted([], whole.categorical, modes=whole.modes, labels=whole.labels)
        table = with_codes(rows, places).withColumns(
            {f"{c}_code": F.when(F.col(c).isNotNull(), F.col(f"{c}_code")) for c in whole.categorical}) if whole.categorical else rows
        columns, bounding = [*numeric, *[f"{c}_code" for c in whole.categorical]], list(range(n + len(whole.categorical)))
        at = {c: {word: i for i, word in enumerate(words)} for c, words in whole.labels.items()}
        lessons = []
        for m, fitted in enumerate(fits):
            taught = {c: set(fitted.labels[c]) for c in whole.categorical}
            lessons.append(foldtrees.Lesson(
                {}, bounding, bounding, np.array(medians[m] + [float(at[c].get(fitted.modes[c], np.nan)) for c in whole.categorical]),
                {n + j: np.array([word in taught[c] for word in whole.labels[c]]) for j, c in enumerate(whole.categorical)}))
    table = materialise(table.select(order.row_id, LABEL, "fold", *columns), "coded")
    return foldtrees.written(table, order.row_id, columns, bounding, LABEL, "fold", lessons, bins)


def _grown(blocks: foldtrees.Blocks, spec: Family, candidates: Sequence[dict], settings: dict, labels: Sequence[dict[int, int]], seed: int) -> list[foldtrees.Grown]:
    """The trees of candidates that weigh rows alike."""
    lessons = [replace(lesson, weights=_weights(spec, candidates[0], None, counts)[0]) for lesson, counts in zip(blocks.lessons, labels)]
    boosted = _boosts(spec, candidates[0])
    given = {"iterations": "rounds"} | {k: k for k in ("learning_rate", "max_depth", "min_rows", "min_gain", "row_share", "column_share")}
    fixed = {} if boosted else {"l2": 0.0, "min_child_weight": 0.0}
    asked = [boosting.BoostingParams(**{name: params[k] for k, name in given.items() if k in params}, **fixed, patience=settings.get("patience"), seed=seed)
             for params in candidates]
    return foldtrees.grow_all(replace(blocks, lessons=lessons), asked, boosted, blocks.rows <= foldtrees.ALONE)


def grow_folds(lessons: FoldLessons, params: dict, order: HashOrder) -> tuple[DataFrame, DataFrame]:
    """``cross_validate`` of trees, all folds in the same passes."""
    settings, folds = lessons.settings, lessons.settings["n_folds"]
    lessons.grown = grown = lessons.grow(params, order)
    scores = grown.held_out(order.row_id).filter(F.col("fold") < folds)
    scores = materialise(scores.withColumn("label", F.col("label").cast(lessons.train.schema[LABEL].dataType)), "fold")
    long = metrics.to_long(metrics.evaluate(scores, by=["fold"], **_limit(settings)), ["fold"])
    if settings.get("patience"):
        rounds = [(m, "best_iteration", float(len(t))) for m, t in enumerate(grown.trees[:folds])]
        long = long.unionByName(scores.sparkSession.createDataFrame(rounds, "fold int, metric string, value double"))
    return materialise(long, "fold-metrics"), scores


def _perceptrons_together(spec: Family, params: dict, settings: dict, fits: Sequence[preprocess.Fitted]) -> bool:
    """Whether the models are perceptrons on codes that a task can hold, over scaled rows that are the same for all of them."""
    return (spec.name == "mlp" and settings.get("scale", True) and not any(settings.get(k) for k in ("fold_noise", "patience", "ordered"))
            and not any(f.joined for f in fits))


def train_perceptrons(rows: DataFrame, n: int, spec: Family, params: dict, fits: Sequence[preprocess.Fitted], order: HashOrder,
                      seed: int) -> tuple[DataFrame, perceptron.Perceptrons]:
    """The blocks of ``rows``, and the perceptrons that leave out fold 0, 1, ... and have learnt ``fits``."""
    whole = fits[-1]
    table, columns = coded_blocks(rows, whole, order)
    layers = [len(columns), *params["hidden_layers"], 2]
    return table, perceptron.train(table, n, [logistic.Encoder.of(f, whole.labels) for f in fits], layers, params["max_iter"], params["tol"], seed)


def _perceptron_model(rows: DataFrame, spec: Family, params: dict, fitted: preprocess.Fitted, theta: np.ndarray, seed: int) -> ScoringModel:
    """MLlib's model with the weights: its trainer, started there, takes no step."""
    estimator = spec.build(params, seed, {"width": len(fitted.numeric) + len(fitted.categorical)})
    estimator = estimator.copy({estimator.maxIter: 0, estimator.initialWeights: Vectors.dense(theta)})
    few = rows.filter(F.col(LABEL).isNotNull()).limit(2).withColumn(WEIGHT, F.lit(1.0))
    return ScoringModel.of(fitted, estimator.fit(preprocess.transform(few, fitted).select("features", LABEL)))


def perceptron_folds(lessons: FoldLessons, params: dict, order: HashOrder) -> tuple[DataFrame, DataFrame]:
    """``cross_validate`` of perceptrons, all folds in the same passes; that of all rows is kept by ``lessons``."""
    settings, folds = lessons.settings, lessons.settings["n_folds"]
    table, lessons.perceptrons = train_perceptrons(lessons.train, sum(lessons.labels[-1].values()), lessons.spec, params, lessons.fits, order, settings["seed"])
    scores = lessons.perceptrons.held_out(table, order.row_id, folds)
    scores = materialise(scores.withColumn("label", F.col("label").cast(lessons.train.schema[LABEL].dataType)), "fold")
    long = metrics.to_long(metrics.evaluate(scores, by=["fold"], **_limit(settings)), ["fold"])
    return materialise(long, "fold-metrics"), scores


def perceptron_model(train: DataFrame, spec: Family, params: dict, settings: dict, seed: int, order: HashOrder) -> ScoringModel | None:
    """``fit_model`` of a perceptron; none where the rows ask for MLlib's road."""
    if spec.name != "mlp":
        return None
    fitted = preprocess.fit(train, spec.numeric, spec.categorical, scale=settings.get("scale", True))
    if not _perceptrons_together(spec, params, settings, [fitted]):
        return None
    _, found = train_perceptrons(train.withColumn("fold", F.lit(-1)), sum(_label_counts(train).values()), spec, params, [fitted], order, seed)
    return _perceptron_model(train, spec, params, fitted, found.thetas[0], seed)


def _forested(spec: Family, params: dict, settings: dict, fits: Sequence[preprocess.Fitted]) -> bool:
    """Whether the models are forests that ``forests`` grows: on codes that a task can hold, with a known number of drawn features."""
    return (isinstance(spec.build(params, 0, {"weight_sum": 1.0, "width": 1}), RandomForestClassifier) and params["max_features"] in forests.SHARES
            and not settings.get("ordered") and not any(f.joined for f in fits))


def _forest(blocks: foldtrees.Blocks, m: int, fitted: preprocess.Fitted, spec: Family, params: dict, labels: dict[int, int], seed: int) -> TreeModel:
    kind = spec.build(params, seed, {"weight_sum": 1.0, "width": len(blocks.edges)})
    p = forests.ForestParams(kind.getNumTrees(), kind.getMaxDepth(), kind.getMinInstancesPerNode(), forests.SHARES[params["max_features"]](len(blocks.edges)),
                             kind.getBootstrap(), seed)
    lessons = [replace(lesson, weights=_weights(spec, params, None, labels)[0]) if n == m else lesson for n, lesson in enumerate(blocks.lessons)]
    trees, gains = forests.grow(replace(blocks, lessons=lessons), m, p)
    return TreeModel(fitted, blocks.edges, trees, False, gains.tolist())


def _forest_scores(blocks: foldtrees.Blocks, m: int, model: TreeModel, row_id: str, label: str) -> DataFrame:
    """(id, fold, label, score) of the rows that model ``m`` has left out; one forest at a time is sent to the tasks."""
    grown = foldtrees.Grown(blocks, [[]] * m + [model.trees], np.zeros(0), [], False)
    scores = grown.held_out(row_id).filter(F.col("fold") == m)
    return materialise(scores.withColumn("label", F.col("label").cast(label)), "fold")


def forest_folds(lessons: FoldLessons, params: dict, order: HashOrder, parallelism: int) -> list[DataFrame]:
    """The scores of each fold's rows by a forest of the others, all on the same blocks; that of all rows is kept by ``lessons``."""
    settings, spec, fits, labels = lessons.settings, lessons.spec, lessons.fits, lessons.labels
    folds, blocks, kind = settings["n_folds"], lessons.blocks(order), lessons.train.schema[LABEL].dataType

    def one(m: int):
        model = _forest(blocks, m, fits[m], spec, params, labels[m], settings["seed"] + (m + 1) % (folds + 1))
        if m == folds:
            lessons.forest = model
            return None
        return _forest_scores(blocks, m, model, order.row_id, kind)

    with ThreadPool(min(parallelism, len(blocks.lessons))) as pool:
        return pool.map(inheritable_thread_target(lessons.train.sparkSession)(one), range(len(blocks.lessons)), chunksize=1)[:folds]


def forest_fold(inside: DataFrame, outside: DataFrame, fold: int, spec: Family, params: dict, settings: dict, seed: int, features: list[str] | None,
                labels: dict[int, int], order: HashOrder) -> DataFrame | None:
    """The scores of ``outside`` by a forest of ``inside``, on blocks of their own; none where the rows ask for MLlib's road."""
    if not _forested(spec, params, settings, []):
        return None
    inside = materialise(inside, "inside")
    fitted = preprocess.fit(inside, *_chosen(spec, features), scale=settings.get("scale", True))
    if fitted.joined:
        return None
    rows = inside.withColumn("fold", F.lit(-1)).unionByName(outside.withColumn("fold", F.lit(0)))
    blocks = fold_blocks(rows, spec, settings, [fitted], fitted, features, order)
    model = _forest(blocks, 0, fitted, spec, params, labels, seed)
    return _forest_scores(blocks, 0, model, order.row_id, inside.schema[LABEL].dataType).withColumn("fold", F.lit(fold))


def _tree_model(grown: foldtrees.Grown, model: int, fitted: preprocess.Fitted) -> TreeModel:
    return TreeModel(fitted, grown.blocks.edges, grown.trees[model], grown.boosted, grown.gains[model].tolist())


def grow_model(train: DataFrame, spec: Family, params: dict, settings: dict, seed: int, features: list[str] | None = None,
               validation: DataFrame | None = None, order: HashOrder | None = None) -> TreeModel | None:
    """``fit_model`` of trees; none where the rows ask for MLlib's. ``validation`` rows are judged in the passes that grow the trees."""
    order = order or HashOrder(ROW_ID, seed)
    forest = _forested(spec, params, settings, [])
    if (_boosts(spec, params) is None and not forest) or order.row_id not in train.columns:       # draws are by id
        return None
    numeric, categorical = _chosen(spec, features)
    by_target = bool(settings.get("ordered") and categorical)
    train = materialise(train, "fit") if forest else train
    fitted = preprocess.fit(train, numeric, [] if by_target else categorical, scale=settings.get("scale", True))
    if forest and not fitted.joined:
        blocks = fold_blocks(train.withColumn("fold", F.lit(-1)), spec, settings, [fitted], fitted, features, order)
        return _forest(blocks, 0, fitted, spec, params, _label_counts(train), seed)
    if not _grown_together(spec, params, settings, [fitted]):
        return None
    rows = train.withColumn("fold", F.lit(-1))
    if validation is not None:
        rows = rows.unionByName(validation.withColumn("fold", F.lit(0)))
    blocks = fold_blocks(rows, spec, settings, [fitted], fitted, features, order)
    early = {"patience": settings["patience"]} if validation is not None else {}
    grown, = _grown(blocks, spec, [params], early, [_label_counts(train)], seed)
    if by_target:
        codes = materialise(ordered.target_statistics(train, categorical, LABEL, ordered.PRIOR), "statistics")
        fitted = replace(fitted, categorical=categorical, modes={}, labels={}, code_table=codes, unseen=ordered.PRIOR)
    return _tree_model(grown, 0, fitted)


def _classifier(model: ScoringModel):
    return model.pipeline.stages[-1]


def select_features(train: DataFrame, spec: Family, params: dict, settings: dict, seed: int,
                    order: HashOrder | None = None) -> tuple[list[str], DataFrame]:
    """Features kept by a quick boosting model, and the importance table."""
    quick = layered(params, {"iterations": 20, "max_depth": 3, "learning_rate": 0.1})
    model = grow_model(train, spec, quick, settings, seed, order=order) or fit_model(train, spec, quick, settings, seed, order=order)
    table = importance_table(train.sparkSession, model.features, model if isinstance(model, TreeModel) else _classifier(model))
    return pick_features(table, settings["importance_threshold"], settings["max_features"]), table


def cross_validate(train: DataFrame, spec: Family, params: dict, settings: dict, order: HashOrder,
                   features: list[str] | None = None, parallelism: int = 4,
                   lessons: FoldLessons | None = None) -> tuple[DataFrame, DataFrame]:
    """Long frame (fold, metric, value), and (id, fold, label, score): each fold scored by a model of the other folds.

    Preprocessing of all folds is fitted together, unless each fold's training part gets noise of its own. With the ``lessons`` of a whole job
    trees of all folds grow in the same passes; other classifiers' fits run side by side. The out-of-fold scores are written as one narrow table, from which all folds' metrics come in one grouped curve.
    """
    folds, seed, noisy = settings["n_folds"], settings["seed"], settings.get("fold_noise")
    if lessons and not noisy and _grown_together(spec, params, settings, lessons.fits):
        return grow_folds(lessons, params, order)
    if lessons and _perceptrons_together(spec, params, settings, lessons.fits):
        return perceptron_folds(lessons, params, order)
    together = bool(lessons) and not noisy and _forested(spec, params, settings, lessons.fits)
    lessons = lessons or FoldLessons(train, spec, settings, features)
    if _regressed_together(lessons):
        return regress_folds(lessons, [params], order)[0]
    known = [] if together else [{"labels": lessons.labels[m], "fitted": None if noisy else lessons.fits[m]} for m in range(folds)]

    at_a_time, parts = side_by_side(train, spec, params, lessons.labels, folds, parallelism)

    def one_fold(fold: int):
        inside, outside = train.filter(F.col("fold") != fold), train.filter(F.col("fold") == fold)
        if noisy:
            inside = add_fold_noise(inside, spec.numeric, noisy, order.row_id, seed + fold + 1)
        early = settings.get("patience")
        if order.row_id in train.columns:
            found = forest_fold(inside, outside, fold, spec, params, settings, seed + fold + 1, features, lessons.labels[fold], order)
            if found is not None:
                return found, None
        model = fit_model(inside, spec, params, settings, seed + fold + 1, features, outside if early else None, order=order, parts=parts, **known[fold])
        scored = model.probability(outside, "score").select(
            order.row_id, "fold", F.col(LABEL).alias("label"), "score")
        return materialise(scored, "fold"), getattr(_classifier(model), "getNumTrees", None)

    if together:
        done = [(scored, None) for scored in forest_folds(lessons, params, order, parallelism)]
    else:
        with ThreadPool(at_a_time) as pool:
            done = pool.map(inheritable_thread_target(train.sparkSession)(one_fold), range(folds))
    scores = done[0][0]
    for other, _ in done[1:]:
        scores = scores.unionByName(other)
    long = metrics.to_long(metrics.evaluate(scores, by=["fold"], **_limit(settings)), ["fold"])
    if settings.get("patience"):
        rounds = [(fold, "best_iteration", float(trees)) for fold, (_, trees) in enumerate(done)]
        long = long.unionByName(train.sparkSession.createDataFrame(rounds, "fold int, metric string, value double"))
    return materialise(long, "fold-metrics"), scores


def _limit(settings: dict) -> dict:
    return {"target": settings["recall_target"]} if settings.get("recall_target") else {"threshold": settings.get("threshold", 0.5)}


def _regressed_together(lessons: FoldLessons) -> bool:
    """Whether the folds are logistic regressions on codes that a task can hold, over rows that are the same for all of them."""
    settings = lessons.settings
    return (lessons.spec.name == "logistic" and settings.get("scale", True) and not any(settings.get(k) for k in ("fold_noise", "patience", "ordered"))
            and not any(fitted.joined for fitted in lessons.fits))


def coded_blocks(rows: DataFrame, whole: preprocess.Fitted, order: HashOrder) -> tuple[DataFrame, list[str]]:
    """Blocks of plain numbers and category places of ``whole``, -1 for missing ones, and their columns."""
    places = preprocess.Fitted([], whole.categorical, modes=whole.modes, labels=whole.labels)
    coded = [f"{c}_code" for c in whole.categorical]
    rows = with_codes(rows, places).withColumns(
        {f"{c}_code": F.when(F.col(c).isNull(), -1.0).otherwise(F.col(f"{c}_code")) for c in whole.categorical})
    columns = [*whole.numeric, *coded]
    return logistic.blocks(rows, order.row_id, columns, LABEL, "fold"), columns


def regress_folds(lessons: FoldLessons, candidates: Sequence[dict], order: HashOrder) -> list[tuple[DataFrame, DataFrame]]:
    """``cross_validate`` of logistic regression for each of ``candidates``, all folds of all of them in the same passes."""
    spec, settings, fits = lessons.spec, lessons.settings, lessons.fits
    folds, whole = settings["n_folds"], fits[-1]
    table, columns = coded_blocks(lessons.train, whole, order)
    asked = []
    for params in candidates:
        for fold in range(folds):
            weights, weight_sum = _weights(spec, params, lessons.train, lessons.labels[fold])
            model = spec.build(params, settings["seed"], {"weight_sum": weight_sum, "width": len(columns)})
            asked.append(logistic.Regression(fold, weights, model.getRegParam(), model.getElasticNetParam(), model.getMaxIter()))
    found = logistic.regress(table, columns, [logistic.Encoder.of(f, whole.labels) for f in fits[:folds]], asked)
    groups = [range(n * folds, (n + 1) * folds) for n in range(len(candidates))]
    scores = materialise(found.held_out(table, order.row_id, groups), "fold").withColumn("label", F.col("label").cast(lessons.train.schema[LABEL].dataType))
    long = materialise(metrics.to_long(metrics.evaluate(scores, by=["group", "fold"], **_limit(settings)), ["group", "fold"]), "fold-metrics")
    return [tuple(df.filter(F.col("group") == n).drop("group") for df in (long, scores)) for n in range(len(candidates))]


def _cv_means(fold_metrics: DataFrame) -> dict[str, float]:
    out = {}
    for r in metrics.cv_summary(fold_metrics).collect():
        out[f"cv_{r['metric']}_mean"], out[f"cv_{r['metric']}_std"] = r["mean"], r["std"]
    return out


def train(transactions: DataFrame, name: str, params: dict | None = None, settings: dict | None = None,
          order: HashOrder | None = None, parallelism: int = 4) -> Trained:
    """The whole job of one trainer.

    The decision threshold is the mean of the folds' thresholds when a recall target is set, the best F1 on
    the training rows for the behaviour model, else the fixed one.
    """
    spec = family(name)
    params, settings = layered(spec.params, params), layered(spec.settings, settings)
    order = order or HashOrder(ROW_ID, settings["seed"])
    table = prepare(rows_for(transactions, spec, settings), spec, settings, order)
    in_train, in_test = table.filter(~F.col(HELD_OUT)), table.filter(HELD_OUT)
    seed = settings["seed"]

    features = importances = None
    if settings.get("select_features"):
        features, importances = select_features(in_train, spec, params, settings, seed, order)

    found, fold_metrics, fold_scores, threshold = {}, None, None, settings.get("threshold", 0.5)
    known = {}
    if settings.get("n_folds"):
        lessons = FoldLessons(in_train, spec, settings, features)
        fold_metrics, fold_scores = cross_validate(in_train, spec, params, settings, order, features, parallelism, lessons)
        if not settings.get("patience") and not settings.get("fold_noise"):
            known = {"fitted": lessons.fits[-1], "labels": lessons.labels[-1]}       # the last fit is of the same rows
        found = _cv_means(fold_metrics)
        threshold = found.get("cv_decision_threshold_mean", threshold)

    fit_rows, validation = in_train, None
    if settings.get("patience"):
        fit_rows, validation = sampling.stratified_split(
            in_train, settings["validation_size"], LABEL, HashOrder(order.row_id, seed + 1, order.method))
    if settings.get("fold_noise"):
        fit_rows = add_fold_noise(fit_rows, spec.numeric, settings["fold_noise"], order.row_id, seed)
    model = None
    if known and lessons.grown and not settings.get("ordered"):
        model = _tree_model(lessons.grown, settings["n_folds"], lessons.fits[-1])
    if known and lessons.forest:
        model = lessons.forest
    if known and lessons.perceptrons:
        model = _perceptron_model(in_train, spec, params, lessons.fits[-1], lessons.perceptrons.thetas[-1], seed)
    model = (model or perceptron_model(fit_rows, spec, params, settings, seed, order) or grow_model(fit_rows, spec, params, settings, seed, features, validation, order)
             or fit_model(fit_rows, spec, params, settings, seed, features, validation, order=order, **known))
    if settings.get("threshold_from_train"):
        fitted = materialise(model.probability(fit_rows, "score").select(F.col(LABEL).alias("label"), "score"), "train")
        threshold = metrics.threshold_at_best_f1(fitted).first()["decision_threshold"]
    model.threshold = threshold

    if settings.get("test_size"):
        scores = model.probability(in_test, "score").select(F.col(LABEL).alias("label"), "score")
        row = metrics.evaluate(materialise(scores, "test"), threshold=threshold).first().asDict()
        found |= {f"test_{k}": v for k, v in row.items() if k != "decision_threshold"}
    found["decision_threshold"] = threshold
    return Trained(model, found, params, fold_metrics, fold_scores, importances, model.features)


def metric_frame(trained: Trained) -> DataFrame:
    rows = [(k, float(v)) for k, v in sorted(trained.metrics.items()) if v is not None]
    return SparkSession.active().createDataFrame(rows, "metric string, value double")


def with_codes(rows: DataFrame, codes: preprocess.Fitted) -> DataFrame:
    """``rows`` with a column ``<name>_code`` for each category."""
    values = vector_to_array("features")
    return preprocess.transform(rows, codes).withColumns(
        {f"{c}_code": values[n] for n, c in enumerate(codes.categorical)}).drop("features")


def _side_by_side(transactions: DataFrame, name: str, params: dict | None, settings: dict | None, order: HashOrder | None, fit) -> Trained:
    """A family whose models of all folds and of all training rows come from ``fit(rows, features, params, settings, order)`` at once.

    Missing numbers are not imputed; categories are codes in order, fitted on all training rows.
    """
    spec = family(name)
    params, settings = layered(spec.params, params), layered(spec.settings, settings)
    order = order or HashOrder(ROW_ID, settings["seed"])
    table = prepare(rows_for(transactions, spec, settings), spec, settings, order)
    in_train, in_test = table.filter(~F.col(HELD_OUT)), table.filter(HELD_OUT)
    codes = preprocess.fit(in_train, [], spec.categorical, scale=False)
    weights, _ = _weights(spec, params, in_train)
    coded = [f"{c}_code" for c in spec.categorical]

    def ready(rows: DataFrame) -> DataFrame:
        return with_codes(add_class_weight(rows, weights, LABEL, WEIGHT), codes)

    rows = materialise(ready(in_train).select(order.row_id, *spec.numeric, *coded, LABEL, WEIGHT, "fold"), "rows")
    model = fit(rows, [*spec.numeric, *coded], params, settings, order)
    scores = materialise(model.score(rows, fold="fold").select(order.row_id, "fold", F.col(LABEL).alias("label"), "score"), "fold")
    long = metrics.to_long(metrics.evaluate(scores, by=["fold"], **_limit(settings)), ["fold"])
    if settings.get("patience"):
        rounds = [(n, "best_iteration", float(len(t))) for n, t in enumerate(model.trees[:-1])]
        long = long.unionByName(rows.sparkSession.createDataFrame(rounds, "fold int, metric string, value double"))
    long = materialise(long, "fold-metrics")
    found = _cv_means(long)
    threshold = found.get("cv_decision_threshold_mean", settings.get("threshold", 0.5))
    if settings.get("test_size"):
        tested = model.score(ready(in_test)).select(F.col(LABEL).alias("label"), "score")
        row = metrics.evaluate(materialise(tested, "test"), threshold=threshold).first().asDict()
        found |= {f"test_{k}": v for k, v in row.items() if k != "decision_threshold"}
    found["decision_threshold"] = threshold
    return Trained(model, found, params, long, scores, None, model.features, codes)


def boosted_folds(transactions: DataFrame, name: str = "xgboost", params: dict | None = None, settings: dict | None = None,
                  order: HashOrder | None = None) -> Trained:
    """A boosting family by the second-order booster: the models of all folds and of all training rows in the passes of one.

    Missing numbers have a bin of their own. Early stopping looks at each fold's held-out loss, the model of all rows takes the folds' mean
    number of rounds. ``reg_alpha``, ``reg_lambda`` and ``max_delta_step`` count.
    """
    fixed = {"iterations": "rounds", "reg_alpha": "l1", "reg_lambda": "l2", "min_rows": "min_rows", "max_bins": "bins"}

    def fit(rows, features, params, settings, order):
        chosen = {fixed.get(k, k): v for k, v in params.items() if fixed.get(k, k) in boosting.BoostingParams.__dataclass_fields__}
        return boosting.boost(rows, features, LABEL, boosting.BoostingParams(
            **chosen, patience=settings.get("patience"), seed=settings["seed"]), order.row_id, WEIGHT, "fold", settings["n_folds"])

    return _side_by_side(transactions, name, params, settings, order, fit)


def random_threshold_folds(transactions: DataFrame, name: str = "extra_tree", params: dict | None = None, settings: dict | None = None,
                           order: HashOrder | None = None) -> Trained:
    """Extremely randomised trees with drawn thresholds: the forests of all folds and of all training rows, level by level together."""
    def fit(rows, features, params, settings, order):
        p = extratrees.ExtraParams(params["trees"], params["max_depth"], params["min_rows"], seed=settings["seed"])
        return extratrees.grow(rows, features, LABEL, p, WEIGHT, "fold", settings["n_folds"])

    return _side_by_side(transactions, name, params, settings, order, fit)
