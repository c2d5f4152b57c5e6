"""Every registered query with a SQL equivalent, value by value, on the smallest tables."""

import pytest
from compare import connect, difference, type_difference

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


# Trainings at their real settings take a minute or two each; tests/compare.py compares them all, one is compared here.
QUICK = [n for n in oracle_sql() if not n.endswith(("_training", "_search")) or n == "decision_tree_training"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    sql = oracle_sql()[name]
    df = queries()[name](spark, SF)
    assert difference(df.toPandas(), duck.execute(sql).df()) is None
    assert type_difference(df.dtypes, duck, sql) is None


def test_entry(spark):
    assert entry(spark).columns == ["category", "transactions", "fraud_cases", "fraud_rate"] and entry(spark).count() > 0


def test_every_query_names_what_it_covers():
    from ledgerlark.plans.registry import REGISTRY
    assert all(q.covers for q in REGISTRY.values()) and set(oracle_sql()) <= set(queries())


def test_fold_noise_handles_every_row_of_the_table(spark):
    rows = queries()["fold_noise_parts"](spark, SF)
    ids = queries()["stratified_folds"](spark, SF)
    counted = rows.groupBy("record_id").count()
    assert counted.count() == ids.count() and {r["count"] for r in counted.select("count").distinct().collect()} == {2}


def test_every_family_is_trained_and_logistic_searched_at_its_own_settings(monkeypatch):
    from ledgerlark.operators.models import FAMILIES
    from ledgerlark.plans import registry
    used = []
    for name in ("_facts", "_searched"):
        monkeypatch.setattr(registry, name, lambda *args, kind=name, **settings: used.append((kind, args[2], settings)))
    for name in registry.REGISTRY:
        if name.endswith(("_training", "_search")):
            queries()[name](None, SF)
    assert {family for kind, family, settings in used if kind == "_facts" and not settings} == set(FAMILIES)
    assert ("_searched", "logistic", {}) in used
    for family in ("catboost", "lightgbm", "tabnet", "extra_tree", "random_forest", "mlp"):
        assert FAMILIES[family].settings["n_folds"] == 10
        assert "'folds', 10" in oracle_sql()[f"{family}_folds_training"]


def test_boosting_search_judges_ten_candidates_and_each_model_once(spark, monkeypatch):
    from ledgerlark.plans import registry, search
    judged = []

    def cross_validate(train, spec, params, settings, *rest):
        judged.append((params, settings["n_folds"], settings["patience"]))
        return spark.createDataFrame([(f, "avg_precision", len(judged) / 10 + f / 1000) for f in range(3)], "fold int, metric string, value double"), None

    monkeypatch.setattr(search, "cross_validate", cross_validate)
    monkeypatch.setattr(search, "rows_for", lambda rows, *rest: rows)
    monkeypatch.setattr(search, "prepare", lambda rows, *rest: spark.range(1).selectExpr("id", f"false AS {search.HELD_OUT}"))
    monkeypatch.setattr(registry, "txn", lambda *rest: None)
    rows = sorted(map(tuple, queries()["boosting_folds_search"](spark, SF).collect()))
    assert [r[0] for r in rows] == list(range(1, 11)) and all(r[2] and r[3] for r in rows)
    assert len(judged) == len({tuple(p[k] for k in p if k != "max_delta_step") for p, *_ in judged}) == 5
    assert {(folds, patience) for _, folds, patience in judged} == {(10, 25)}


@pytest.mark.parametrize("name, family, candidates", [("boosting_search", "xgboost", 10), ("logistic_search", "logistic", 6)])
def test_searches_judge_all_candidates_at_the_family_s_own_settings(monkeypatch, name, family, candidates):
    from ledgerlark.plans import registry
    used = []
    monkeypatch.setattr(registry, "_searched", lambda spark, sf_dir, *args, **settings: used.append((args, settings)))
    queries()[name](None, SF)
    (args, settings), = used
    assert args[0] == family and len(args[1]) == candidates and not settings
    assert oracle_sql()[name].count("AS candidate") == candidates
