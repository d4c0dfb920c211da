"""Several models over the same people: one feature table, one preparation, the results of single fits."""

from types import SimpleNamespace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderloom.operators import ml
from orderloom.plans import queries
from orderloom.plans.shop import Shop
from orderloom.session import handed_over

from conftest import values

SIZES = {ml.LOGISTIC: {"maxIter": 15}, ml.FOREST: {"numTrees": 4, "maxDepth": 3},
         ml.BOOSTED: {"maxIter": 3, "maxDepth": 3}}


@pytest.fixture
def counted(monkeypatch):
    """Small models; how often features are stored and numbers imputed."""
    calls = {"features": 0, "impute": 0}

    def watch(module, name, key):
        whole = getattr(module, name)

        def counting(*args):
            calls[key] += 1
            return whole(*args)

        monkeypatch.setattr(module, name, counting)

    whole = ml.classifier
    monkeypatch.setattr(ml, "classifier", lambda m, **k: whole(m, **{**SIZES[m], **k}))
    watch(queries, "_features", "features")
    watch(ml, "impute", "impute")
    return calls


@pytest.fixture
def shop(spark, tmp_path):
    """People of this test alone, so that no stored fit of another one is found."""
    people = Shop.over_fixtures(spark, "/root/testdata/sf0.001").churn_features.selectExpr(
        "* except (customer_unique_id)", f"concat('{tmp_path.name}', customer_unique_id) AS customer_unique_id")
    return SimpleNamespace(churn_features=people, src=SimpleNamespace(spark=spark))


def test_model_nodes_prepares_once(counted, shop):
    faults = queries.REGISTRY["model_nodes"](shop).collect()
    assert counted == {"features": 1, "impute": 1}
    assert {(r.model, r.trees) for r in faults} == {(ml.FOREST, 4), (ml.BOOSTED, 3)}
    assert all(r.orphans == r.shared == r.missing == r.mute == 0 for r in faults)


def test_importances_prepare_once_and_equal_single_fits(counted, shop):
    got = sorted(values(queries.REGISTRY["importance_values"](shop)))
    assert counted == {"features": 1, "impute": 1}
    features, expected = handed_over(shop.churn_features), []
    for model in ml.MODELS:  # each prepared and fitted as if it were the only one
        rows = ml.with_split(ml.impute(features))
        train = rows.where("is_train")
        prepared = ml.feature_pipeline(train).fit(train)
        dealt = ml._dealt(ml._weighted(prepared.transform(rows).where("is_train"), model))
        found = ml.importance(ml.classifier(model).fit(dealt), ml.feature_names(prepared))
        expected += [(name, value, model) for name, value in values(found)]
    assert [(n, m) for n, _, m in got] == [(n, m) for n, _, m in sorted(expected)]
    assert [v for _, v, _ in got] == pytest.approx([v for _, v, _ in sorted(expected)], abs=1e-9)


def test_a_preparation_belongs_to_its_rows(spark, shop):
    features = handed_over(shop.churn_features)
    names = lambda found: ml.feature_names(found[0], ml._numeric(False))
    vectors = lambda found: sorted(values(found[1].select(
        "customer_unique_id", "is_train", vector_to_array(ml.FEATURES))))
    first, again = ml.prepare(features), ml.prepare(features.repartition(3))
    assert names(first) == names(again) and vectors(first) == vectors(again)
    assert again[1].inputFiles() == first[1].inputFiles()
    less = ml.prepare(features.where(F.col("customer_unique_id") != features.first().customer_unique_id))
    assert less[1].inputFiles() != first[1].inputFiles()
    assert ml.prepare(features, True)[1].first().features.size < first[1].first().features.size
