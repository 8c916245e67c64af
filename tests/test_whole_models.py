"""Queries fit models as these declare themselves, on all rows and features."""

import pytest

from covaria.models import ensembles
from covaria.models.registry import REGRESSORS
from covaria.plans import fit_queries
from covaria.plans.views import FEATURES


class Seen(Exception):
    pass


def _fit_of(monkeypatch, kind, spark, sf, run):
    seen = []

    def fit(self, df, features, *rest):
        seen.append((self, list(features)))
        raise Seen

    monkeypatch.setattr(kind, "fit", fit)
    with pytest.raises(Seen):
        run(spark, sf)
    return seen[0]


def test_bootstrapped_members_have_their_declared_number_and_rounds(spark, sf, monkeypatch):
    """F11"""
    model, features = _fit_of(monkeypatch, ensembles.BootstrappedRegressor, spark, sf, fit_queries.bootstrapped_gbt)
    member = model.member(0).build()
    assert (model.n_models, member.getMaxIter(), member.getMaxDepth()) == (10, 500, 13) and features == FEATURES


def test_every_kind_of_model_is_judged():
    """F12"""
    assert set(fit_queries._QUALITY) == set(REGRESSORS)


def test_quantile_interval_has_its_declared_rounds(spark, sf, monkeypatch):
    """F13"""
    model, features = _fit_of(monkeypatch, ensembles.QuantileIntervalRegressor, spark, sf, fit_queries.quantile_interval)
    assert model.mean_param["num_boost_round"] == 100 and features == FEATURES


def test_the_vote_has_its_members_whole(spark, sf, monkeypatch):
    """F14"""
    model, features = _fit_of(monkeypatch, ensembles.SuperLearner, spark, sf, fit_queries.super_learner)
    built = [m.build() for m in model.members if hasattr(m, "build")]
    assert features == FEATURES and len(model.members) == 10
    assert [b.getMaxIter() for b in built if b.hasParam("maxIter")] == [100, 100, 100, 20]
    assert [b.getNumTrees() for b in built if b.hasParam("numTrees")] == [10, 100, 100]
