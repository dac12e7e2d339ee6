"""The tree queries ask for the operators' own settings; the fits themselves are made small here."""

from pathlib import Path

import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from hearthrate.operators import models
from hearthrate.session import shared_dir
from suite import explaining, modelling


@pytest.fixture
def asked(monkeypatch):
    """The settings of every tree model that is fitted."""
    seen = []
    for kind, few in ((GBTRegressor, {"maxIter": 2, "maxDepth": 2}), (RandomForestRegressor, {"numTrees": 2, "maxDepth": 2})):
        def fit(self, rows, whole=kind.fit, few=few):
            seen.append({p.name: v for p, v in self.extractParamMap().items()})
            return whole(self.copy({self.getParam(k): v for k, v in few.items()}), rows)

        monkeypatch.setattr(kind, "fit", fit)
    return seen


def holds(settings, wanted):
    return {k: settings[k] for k in wanted} == wanted


def test_forest_and_boosted(spark, sf_dir, asked):
    assert modelling.forest(spark, sf_dir).count() == modelling.boosted(spark, sf_dir).count() == 1
    assert len(asked) == 2 and holds(asked[0], models.FOREST) and holds(asked[1], models.BOOSTED)


def test_model_comparison(spark, sf_dir, asked):
    table = modelling.model_comparison(spark, sf_dir).collect()
    assert {r[0] for r in table} == {"linear", "ridge", "forest", "boosted"}
    assert len(asked) == 2 and holds(asked[0], models.FOREST) and holds(asked[1], models.BOOSTED)


def test_search(spark, sf_dir):
    log = modelling.search(spark, sf_dir).orderBy("trial").collect()
    assert [r.alpha for r in log] == [round(a, 6) for a in models.penalties()] and models.TRIALS == len(log) == 30
    assert log[-1].best_so_far == min(r.mae for r in log) and len({r.test_mae for r in log}) == 1


def test_tree_attribution_is_saved(spark, sf_dir, asked):
    before = set(Path(shared_dir(spark)).glob("hearthrate-attributions-*"))
    row, = explaining.tree_attribution(spark, sf_dir).collect()
    assert row.n == row.additive and row.saved == 4 * row.n and row.features == "|".join(sorted(modelling.FEATURES))
    saved, = set(Path(shared_dir(spark)).glob("hearthrate-attributions-*")) - before
    assert spark.read.parquet(str(saved)).count() == 4 * modelling.line_table(spark, sf_dir).count()
    assert len(asked) == 1 and holds(asked[0], models.BOOSTED)


def test_importance_stability(spark, sf_dir, asked):
    assert explaining.importance_stability(spark, sf_dir).count() == 4
    assert [a["seed"] for a in asked] == list(explaining.A.STABILITY_SEEDS) and all(holds(a, models.BOOSTED) for a in asked)
