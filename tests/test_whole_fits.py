"""Registered fits use the operators' full forests."""

import pytest

from stationlab.operators import regress
from stationlab.queries import QUERIES, modelling

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, module, forest", [("fit_stages", modelling, "RandomForestClassifier"), ("evaluation_report", regress, "RandomForestRegressor")])
def test_full_forest(spark, monkeypatch, name, module, forest):
    plain, made = getattr(module, forest), []

    def noted(**options):
        made.append(plain(**options))
        return made[-1]

    monkeypatch.setattr(module, forest, noted)
    QUERIES[name](spark, SF)
    assert [(m.getNumTrees(), m.getMaxDepth()) for m in made] == [(20, 5)]
