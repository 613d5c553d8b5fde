"""Training-data queries whose workers cannot import the package."""

from tests.test_shipping import run_elsewhere

from .conftest import SF


def test_models_travel(tmp_path):
    run_elsewhere(["op4_quality_model", "op10_simhash"], tmp_path, SF)
