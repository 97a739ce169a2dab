import numpy as np
import pytest

from cinderspark.errors import DataContractError, EmptyInputError, MissingInputError
from cinderspark.operators import areas, mlp
from cinderspark.sources import sinks


def test_models_are_stored_and_read(spark, tmp_path):
    rng = np.random.default_rng(0)
    net = mlp.Network(mlp.initial_layers(3, rng), [0.0] * 3, [1.0, 0.0, 2.0], [0, 1, 2])
    sinks.write_model(spark, net, f"{tmp_path}/m", mlp.hyperparameters(net, "landcover", 3))
    back = sinks.read_model(spark, f"{tmp_path}/m")
    x = rng.normal(size=(5, 3))
    assert np.allclose(net.run(x), back.run(x)) and back.std[1] == 1.0
    with pytest.raises(MissingInputError):
        sinks.read_model(spark, f"{tmp_path}/none")
    (tmp_path / "old.json").write_text("{}")
    with pytest.raises(EmptyInputError):
        sinks.read_model(spark, f"{tmp_path}/old.json")


def test_scars_of_one_name(spark, tmp_path):
    scars = spark.createDataFrame([(1, "a", 2.5, 2017), (2, "a", 2.4, 2017), (3, None, 1.0, 2018)], "id long, fire_id string, area_ha double, year int")
    got = {r["out_name"]: r["id"] for r in sinks.by_scar(scars).collect()}
    assert got == {"a_2ha_2017": 2, "None_1ha_2018": 3}
    with pytest.raises(DataContractError):
        sinks.by_scar(scars, keep_last=False)
    sinks.write_by_scar(scars, f"{tmp_path}/scars")
    assert spark.read.parquet(f"{tmp_path}/scars").count() == 2


def test_lists_and_thresholds(spark, tmp_path):
    sinks.write_paths(spark.createDataFrame([("b",), ("a",)], "path string"), f"{tmp_path}/p")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/p").orderBy("value").collect()] == ["a", "b"]
    (tmp_path / "s.json").write_text('{"threshold_recommendations": {"rule_elbow_threshold_ha": 7.5}}')
    assert areas.read_threshold(spark, f"{tmp_path}/s.json", "elbow") == 7.5
    with pytest.raises(MissingInputError):
        areas.read_threshold(spark, f"{tmp_path}/none.json")
