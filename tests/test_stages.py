import json
import subprocess
import sys

import pytest
from conftest import days
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from seriesworks.operators.stages import BoostedTreesRegressor, FeatureBuilder

QUICK = {"num_boost_round": 5, "learning_rate": 0.3, "min_data_in_leaf": 5, "early_stopping_rounds": 3, "num_leaves": 4}
LOAD = """
import json, sys
from pyspark.ml import PipelineModel
from seriesworks.session import local_session
spark = local_session(2, "load")
rows = PipelineModel.load(sys.argv[1]).transform(spark.read.parquet(sys.argv[2])).orderBy("hospital_id", "date").collect()
print(json.dumps([r["predicted"] for r in rows]))
"""


@pytest.fixture(scope="module")
def panel(make_panel):
    series = {("d", h): [float((i * k) % 7 + 10 * (i % 30 == 0)) for i in range(220)] for k, h in enumerate("ab", 2)}
    return make_panel({k: days("2020-01-01", v) for k, v in series.items()})


def test_pipeline_predicts_the_same_in_a_new_session(spark, panel, tmp_path):
    pipeline = Pipeline(stages=[FeatureBuilder(testSize=0.2), BoostedTreesRegressor(boosting=QUICK, categoricalCols=["hospital_id"])])
    pipeline.write().overwrite().save(f"{tmp_path}/unfitted")
    fitted = Pipeline.load(f"{tmp_path}/unfitted").fit(panel)
    assert fitted.stages[1].trees.trees and fitted.stages[1].getOrDefault("boosting") == QUICK
    fitted.write().save(f"{tmp_path}/fitted")
    panel.write.parquet(f"{tmp_path}/panel")
    mine = [r["predicted"] for r in fitted.transform(panel).orderBy("hospital_id", "date").collect()]
    again = PipelineModel.load(f"{tmp_path}/fitted")
    assert again.stages[1].getOrDefault("categoricalCols") == ["hospital_id"] and again.stages[1].uid == fitted.stages[1].uid
    command = [sys.executable, "-c", LOAD, f"{tmp_path}/fitted", f"{tmp_path}/panel"]
    done = subprocess.run(command, capture_output=True, text=True, check=True, timeout=300)
    assert json.loads(done.stdout.splitlines()[-1]) == pytest.approx(mine)
    assert len(set(mine)) > 1


def test_features_without_a_split(spark, panel):
    assert "split" not in FeatureBuilder(testSize=0.0).transform(panel).columns
    assert FeatureBuilder().transform(panel).where(F.col("split") == "test").count() > 0


def test_an_unfitted_estimator_keeps_its_settings(tmp_path):
    made = BoostedTreesRegressor(featureCols=["a"], maxBins=16, boosting={"num_leaves": 3})
    made.write().save(f"{tmp_path}/estimator")
    found = BoostedTreesRegressor.load(f"{tmp_path}/estimator")
    assert (found.getOrDefault("featureCols"), found.getOrDefault("maxBins")) == (["a"], 16)
    assert found.getOrDefault("boosting") == {"num_leaves": 3}
