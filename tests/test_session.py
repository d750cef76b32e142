import os
import subprocess
import sys

from pyspark import cloudpickle

from seriesworks.session import application_folder, cut_lineage


def test_cut_lineage_writes_to_the_applications_folder(spark):
    folder = application_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and spark.sparkContext.applicationId in folder
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = spark.range(5).selectExpr("id", "named_struct('a', id, 'b', cast(null as string)) AS s")
    cut = cut_lineage(df)
    assert len(set(os.listdir(folder)) - before) == 1
    assert cut.schema.simpleString() == df.schema.simpleString() and cut.count() == 5
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_worker_code_travels_with_the_job():
    assert "seriesworks" in cloudpickle.list_registry_pickle_by_value()


def test_the_folder_is_gone_when_the_application_has_ended(tmp_path):
    code = (
        "from seriesworks.session import cut_lineage, local_session\n"
        f"spark = local_session(1, **{{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "assert cut_lineage(spark.range(3)).count() == 3\n"
        "spark.stop()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120, capture_output=True)
    assert not [x for x in os.listdir(tmp_path) if x.startswith("seriesworks")]  # the other folder is Spark's own
