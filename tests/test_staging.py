"""Where intermediates go."""

import pytest

from tenure.errors import DataQualityError
from tenure.operators.staging import SHARED_FOLDER, staged, staging_folder


class Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, folder=None):
        self.settings = {"spark.sql.warehouse.dir": "file:/warehouse"} | ({SHARED_FOLDER: folder} if folder else {})
        self.conf = self.sparkContext = self
        self.master, self.checkpoints = master, None

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getCheckpointDir(self):
        return self.checkpoints


def test_the_named_folder_is_used():
    assert staging_folder(Session("yarn", "hdfs://shared/tmp")) == "hdfs://shared/tmp"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(DataQualityError, match=SHARED_FOLDER):
        staging_folder(Session("yarn"))


def test_a_local_session_stages_below_its_warehouse():
    assert staging_folder(Session("local[2]")) == "file:/warehouse/staging"


def test_executors_of_their_own_need_a_named_folder_on_one_machine_too():
    with pytest.raises(DataQualityError, match=SHARED_FOLDER):
        staging_folder(Session("local-cluster[2,1,1024]"))


def test_staged_rows_come_from_files(spark):
    df = staged(spark.range(5).toDF("n"), "numbers")
    assert sorted(r["n"] for r in df.collect()) == list(range(5))
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()
