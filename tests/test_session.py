from __future__ import annotations

from types import SimpleNamespace

import pytest

from logscore.session import RUNTIME_SETTINGS, scratch_folder


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_folders_are_new_ones_in_the_shared_folder():
    cluster = session("yarn", spark_checkpoint_dir="hdfs://shared/scratch/")
    folders = {scratch_folder(cluster, "events") for _ in range(3)}
    assert len(folders) == 3
    assert all(f.startswith("hdfs://shared/scratch/events-") for f in folders)


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session("yarn"), "events")


def test_a_local_session_may_leave_it_unset():
    assert "/events-" in scratch_folder(session("local[2]"), "events")


def test_settings_are_applied(spark):
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())
