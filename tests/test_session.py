from __future__ import annotations

from types import SimpleNamespace

import pytest

from faregate.session import SQL_PROFILES, shared_folder, size_shuffles, variant_session


def test_variants_do_not_change_the_callers_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    teaching = variant_session(spark, SQL_PROFILES["teaching"])
    assert teaching.conf.get("spark.sql.adaptive.enabled") == "false"
    assert teaching.conf.get("spark.sql.shuffle.partitions") == "16"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_variants_inherit_what_the_caller_set(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert variant_session(spark, {}).conf.get("spark.sql.shuffle.partitions") == "5"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def fake(conf_dir, context_dir, master="local[2]"):
    made = []
    context = SimpleNamespace(getCheckpointDir=lambda: context_dir, setCheckpointDir=made.append, master=master)
    conf = SimpleNamespace(get=lambda name, default: conf_dir if name == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=context), made


def test_scratch_tables_go_below_the_clusters_checkpoint_folder():
    session, made = fake("s3://shared/ckpt/", None)
    first, second = shared_folder(session), shared_folder(session)
    assert first.startswith("s3://shared/ckpt/faregate-") and first != second and not made


def test_a_local_folder_only_where_none_is_set():
    session, made = fake(None, "file:/ckpt/app")
    assert shared_folder(session).startswith("file:/ckpt/app/faregate-") and not made
    session, made = fake(None, None)
    assert shared_folder(session).startswith(made[0])


def test_no_local_folder_on_several_machines():
    for master in ("spark://head:7077", "yarn", "local-cluster[2,1,1024]"):
        session, made = fake(None, None, master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session)
        assert not made


def test_shuffle_width_follows_the_input(spark):
    sizing = variant_session(spark, {})
    assert [size_shuffles(sizing, n) for n in (0, 10**12, 10**14)] == [200, 3725, 372_529]
    assert sizing.conf.get("spark.sql.shuffle.partitions") == "372529"
