import pytest

from stratum import session


def test_scratch_is_unique_and_under_the_shared_root(spark):
    root = session.shared_root(spark)
    a, b = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert a != b and a.startswith(root + "/stratum/x-") and b.startswith(root + "/stratum/x-")


def test_shared_root_prefers_the_configured_folder(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_root(spark) == configured.rstrip("/")
    else:
        assert session.shared_root(spark)


def test_filesystem_helpers(spark, tmp_root):
    session.ensure_dir(spark, tmp_root + "/a/b")
    assert session.path_exists(spark, tmp_root + "/a/b")
    assert session.list_dirs(spark, tmp_root + "/a") == ["b"]
    assert session.list_dirs(spark, tmp_root + "/missing") == []


def test_pin_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    session.pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_storage_errors_raise(spark):
    for call in (session.path_exists, session.list_dirs, session.delete_path, session.ensure_dir):
        with pytest.raises(Exception):
            call(spark, "nosuchscheme://host/a")
