import pytest

from foldlake.llm import common


class _Session:
    class conf:
        value = None

        @classmethod
        def get(cls, key, default):
            return cls.value or default


def test_shared_folder(spark):
    own = common.shared_dir(_Session)
    assert own.startswith("file:///") and common.shared_dir(_Session) == own
    _Session.conf.value = "hdfs://a/b/"
    assert common.shared_dir(_Session) == "hdfs://a/b"
    _Session.conf.value = "/a/b"
    assert common.shared_dir(_Session) == "file:///a/b"


def test_no_folder_of_its_own_on_a_cluster(spark):
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default):
                return "spark://host:7077" if key == "spark.master" else default

    with pytest.raises(ValueError):
        common.shared_dir(Cluster)


def test_materialize_and_files(spark, tmp_path):
    df = common.materialize(spark.range(10), "numbers")
    assert df.count() == 10 and "parquet" in df.inputFiles()[0]
    with common.writing(f"file://{tmp_path}/x/y.bin") as out:
        out.write(b"abc")
    with common.reading(f"file://{tmp_path}/x/y.bin") as file:
        assert file.read() == b"abc"
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["y.bin"]


def test_one_memory_at_a_time():
    made = []

    @common.remembered
    def words(size):
        made.append(size)
        return [size]

    @common.remembered
    def other():
        return {}

    assert words(1) is words(1) and made == [1]
    assert other() is other()
    assert words(1) == [1] and made == [1, 1]
    assert words(2) == [2] and made == [1, 1, 2]
