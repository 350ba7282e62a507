import pytest

from daymill import session


@pytest.fixture
def sizes(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", session.OWN_PARTITIONS, session.SET_PARTITIONS]
    old = {n: spark.conf.get(n, None) for n in names}
    yield lambda: tuple(int(spark.conf.get(n)) for n in names[:2])
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_partitions_grow_with_the_input_and_return(spark, sizes):
    session.size_for_input(spark, 0)
    own, split = sizes()
    session.size_for_input(spark, 1 << 40)
    assert sizes() == (4096, 128 << 20)
    session.size_for_input(spark, 100 << 40)
    assert sizes() == (409_600, 512 << 20)
    session.size_for_input(spark, 1 << 20)
    assert sizes() == (own, split)
    spark.conf.set("spark.sql.shuffle.partitions", "33")  # the user changes their mind
    session.size_for_input(spark, 1 << 40)
    session.size_for_input(spark, 0)
    assert sizes()[0] == 33


class Conf(dict):
    set = dict.__setitem__


class Stub:
    """Stands in for a session: ``spark.checkpoint.dir`` cannot be changed in a running one."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session():
    cluster = Stub("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert session.shared_dir(cluster) == "hdfs://shared"
    assert session.scratch_table(cluster, "x").startswith("hdfs://shared/x-")


def test_only_a_local_session_may_use_a_temporary_folder():
    with pytest.raises(ValueError):
        session.shared_dir(Stub("yarn"))
    local = Stub("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_a_few_gigabytes_are_cut_into_small_partitions(spark, sizes):
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    for gb in (1, 6):
        session.size_for_input(spark, gb << 30)
        assert sizes() == (gb * 128, 32 << 20)
    session.size_for_input(spark, 512 << 30)
    assert sizes() == (4096, 64 << 20)
    assert int(spark.conf.get(session.ADVISORY).rstrip("m")) <= 8  # nor are they merged to large ones


def test_files_may_be_larger_than_partitions(spark):
    held = spark.conf.get(session.ADVISORY)
    with pytest.raises(KeyError), session.file_sizes(spark):
        assert spark.conf.get(session.ADVISORY) == "64m"
        raise KeyError
    assert spark.conf.get(session.ADVISORY) == held
    spark.conf.set(session.ADVISORY, "3m")  # the user's own
    with session.file_sizes(spark):
        assert spark.conf.get(session.ADVISORY) == "3m"
    spark.conf.set(session.ADVISORY, held)
