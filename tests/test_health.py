"""Files of a store by what counts, and rewrites that nobody sees half done."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensormill.plans.health import file_ledger, rewrite_small, table_health
from sensormill.plans.reconcile import active_rows
from sensormill.plans.store import ParquetStore

ROWS = "log_id string, ingest_commit_id string, v int"


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.store = ParquetStore(spark, str(folder), {"t": T.StructType.fromDDL(ROWS), "other": T.StructType.fromDDL("k int")})
        self.store.ensure_tables()

    def append(self, append_id, *rows, commits=True):
        self.store.append("t", self.spark.createDataFrame(list(rows), ROWS).coalesce(1), append_id)
        if commits:
            ledger = [(append_id, log, commit, commit, "v1") for log, commit in {(r[0], r[1]) for r in rows}]
            ddl = "seq bigint, log_id string, commit_id string, source_digest string, transform_version string"
            self.store.append_ledger(self.spark.createDataFrame(ledger, ddl), append_id)

    def states(self):
        return {(r.append_id, r.state) for r in file_ledger(self.store).collect()}

    def active(self):
        return sorted(r.v for r in active_rows(self.store, "t").collect())


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, tmp_path / "lake")
    made.append(1, ("a", "a1", 1), ("b", "b1", 2))
    made.append(2, ("a", "a2", 3))
    made.append(3, ("c", "c1", 4), ("c", "c1", 4))
    made.append(4, ("d", "d1", 9), commits=False)  # the job died before the ledger
    return made


def test_every_file_has_a_state(lake):
    stray = lake.folder / "t/_temporary/0/x.parquet"
    stray.parent.mkdir(parents=True)
    stray.write_bytes(b"half")
    assert lake.states() == {(1, "live"), (2, "live"), (3, "live"), (4, "dead_append"), (None, "stray")}
    health = {r.table_name: r for r in table_health(lake.store).collect()}
    assert (health["t"].n_snapshots, health["t"].n_files, health["t"].n_small, health["t"].n_orphans) == (3, 3, 3, 2)
    assert health["t"].n_bytes > 0 and health["t"].orphan_bytes > 4 and "other" not in health


def test_a_rewrite_changes_files_and_nothing_else(lake):
    before, every = lake.active(), sorted(r.v for r in lake.store.read("t").collect())
    assert rewrite_small(lake.store, "t") == 3
    assert lake.active() == before == [2, 3, 4, 4] and sorted(r.v for r in lake.store.read("t").collect()) == every
    states = {}
    for append_id, state in lake.states():
        states.setdefault(state, []).append(append_id)
    assert sorted(states["moved"]) == [1, 2, 3] and len(states["live"]) == 1 and states["dead_append"] == [4]
    assert rewrite_small(lake.store, "t") == 0
    # Time travel goes to the files of that time; later appends stand beside the rewritten ones.
    assert sorted(r.v for r in lake.store.read("t", as_of=2).collect()) == [1, 2, 3]
    lake.append(5, ("a", "a3", 7))
    assert lake.active() == [2, 4, 4, 7]


def test_a_rewrite_that_died_is_not_seen(lake, monkeypatch):
    before = lake.active()

    def dies(rows, seq):
        raise RuntimeError("killed")

    append = lake.store.append_moves
    monkeypatch.setattr(lake.store, "append_moves", dies)
    with pytest.raises(RuntimeError, match="killed"):
        rewrite_small(lake.store, "t")
    assert lake.active() == before and lake.store.read("t").count() == 6
    assert sum(state == "dead_rewrite" for _, state in lake.states()) == 1
    monkeypatch.setattr(lake.store, "append_moves", append)
    assert rewrite_small(lake.store, "t") == 3 and lake.active() == before


def test_appends_are_packed_in_order_up_to_the_target(lake):
    sizes = {r.append_id: r.byte_size for r in file_ledger(lake.store).where("state = 'live'").collect()}
    target = sizes[1] + sizes[2]
    assert rewrite_small(lake.store, "t", target=target) == 2  # the third has a bin of its own and stays
    assert {a for a, s in lake.states() if s == "moved"} == {1, 2} and lake.active() == [2, 3, 4, 4]
    assert lake.store.moves("t").agg(F.count_distinct("to_append")).first()[0] == 1
    assert rewrite_small(lake.store, "t", small=1) == 0  # no file is small
