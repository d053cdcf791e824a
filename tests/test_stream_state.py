"""Where the uniqueness stream keeps its state: not in the executors' heaps."""

import glob
import json
import os

from qualstar.sources.files import GRANT_SCHEMA
from qualstar.streaming.uniqueness import start_uniqueness_monitor, uniqueness_results

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROWS_TRACKED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
ON_DISK, IN_HEAP = (f"org.apache.spark.sql.execution.streaming.state.{n}StateStoreProvider" for n in ("RocksDB", "HDFSBacked"))


def _row(i):
    return (f"A{i}", None, "S", 1.0, 1, None, "Pending", None, None, None)


def _providers(checkpoint):
    """The state store of each batch, as the query wrote it down."""
    batches = sorted(glob.glob(os.path.join(checkpoint, "offsets", "[0-9]*")), key=lambda p: int(os.path.basename(p)))
    return [json.loads(open(b).read().splitlines()[1])["conf"][PROVIDER] for b in batches]


def _arrive(spark, tmp_dir, rows):
    inbox, counts, ck = (os.path.join(tmp_dir, p) for p in ("inbox", "counts", "ck"))
    spark.createDataFrame(rows, GRANT_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    start_uniqueness_monitor(spark, inbox, counts, ck, source_format="parquet").awaitTermination()
    got = {(r.rule_id, r.application_id, r.passed): r.n_rows for r in uniqueness_results(spark, counts).collect()}
    return got, _providers(ck)


def test_state_is_kept_in_rocksdb_and_the_session_is_left_as_it_was(spark, tmp_dir):
    before = {k: spark.conf.get(k, None) for k in (PROVIDER, ROWS_TRACKED)}
    assert _arrive(spark, tmp_dir, [_row(1), _row(2)])[1] == [ON_DISK]
    got, providers = _arrive(spark, tmp_dir, [_row(1)])
    assert set(providers) == {ON_DISK} and len(providers) > 1
    assert got["U002", "A1", False] == 1 and got["U001", "A1", False] == 2 and got["U001", "A2", True] == 1
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_a_checkpoint_with_state_in_heap_goes_on_with_it(spark, tmp_dir, monkeypatch):
    from qualstar.streaming import uniqueness
    with monkeypatch.context() as m:
        m.setattr(uniqueness, "_STATE_ON_DISK", {})
        assert _arrive(spark, tmp_dir, [_row(1), _row(2)])[1] == [IN_HEAP]
    got, providers = _arrive(spark, tmp_dir, [_row(1)])
    assert set(providers) == {IN_HEAP}
    assert got["U002", "A1", False] == 1 and got["U001", "A1", False] == 2


def test_a_provider_that_the_session_names_is_kept(spark, tmp_dir):
    spark.conf.set(PROVIDER, IN_HEAP)
    try:
        assert _arrive(spark, tmp_dir, [_row(1)])[1] == [IN_HEAP]
        assert spark.conf.get(PROVIDER) == IN_HEAP
    finally:
        spark.conf.unset(PROVIDER)
