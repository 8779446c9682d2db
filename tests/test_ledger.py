"""Tables whose micro-batches are committed by a ledger."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from logscore.streaming.batch import Batch
from logscore.streaming.ledger import LedgerWriter, committing, read_committed, vacuum
from logscore.streaming.sinks import deliver

SCHEMA = T.StructType([T.StructField("id", T.LongType())])


def ids(spark, path):
    return sorted(r.id for r in read_committed(spark, str(path), SCHEMA).collect())


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path):
    write = LedgerWriter(str(tmp_path))
    assert ids(spark, tmp_path) == []
    with committing(Batch(0), write):
        write(spark.range(3), Batch(0, "a"))
        write(spark.range(3, 5), Batch(0, "b"))
        assert ids(spark, tmp_path) == []
    assert ids(spark, tmp_path) == [0, 1, 2, 3, 4]


def test_a_batch_written_again_in_other_parts_is_there_once(spark, tmp_path):
    first = LedgerWriter(str(tmp_path))
    with committing(Batch(0), first):
        first(spark.range(2), Batch(0))
    with pytest.raises(OSError), committing(Batch(1), first):
        first(spark.range(10, 14), Batch(1, "3"))
        raise OSError("stopped between parts")
    second = LedgerWriter(str(tmp_path))  # the next run
    for _ in range(2):  # it stops again after the commit, before its offsets are kept
        with committing(Batch(1), second):
            second(spark.range(10, 12), Batch(1, "0"))
            second(spark.range(12, 14), Batch(1, "1"))
    assert ids(spark, tmp_path) == [0, 1, 10, 11, 12, 13]
    with committing(Batch(2), second):
        pass
    with committing(Batch(3), second):
        second(spark.range(20, 21), Batch(3))
    assert vacuum(spark, str(tmp_path)) == 3
    assert ids(spark, tmp_path) == [0, 1, 10, 11, 12, 13, 20]


def test_a_batch_that_has_nothing_any_more(spark, tmp_path):
    write = LedgerWriter(str(tmp_path))
    with committing(Batch(5), write):
        write(spark.range(2), Batch(5))
    with committing(Batch(5), write):
        pass
    assert ids(spark, tmp_path) == []


def test_deliver_commits_what_both_sinks_took(spark, tmp_path):
    class Refuses(LedgerWriter):
        def __call__(self, events, batch):
            if not events.where("id = 7").isEmpty():
                raise OSError("refused")
            super().__call__(events, batch)

    main, dead = Refuses(str(tmp_path / "main")), LedgerWriter(str(tmp_path / "dead"))
    events = spark.range(20)
    outcome = deliver(events, main, dead, batch_id=4, first_wait=0.0, part_by="id")
    assert outcome == "dead_letter"
    assert ids(spark, tmp_path / "main") == [i for i in range(20) if i != 7]
    assert ids(spark, tmp_path / "dead") == [7]


def test_a_batch_needs_an_id(spark, tmp_path):
    with pytest.raises(ValueError, match="micro-batches"):
        LedgerWriter(str(tmp_path))(spark.range(1), Batch())
