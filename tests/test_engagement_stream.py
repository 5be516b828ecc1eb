"""The streamed fact against the batch fact, with late and repeated rows and restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cascata.operators import gold
from cascata.schemas import SILVER_INTERACTION
from cascata.sources import versions
from cascata.streaming import engagement_stream as stream


def day(n, hour=8):
    return dt.datetime(2024, 1, n, hour)


def rows(spark, given):
    kinds = ["visualização", "início", "conclusão", "curtida"]
    full = [(u, c, kinds[(u + c) % 4], t, u + c, None, 4 if c == 1 else None) for u, c, t in given]
    return spark.createDataFrame(full, SILVER_INTERACTION)


def fact(df):
    return sorted(tuple(r) for r in df.drop("execucao_id").collect())


@pytest.fixture
def follow(spark, tmp_path):
    (tmp_path / "chegadas").mkdir()

    def run(*files):
        for name, given in files:
            rows(spark, given).coalesce(1).write.parquet(str(tmp_path / "chegadas" / name))
        query = stream.follow_engagement(spark, str(tmp_path / "chegadas" / "*"), str(tmp_path / "fato"), str(tmp_path / "marca"), "fluxo",
                                         str(tmp_path / "tardias"))
        query.awaitTermination()
        assert query.exception() is None
        return str(tmp_path / "fato"), str(tmp_path / "tardias")

    return run


def test_late_and_repeated_rows(spark, follow):
    first = [(1, 1, day(1)), (2, 1, day(1)), (1, 2, day(2)), (1, 2, day(2))]
    second = [(3, 1, day(1)), (1, 1, day(1)), (4, 4, day(6)), (5, 4, day(4))]  # a day still open, a repeat, and a jump ahead
    third = [(9, 9, day(2)), (9, 9, day(3)), (4, 4, day(6)), (6, 4, day(4)), (7, 1, day(7))]  # two of closed days
    base, late = follow(("a", first))
    follow(("b", second))
    follow(("c", third), )
    kept = rows(spark, sorted({*first, *second, *third} - {(9, 9, day(2)), (9, 9, day(3))}))
    assert fact(stream.streamed_fact(spark, base, "r")) == fact(gold.fact_engagement_day(kept, "r"))
    quarantined = spark.read.parquet(late)
    assert sorted((r["usuario_id"], r["data"].day) for r in quarantined.collect()) == [(9, 2), (9, 3)]
    assert {r["regra_violada"] for r in quarantined.collect()} == {stream.LATE}
    closed = stream.streamed_fact(spark, base, "r", closed_only=True)
    assert closed.agg(F.max("data")).first()[0] == dt.date(2024, 1, 4)
    seen = versions.newest(spark, base).tables[stream.SEEN].parts
    assert min(seen) >= "2024-01-05"  # keys of closed days are let go


def test_a_restart_without_files_and_a_batch_delivered_twice_change_nothing(spark, follow):
    base, late = follow(("a", [(1, 1, day(1)), (2, 2, day(1))]))
    before = versions.newest(spark, base)
    follow()
    again = stream.take_batch(spark, base, rows(spark, [(1, 1, day(1)), (8, 8, day(1))]), before.tables[stream.SUMS].notes["lote"], "fluxo", late, 2)
    assert again == before == versions.newest(spark, base)


def test_a_batch_that_fails_before_its_commit_is_taken_again(spark, follow, monkeypatch):
    base, late = follow(("a", [(1, 1, day(1))]))
    done = versions.commit
    monkeypatch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception):
        follow(("b", [(2, 2, day(2)), (1, 1, day(1))]))
    monkeypatch.setattr(versions, "commit", done)
    follow()
    assert fact(stream.streamed_fact(spark, base, "r")) == fact(gold.fact_engagement_day(rows(spark, [(1, 1, day(1)), (2, 2, day(2))]), "r"))
