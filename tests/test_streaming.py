from __future__ import annotations

import datetime
import random
from types import SimpleNamespace

import pandas as pd
import pytest

from txrisk import schemas
from txrisk.operators import indicators, score, sequences
from txrisk.operators.facts import clean, facts
from txrisk.params import BurstRules
from txrisk.streaming import bursts
from txrisk.streaming import cards as streaming


@pytest.fixture
def source(spark, build, tmp_path):
    """Files of transactions, read one file per batch."""

    def opened(*batches):
        """Without batches, the files that are there already."""
        for i, batch in enumerate(batches):
            part = tmp_path / f"part-{i}"
            build.raw(*batch).coalesce(1).write.parquet(str(part))
        stream = (
            spark.readStream.schema(schemas.TRANSACTIONS)
            .option("maxFilesPerTrigger", 1)
            .parquet(str(tmp_path / "part-*"))
        )
        return streaming.timed(stream)

    opened.spark, opened.opened = spark, opened
    return opened


def at(day, hour, minute=0):
    return {"date": f"2024-01-{day:02d} {hour:02d}:{minute:02d}:00"}


def test_finished_days_equal_the_batch_result(spark, build, rows, source):
    first = [{**at(1, h), "merchant_city": c, "errors": e} for h, c, e in [(1, "A", "x"), (5, "ONLINE", None), (9, "A", "")]]
    second = [{**at(1, 23), "merchant_city": "B"}, {**at(2, 0, 30), "card_id": 2}, {"date": "?"}]
    third = [at(4, 12)]
    found = streaming.drain(streaming.card_day_scores(source(first, second, third)), "t")
    everything = [{**row, "id": i} for i, row in enumerate([*first, *second, *third])]
    batch = score.risk_scores(indicators.card_days(facts(clean(build.raw(*everything)))))
    finished = batch.filter("tx_date < '2024-01-04'")
    assert rows(found) == rows(finished) and finished.count() == 2


def test_late_rows_are_dropped_once_the_watermark_has_passed(rows, source):
    """A batch is measured against the watermark that the batch before the last one left."""
    stream = source([at(1, 10)], [at(3, 0)], [at(3, 1)], [at(1, 11)], [at(5, 0)])
    found = streaming.drain(streaming.card_days(stream).select("tx_date", "n_tx"), "t")
    assert rows(found) == [(datetime.date(2024, 1, 1), 1), (datetime.date(2024, 1, 3), 2)]


def test_alerts(rows, source):
    tries = [{**at(1, 10, m), "errors": "Bad PIN", "id": m} for m in (0, 1, 2)]
    end = [{**at(3, 0), "card_id": 2}]
    quick = streaming.velocity_alerts(source(tries, end), BurstRules(velocity_tx=3))
    started = [datetime.datetime(2024, 1, 1, 9, 58) + datetime.timedelta(minutes=m) for m in range(3)]
    assert rows(streaming.drain(quick, "t")) == [(1, ts, 3) for ts in started]


def test_pin_alerts(rows, source):
    tries = [{**at(1, 10, m), "errors": "Bad PIN" if m else None, "id": m} for m in (0, 10, 20, 50)]
    found = streaming.pin_alerts(source(tries, [at(3, 0)]), BurstRules(pin_errors=3))
    windows = {r[1] for r in rows(streaming.drain(found, "t"))}
    assert windows == {datetime.datetime(2024, 1, 1, 10, 0), datetime.datetime(2024, 1, 1, 10, 10)}


def test_sessions_end_after_a_silence(rows, source):
    stream = source([at(1, 0), at(1, 5), {**at(1, 12), "amount": "$5"}], [at(1, 17), at(4, 0)])
    found = rows(streaming.drain(streaming.sessions(stream), "t"), "session_start", "n_tx", "amount_net")
    assert found == [(datetime.datetime(2024, 1, 1, 0), 2, 20.0), (datetime.datetime(2024, 1, 1, 12), 2, 15.0)]


def test_a_silence_as_long_as_the_gap_ends_nothing(rows, source):
    """Within a task, across tasks and across batches."""
    together = [at(1, 0), at(1, 6), {**at(1, 0), "card_id": 2}, {**at(1, 6, 1), "card_id": 2}]
    found = streaming.drain(streaming.sessions(source(together, [at(1, 12)], [at(4, 0)])), "t")
    assert rows(found, "card_id", "n_tx") == [(1, 3), (2, 1), (2, 1)]


def test_enrichment_keeps_every_row(build, rows, source):
    stream = source([{"id": 1, "mcc": 5812}], [{"id": 2, "mcc": None, "card_id": None, "date": "?"}])
    found = streaming.enriched(stream, build.codes(c5812="A"), build.cards({"id": 1, "card_type": "Debit"}), build.users())
    columns = found.select("id", "merchant_category", "card_type")
    assert rows(streaming.drain(columns, "t")) == [(1, "A", "Debit"), (2, "Unknown", None)]


def test_a_session_without_a_valid_amount_has_none(rows, source):
    found = streaming.drain(streaming.sessions(source([{**at(1, 0), "amount": "?"}], [at(4, 0)])), "t")
    assert rows(found, "n_tx", "amount_net") == [(1, None)]


def test_sessions_leave_the_configuration_alone(spark, source):
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    streaming.sessions(source([at(1, 0)]))
    assert spark.conf.get(name) == before


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    def add(k):
        spark.range(k, k + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def drained():
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        return sorted(r.id for r in streaming.drain(stream, "t", str(tmp_path / "out")).collect())

    add(1)
    assert drained() == [1]
    add(2)
    assert drained() == [1, 2]


def dated(second, **more):
    moment = datetime.datetime(2024, 1, 1, 10) + datetime.timedelta(seconds=second)
    return {"date": moment.strftime("%Y-%m-%d %H:%M:%S"), **more}


def test_a_burst_that_straddles_every_grid(rows, source):
    """Ten payments in 280 seconds that begin 50 seconds after a full minute: windows each minute hold at most nine."""
    tries = [dated(50 + 31 * i) for i in range(10)]
    end = [dated(90000, card_id=2)]
    with bursts.arbitrary_state(source.spark):
        on_grid = streaming.drain(streaming.velocity_alerts(source(tries, end)), "grid")
        exact = streaming.drain(bursts.velocity_bursts(source.opened()), "exact")
    assert rows(on_grid) == []
    assert rows(exact) == [(1, datetime.datetime(2024, 1, 1, 10) + datetime.timedelta(seconds=50 + 31 * 9), 10)]


def test_exact_bursts_equal_the_batch_result_also_after_a_restart(spark, build, rows, tmp_path):
    rng = random.Random(8)
    given = [dated(rng.randrange(40_000), card_id=rng.choice([1, 1, 2, None]), errors=rng.choice([None, "Bad PIN"]), id=i) for i in range(900)]
    given += [{"date": None, "id": 900}, dated(10**6, card_id=9, id=901), dated(10**6 + 1, card_id=9, id=902)]
    given.sort(key=lambda r: r["date"] or "")
    burst = BurstRules(velocity_tx=4, pin_errors=3, pin_seconds=600)
    folder = str(tmp_path / "in")
    for name, alerts, expected in (("velocity", bursts.velocity_bursts, sequences.velocity_bursts), ("pins", bursts.pin_bursts, sequences.pin_bursts)):
        for i, start in enumerate(range(0, len(given), 180)):
            build.raw(*given[start : start + 180]).coalesce(1).write.mode("append").parquet(f"{folder}-{name}")
            stream = spark.readStream.schema(schemas.TRANSACTIONS).option("maxFilesPerTrigger", 1).parquet(f"{folder}-{name}")
            with bursts.arbitrary_state(spark):
                found = streaming.drain(alerts(streaming.timed(stream, "10 minutes"), burst), name, str(tmp_path / name))
        batch = expected(sequences.moments(build.facts(*given)), burst).filter("tx_ts < '2024-01-10'")
        assert rows(found) == rows(batch) and batch.count() > 20


class Recorded:
    """Stands for the handle, the states and the timers of one card, and counts what is asked of them."""

    def __init__(self):
        self.calls, self.ring, self.expiry, self.timers = [], [], None, set()

    def getListState(self, name, schema):
        return SimpleNamespace(get=lambda: iter(self.ring), put=lambda rows: self.set("ring", rows), clear=lambda: self.set("ring", []))

    def getValueState(self, name, schema):
        return SimpleNamespace(exists=lambda: self.expiry is not None, get=lambda: self.expiry, update=lambda at: self.set("expiry", at), clear=lambda: self.set("expiry", None))

    def set(self, name, value):
        self.calls.append(name)
        setattr(self, name, value)

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls.append("timer")
        self.timers.remove(at)


def test_state_is_held_only_of_seconds_that_may_still_count():
    def came(watermark, *seconds):
        rows = iter([pd.DataFrame({"second": [s], "n": [1]}) for s in seconds])
        found = list(card.handleInputRows((1,), rows, SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark * 1000)))
        return [tuple(r) for part in found for r in part[["second", "n_recent"]].to_numpy()]

    card, state = bursts.Trailing(10, 2), Recorded()
    card.init(state)
    assert came(111, 100, 95, 50) == [(100, 2)]
    assert (state.calls, state.ring, state.timers) == ([], [], set())  # 111 covers no second up to 100
    assert came(131, 125, 121, 120, 112) == [(120, 2), (121, 3), (125, 3)]
    assert (state.ring, state.timers) == ([(121, 1), (125, 1)], {136_000})  # 131 covers 121, and not 120
    assert came(140, 131, 135) == [(131, 3), (135, 3)]
    assert (state.ring, state.timers) == ([(131, 1), (135, 1)], {146_000})
    assert came(200, 141) == [(141, 3)]
    assert (state.ring, state.expiry, state.timers) == ([], None, set())


def test_arbitrary_state_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(bursts.PROVIDER)
    with bursts.arbitrary_state(spark):
        assert spark.conf.get(bursts.PROVIDER) == bursts.ROCKSDB
    assert spark.conf.get(bursts.PROVIDER) == before
