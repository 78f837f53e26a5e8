"""The state of price changes against a walk over all sightings; it passes between the engines as one block."""

import datetime as dt
import random

import pandas as pd
import pyarrow as pa

from anaquel.streaming import jobs as T
from anaquel.streaming import price_state
from anaquel.streaming.price_state import settle
from tests.test_streaming import arrive, stream
from tests.test_tables import frame, observation

DAY = 86_400_000_000


class State:
    def __init__(self):
        self.kept, self.days = None, 0

    exists = property(lambda self: self.kept is not None)
    get = property(lambda self: self.kept)

    def getCurrentWatermarkMs(self):
        return self.days * 86_400_000

    def update(self, kept):
        self.kept = kept

    def remove(self):
        self.kept = None

    def setTimeoutTimestamp(self, at):
        assert at > self.getCurrentWatermarkMs()


def changes(sightings, until, forget):
    best, last, found = {}, {}, []
    for product, day, cents in sightings:
        best[day, product] = max(cents, best.get((day, product), 0))
    for (day, product), cents in sorted(best.items()):
        if day < until:
            seen, before = last.get(product, (None, None))
            previous = before if seen is not None and day - seen <= forget else None
            if previous != cents:
                found.append((product, day, previous, cents))
            last[product] = (day, cents)
    return found


def test_changes_equal_a_walk_and_state_is_one_block():
    rng = random.Random(4)
    for _ in range(60):
        state, until, seen, found = State(), 0, [], []
        for step in range(6):
            state.days = until
            rows = [(f"p{rng.randrange(4)}", rng.randrange(until, until + 30), rng.randrange(1, 4)) for _ in range(rng.choice([0, 1, 25]))]
            seen += rows
            frame = pd.DataFrame([(p, d * DAY, c, 1) for p, d, c in rows], columns=["product", "at", "cents", "dealt"])
            for out in settle(9)((1,), iter([frame[:7], frame[7:]]), state):
                found += [(r.product, int(r.at) // DAY, None if pd.isna(r.previous) else int(r.previous), int(r.cents)) for r in out.itertuples()]
            assert state.kept is None or [type(x) for x in state.kept] == [int, bytes]
            last, until = until, until + rng.choice([0, 5, 20])
        assert sorted(found, key=repr) == sorted(changes(seen, last, 9), key=repr)


def test_a_task_sends_one_row_per_product_and_time(monkeypatch):
    times = [dt.datetime(2026, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2)]
    rows = [(p, times[k % 2], c) for k, (p, c) in enumerate([("a", 5), ("a", 1), ("a", 7), ("b", 2), ("a", 7), ("b", 9)])]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["product", "scrape_timestamp", "cents"])
    folded = lambda: [tuple(r.values()) for b in price_state.highest(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    assert sorted(folded()) == [("a", times[0], 7), ("a", times[1], 1), ("b", times[1], 9)]
    monkeypatch.setattr(price_state, "RUN", 2)
    assert len(folded()) == 4 and not list(price_state.highest(iter([])))


def test_price_changes_keep_one_kind_of_state(spark, tmp_path):
    arrive(spark, tmp_path / "in", frame(spark, observation("c", "1")))
    out = T.stream_price_changes(stream(spark, tmp_path / "in"), "1 day", groups=2)
    T.run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    assert [f.name for f in (tmp_path / "state" / "state").iterdir()] == ["0"]
