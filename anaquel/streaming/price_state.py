"""State of products on a stream of prices: last settled prices, and sightings that are still open."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.streaming.state import GroupState

# Workers get this small module with the task, so no package has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_DAY = 86_400_000_000
#: Last settled time (microseconds) and price of each product, as many as ``known``, then the open sightings: one block of
#: columns, since values that pass between the engines one by one take longer than all else.
KEPT = "known bigint, rows binary"
ROWS = pa.schema([("product", pa.large_string()), ("at", pa.int64()), ("cents", pa.int64())])
SIGHTING = "product string, scrape_timestamp timestamp, cents bigint"
#: Rows of a task among which repeated sightings are looked for at a time.
RUN = 100_000
CHANGES = "product string, at bigint, previous bigint, cents bigint"


def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per product and time in each run of a task's rows, with the highest price."""

    def folded(run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["product", "scrape_timestamp"]
        rows = pa.Table.from_batches(run).group_by(names, use_threads=False).aggregate([("cents", "max")])
        yield from rows.rename_columns({"cents_max": "cents"}).select([*names, "cents"]).to_batches(10_000)

    run: list[pa.RecordBatch] = []
    for batch in batches:
        run.append(batch)
        if sum(b.num_rows for b in run) >= RUN:
            yield from folded(run)
            run = []
    if run:
        yield from folded(run)


def _last_of(*keys: np.ndarray) -> np.ndarray:
    """Of sorted rows, those whose next row differs in one of the keys."""
    ends = np.ones(len(keys[0]), bool)
    ends[:-1] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return ends


def packed(*columns: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ROWS, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, ROWS.types)], schema=ROWS))
    return sink.getvalue().to_pybytes()


def unpacked(rows: bytes) -> list[np.ndarray]:
    return [c.to_numpy() for c in pa.ipc.open_stream(rows).read_all().columns]


def settle(forget_days: int) -> Callable:
    """For a group of products: collect sightings, and report the changes among those that the watermark has passed.

    Products are numbered as they come, so only whole numbers are sorted and compared.
    """
    forget = forget_days * _DAY

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, rows = state.get if state.exists else (0, packed([], [], []))
        held, new = unpacked(rows), list(frames)
        product, names = pd.factorize(np.concatenate([held[0].astype(object), *[f["product"].to_numpy(object) for f in new]]))
        at, cents = (np.concatenate([held[k], *[f[c].to_numpy(np.int64) for f in new]]) for k, c in ((1, "at"), (2, "cents")))
        passed = state.getCurrentWatermarkMs() * 1000

        # Of one product and time the highest price counts.
        order = known + np.lexsort((cents[known:], at[known:], product[known:]))
        sightings = order[_last_of(product[order], at[order])]
        waiting = sightings[at[sightings] >= passed]
        # A known price comes before a sighting of its time.
        settled = np.concatenate([np.arange(known), sightings[at[sightings] < passed]])
        settled = settled[np.lexsort((at[settled], product[settled]))]
        one, when, price = product[settled], at[settled], cents[settled]
        follows = np.zeros(len(settled), bool)
        follows[1:] = (one[1:] == one[:-1]) & (when[1:] - when[:-1] <= forget)
        before = np.zeros(len(settled), np.int64)
        before[1:] = price[:-1]
        changed = (settled >= known) & ~(follows & (before == price))

        latest = settled[_last_of(one)]
        latest = latest[at[latest] + forget >= passed]
        if len(latest) or len(waiting):
            rows = np.concatenate([latest, waiting])
            state.update((len(latest), packed(names[product[rows]], at[rows], cents[rows])))
            wake = at[waiting].min() if len(waiting) else at[latest].min() + forget
            state.setTimeoutTimestamp(max(int(wake) // 1000, passed // 1000 + 1))
        else:
            state.remove()
        previous = pd.arrays.IntegerArray(before[changed], ~follows[changed])
        yield pd.DataFrame({"product": names[one[changed]], "at": when[changed], "previous": previous, "cents": price[changed]})

    return run
