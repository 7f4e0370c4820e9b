"""Helpers: cut an events table into ordered parquet files for a file stream."""

import os
import tempfile
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

from streamops.sources.tables import JITTER_MOD, JITTER_MULT, JITTER_STEP_MS


def split_events(sf_dir: str, parts: int, jitter: bool = False, first: int | None = None,
                 closing: bool = False) -> tuple[str, list[str]]:
    """Write ``parts`` parquet files in arrival order into a fresh folder.

    With ``jitter`` the order is the synthetic arrival order (arr_ms, event_id).
    Files get increasing modification times so the stream reads them in order.
    With ``closing`` two more files follow with one row each of another key, a
    year on: they close every window of the data and stay open themselves.
    Returns (folder, [file paths]); with ``first`` only that many files are
    placed in the folder, the rest are written next to it for later moves.
    """
    t = pq.read_table(os.path.join(sf_dir, "events.parquet"))
    eid = t.column("event_id").to_numpy()
    if jitter:
        ts_us = pc.cast(t.column("ts"), "int64").to_numpy()
        ts_ms = ts_us // 1000
        arr = ts_ms + ((eid * JITTER_MULT) % JITTER_MOD) * JITTER_STEP_MS
        order = np.lexsort((eid, arr))
    else:
        order = np.argsort(eid, kind="stable")
    t = t.take(order)
    root = tempfile.mkdtemp(prefix="streamops-stream-")
    src = os.path.join(root, "in")
    later = os.path.join(root, "later")
    os.makedirs(src)
    os.makedirs(later)
    bounds = np.linspace(0, t.num_rows, parts + 1).astype(int)
    paths = []
    now = time.time() - 10_000
    for i in range(parts):
        folder = src if first is None or i < first else later
        p = os.path.join(folder, f"part-{i:04d}.parquet")
        pq.write_table(t.slice(bounds[i], bounds[i + 1] - bounds[i]), p)
        os.utime(p, (now + i, now + i))
        paths.append(p)
    if closing:
        for i in (1, 2):
            row = {c: t.column(c).slice(t.num_rows - 1, 1) for c in t.column_names}
            row["event_id"] = pa.array([10_000_000 + i], t.schema.field("event_id").type)
            row["user_id"] = pa.array([-1], t.schema.field("user_id").type)
            late = pc.add(pc.cast(row["ts"], pa.int64()), i * 365 * 86_400 * 1_000_000)
            row["ts"] = pc.cast(late, t.schema.field("ts").type)
            p = os.path.join(src, f"part-{parts + i:04d}.parquet")
            pq.write_table(pa.table(row).cast(t.schema), p)
            os.utime(p, (now + parts + i, now + parts + i))
            paths.append(p)
    return src, paths
