"""Stateful processors for ``groupBy(key).transformWithStateInPandas``.

Each mirrors one batch operator and must produce the same rows when the
input arrives in arrival order, however it is cut into micro-batches.  Rows
inside a micro-batch are sorted by ``arrival`` first: order after the
shuffle is not guaranteed.  No ``withWatermark`` precedes these processors
(it would drop late rows before they are seen); they run with
``timeMode="none"`` unless they need event-time timers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor


#: Rows of one key in one micro-batch.  They are sorted together in memory, so
#: the source must cut batches (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)
#: such that no key brings more; beyond this the batch fails with that advice
#: instead of running out of memory.
MAX_KEY_ROWS = 5_000_000


def _sorted(rows: Iterator[pd.DataFrame], order: str = "arrival", limit: int | None = None) -> pd.DataFrame:
    """All rows of one key in this micro-batch, in arrival order."""
    parts, n, limit = [], 0, limit or MAX_KEY_ROWS
    for p in rows:
        n += len(p)
        if n > limit:
            raise ValueError(f"a key brings over {limit} rows in one micro-batch: lower the source's batch size")
        if len(p):
            parts.append(p)
    if not parts:
        return pd.DataFrame(columns=[order, "vc", "ts_ms"])
    return pd.concat(parts, ignore_index=True).sort_values(order, kind="stable")


def _values(pdf: pd.DataFrame, col: str = "vc") -> pd.Series:
    """The values as nullable integers; NULL follows the batch forms' rules."""
    return pd.to_numeric(pdf[col]).astype("Int64").reset_index(drop=True)


class JumpAlert(StatefulProcessor):
    """ValueState: alert when |vc - previous vc| > threshold (previous starts
    at 0).  A NULL value alerts nothing and counts as 0 for the next row."""

    OUTPUT = "id string, arrival bigint, vc int, prev_vc int"

    def __init__(self, threshold: int = 10):
        self.threshold = threshold

    def init(self, handle):
        self.last = handle.getValueState("last_vc", "vc int")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        vc = _values(pdf)
        before = self.last.get()[0] if self.last.exists() else None
        prev = pd.concat([pd.Series([before], dtype="Int64"), vc[:-1]], ignore_index=True).fillna(0) if len(vc) else vc
        hit = ((vc - prev).abs() > self.threshold).fillna(False).to_numpy(dtype=bool)
        if len(vc):
            self.last.update((None if pd.isna(vc.iloc[-1]) else int(vc.iloc[-1]),))
        yield pd.DataFrame({"id": key[0], "arrival": pdf["arrival"].to_numpy()[hit],
                            "vc": vc[hit].to_numpy("int32"), "prev_vc": prev[hit].to_numpy("int32")})

    def close(self):
        pass


class RunningSumAvg(StatefulProcessor):
    """Value state (sum, count): running sum and mean per row (ST4, ST5), both
    over the values that are not NULL, and NULL before the first."""

    OUTPUT = "id string, arrival bigint, vc int, sum_vc bigint, avg_vc double"

    def init(self, handle):
        self.acc = handle.getValueState("acc", "s long, n long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        s0, n0 = self.acc.get() if self.acc.exists() else (0, 0)
        vc = _values(pdf)
        sums = s0 + vc.fillna(0).to_numpy("int64").cumsum()
        counts = n0 + vc.notna().to_numpy().cumsum()
        if len(vc):
            self.acc.update((int(sums[-1]), int(counts[-1])))
        some = counts > 0
        yield pd.DataFrame({"id": key[0], "arrival": pdf["arrival"].to_numpy(), "vc": vc.astype("Int32").array,
                            "sum_vc": pd.Series(sums, dtype="Int64").where(some),
                            "avg_vc": pd.Series(np.divide(sums, np.maximum(counts, 1))).where(some)})

    def close(self):
        pass


class TopK(StatefulProcessor):
    """ListState: the k largest values so far, descending (ST2); NULL changes
    nothing.  ``value_type`` is the value column's type."""

    def __init__(self, k: int = 3, value_type: str = "int"):
        self.k, self.value_type = k, value_type
        self.OUTPUT = f"id string, arrival bigint, vc {value_type}, " + ", ".join(f"top{i + 1} {value_type}" for i in range(k))

    def init(self, handle):
        self.top = handle.getListState("top", f"v {self.value_type}")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        low = np.iinfo(np.int64).min                   # stands for "no value"
        top = [int(r[0]) for r in self.top.get()] if self.top.exists() else []
        vc, out = _values(pdf), []
        x = vc.fillna(low).to_numpy("int64")
        for first in (top + [low] * self.k)[: self.k]:
            # the largest so far, from the state on; what a row displaces goes to the next level
            most = np.maximum.accumulate(np.concatenate(([first], x)))
            x = np.minimum(x, most[:-1])
            out.append(most)
        self.top.put([(int(m[-1]),) for m in out if m[-1] != low])
        kind = "Int32" if self.value_type == "int" else "Int64"
        res = {"id": key[0], "arrival": pdf["arrival"].to_numpy(), "vc": vc.astype(kind)}
        for i, m in enumerate(out):
            res[f"top{i + 1}"] = pd.Series(m[1:], dtype="Int64").where(m[1:] != low).astype(kind)
        yield pd.DataFrame(res)

    def close(self):
        pass


class ValueCounts(StatefulProcessor):
    """MapState vc -> count; per row the count of its own value (ST3).  NULL is
    a value of its own, kept under a flag."""

    OUTPUT = "id string, arrival bigint, vc int, cnt bigint"

    def init(self, handle):
        self.counts = handle.getMapState("counts", "vc int, known boolean", "n long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        vc = _values(pdf)
        known, plain = vc.notna(), vc.fillna(0)
        group = pd.Series(list(zip(plain.tolist(), known.tolist())), dtype=object)
        base = {}
        for g in group.unique():
            at = (int(g[0]), bool(g[1]))
            base[g] = int(self.counts.getValue(at)[0]) if self.counts.containsKey(at) else 0
        cnt = group.groupby(group).cumcount().to_numpy("int64") + 1 + group.map(base).to_numpy("int64") if len(group) else []
        for g, n in zip(group, cnt):
            base[g] = int(n)
        for g, n in base.items():
            self.counts.updateValue((int(g[0]), bool(g[1])), (n,))
        yield pd.DataFrame({"id": key[0], "arrival": pdf["arrival"].to_numpy(), "vc": vc.astype("Int32").array,
                            "cnt": np.array(cnt, "int64")})

    def close(self):
        pass


class EventTimeTTL(StatefulProcessor):
    """Value state with a TTL on the *event* clock, refreshed by every read
    and write (ST6).  Spark's own ``ttlDurationMs`` runs on processing time
    and refreshes on write only, so the value and its last access time are
    kept explicitly; the answer then does not depend on wall-clock speed."""

    OUTPUT = "id string, arrival bigint, ts_ms bigint, vc int, state int"

    def __init__(self, ttl_ms: int, write_above: int = 10):
        self.ttl_ms, self.write_above = ttl_ms, write_above

    def init(self, handle):
        self.st = handle.getValueState("st", "v int, last_ms long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        n = len(pdf)
        if not n:
            return
        v, last = self.st.get() if self.st.exists() else (None, None)
        vc, time = _values(pdf), pdf["ts_ms"].to_numpy("int64")
        before = np.concatenate(([time[0] if last is None else last], time[:-1]))
        expired = time - before >= self.ttl_ms
        wrote = (vc > self.write_above).fillna(False).to_numpy(dtype=bool)
        # the row that wrote last before each row (-1: the state), valid if nothing expired since
        at = np.arange(n)
        writer = np.maximum.accumulate(np.concatenate(([-1], np.where(wrote, at, -1))))
        start = np.maximum.accumulate(np.where(expired, at, -1))
        held = pd.concat([pd.Series([v], dtype="Int64"), vc], ignore_index=True)
        state = held.take(writer[:-1] + 1).reset_index(drop=True).where(writer[:-1] >= start)
        final = held.iloc[int(writer[-1]) + 1] if writer[-1] >= start[-1] else None
        self.st.update((None if final is None or pd.isna(final) else int(final), int(time[-1])))
        yield pd.DataFrame({"id": key[0], "arrival": pdf["arrival"].to_numpy(), "ts_ms": time,
                            "vc": vc.astype("Int32"), "state": state.astype("Int32")})

    def close(self):
        pass


class ProcessingTimeTTL(StatefulProcessor):
    """Value state with Spark's processing-time TTL (ST6 as configured in the
    reference).  Spark refreshes a TTL on write only, so every read writes the
    value back: reads and writes both refresh it, and an expired value is
    never returned.  Results depend on wall-clock timing (rows-only).  Spark
    requires ``time_mode="ProcessingTime"`` for state TTL."""

    OUTPUT = "id string, arrival bigint, vc int, state int"

    def __init__(self, ttl_ms: int, write_above: int = 10):
        self.ttl_ms, self.write_above = ttl_ms, write_above

    def init(self, handle):
        self.st = handle.getValueState("st", "v int", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        out = []
        for a, x in zip(pdf["arrival"].tolist(), _values(pdf).tolist()):
            x = None if pd.isna(x) else int(x)
            v = self.st.get()[0] if self.st.exists() else None
            out.append((key[0], a, x, v))
            if x is not None and x > self.write_above:
                self.st.update((x,))
            elif v is not None:
                self.st.update((v,))  # refresh on read
        res = pd.DataFrame(out, columns=["id", "arrival", "vc", "state"])
        res[["vc", "state"]] = res[["vc", "state"]].astype("Int32")
        yield res

    def close(self):
        pass


class BucketCount(StatefulProcessor):
    """Operator list state stand-in: a durable running count per bucket (ST7)."""

    OUTPUT = "bucket int, arrival bigint, cnt bigint"

    def init(self, handle):
        self.n = handle.getValueState("n", "n long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        n0 = int(self.n.get()[0]) if self.n.exists() else 0
        cnt = n0 + np.arange(1, len(pdf) + 1)
        if len(pdf):
            self.n.update((int(cnt[-1]),))
        yield pd.DataFrame({"bucket": key[0], "arrival": pdf["arrival"].to_numpy(), "cnt": cnt.astype("int64")})

    def close(self):
        pass


class CountWindows(StatefulProcessor):
    """countWindow(size) and countWindow(size, slide) per key (W7, W8).

    List state keeps at most ``size`` recent values; the position counter is
    a value state.  Output ``kind`` is 'tumbling' or 'sliding'."""

    OUTPUT = "id string, kind string, pos bigint, cnt bigint, sum_vc bigint"

    def __init__(self, size: int = 5, slide: int = 2):
        self.size, self.slide = size, slide

    def init(self, handle):
        self.buf = handle.getListState("buf", "v int")
        self.pos = handle.getValueState("pos", "n long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        buf = [r[0] for r in self.buf.get()] if self.buf.exists() else []
        n = int(self.pos.get()[0]) if self.pos.exists() else 0
        # the kept values and the batch in one row, with running sums and counts of values that are not NULL
        x = pd.concat([pd.Series(buf, dtype="Int64"), _values(pdf)], ignore_index=True)
        total = np.concatenate(([0], x.fillna(0).to_numpy("int64").cumsum()))
        some = np.concatenate(([0], x.notna().to_numpy().cumsum()))
        place = np.arange(n + 1, n + 1 + len(pdf))
        end = len(buf) + np.arange(1, len(pdf) + 1)
        start = np.maximum(end - self.size, 0)
        sums = pd.Series(total[end] - total[start], dtype="Int64").where(some[end] > some[start])
        cnt = np.minimum(place, self.size)

        def fired(hit, kind, pos):
            return pd.DataFrame({"id": key[0], "kind": kind, "pos": pos[hit], "cnt": cnt[hit], "sum_vc": sums[hit].array})

        self.buf.put([(None if pd.isna(v) else int(v),) for v in x[-self.size:]])
        self.pos.update((n + len(pdf),))
        yield fired(place % self.size == 0, "tumbling", place // self.size - 1)
        yield fired(place % self.slide == 0, "sliding", place)

    def close(self):
        pass


class WindowProcess(StatefulProcessor):
    """Full-window function per (key, tumbling window) (W12): the rows are list
    state; when the watermark passes the window's end they are given out with
    the window's count, in parts, and the state is cleared."""

    OUTPUT = "id string, w_start bigint, w_end bigint, cnt bigint, arrival bigint, ts_ms bigint, vc int"
    PART = 10_000

    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def init(self, handle):
        self.handle = handle
        self.rows = handle.getListState("rows", "arrival long, ts_ms long, vc int")
        self.n = handle.getValueState("n", "n long")

    def handleInputRows(self, key, rows, timerValues):
        n = int(self.n.get()[0]) if self.n.exists() else 0
        if not n:
            self.handle.registerTimer(int(key[1]) + self.size_ms - 1)
        for p in rows:
            if len(p):
                vc = [None if pd.isna(v) else int(v) for v in p["vc"]]
                self.rows.appendList(list(zip(p["arrival"].tolist(), p["ts_ms"].tolist(), vc)))
                n += len(p)
        self.n.update((n,))
        yield pd.DataFrame(columns=["id", "w_start", "w_end", "cnt", "arrival", "ts_ms", "vc"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, part = int(self.n.get()[0]), []

        def out():
            res = pd.DataFrame(part, columns=["arrival", "ts_ms", "vc"])
            res["vc"] = res["vc"].astype("Int32")
            for i, (c, v) in enumerate((("id", key[0]), ("w_start", int(key[1])), ("w_end", int(key[1]) + self.size_ms), ("cnt", n))):
                res.insert(i, c, v)
            return res

        for r in self.rows.get():
            part.append(tuple(r))
            if len(part) == self.PART:
                yield out()
                part = []
        if part:
            yield out()
        self.rows.clear()
        self.n.clear()

    def close(self):
        pass


class WindowFirings(StatefulProcessor):
    """Window results with allowed lateness, one row per firing (WM7), over
    rows classified as on time or allowed late.  State: count, sum, firings."""

    OUTPUT = "id string, w_start bigint, w_end bigint, firing bigint, cnt bigint, sum_vc bigint"

    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def init(self, handle):
        self.handle = handle
        self.st = handle.getValueState("st", "cnt long, sum_vc long, late long, fired boolean")

    def handleInputRows(self, key, rows, timerValues):
        if self.st.exists():
            cnt, total, late, fired = self.st.get()
        else:
            cnt, total, late, fired = 0, None, 0, False
            self.handle.registerTimer(int(key[1]) + self.size_ms - 1)
        pdf, out = _sorted(rows), []
        order = pdf.sort_values(["arr_ms", "arrival"], kind="stable") if "arr_ms" in pdf else pdf
        for allowed, v in zip((order["lateness"] == "allowed").tolist(), _values(order).tolist()):
            if allowed and not fired:                  # all on-time rows came before the first allowed one
                if cnt:
                    out.append((key[0], int(key[1]), int(key[1]) + self.size_ms, 0, cnt, total))
                fired = True
            cnt += 1
            total = total if pd.isna(v) else (total or 0) + int(v)
            if allowed:
                late += 1
                out.append((key[0], int(key[1]), int(key[1]) + self.size_ms, late, cnt, total))
        self.st.update((cnt, total, late, fired))
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        cnt, total, late, fired = self.st.get()
        yield self.frame([] if fired else [(key[0], int(key[1]), int(key[1]) + self.size_ms, 0, cnt, total)])
        self.st.clear()

    @staticmethod
    def frame(rows):
        res = pd.DataFrame(rows, columns=["id", "w_start", "w_end", "firing", "cnt", "sum_vc"])
        res["sum_vc"] = res["sum_vc"].astype("Int64")
        return res

    def close(self):
        pass


class GlobalTrigger(StatefulProcessor):
    """Global window with a trigger and purge rule (W9), as in
    ``operators.triggers``.  The rows carry the trigger's condition as the
    column ``own`` (``with_own``).  State: place since the last cut, latest time,
    firing number, and the contents' count, sum and first arrival; whole numpy
    columns, no loop over rows."""

    OUTPUT = "id string, firing bigint, fire_arrival bigint, cnt bigint, sum_vc bigint, first_arrival bigint"

    def __init__(self, trigger, purge: bool = True):
        self.trigger, self.purge = trigger, purge

    @staticmethod
    def with_own(stream: DataFrame, trigger) -> DataFrame:
        from pyspark.sql import functions as F
        own = F.coalesce(F.expr(trigger.when), F.lit(False)) if trigger.when else F.lit(False)
        return stream.withColumn("own", own)

    def init(self, handle):
        self.st = handle.getValueState("st", "place long, latest long, firing long, cnt long, some long, sum_vc long, first long")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _sorted(rows)
        n = len(pdf)
        if not n:
            return
        place0, latest, firing0, cnt0, some0, sum0, first0 = self.st.get() if self.st.exists() else (0, None, 0, 0, 0, 0, None)
        cut = pdf["own"].to_numpy(dtype=bool).copy()
        low = np.iinfo(np.int64).min
        time = pd.to_numeric(pdf["ts_ms"]).astype("Int64").fillna(low).to_numpy("int64")
        latest = low if latest is None else latest
        so_far = np.maximum.accumulate(np.concatenate(([latest], time)))
        if self.trigger.every_ms:
            known = (time != low) & (so_far[:-1] != low)
            cut |= known & (np.where(known, time, 0) // self.trigger.every_ms > np.where(known, so_far[:-1], 0) // self.trigger.every_ms)
        at = np.arange(1, n + 1)
        last_cut = np.maximum.accumulate(np.concatenate(([-place0], np.where(cut, at, -place0))))
        fires = cut | ((at - last_cut[:-1]) % self.trigger.count == 0) if self.trigger.count else cut
        vc = _values(pdf)
        cnt = np.concatenate(([0], np.arange(1, n + 1))) + cnt0
        some = np.concatenate(([0], vc.notna().to_numpy().cumsum())) + some0
        total = np.concatenate(([0], vc.fillna(0).to_numpy("int64").cumsum())) + sum0
        arrival = pdf["arrival"].to_numpy()
        hit = np.flatnonzero(fires)
        starts = np.concatenate(([0], hit + 1)) if self.purge else np.zeros(len(hit) + 1, int)
        # what was there before the first row that counts: the state's contents, none after a purge
        base = [np.where(starts > 0, x[starts], 0) for x in (cnt, some, total)]
        first = [first0 if s == 0 and first0 is not None else int(arrival[s]) if s < n else None for s in starts.tolist()]
        known = (some[hit + 1] - base[1][:-1]) > 0
        self.st.update((int(n - last_cut[-1]), None if so_far[-1] == low else int(so_far[-1]), firing0 + len(hit),
                        int(cnt[-1] - base[0][-1]), int(some[-1] - base[1][-1]), int(total[-1] - base[2][-1]), first[-1]))
        yield pd.DataFrame({
            "id": key[0], "firing": firing0 + np.arange(len(hit)), "fire_arrival": arrival[hit],
            "cnt": cnt[hit + 1] - base[0][:-1], "sum_vc": pd.Series(total[hit + 1] - base[2][:-1], dtype="Int64").where(known),
            "first_arrival": pd.Series(first[:-1], dtype="Int64")})

    def close(self):
        pass


class EventTimer(StatefulProcessor):
    """Registers an event-time timer at a fixed time when a key is first seen
    and reports it when the watermark passes it (T1)."""

    OUTPUT = "id string, timer_ms bigint, watermark_ms bigint"

    def __init__(self, timer_ms: int):
        self.timer_ms = timer_ms

    def init(self, handle):
        self.handle = handle
        self.seen = handle.getValueState("seen", "b boolean")

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        if not self.seen.exists():
            self.seen.update((True,))
            self.handle.registerTimer(self.timer_ms)
        yield pd.DataFrame(columns=["id", "timer_ms", "watermark_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield pd.DataFrame([(key[0], expiredTimerInfo.getExpiryTimeInMs(),
                             timerValues.getCurrentWatermarkInMs())],
                           columns=["id", "timer_ms", "watermark_ms"])

    def close(self):
        pass


class ProcessingTimer(StatefulProcessor):
    """A processing-time timer at now + delay for each input batch of a key (T2)."""

    OUTPUT = "id string, timer_ms bigint"

    def __init__(self, delay_ms: int = 5000):
        self.delay_ms = delay_ms

    def init(self, handle):
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        yield pd.DataFrame(columns=["id", "timer_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield pd.DataFrame([(key[0], expiredTimerInfo.getExpiryTimeInMs())], columns=["id", "timer_ms"])

    def close(self):
        pass


def apply(stream: DataFrame, key: str, processor, time_mode: str = "none",
          event_time_col: str = "") -> DataFrame:
    """``groupBy(key).transformWithStateInPandas`` with the processor's schema."""
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.OUTPUT, outputMode="Append",
        timeMode=time_mode, eventTimeColumnName=event_time_col)


def stored_state(spark, checkpoint: str, variable: str) -> DataFrame:
    """What a stopped query's checkpoint holds of one state variable: the keys'
    fields and the value's fields, one row for each key (value state).  A check
    of restored state (ST7) that needs no running query."""
    state = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    return state.select("key.*", "value.*")
