"""Property tests against small Python models of the rules (each example is a
whole batch of inputs in one DataFrame, so Spark runs few jobs)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from streamops.functions.parse import parse_sensor_lines
from streamops.functions.tokenize import tokenize_lines
from streamops.operators.windows import session_agg

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def java_split(s: str, sep: str) -> list[str]:
    """String.split with a one-character literal separator and limit 0."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_parse(line: str):
    f = java_split(line, ",")
    if len(f) < 3:
        return "missing_fields"

    def num(x, bits):
        if not re.fullmatch(r"[+-]?[0-9]+", x):
            return None
        v = int(x)
        return v if -(1 << (bits - 1)) <= v < (1 << (bits - 1)) else None

    ts, vc = num(f[1], 64), num(f[2], 32)
    if ts is None:
        return "bad_ts"
    if vc is None:
        return "bad_vc"
    return (f[0], ts, vc)


lines = st.lists(st.text(alphabet=" ,ab+-0123456789", max_size=24), min_size=1, max_size=150)


@SETTINGS
@given(lines)
def test_tokenizer_matches_java_split(spark, xs):
    df = spark.createDataFrame(list(enumerate(xs)), "n long, value string")
    got = {}
    for r in tokenize_lines(df, keep=["n"]).collect():
        got.setdefault(r["n"], []).append((r["word_pos"], r["word"]))
    for n, x in enumerate(xs):
        assert [w for _, w in sorted(got.get(n, []))] == java_split(x, " "), repr(x)


big = st.integers(min_value=-(1 << 64), max_value=1 << 64).map(str)
sensor_like = st.tuples(st.text(alphabet="ab", max_size=2), big, big, st.sampled_from(["", ",", ",,", ",x"])).map(
    lambda t: f"{t[0]},{t[1]},{t[2]}{t[3]}")


@SETTINGS
@given(st.lists(st.one_of(st.text(alphabet=" ,ab+-0123456789", max_size=24), sensor_like), min_size=1, max_size=150))
def test_parser_matches_java_rules(spark, xs):
    df = spark.createDataFrame(list(enumerate(xs)), "n long, value string")
    ok, bad = parse_sensor_lines(df, keep=["n"])
    got = {r["n"]: (r["id"], r["ts"], r["vc"]) for r in ok.collect()}
    got.update({r["n"]: r["reason"] for r in bad.collect()})
    assert got == {n: java_parse(x) for n, x in enumerate(xs)}


events = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(min_value=0, max_value=5_000),
                            st.integers(min_value=0, max_value=9)), min_size=1, max_size=120)


@SETTINGS
@given(events, st.integers(min_value=1, max_value=400))
def test_sessions_match_gap_split(spark, evs, gap):
    df = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(evs)],
                               "id string, ts_ms bigint, vc int, arrival bigint")
    got = sorted((r["id"], r["s_start"], r["s_end"], r["cnt"], r["sum_vc"]) for r in session_agg(df, gap).collect())
    want = []
    for k in sorted({e[0] for e in evs}):
        rows = sorted((t, v) for kk, t, v in evs if kk == k)
        cur = [rows[0]]
        for t, v in rows[1:]:
            if t - cur[-1][0] > gap:
                want.append((k, cur[0][0], cur[-1][0] + gap, len(cur), sum(x for _, x in cur)))
                cur = []
            cur.append((t, v))
        want.append((k, cur[0][0], cur[-1][0] + gap, len(cur), sum(x for _, x in cur)))
    assert got == sorted(want)


def simulate(evs, size, delay, late):
    """Event-by-event model: after each row the watermark is max_ts - delay - 1;
    a window [S, E) fires (firing 0, on-time rows) once the watermark reaches
    E - 1; a row for a fired window within the lateness re-fires it with the
    cumulative totals; beyond it the row is a side output."""
    mx, classes, firings, state = None, {}, [], {}
    for arrival, (k, t, v) in enumerate(evs):
        wm = None if mx is None else mx - delay - 1
        e = t - t % size + size
        w = (k, e - size)
        st = state.setdefault(w, {"cnt": 0, "sum": 0, "fired": False, "n": 0})
        if wm is not None and e - 1 + late <= wm:
            classes[arrival] = "closed"
        elif wm is not None and e - 1 <= wm:
            classes[arrival] = "allowed"
            st["cnt"] += 1
            st["sum"] += v
            st["n"] += 1
            firings.append((k, e - size, st["n"], st["cnt"], st["sum"]))
        else:
            classes[arrival] = "on_time"
            st["cnt"] += 1
            st["sum"] += v
        mx = t if mx is None else max(mx, t)
    # firing 0 of every window that had on-time rows (at its watermark or at the end-of-input flush)
    on = {}
    for arrival, (k, t, v) in enumerate(evs):
        if classes[arrival] == "on_time":
            c = on.setdefault((k, t - t % size), [0, 0])
            c[0] += 1
            c[1] += v
    firings += [(k, s, 0, c, sm) for (k, s), (c, sm) in on.items()]
    return classes, sorted(firings)


stream = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(min_value=0, max_value=300),
                            st.integers(min_value=0, max_value=9)), min_size=1, max_size=80)


@SETTINGS
@given(stream, st.integers(min_value=0, max_value=40), st.integers(min_value=0, max_value=40))
def test_lateness_matches_event_simulation(spark, evs, delay, late):
    from pyspark.sql import functions as F
    from streamops.operators import lateness
    size = 50
    df = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(evs)],
                               "id string, ts_ms bigint, vc int, arrival bigint").withColumn("arr_ms", F.col("arrival"))
    c = lateness.classify_tumbling(lateness.watermark_trace(df, delay, chunk_width=16), size, late)
    classes, firings = simulate(evs, size, delay, late)
    assert {r["arrival"]: r["lateness"] for r in c.collect()} == classes
    got = sorted((r["id"], r["w_start"], r["firing"], r["cnt"], r["sum_vc"])
                 for r in lateness.window_firings(c, chunk_width=16).collect())
    assert got == firings


keyed = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(min_value=0, max_value=60),
                           st.integers(min_value=-5, max_value=30)), min_size=1, max_size=90)


@SETTINGS
@given(keyed)
def test_keyed_state_matches_sequential_model(spark, evs):
    from streamops.operators import joins, state, windows
    # arrival = list position; time increases with arrival (steps 0..60 ms)
    rows, t = [], 0
    for i, (k, step, v) in enumerate(evs):
        t += step
        rows.append((k, t, v, i))
    df = spark.createDataFrame(rows, "id string, ts_ms bigint, vc int, arrival bigint")
    W = 3  # tiny chunks: carries across chunks are exercised
    prev, top, ttl, last_t, pos, buf = {}, {}, {}, {}, {}, {}
    alerts, tops, states, tumb, slid = [], {}, {}, [], []
    for k, t, v, a in rows:
        p = prev.get(k, 0)
        if abs(v - p) > 10:
            alerts.append((a, p))
        prev[k] = v
        top[k] = sorted(top.get(k, []) + [v], reverse=True)[:3]
        tops[a] = tuple((top[k] + [None] * 3)[:3])
        if k in last_t and t - last_t[k] >= 25:
            ttl.pop(k, None)
        states[a] = ttl.get(k)
        if v > 10:
            ttl[k] = v
        last_t[k] = t
        pos[k] = pos.get(k, 0) + 1
        buf[k] = (buf.get(k, []) + [v])[-5:]
        if pos[k] % 5 == 0:
            tumb.append((k, pos[k] // 5 - 1, sum(buf[k])))
        if pos[k] % 2 == 0:
            slid.append((k, pos[k], len(buf[k]), sum(buf[k])))
    assert sorted((r["arrival"], r["prev_vc"]) for r in state.jump_alert(df, width=W).collect()) == sorted(alerts)
    assert {r["arrival"]: (r["top1"], r["top2"], r["top3"]) for r in state.running_top_k(df, 3, width=W).collect()} == tops
    assert {r["arrival"]: r["state"] for r in state.ttl_state(df, 25, width=W).collect()} == states
    assert sorted((r["id"], r["win_no"], r["sum_vc"]) for r in windows.count_window_tumbling(df, 5, width=W).collect()) == sorted(tumb)
    assert sorted((r["id"], r["pos"], r["cnt"], r["sum_vc"]) for r in windows.count_window_sliding(df, 5, 2, width=W).collect()) == sorted(slid)
    # as-of: rows of key 'c' are the config stream, the rest data; default threshold 0
    th, want = 0, []
    for k, t, v, a in rows:
        if k == "c":
            th = v
        elif v > th:
            want.append((a, v, th))
    data, cfg = df.where("id <> 'c'"), df.where("id = 'c'").withColumnRenamed("vc", "threshold")
    got = sorted((r["arrival"], r["vc"], r["threshold"]) for r in joins.asof_threshold(data, cfg, width=W).collect())
    assert got == want


@SETTINGS
@given(keyed)
def test_rolling_family_matches_sequential_model(spark, evs):
    from streamops.operators import rolling, state
    rows, t = [], 0
    for i, (k, step, v) in enumerate(evs):
        t += step
        rows.append((k, t, v, i))
    df = spark.createDataFrame(rows, "id string, ts_ms bigint, vc int, arrival bigint")
    W = 4
    first_ts, s, mx, mn, mxb, mnb, vcnt, n, bucket = {}, {}, {}, {}, {}, {}, {}, {}, {}
    want = {f: {} for f in ("sum", "max", "min", "maxby", "minby", "reduce", "counts", "avg", "bucket")}
    for k, t, v, a in rows:
        first_ts.setdefault(k, t)
        s[k] = s.get(k, 0) + v
        n[k] = n.get(k, 0) + 1
        mx[k] = max(mx.get(k, v), v)
        mn[k] = min(mn.get(k, v), v)
        if k not in mxb or v > mxb[k][0]:
            mxb[k] = (v, t)
        if k not in mnb or v < mnb[k][0]:
            mnb[k] = (v, t)
        vcnt[(k, v)] = vcnt.get((k, v), 0) + 1
        b = a % 3
        bucket[b] = bucket.get(b, 0) + 1
        want["sum"][a] = (first_ts[k], s[k])
        want["max"][a] = (first_ts[k], mx[k])
        want["min"][a] = (first_ts[k], mn[k])
        want["maxby"][a] = (mxb[k][1], mxb[k][0])
        want["minby"][a] = (mnb[k][1], mnb[k][0])
        want["reduce"][a] = (t, s[k])
        want["counts"][a] = vcnt[(k, v)]
        want["avg"][a] = s[k] / n[k]
        want["bucket"][a] = (b, bucket[b])
    pair = lambda d: {r["arrival"]: (r["ts_ms"], r["vc"]) for r in d.collect()}
    assert pair(rolling.rolling_sum(df, width=W)) == want["sum"]
    assert pair(rolling.rolling_max(df, width=W)) == want["max"]
    assert pair(rolling.rolling_max(df, width=W, use_min=True)) == want["min"]
    assert pair(rolling.rolling_max_by(df, width=W)) == want["maxby"]
    assert pair(rolling.rolling_max_by(df, width=W, use_min=True)) == want["minby"]
    assert pair(rolling.rolling_reduce(df, width=W)) == want["reduce"]
    assert {r["arrival"]: r["cnt"] for r in state.value_counts_running(df, width=W).collect()} == want["counts"]
    assert {r["arrival"]: r["avg_vc"] for r in state.running_avg(df, width=W).collect()} == want["avg"]
    assert {r["arrival"]: (r["bucket"], r["cnt"]) for r in state.bucket_running_count(df, 3, width=W).collect()} == want["bucket"]


pts = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(min_value=-200, max_value=400),
                         st.integers(min_value=0, max_value=4)), min_size=1, max_size=60)


@SETTINGS
@given(pts, pts, st.integers(min_value=1, max_value=90), st.integers(min_value=1, max_value=90))
def test_windows_joins_topn_match_brute_force(spark, xs, ys, size, slide):
    from streamops.operators import joins, topn, windows
    mk = lambda r: spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(r)],
                                         "id string, ts_ms bigint, vc int, arrival bigint")
    L, R = mk(xs), mk(ys)
    # sliding assignment: window starts s = j * slide with s <= t < s + size
    want = sorted((i, s) for i, (k, t, v) in enumerate(xs)
                  for s in range((t - size) // slide * slide, t + 1, slide) if s <= t < s + size)
    got = sorted((r["arrival"], r["w_start"]) for r in windows.assign_sliding(L, size, slide).collect())
    assert got == want
    # interval join, both plans, bounds inclusive
    lo, hi = -slide, size
    pairs = sorted((i, j) for i, (k, t, _) in enumerate(xs) for j, (k2, t2, _) in enumerate(ys)
                   if k == k2 and t + lo <= t2 <= t + hi)
    for f in (joins.interval_join, joins.interval_join_bucketed):
        assert sorted((r["l_arrival"], r["r_arrival"]) for r in f(L, R, lo, hi).collect()) == pairs
    # window join
    wj = sorted((i, j) for i, (k, t, _) in enumerate(xs) for j, (k2, t2, _) in enumerate(ys)
                if k == k2 and t - t % size == t2 - t2 % size)
    assert sorted((r["l_arrival"], r["r_arrival"]) for r in joins.window_join(L, R, size).collect()) == wj
    # top-2 by frequency per sliding window, ties by smaller value; both plans
    from collections import Counter
    per = {}
    for i, s in want:
        per.setdefault(s, Counter())[xs[i][2]] += 1
    tn = sorted((s, rank + 1, v, c) for s, cnt in per.items()
                for rank, (v, c) in enumerate(sorted(cnt.items(), key=lambda e: (-e[1], e[0]))[:2]))
    for f in (topn.topn_all_window, topn.topn_keyed):
        assert sorted((r["w_start"], r["rank"], r["vc"], r["cnt"]) for r in f(L, 2, size, slide).collect()) == tn
