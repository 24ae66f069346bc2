"""Keyed state of streams costs by the rows and their groups, not by the key or the minute."""

import pandas as pd

from beaconry.streaming import stateful


class Handle:
    """State in a dict; counts the calls, each of which is a round trip on a cluster."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def _state(self):
        handle, held = self, {}

        class State:
            def _call(self, key=None, value=None, drop=False):
                handle.calls += 1
                if drop:
                    held.pop(key, None)
                elif value is not None:
                    held[key] = value
                return held.get(key)

            def get(self):
                return self._call()

            def exists(self):
                return self._call() is not None

            def update(self, value):
                self._call(value=value)

            def clear(self):
                self._call(drop=True)

            def getValue(self, key):
                return self._call(key)

            def updateValue(self, key, value):
                self._call(key, value)

            def removeKey(self, key):
                self._call(key, drop=True)

        return State()

    def getValueState(self, name, *schemas):
        return self._state()

    getMapState = getValueState

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


class Times:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def crumbs_of(rows, limit, ttl_ms):
    """(process, error, crumb, message) by a plain look at all rows in order."""
    waiting, taken = {}, []
    for process, ts, event, is_error, message in sorted(rows, key=lambda r: (r[1], r[2])):
        held, latest = waiting.get(process, ([], ts))
        held = [] if ts > latest + ttl_ms else held
        if is_error:
            taken += [(process, event, c, m) for c, m in held]
        waiting[process] = ([] if is_error else [*held, (event, message)][-limit:], ts)
    return taken


def crumbs_run(rows, watermarks, held, few):
    """All rows arrive first, in batches; then the watermark moves."""
    minute, handle = 60_000, Handle()
    crumbs = stateful._Crumbs(limit=3, ttl_ms=600 * minute, bucket_ms=minute)
    crumbs.init(handle)
    crumbs.marks.held, crumbs.marks.few = held, few
    frame = pd.DataFrame(rows, columns=["process_id", "ts_ms", "event_id", "is_error", "message"])
    for at in range(0, len(frame), 700):
        list(crumbs.handleInputRows((0,), iter([frame.iloc[at:at + 700]]), Times(0)))
    got = []
    for at in watermarks:
        while due := [timer for timer in handle.timers if timer <= at]:
            handle.timers.discard(due[0])
            got += [tuple(r) for some in crumbs.handleExpiredTimer((0,), Times(at), Times(due[0])) for r in some.itertuples(index=False)]
    return got, handle


def marks(n):
    return [(f"p{i % 40}", i * 7919 % n * 45_000 + i % 3, i, i % 11 == 0, f"m{i}") for i in range(n)]


def test_state_is_asked_seldom():
    """2,800 marks in as many minutes take few calls; single keys with a timer a minute took more than ten a mark."""
    rows = marks(2_800)
    got, handle = crumbs_run(rows, [10**12], held=10_000, few=10_000)
    assert sorted(got) == sorted(crumbs_of(rows, 3, 600 * 60_000)) and handle.calls < 300 and not handle.timers


def test_slots_are_parted():
    """The same whichever way slots are parted, and nothing is given out before its minute has passed."""
    rows, middle = marks(2_800), 60_000_123
    want = sorted(crumbs_of(rows, 3, 600 * 60_000))
    for held, few in ((100, 10), (10_000, 10), (50, 10_000)):
        got, _ = crumbs_run(rows, [middle, middle + 5, 90_000_000, 10**12], held, few)
        assert sorted(got) == want
    early, _ = crumbs_run(rows, [middle], 100, 10)
    time = {event: ts for _, ts, event, _, _ in rows}
    assert sorted(early) == [w for w in want if time[w[1]] < middle // 60_000 * 60_000]


def test_an_error_after_the_end_of_its_session_does_not_count():
    handle, sessions = Handle(), stateful._Sessions(1_000)
    sessions.init(handle)
    frame = pd.DataFrame([(f"s{k}", 5, 9, [[1, 5, 2]], [[5, 2], [9, 4]], [7, 3], None, 0) for k in range(500)],
                         columns=["session_id", "started", "latest", "worst", "errors", "ended", "final", "_group"])
    list(sessions.handleInputRows((0,), iter([frame]), Times(0)))
    assert handle.timers == {7}
    handle.timers.clear()
    [got] = sessions.handleExpiredTimer((0,), Times(7), Times(7))
    assert got.values.tolist() == [[f"s{k}", "errored", 1, 5, 2, True] for k in range(500)]
    assert handle.calls < 20 and handle.timers == {1007}
    list(sessions.handleInputRows((0,), iter([frame]), Times(8)))  # they have ended
    [late] = sessions.handleExpiredTimer((0,), Times(1007), Times(1007))
    assert late.empty and sessions.closed.get() is None


def test_state_rows_are_not_counted(spark):
    """A stream-stream join writes every row to its state; counting them reads each key first."""
    from beaconry.streaming.run import tune_streams

    assert tune_streams(spark).conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
