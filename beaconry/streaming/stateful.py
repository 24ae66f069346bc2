"""Keyed state in event time: breadcrumbs waiting for their error, and sessions waiting for their end.

What arrives is not what happened first. Breadcrumbs are kept back until the watermark has passed them and are then taken
in the order of their times. Sessions need no order: marks are folded to a few numbers before they reach the state, and a
fold is the same whichever marks come first.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from beaconry import fixed_values as fixed

BUCKET_MS = 60_000
GROUPS = 1024  # keys are dealt into these, see ``_grouped``
_DAY_MS = 86_400_000
_FINER = 32  # a slot is parted into so many
_HELD = 200_000  # rows that are sorted at a time
_FEW = 2_000  # rows that are rather written again than parted


def _grouped(df: DataFrame, key: str, groups: int) -> DataFrame:
    """Adds ``_group``: state is kept, and a timer set, for a group of keys.

    Every call to the state is a round trip between Python and the JVM; for single keys these cost far more than the work.
    """
    return df.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))


class _Alarm:
    """One timer per group, at the earliest time that anything waits for."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.at = handle.getValueState("alarm", "at bigint")

    def set(self, at_ms: int | None, expired: bool = False) -> None:
        known = self.at.get()
        if known and known[0] == at_ms and not expired:
            return
        if known and not expired:
            self.handle.deleteTimer(known[0])
        if at_ms is None:
            self.at.clear()
        else:
            self.at.update((at_ms,))
            self.handle.registerTimer(at_ms)


class _Reorder:
    """Rows of one group that wait, by slots of time, until no older ones can come.

    A slot's rows lie in parts, one per batch of arriving rows, so that a hot key is never held whole. Slots are about a day
    wide at first; one that holds many rows, or many of which only some are due, is parted into finer ones, down to a bucket.
    Rows without a time are the earliest. ``columns`` begin with the two that order rows, the first in milliseconds.
    """

    def __init__(self, handle: StatefulProcessorHandle, columns: list[str], bucket_ms: int, held: int = _HELD, few: int = _FEW):
        self.columns, self.bucket_ms, self.held, self.few = columns, bucket_ms, held, few
        self.rows = handle.getMapState("rows", "width bigint, slot bigint, part int", "rows string")
        self.known = handle.getValueState("slots", "slots string")
        self.top = bucket_ms
        while self.top * _FINER <= _DAY_MS:
            self.top *= _FINER
        self.slots: dict[tuple[int, int], list[int]] = {}

    def load(self) -> None:
        """The slots, by width and number: how many parts and rows they have, the earliest time, the next part."""
        known = self.known.get()
        self.slots = {(width, slot): about for width, slot, *about in json.loads(known[0])} if known else {}

    def save(self) -> None:
        if self.slots:
            self.known.update((json.dumps([(*key, *about) for key, about in self.slots.items()]),))
        elif self.known.exists():
            self.known.clear()

    def next_ms(self) -> int | None:
        """When the first bucket ends."""
        return min(((low // self.bucket_ms + 1) * self.bucket_ms for _, _, low in self.slots.values()), default=None)

    def _put(self, width: int, slot: int, rows: str, count: int, low: int) -> None:
        about = self.slots.setdefault((width, slot), [0, 0, low])
        self.rows.updateValue((width, slot, about[0]), (rows,))
        self.slots[width, slot] = [about[0] + 1, about[1] + count, min(about[2], low)]

    def add(self, frame: pd.DataFrame) -> None:
        time = self.columns[0]
        frame = frame[self.columns].assign(**{time: frame[time].fillna(0).astype("int64")})
        for number, some in frame.groupby(frame[time].to_numpy() // self.top, sort=False):
            self._put(self.top, int(number), some.to_json(orient="values"), len(some), int(some[time].min()))

    def _drop(self, width: int, slot: int) -> Iterator[list]:
        """The parts of a slot, which are forgotten."""
        for part in range(self.slots.pop((width, slot))[0]):
            yield json.loads(self.rows.getValue((width, slot, part))[0])
            self.rows.removeKey((width, slot, part))

    def _refile(self, width: int, parts: Iterator[list]) -> None:
        for held in parts:
            finer: dict[int, list] = {}
            for row in held:
                finer.setdefault(row[0] // width, []).append(row)
            for slot, some in finer.items():
                self._put(width, slot, json.dumps(some), len(some), min(row[0] for row in some))

    def _part(self, bound: int) -> None:
        """Parts slots that are to be taken until those that are due follow each other and are small."""
        width = self.top
        while width > self.bucket_ms:
            inside = {start * w // width for w, start in self.slots if w < width}
            for w, slot in [key for key in self.slots if key[0] == width and key[1] * width < bound]:
                _, count, _ = self.slots[w, slot]
                if slot in inside or count > self.held or (count > self.few and (slot + 1) * width > bound):
                    self._refile(width // _FINER, self._drop(w, slot))
            width //= _FINER

    def due(self, at_ms: int) -> Iterator[list]:
        """The rows of all buckets that end by ``at_ms``, in order, some at a time; they are forgotten."""
        bound = at_ms // self.bucket_ms * self.bucket_ms
        self._part(bound)
        for width, slot in sorted((key for key in self.slots if key[0] * key[1] < bound), key=lambda key: key[0] * key[1]):
            held = [row for part in self._drop(width, slot) for row in part]
            later = [row for row in held if row[0] >= bound]
            if later:
                self._refile(width, iter([later]))
                held = [row for row in held if row[0] < bound]
            held.sort(key=lambda row: row[:2])
            yield held


class _Crumbs(StatefulProcessor):
    def __init__(self, limit: int, ttl_ms: int, bucket_ms: int = BUCKET_MS):
        self.limit, self.ttl_ms, self.bucket_ms = limit, ttl_ms, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = _Reorder(handle, ["ts_ms", "event_id", "is_error", "message", "process_id"], self.bucket_ms)
        self.waiting = handle.getValueState("waiting", "crumbs string, forget bigint")
        self.alarm = _Alarm(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.marks.load()
        for frame in rows:
            self.marks.add(frame)
        self.marks.save()
        held = self.waiting.get()
        self.alarm.set(self._next(held[1] if held else None))
        return iter(())

    def _next(self, forget: int | None) -> int | None:
        return min((at for at in (self.marks.next_ms(), forget) if at is not None), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self.waiting.get()
        waiting = {process: (crumbs, latest) for process, crumbs, latest in json.loads(held[0])} if held else {}
        self.marks.load()
        for rows in self.marks.due(now):
            taken = []
            for ts_ms, event_id, is_error, message, process in rows:
                crumbs, latest = waiting.get(process, ([], ts_ms))
                if ts_ms > latest + self.ttl_ms:
                    crumbs = []
                if is_error:
                    taken += [(process, event_id, crumb_id, text) for crumb_id, text in crumbs]
                    waiting.pop(process, None)
                else:
                    waiting[process] = ((crumbs + [(event_id, message)])[-self.limit:], ts_ms)
            yield pd.DataFrame(taken, columns=["process_id", "error_id", "event_id", "message"])
        self.marks.save()
        past = now // self.bucket_ms * self.bucket_ms  # marks before this are taken
        waiting = {process: (crumbs, latest) for process, (crumbs, latest) in waiting.items() if latest + self.ttl_ms >= past}
        forget = min((latest for _, latest in waiting.values()), default=0) + self.ttl_ms + 1 + self.bucket_ms if waiting else None
        if waiting:
            self.waiting.update((json.dumps([(process, *rest) for process, rest in waiting.items()]), forget))
        elif held:
            self.waiting.clear()
        self.alarm.set(self._next(forget), expired=True)

    def close(self) -> None:
        pass


def stream_breadcrumbs(marks: DataFrame, delay: str, limit: int = fixed.MAX_BREADCRUMBS,
                       ttl_ms: int = fixed.SPOOL_MAX_AGE_SECONDS * 1000, bucket_ms: int = BUCKET_MS, groups: int = GROUPS) -> DataFrame:
    """One row per crumb an error takes. Reads at (event time), process_id, ts_ms, event_id, is_error, message.

    Marks may come in any order: those of a bucket of ``bucket_ms`` are taken, in the order of (ts_ms, event_id), once the
    watermark is past the bucket, so nothing that is at most ``delay`` late is misplaced. Crumbs are forgotten after
    ``ttl_ms`` without a mark of their process. State is kept for ``groups`` groups of processes, a stream's checkpoint for
    one number of them.
    """
    rows = marks.select("at", "process_id", "ts_ms", "event_id", "is_error", "message")
    return _grouped(rows, "process_id", groups).withWatermark("at", delay).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=_Crumbs(limit, ttl_ms, bucket_ms),
        outputStructType="process_id string, error_id bigint, event_id bigint, message string",
        outputMode="Append", timeMode="EventTime")


_STATUS = ["ok", "errored", "abnormal", "crashed"]
_SEVERITY = {"error": 1, "abnormal": 2, "crash": 3}
_FOLDED = ("session_id string, at timestamp, started bigint, latest bigint, worst array<array<bigint>>, errors array<array<bigint>>, "
           "ended array<bigint>, final string")
_FOLD_COLUMNS = ["session_id", "started", "latest", "worst", "errors", "ended", "final"]
_SESSIONS_HELD = 100_000


class _Fold:
    """What a session's marks come to: times of the first and last, the first mark of each severity, errors, the first end.

    Marks are (ms, event id). Severities and errors after the first end do not count, but whether an end is the first
    shows only when all marks are in, so they keep their mark; errors that no end can precede any more are a mere count.
    """

    __slots__ = ("started", "latest", "worst", "errors", "ended", "final", "counted")

    def __init__(self, started=None, latest=None, worst=(), errors=(), ended=None, final=None, counted=0):
        self.started, self.latest, self.final, self.counted = started, latest, final, counted
        self.ended = None if ended is None else (int(ended[0]), int(ended[1]))
        self.worst, self.errors = [tuple(map(int, w)) for w in worst], [tuple(map(int, e)) for e in errors]

    def add(self, other: _Fold) -> None:
        self.started = other.started if self.started is None else min(self.started, other.started)
        self.latest = other.latest if self.latest is None else max(self.latest, other.latest)
        first = {}
        for severity, *mark in sorted([*self.worst, *other.worst]):
            first.setdefault(severity, (severity, *mark))
        self.worst = list(first.values())
        if other.ended is not None and (self.ended is None or other.ended < self.ended):
            self.ended, self.final = other.ended, other.final
        self.errors = [*self.errors, *other.errors]
        self.counted += other.counted
        if self.ended is not None:
            self.errors = [e for e in self.errors if e <= self.ended]

    def settle(self, before_ms: int) -> None:
        """Errors before a time that no end can have any more are counted."""
        if self.ended is None:
            open_ = [e for e in self.errors if e[0] >= before_ms]
            self.counted += len(self.errors) - len(open_)
            self.errors = open_

    def severity(self) -> int:
        return max((s for s, *mark in self.worst if self.ended is None or tuple(mark) <= self.ended), default=0)

    def packed(self) -> list:
        """As the arguments of a fold, of what JSON can hold."""
        return [int(self.started), int(self.latest), self.worst, self.errors, self.ended, self.final, int(self.counted)]


def _fold_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Marks, or folds of marks, to one fold per session; a task that meets very many sessions hands on what it has."""
    held: dict[str, tuple[pd.Timestamp, _Fold]] = {}

    def rows() -> pd.DataFrame:
        return pd.DataFrame([(key, at, f.started, f.latest, f.worst, f.errors, f.ended, f.final) for key, (at, f) in held.items()], columns=[
            "session_id", "at", "started", "latest", "worst", "errors", "ended", "final"])

    for frame in frames:
        some = zip(*(frame[c] for c in frame.columns), strict=True)
        if "mark" in frame.columns:
            some = _folds_of_marks(frame)
        for key, at, *fold in some:
            fold = _Fold(*fold)
            if key in held:
                held[key][1].add(fold)
                held[key] = (max(at, held[key][0]), held[key][1])
            else:
                held[key] = (at, fold)
        if len(held) > _SESSIONS_HELD:
            yield rows()
            held.clear()
    yield rows()


def _folds_of_marks(frame: pd.DataFrame) -> Iterator[tuple]:
    """A batch's marks by session, folded a session at a time without a look at every row."""
    frame = frame.assign(ts_ms=frame["ts_ms"].fillna(0).astype("int64"), event_id=frame["event_id"].astype("int64")).sort_values(["ts_ms", "event_id"])
    by = frame.groupby("session_id", sort=False)
    spans = by.agg(at=("at", "max"), started=("ts_ms", "min"), latest=("ts_ms", "max"))
    special = frame[frame["mark"].isin(["error", "crash", "abnormal", "end"])]
    marks: dict[str, list] = {}
    for key, ts_ms, event_id, mark, final in zip(*(special[c].tolist() for c in ("session_id", "ts_ms", "event_id", "mark", "final_status")), strict=True):
        worst, errors, ended = marks.setdefault(key, ({}, [], []))
        if mark == "end":
            if not ended:
                ended += [(ts_ms, event_id), final if isinstance(final, str) and final else None]
            continue
        worst.setdefault(_SEVERITY[mark], (_SEVERITY[mark], ts_ms, event_id))
        if mark != "abnormal":
            errors.append((ts_ms, event_id))
    for key, at, started, latest in zip(spans.index, spans["at"], spans["started"].tolist(), spans["latest"].tolist(), strict=True):
        worst, errors, ended = marks.get(key, ({}, [], []))
        yield key, at, started, latest, list(worst.values()), errors, *(ended or (None, None))


def fold_marks(marks: DataFrame) -> DataFrame:
    """Session marks to one fold per session: within each task first, then once more where a session's folds meet.

    Stateless, so it works on a stream, where it hands on one row per session and micro-batch: what a hot session's marks
    cost the keyed step is a row per task. Reads at, session_id, ts_ms, event_id, mark, final_status.
    """
    rows = marks.select("session_id", F.col("at").cast("timestamp"), "ts_ms", "event_id", "mark", "final_status")
    return rows.mapInPandas(_fold_frames, _FOLDED).repartition("session_id").mapInPandas(_fold_frames, _FOLDED)


class _Sessions(StatefulProcessor):
    """The sessions of a group: folds of those that are open, and until when ended ones are remembered."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "folds string")
        self.closed = handle.getValueState("closed", "until string")
        self.alarm = _Alarm(handle)

    @staticmethod
    def _load(state) -> dict:
        held = state.get()
        return dict(json.loads(held[0])) if held else {}

    @staticmethod
    def _save(state, held: dict) -> None:
        if held:
            state.update((json.dumps(list(held.items())),))
        elif state.exists():
            state.clear()

    def _due_ms(self, fold: list) -> int:
        """When a packed fold's session is given out."""
        latest, ended = fold[1], fold[4]
        return ended[0] if ended is not None else latest + self.idle_ms

    def _next(self, open_: dict, closed: dict) -> int | None:
        return min([*map(self._due_ms, open_.values()), *closed.values()], default=None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        open_, closed, now = self._load(self.open), self._load(self.closed), timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            for session, *row in zip(*(frame[c] for c in _FOLD_COLUMNS), strict=True):
                if session in closed:  # marks after the end are ignored
                    continue
                fold = _Fold(*open_[session]) if session in open_ else _Fold()
                fold.add(_Fold(*row))
                fold.settle(now)
                open_[session] = fold.packed()
        self._save(self.open, open_)
        self.alarm.set(self._next(open_, closed))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        open_, closed = self._load(self.open), {k: until for k, until in self._load(self.closed).items() if until > now}
        given = []
        for session in [k for k, fold in open_.items() if self._due_ms(fold) <= now]:
            fold = _Fold(*open_.pop(session))
            ended = fold.ended is not None
            last = fold.ended[0] if ended else fold.latest
            status = fold.final if ended and fold.final else _STATUS[fold.severity() if ended else max(fold.severity(), _SEVERITY["abnormal"])]
            started = min(fold.started, last)
            if ended and last + self.idle_ms > now:
                closed[session] = last + self.idle_ms
            given.append((session, status, fold.counted + len(fold.errors), started, last - started, ended))
        self._save(self.open, open_)
        self._save(self.closed, closed)
        self.alarm.set(self._next(open_, closed), expired=True)
        return iter([pd.DataFrame(given, columns=["session_id", "status", "error_count", "started_ms", "duration_ms", "ended"])])

    def close(self) -> None:
        pass


def stream_sessions(marks: DataFrame, delay: str, idle_ms: int, groups: int = GROUPS) -> DataFrame:
    """Sessions once they have ended. One that stays silent for ``idle_ms`` past the watermark ends as abnormal, or as crashed.

    Reads at (event time), session_id, ts_ms, event_id, mark, final_status. Marks may come in any order: a session is given
    out when the watermark is past its first end, with what came before that end. That it has ended is remembered for
    ``idle_ms``, so that later marks are ignored. Folds are late, and dropped, if their latest mark is. State is kept for
    ``groups`` groups of sessions, a stream's checkpoint for one number of them.
    """
    return _grouped(fold_marks(marks), "session_id", groups).withWatermark("at", delay).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=_Sessions(idle_ms),
        outputStructType="session_id string, status string, error_count bigint, started_ms bigint, "
                         "duration_ms bigint, ended boolean",
        outputMode="Append", timeMode="EventTime")
