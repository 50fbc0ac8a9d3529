"""State calls of the retry processor go by user and batch, and no pending retry is left without a timer."""
import random
from collections import Counter
from types import SimpleNamespace

import pytest

from eventide.streaming.jobs import APPEND_AT_ONCE, RetryProcessor


class _Store:
    """One user's state and timers, counting the calls."""

    def __init__(self):
        self.value, self.items, self.timers, self.calls = None, [], set(), Counter()

    def _call(self, name):
        self.calls[name] += 1

    def getValueState(self, *_):
        return SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, update=self._update)

    def getListState(self, *_):
        return SimpleNamespace(get=lambda: self._call("get") or iter(list(self.items)), appendList=self._append,
                               appendValue=lambda v: self._append([v]), put=self._put, clear=lambda: self._put([]))

    def registerTimer(self, at):
        self._call("registerTimer")
        self.timers.add(at)

    def _update(self, v):
        self.value = v

    def _append(self, v):
        self._call("append")
        assert len(v) <= APPEND_AT_ONCE
        self.items += v

    def _put(self, v):
        self._call("put")
        self.items = list(v)

    def fire(self, proc, mark):
        out, now = [], SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        for at in sorted(t for t in self.timers if t < mark):
            out += proc.handleExpiredTimer(("u",), now, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
            self.timers.discard(at)  # as Spark does when the call is over
        return out


def _proc(replay_fails=None):
    store, proc = _Store(), RetryProcessor(replay_fails=replay_fails)
    proc.init(store)
    return store, proc


def _failures(times):
    return [SimpleNamespace(event_id=i, timestamp_ms=t, failed=True) for i, t in times]


def test_calls_do_not_grow_with_failures():
    calls = []
    for n in (40, 4000):
        store, proc = _proc()
        routes = Counter(r.route for r in proc.handleInputRows(("u",), iter(_failures((i, 10 * i) for i in range(n))), None))
        replays = store.fire(proc, 10_000_000)
        assert routes == {"retry": n * 3 // 4, "dlq": n // 4} and len(replays) == routes["retry"]
        assert not store.items and not store.timers
        calls.append(sum(store.calls.values()))
    assert calls[0] == calls[1]


@pytest.mark.parametrize("seed", range(20))
def test_every_retry_runs_to_its_end(seed):
    rnd = random.Random(seed)
    store, proc = _proc(lambda event_id, attempt: event_id % 3 != 0 and attempt <= event_id % 5)
    got, want, n = [], Counter(), 0
    for batch in range(12):
        rows = _failures((n + k, rnd.randrange(0, 30) * 1000) for k in range(rnd.randrange(0, 6)))
        n += len(rows)
        for r in proc.handleInputRows(("u",), iter(rows), None):
            if r.route == "retry":
                last = 1
                while r.event_id % 3 != 0 and last <= r.event_id % 5 and last < 3:
                    want[r.event_id, "replay_retry", last] += 1
                    last += 1
                fails = r.event_id % 3 != 0 and last <= r.event_id % 5
                want[r.event_id, "replay_dlq" if fails else "replay_success", last] += 1
        got += store.fire(proc, batch * 3000)
        assert not store.items or min(store.timers) <= min(at for _, _, at, _ in store.items)
    for mark in range(36_000, 90_000, 3000):
        got += store.fire(proc, mark)
    assert Counter((r.event_id, r.route, r.attempt) for r in got) == want
    assert not store.items and not store.timers
