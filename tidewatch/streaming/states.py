"""Keyed state: the ``for`` clause of alerts, the notification timers, agent sessions and export buffers.

State is a few numbers per key. The pandas functions see the rows of one key in
one micro-batch, which are the evaluations or transitions since the last one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.functions.scan import MICROS

TRANSITIONS = "alertname STRING, series STRING, state STRING, at_us BIGINT, active_us BIGINT, value DOUBLE"
ALERT_STATE = "active_us BIGINT, firing BOOLEAN, last_us BIGINT, every_us BIGINT, value DOUBLE, waiting STRING"


def alert_transitions(evaluations: DataFrame) -> DataFrame:
    """Pending, firing and resolved transitions per (alertname, series).

    Input: ``alertname, series, eval_us, active, value, every_us, hold_us`` and
    the watermarked time ``eval_ts``. Evaluations wait until the watermark has
    passed them and are then read in time order, so it makes no difference in
    which batch one arrives. A false or a missing evaluation ends a run; a run
    that ends before it fired goes back to inactive without a row. A quiet key is
    closed when the watermark passes its next evaluation. What waits is bounded
    by the watermark's delay.
    """
    return evaluations.groupBy("alertname", "series").applyInPandasWithState(
        _advance, TRANSITIONS, ALERT_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    active, firing, last, every, value, waiting = state.get if state.exists else (None, False, None, None, None, "[]")
    out: list[tuple] = []

    def close(at: int) -> None:
        nonlocal active, firing
        if firing:
            out.append((*key, "resolved", at, active, value))
        active, firing = None, False

    rows = [tuple(r) for r in json.loads(waiting)]
    if not state.hasTimedOut:
        for batch in batches:
            columns = (batch[c].tolist() for c in ("eval_us", "active", "value", "every_us", "hold_us"))
            rows += [(int(at), bool(hit), float(v), int(e), int(h)) for at, hit, v, e, h in zip(*columns)]
    passed = state.getCurrentWatermarkMs() * 1000
    rows.sort(key=lambda r: r[0])
    for at, hit, v, every, hold in (r for r in rows if r[0] < passed):
        if last is not None and active is not None and at - last > every:
            close(last + every)
        if hit:
            value = v
            if active is None:
                active = at
                out.append((*key, "pending", at, at, value))
            if not firing and at - active >= hold:
                firing = True
                out.append((*key, "firing", at, active, value))
        elif active is not None:
            close(at)
        last = at
    rows = [r for r in rows if r[0] >= passed]
    if active is not None and last + every < passed:
        # The watermark has passed the next evaluation: it is missing.
        close(last + every)
    times = [r[0] for r in rows[:1]] + ([last + every] if active is not None else [])
    if times:
        state.update((active, firing, last, every, value, json.dumps(rows)))
        state.setTimeoutTimestamp(max(min(times) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=[c.split()[0] for c in TRANSITIONS.split(", ")])


NOTICES = "receiver STRING, group_key STRING, status STRING, reason STRING, sent_us BIGINT, alerts BIGINT"
GROUP_STATE = "open BIGINT, began_us BIGINT, first_us BIGINT, news_us BIGINT, sent_us BIGINT, ended_us BIGINT, wait BIGINT, every BIGINT, again BIGINT, waiting STRING"


def notification_timers(transitions: DataFrame) -> DataFrame:
    """Notification times per (receiver, group_key).

    Input: ``receiver, group_key, state`` (firing or resolved), ``at_us``,
    ``group_wait, group_interval, repeat_interval`` in seconds and the
    watermarked time ``at_ts``. Timers run on event time: a notice is given when
    the watermark passes its due time. Transitions wait until the watermark has
    passed them and are then read in time order, so it makes no difference in
    which batch one arrives. A resolved row without an open alert changes nothing.
    What waits is bounded by the watermark's delay.
    """
    return transitions.groupBy("receiver", "group_key").applyInPandasWithState(
        _notify, NOTICES, GROUP_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _notify(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in GROUP_STATE.split(", ")]
    s = dict(zip(names, state.get)) if state.exists else dict.fromkeys(names)
    s["open"] = s["open"] or 0
    rows = [tuple(r) for r in json.loads(s.pop("waiting") or "[]")]
    names.remove("waiting")
    out: list[tuple] = []

    def due() -> tuple[int, str] | None:
        """Next notice: news first, then the end of the group, then a repeat."""
        choices = []
        if s["news_us"] is not None:
            choices.append((s["news_us"], "news"))
        if s["ended_us"] is not None:
            passed = max(0, s["ended_us"] - s["first_us"])
            choices.append((s["first_us"] + -(-passed // s["every"]) * s["every"], "end"))
        elif s["sent_us"] is not None and s["open"] > 0:
            choices.append((s["sent_us"] + s["again"], "repeat"))
        return min(choices) if choices else None

    def fire_until(limit: int) -> None:
        while (item := due()) is not None and item[0] <= limit:
            at, reason = item
            if reason == "end":
                if s["sent_us"] is not None:
                    out.append((*key, "resolved", reason, at, 0))
                s.update(dict.fromkeys(names), open=0)
                return
            if s["ended_us"] is not None and at >= s["ended_us"]:
                s["news_us"] = None  # over before the notice was due
                if s["sent_us"] is None:
                    s.update(dict.fromkeys(names), open=0)
                    return
                continue
            out.append((*key, "firing", reason, at, s["open"]))
            s["sent_us"], s["news_us"] = at, None

    if not state.hasTimedOut:
        for batch in batches:
            columns = (batch[c].tolist() for c in ("at_us", "state", "group_wait", "group_interval", "repeat_interval"))
            rows += [(int(at), kind, int(w), int(e), int(r)) for at, kind, w, e, r in zip(*columns)]
    passed = state.getCurrentWatermarkMs() * 1000
    rows.sort(key=lambda r: r[:2])
    for at, kind, wait, interval, repeat in (r for r in rows if r[0] < passed):
        fire_until(at - 1)
        if kind == "firing":
            s["ended_us"] = None
            s["open"] += 1
            if s["began_us"] is None:
                s.update(
                    began_us=at,
                    first_us=at + wait * MICROS,
                    wait=wait * MICROS,
                    every=interval * MICROS,
                    again=repeat * MICROS,
                )
                s["news_us"] = s["first_us"]
            elif s["news_us"] is None:
                behind = max(0, at - s["first_us"])
                s["news_us"] = s["first_us"] + -(-behind // s["every"]) * s["every"]
        elif s["open"] > 0:
            s["open"] -= 1
            if s["open"] == 0:
                s["ended_us"] = at
    # A transition at the watermark itself still waits, and comes before a notice of that time.
    fire_until(passed - 1)
    rows = [r for r in rows if r[0] >= passed]
    upcoming = due()
    times = [r[0] for r in rows[:1]] + ([upcoming[0]] if upcoming is not None else [])
    if times:
        state.update((*(s[n] for n in names), json.dumps(rows)))
        state.setTimeoutTimestamp(max(min(times) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=[c.split()[0] for c in NOTICES.split(", ")])


SESSIONS = "session_id STRING, session_start_us BIGINT, closed_us BIGINT, ended_by STRING, agent_name STRING, steps_taken BIGINT, errors BIGINT"
SESSION_STATE = "start_us BIGINT, last_us BIGINT, agent_name STRING, steps BIGINT, errors BIGINT, waiting STRING"


def closed_sessions(steps: DataFrame, gap_us: int) -> DataFrame:
    """Agent sessions, closed by their completion event; a quiet gap closes one that has none.

    Input: ``session_id, us, row_id, agent_name, failed, completes`` and the
    watermarked time. Rows wait until the watermark has passed them and are
    then read by time and row, so it makes no difference in which batch one
    arrives. A completion closes the session at its own time (``completed``); a
    row more than ``gap_us`` after the last one, or the watermark, closes it at
    the end of the gap (``gap``). A completion without steps closes a session of
    none. State is a few numbers per key and what waits, which the watermark's
    delay bounds.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, last, agent, count, errors, waiting = state.get if state.exists else (None, None, None, 0, 0, "[]")
        out: list[tuple] = []

        def close(at: int, by: str) -> None:
            nonlocal start, last, agent, count, errors
            out.append((*key, start, at, by, agent, count, errors))
            start, last, agent, count, errors = None, None, None, 0, 0

        rows = [tuple(r) for r in json.loads(waiting)]
        if not state.hasTimedOut:
            for batch in batches:
                columns = (batch[c].tolist() for c in ("us", "row_id", "agent_name", "failed", "completes"))
                rows += [(int(us), int(i), a, bool(f), bool(c)) for us, i, a, f, c in zip(*columns)]
        passed = state.getCurrentWatermarkMs() * 1000
        rows.sort(key=lambda r: r[:2])
        for us, _, name, failed, completes in (r for r in rows if r[0] < passed):
            if last is not None and us - last > gap_us:
                close(last + gap_us, "gap")
            start, last = us if start is None else start, us
            agent = name if agent is None or (name is not None and name > agent) else agent
            count, errors = count + (not completes), errors + failed
            if completes:
                close(us, "completed")
        rows = [r for r in rows if r[0] >= passed]
        if last is not None and last + gap_us < passed:
            close(last + gap_us, "gap")
        times = [r[0] for r in rows[:1]] + ([last + gap_us] if last is not None else [])
        if times:
            state.update((start, last, agent, count, errors, json.dumps(rows)))
            state.setTimeoutTimestamp(max(min(times) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SESSIONS.split(", ")])

    return steps.groupBy("session_id").applyInPandasWithState(advance, SESSIONS, SESSION_STATE, "append", GroupStateTimeout.EventTimeTimeout)


FLUSHES = "source STRING, shard BIGINT, tick BIGINT, part BIGINT, reason STRING, flushed_us BIGINT, n BIGINT, first_us BIGINT, last_us BIGINT, body STRING"
FLUSH_STATE = "tick BIGINT, part BIGINT, held STRING, waiting STRING"


def buffered_flushes(lines: DataFrame, size: int, every_us: int) -> DataFrame:
    """Export buffers per (source, shard): flushed when they hold ``size`` lines, or at the next tick of ``every_us``.

    Input: ``source, shard, us, row_id, line`` and the watermarked time. Rows
    wait until the watermark has passed them and are then read by time and row,
    so it makes no difference in which batch one arrives. A row at a tick belongs
    to the next buffer; a tick without lines flushes nothing; null lines are left
    out. ``part`` numbers the flushes inside a tick. A body has at most ``size``
    lines. What waits is bounded by the watermark's delay; a source with very many
    rows is cut into shards, each a buffer of its own, as each writing process is.
    A Python process holds what one key brings in a micro-batch; for batches without
    a bound ``jobs.flush_batch`` makes the same buffers.
    """
    if size < 1 or every_us < 1:
        raise ValueError("size and every_us are at least 1")

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tick, part, held, waiting = state.get if state.exists else (None, 0, "[]", "[]")
        buffer, out = [tuple(r) for r in json.loads(held)], []

        def flush(reason: str, at: int) -> None:
            nonlocal part, buffer
            out.append((*key, tick, part, reason, at, len(buffer), buffer[0][0], buffer[-1][0], "\n".join(r[2] for r in buffer)))
            part, buffer = part + 1, []

        rows = [tuple(r) for r in json.loads(waiting)]
        if not state.hasTimedOut:
            for batch in batches:
                rows += [(int(us), int(i), t) for us, i, t in zip(batch["us"].tolist(), batch["row_id"].tolist(), batch["line"].tolist()) if t is not None]
        passed = state.getCurrentWatermarkMs() * 1000
        rows.sort()
        for row in (r for r in rows if r[0] < passed):
            if row[0] // every_us != tick:
                if buffer:
                    flush("time", (tick + 1) * every_us)
                tick, part = row[0] // every_us, 0
            buffer.append(row)
            if len(buffer) == size:
                flush("size", row[0])
        rows = [r for r in rows if r[0] >= passed]
        # The number of the part lives as long as its tick.
        if tick is not None and (tick + 1) * every_us <= passed:
            if buffer:
                flush("time", (tick + 1) * every_us)
            tick, part = None, 0
        times = [r[0] for r in rows[:1]] + ([(tick + 1) * every_us] if tick is not None else [])
        if times:
            state.update((tick, part, json.dumps(buffer), json.dumps(rows)))
            state.setTimeoutTimestamp(max(min(times) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in FLUSHES.split(", ")])

    return lines.groupBy("source", "shard").applyInPandasWithState(advance, FLUSHES, FLUSH_STATE, "append", GroupStateTimeout.EventTimeTimeout)
