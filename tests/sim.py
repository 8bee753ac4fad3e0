"""Test-only reference model: a plain-Python sequential simulation of the
merge/flush semantics, used to check the DataFrame kernels."""

from __future__ import annotations


def simulate(messages, period, ttl, t_end):
    """messages: (vin, sensor|None, value, received_at, seq, arr).

    Ticks at every multiple of ``period`` up to ``t_end``; a tick at time T runs
    before any message with arr >= T. Returns {(tick, vin, sensor): (value, received_at, seq)}
    and {(tick): set(vins)}."""
    msgs = sorted(messages, key=lambda m: (m[5], m[4]))
    state = {}       # vin -> {"last_seen": arr, "metrics": {sensor: (ra, seq, value)}}
    out, devs = {}, {}
    first = (msgs[0][5] // period + 1) * period if msgs else t_end + 1
    ticks = list(range(first, t_end + 1, period))
    i = 0

    def flush(t):
        for vin in list(state):
            if ttl is not None and t - state[vin]["last_seen"] > ttl:
                del state[vin]
        live = set()
        for vin, dev in state.items():
            live.add(vin)
            for sensor, (ra, seq, value) in dev["metrics"].items():
                out[(t, vin, sensor)] = (value, ra, seq)
        if live:
            devs[t] = live

    for t in ticks:
        while i < len(msgs) and msgs[i][5] < t:
            vin, sensor, value, ra, seq, arr = msgs[i]
            i += 1
            if not vin:
                continue
            dev = state.setdefault(vin, {"last_seen": arr, "metrics": {}})
            if sensor is not None:
                cur = dev["metrics"].get(sensor, (0, -1, None))
                if ra >= cur[0]:
                    dev["metrics"][sensor] = (ra, seq, value)
            dev["last_seen"] = arr
        flush(t)
    return out, devs


def fold_latest(messages):
    """Latest-wins fold in arrival order: {(vin, sensor): (value, received_at, seq)}."""
    state = {}
    for vin, sensor, value, ra, seq, _arr in sorted(messages, key=lambda m: (m[5], m[4])):
        if not vin or sensor is None:
            continue
        cur = state.get((vin, sensor))
        if ra >= (cur[1] if cur else 0):
            state[(vin, sensor)] = (value, ra, seq)
    return state
