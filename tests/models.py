"""Plain sequential state machines of the reference's keyed rules, used as
independent checks of the batch forms. Input rows are dicts; arrival order
is (ts, seq)."""

from datetime import datetime, timezone

DAY = 86400000


def _date(ms):
    return datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d")


def visitor_flag(rows):
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        flag, cur = r["is_new"], _date(r["ts"])
        last = state.get(r["mid"])
        if flag == "1":
            if not last:
                state[r["mid"]] = cur
            elif last != cur:
                flag = "0"
        elif not last:
            state[r["mid"]] = _date(r["ts"] - DAY)
        out[r["seq"]] = flag
    return out


def unique_visitor(rows):
    state, kept = {}, []
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        if r["lp"] is not None:
            continue
        cur = _date(r["ts"])
        if not state.get(r["mid"]) or state[r["mid"]] != cur:
            state[r["mid"]] = cur
            kept.append(r["seq"])
    return sorted(kept)


def bounce(rows, within):
    """Pattern 'empty then next empty, within' with timeouts, per device."""
    pending, out = {}, []
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        p = pending.pop(r["mid"], None)
        empty = not r["lp"]
        if p is not None and (r["ts"] - p["ts"] >= within or empty):
            out.append(p["seq"])
        if empty:
            pending[r["mid"]] = r
    out.extend(p["seq"] for p in pending.values())   # bounded input: all time out
    return sorted(out)


def config_fold(changes):
    state = {}
    for op, before, after in changes:
        if op == "d":
            state.pop(before["source_table"], None)
        else:
            state[after["source_table"]] = after["sink_table"]
    return state
