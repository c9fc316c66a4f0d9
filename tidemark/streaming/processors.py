"""The stateful processor of streaming T1 (flag repair).

A device's anchor date is kept for ever, so it lives in RocksDB-backed state
(``groupBy("mid").transformWithStateInPandas``): one short string per device.
Rows arrive as Arrow batches; once the anchor is known they pass through one by
one, with vectorised column operations.
"""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

DAY_MS = 24 * 60 * 60 * 1000


def _zone(name: str):
    return timezone.utc if name.upper() in ("UTC", "Z", "GMT") else ZoneInfo(name)


def _date(ms: int, tz) -> str:
    return datetime.fromtimestamp(ms / 1000, tz).strftime("%Y-%m-%d")


def _dates(ms: pd.Series, tz) -> pd.Series:
    t = pd.to_datetime(ms.astype("int64"), unit="ms", utc=True)
    if tz is not timezone.utc:
        t = t.dt.tz_convert(tz)
    return t.dt.strftime("%Y-%m-%d").reset_index(drop=True)


# Input columns: mid, seq, ts, is_new, value.
VISITOR_OUT = "mid string, seq bigint, ts bigint, is_new_in string, is_new string, value string"


class VisitorFlagProcessor(StatefulProcessor):
    """The anchor date is written once, by the device's first record;
    later ``is_new = '1'`` records on another date become ``'0'``. No TTL
    (as in the reference)."""

    def __init__(self, zone: str = "UTC"):
        self.zone = zone

    def init(self, handle):
        self.tz = _zone(self.zone)
        self.anchor = handle.getValueState("anchor", "anchor string")

    def handleInputRows(self, key, rows, timerValues):
        if not self.anchor.exists():
            # the device's first batch: its earliest record sets the anchor
            held, first = [], None
            for pdf in rows:
                held.append(pdf)
                for ts, _, is_new in pdf.sort_values(["ts", "seq"])[["ts", "seq", "is_new"]].head(1).values:
                    if first is None or (ts, _) < first[:2]:
                        first = (ts, _, is_new)
            if first is None:
                return
            day = int(first[0]) if first[2] == "1" else int(first[0]) - DAY_MS
            self.anchor.update((_date(day, self.tz),))
            rows = held
        anchor = self.anchor.get()[0]
        for pdf in rows:  # known anchor: batch by batch, nothing is gathered
            if pdf.empty:
                continue
            changed = (pdf["is_new"] == "1") & (_dates(pdf["ts"], self.tz).set_axis(pdf.index) != anchor)
            yield pd.DataFrame({
                "mid": key[0], "seq": pdf["seq"], "ts": pdf["ts"], "is_new_in": pdf["is_new"],
                "is_new": pdf["is_new"].where(~changed, "0"), "value": pdf["value"]})

    def close(self):
        pass
