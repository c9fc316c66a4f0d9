import json

from tidemark.operators.parse import parse_log
from tidemark.operators.split import page_records
from tidemark.sources.logs import from_rows

D1 = 1704067200000  # 2024-01-01 00:00:00 UTC
DAY = 86400000


def log_line(mid, ts, is_new=None, last_page_id=None, page=True, **extra):
    common = {"mid": mid}
    if is_new is not None:
        common["is_new"] = is_new
    rec = {"common": common, "ts": ts}
    if page:
        p = {"page_id": "home"}
        if last_page_id is not None:
            p["last_page_id"] = last_page_id
        rec["page"] = p
    rec.update(extra)
    return json.dumps(rec)


def parsed(spark, lines):
    return parse_log(from_rows(spark, lines))


def pages(spark, lines):
    return page_records(parsed(spark, lines))


def by_seq(df, *cols):
    return {r["seq"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]]
            for r in df.select("seq", *cols).collect()}


def seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())


def parse_values(df):
    return [json.loads(r["value"]) for r in df.select("value").collect()]


__all__ = ["D1", "DAY", "log_line", "parsed", "pages", "by_seq", "seqs", "parse_values"]
