from tidemark.functions.time import (  # noqa: F401
    epoch_ms, fmt_date, fmt_datetime, ms_to_local, rowtime, rowtime_instant, to_date, to_ts,
    to_ymd_hms, wall_clock,
)
from tidemark.functions.text import (  # noqa: F401
    is_empty, register_tokenizer, split_list, tokens,
)
