"""Equivalent SQL for the registered queries, for comparison by another engine."""

from orderlens.sources.sample import PHYSICAL, with_tables

from oracle import cleaning, cleanlog, cleanops, features, ml, reports, sqlbank, stats, streaming

_NAMES = {n: n for n in PHYSICAL}


def _wrap(text: str, extra: dict[str, str] | None = None) -> str:
    body = text.strip()
    full = with_tables("<BODY>" + body, "duckdb", _NAMES, extra)
    head, _, _ = full.partition("<BODY>")
    if body.upper().startswith("WITH ") and head:
        return head.rstrip() + ",\n" + body[5:]
    return head + body


def all_sql() -> dict[str, str]:
    out = {k: _wrap(v) for k, v in sqlbank.SQL.items()}
    out |= {k: _wrap(v, cleaning.TABLES) for k, v in cleaning.SQL.items()}
    out |= {k: _wrap(v, cleanops.EXTRA) for k, v in cleanops.SQL.items()}
    out |= {k: _wrap(v, features.TABLES) for k, v in features.SQL.items()}
    out |= {k: _wrap(v, reports.TABLES) for k, v in reports.SQL.items()}
    out |= {k: _wrap(v, stats.TABLES) for k, v in stats.SQL.items()}
    out |= {k: _wrap(v, ml.TABLES) for k, v in ml.SQL.items()}
    out |= {k: _wrap(v) for k, v in streaming.SQL.items()}
    out |= {k: _wrap(v, cleanlog.TABLES) for k, v in cleanlog.SQL.items()}
    return out
