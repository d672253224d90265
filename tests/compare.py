"""Row-for-row comparison of a Spark result with a DuckDB result."""

import math


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    theirs = rows_of(theirs_columns, result.fetchall())
    ours_columns = df.columns
    ours = rows_of(ours_columns, [tuple(r) for r in df.collect()])
    if sorted(ours_columns) != sorted(theirs_columns):
        return f"columns {sorted(ours_columns)} <> {sorted(theirs_columns)}"
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:3]
        only_theirs = [r for r in theirs if r not in set(ours)][:3]
        return f"{len(ours)} rows <> {len(theirs)}; only here {only_ours}; only there {only_theirs}"
    return None
