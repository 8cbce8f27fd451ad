"""Compare a query's rows with its SQL equivalent in DuckDB."""

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("d", value.normalize())
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def difference(df, connection, sql):
    """None when both sides hold the same rows under the same names."""
    names = sorted(df.columns)
    cursor = connection.execute(sql)
    theirs = [column[0] for column in cursor.description]
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    order = [theirs.index(name) for name in names]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    found = Counter(tuple(plain(v) for v in row) for row in df.select(*names).collect())
    if expected == found:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"rows {sum(found.values())} != {sum(expected.values())}; columns {names}; "
        f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}"
    )
