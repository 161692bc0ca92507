"""Run registered queries beside their check SQL and compare the rows."""

import glob
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

# The name each engine gives to a type that results may have.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value.normalize())
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def check_rows(sf_dir, sql):
    """Column names, types and rows of the check SQL."""
    with duckdb.connect() as db:
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
        found = db.sql(sql)
        return found.columns, [str(t) for t in found.types], found.fetchall()


def differences(frame, sf_dir, sql):
    """A description of how the results differ; empty when they are equal."""
    columns, types, rows = check_rows(sf_dir, sql)
    want = sorted(zip(columns, types))
    have = sorted((f.name, TYPES[f.dataType.simpleString()]) for f in frame.schema.fields)
    if have != want:
        return f"columns {have} != {want}"
    want = sorted_rows(columns, rows)
    have = sorted_rows(frame.columns, frame.collect())
    if have == want:
        return ""
    extra, missing = Counter(have) - Counter(want), Counter(want) - Counter(have)
    return (
        f"{len(have)} rows, want {len(want)}; "
        f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    )
