"""Runs a registered query and its SQL side by side and compares all rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

from paymart.queries import ORACLES, QUERIES
from paymart.queries.batch import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, name: str, sf_dir: str) -> int:
    """Number of rows both sides agree on; raises if they differ."""
    df = QUERIES[name](spark, sf_dir)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLES[name])
    columns = [(d[0], str(d[1])) for d in result.description]
    want = _bag([c for c, _ in columns], result.fetchall())

    expected = {c: t for c, t in columns}
    assert sorted(df.columns) == sorted(expected), (df.columns, columns)
    for field in df.schema:
        kind = field.dataType.simpleString()
        kind = KINDS.get(kind, kind.upper().replace(",", ", "))
        have = expected[field.name].replace(", ", ",").replace(",", ", ")
        if sum(want.values()):
            assert have == kind, f"{name}.{field.name}: {kind} against {have}"
    missing, extra = want - got, got - want
    assert not missing and not extra, (
        f"{name}: {sum(missing.values())} missing, {sum(extra.values())} extra; "
        f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
    )
    return sum(got.values())
