"""Compare registered queries with their SQL on the test tables.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Spark type -> DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"}, "float": {"FLOAT"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def difference(df, con, sql: str) -> tuple[str, int]:
    """Text that describes the first difference, or '' when both sides agree."""
    cols = sorted(df.columns)
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(kinds) != cols:
        return f"columns {cols} against {sorted(kinds)}", 0
    odd = {c: (df.schema[c].dataType.simpleString(), kinds[c]) for c in cols
           if kinds[c] not in SAME_TYPE.get(df.schema[c].dataType.simpleString(), ())}
    if odd:
        return f"types {odd}", 0
    listed = ", ".join(f'"{c}"' for c in cols)
    mine = [tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    theirs = con.execute(f"SELECT {listed} FROM ({sql}) q").fetchall()
    a, b = (Counter(tuple(map(repr, r)) for r in x) for x in (mine, theirs))
    if a == b:
        return "", len(mine)
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return (f"{len(mine)} rows against {len(theirs)}; {len(only_a)} only here {only_a[:2]}; "
            f"{len(only_b)} only there {only_b[:2]}; columns {cols}"), len(mine)


def main() -> None:
    from statlake.bindings import ORACLES, QUERIES
    from statlake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(8), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                text, n = difference(df, con, ORACLES[name])
                state = "DIFF " + text if text else "ok"
                if not text and n == 0:
                    state = "EMPTY"
            else:
                n, state = len(df.collect()), "rows only"
        except Exception as e:  # noqa: BLE001
            n, state = 0, "ERROR " + str(e)[:1500]
        bad += not (state == "ok" or (state == "rows only" and n))
        print(f"{name:26} {n:8} {time.time() - start:6.2f}s {state}", flush=True)
    print("bad:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
