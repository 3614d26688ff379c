"""Fixed-length big-endian records of the polarimeter's level 2 files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import sinusoidal_lat, sinusoidal_lon

HEADER, SLOPE = 180, 2e-3


def _decode(content: bytes, land: bool) -> pd.DataFrame:
    """Record number, line, column and optical depths. A record whose number isn't the next starts a byte too late, as
    do all after it."""
    count, length = (int.from_bytes(content[i : i + 4], "big") for i in (52, 56))
    raw = np.frombuffer(content, "u1")
    at = HEADER + np.arange(count, dtype="int64") * length
    fits = lambda a: a[a + 24 <= len(raw)]
    at = fits(at)
    number = lambda a, n: sum(raw[a + k].astype("int64") << 8 * (n - 1 - k) for k in range(n))
    want, start = np.arange(2, len(at) + 2), 0
    while len(off := np.flatnonzero(number(at[start:], 4) != want[start:])):
        start += off[0] + 1
        at[start - 1 :] -= 1
    out = {"record": np.arange(2, len(at) + 2), "line": number(at + 6, 2), "column": number(at + 8, 2)}
    if land:
        return pd.DataFrame(out | {"aot": number(at + 10, 2)})
    return pd.DataFrame(out | {"aot_865": number(at + 20, 2), "aot_670": number(at + 22, 2)})


def read_polarimeter(files: DataFrame, land: bool) -> DataFrame:
    """binaryFile rows (path, content) to pixels with lat, lon and optical depths."""
    fields = ["aot"] if land else ["aot_865", "aot_670"]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                yield _decode(content, land).assign(path=path)[["path", "record", "line", "column", *fields]]

    rows = files.select("path", "content").mapInPandas(decode, "path string, record long, line long, column long, " + ", ".join(f"{f} long" for f in fields))
    rows = rows.withColumns({f: F.col(f) * SLOPE for f in fields})
    return rows.withColumns({"lat": sinusoidal_lat(F.col("line")), "lon": sinusoidal_lon(F.col("line"), F.col("column"))})


def dateline_bbox(df: DataFrame, *keys: str) -> DataFrame:
    """Longitudes from west to east: where they span the date line, from the least positive to the greatest negative one."""
    box = df.groupBy(*keys).agg(
        F.min("lon").alias("lo"), F.max("lon").alias("hi"), F.min(F.when(F.col("lon") > 0, F.col("lon"))).alias("least_east"), F.max(F.when(F.col("lon") < 0, F.col("lon"))).alias("most_west")
    )
    over = (F.col("lo") * F.col("hi") < 0) & (F.col("hi") - F.col("lo") > 270)
    return box.select(*keys, F.when(over, F.col("least_east")).otherwise(F.col("lo")).alias("lon_min"), F.when(over, F.col("most_west")).otherwise(F.col("hi")).alias("lon_max"))
