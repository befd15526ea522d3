import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tissueframe.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                    spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


class Grid:
    """Dense label arrays to run tables and back."""

    schema = "chip long, label long, y long, x0 long, x1 long"

    def __init__(self, spark):
        self.spark = spark

    def runs(self, arr, chip=0):
        rows = []
        for y, line in enumerate(np.asarray(arr)):
            x = 0
            while x < len(line):
                if line[x]:
                    x0 = x
                    while x + 1 < len(line) and line[x + 1] == line[x0]:
                        x += 1
                    rows.append((chip, int(line[x0]), y, x0, x))
                x += 1
        return self.spark.createDataFrame(rows, self.schema)

    @staticmethod
    def dense(df, shape, value="label"):
        out = np.zeros(shape, dtype=np.int64)
        for r in df.collect():
            assert (out[r["y"], r["x0"]:r["x1"] + 1] == 0).all(), "runs overlap"
            out[r["y"], r["x0"]:r["x1"] + 1] = r[value]
        return out


@pytest.fixture(scope="session")
def grid(spark):
    return Grid(spark)


def flood(mask, conn):
    """Reference labelling: 1.. in raster order of the first pixel."""
    steps = [(-1, 0), (1, 0), (0, -1), (0, 1)] + ([(-1, -1), (-1, 1), (1, -1), (1, 1)] if conn == 8 else [])
    out, n = np.zeros(mask.shape, dtype=np.int64), 0
    for y, x in zip(*np.nonzero(mask)):
        if out[y, x]:
            continue
        n += 1
        stack = [(y, x)]
        out[y, x] = n
        while stack:
            a, b = stack.pop()
            for dy, dx in steps:
                c, d = a + dy, b + dx
                if 0 <= c < mask.shape[0] and 0 <= d < mask.shape[1] and mask[c, d] and not out[c, d]:
                    out[c, d] = n
                    stack.append((c, d))
    return out
