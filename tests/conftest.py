import os
import sys
from datetime import date, timedelta

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dailybars import schemas  # noqa: E402
from dailybars.session import local_session  # noqa: E402
from dailybars.sources.tables import TableStore  # noqa: E402


ARROW = {"string": pa.string(), "date": pa.date32(), "double": pa.float64(), "bigint": pa.int64()}


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, "4g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


@pytest.fixture
def make_bars(spark):
    """Bars from (symbol, day, close) or (symbol, day, open, high, low, close, volume) tuples."""

    def make(rows, schema=schemas.RAW_BARS):
        full = [
            row if len(row) == 7 else (row[0], row[1], 10.0, 12.0, 9.0, row[2], 100) for row in rows
        ]
        columns = list(zip(*full)) if full else [()] * len(schema.fields)
        arrow = pa.schema(
            [(field.name, ARROW[field.dataType.simpleString()]) for field in schema.fields]
        )
        arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow)]
        return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)

    return make


@pytest.fixture
def daily():
    """(symbol, day, close) tuples on consecutive days."""

    def rows(symbol, first, closes):
        start = date.fromisoformat(first)
        return [(symbol, start + timedelta(days=i), float(c)) for i, c in enumerate(closes)]

    return rows
