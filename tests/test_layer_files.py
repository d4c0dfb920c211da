"""The CSV files between the sources and the stored layers: packed, whole, dropped once ingested."""

import os

import pytest
from pyspark.sql import functions as F

from orderloom.plans import queries
from orderloom.plans.shop import Shop
from orderloom.sources import files, schemas


def size(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names)


def test_packed_files_hold_every_row_and_line_break(spark, tmp_path):
    text = F.concat(F.lit('line "one"\nof '), "id", F.lit(',\n"'))
    rows = spark.range(0, 5000, 1, 2).select("id", F.when(F.col("id") % 3 > 0, text).alias("text"))
    for name, layout in (("plain", {}), ("packed", {**files.PACKED, "maxRecordsPerFile": 700})):
        files.write_csv(rows, f"{tmp_path}/{name}.csv", **layout)
    found = files.read_csv(spark, f"{tmp_path}/packed.csv", "id long, text string", typed=True)
    assert sorted(found.collect(), key=str) == sorted(rows.collect(), key=str)
    assert size(tmp_path / "packed.csv") < size(tmp_path / "plain.csv") / 2
    assert sum(f.endswith(".gz") for f in os.listdir(tmp_path / "packed.csv")) == 8


@pytest.mark.parametrize("last", ["silver", "gold"])
def test_files_are_packed_and_dropped_once_ingested(spark, small_folder, monkeypatch, last):
    seen, ingest = {}, files.ingest_csv

    def watched(spark, folder, file_name, *rest, **more):
        path = f"{folder}/{file_name}".removeprefix("file:")
        assert any(f.endswith(".csv.gz") for f in os.listdir(path))
        rows = ingest(spark, folder, file_name, *rest, **more)
        seen[path] = rows
        return rows

    monkeypatch.setattr(files, "ingest_csv", watched)
    shop = Shop.over_fixtures(spark, small_folder)
    schema = queries._layers(shop, last)[last]
    assert len(seen) == len(schemas.SOURCES) and not any(os.path.exists(path) for path in seen)
    assert sorted(seen.values()) == sorted(shop.src[s].count() for s in schemas.SOURCES)
    tables = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    assert tables and all(f.endswith(".zstd.parquet") for t in tables
                          for f in spark.table(f"{schema}.{t}").inputFiles())
