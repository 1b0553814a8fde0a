"""What the append builds land and write takes little room."""

from pathlib import Path

from lakemart.contracts import RAW_FILES
from lakemart.plans import catalog
from lakemart.sources import files
from tests.test_lean import codecs


def test_plain_tables_are_written_compactly(spark, tmp_path):
    files.write_parquet(spark.range(10), str(tmp_path / "t"))
    assert codecs(tmp_path / "t") == {"zstd"}


def test_raw_files_of_the_append_builds_are_compressed(spark, tmp_path, monkeypatch):
    landed = []
    monkeypatch.setattr(catalog.adapters, "raw", lambda spark, folder, name, as_text: spark.createDataFrame(
        [tuple("2001-01-01" for _ in RAW_FILES[name].columns)], RAW_FILES[name].schema))

    def run_all(spark, paths, root, **kwargs):
        landed.extend(p for path in paths.values() for p in Path(path).glob("part-*"))
        return {"daily_sales_gold": spark.range(1)}

    monkeypatch.setattr(catalog.build, "run_all", run_all)
    catalog.append_build_parquet(spark, "").count()
    assert landed and all(p.name.endswith(".csv.gz") for p in landed)
