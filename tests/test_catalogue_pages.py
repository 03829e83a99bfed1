"""Pages of a catalogue at size: few tasks, and no commit over all pages."""

import json

from pyspark.sql import functions as F

from cellweave.sources import catalogue as C


def saved(spark, path, pages):
    entries = spark.range(pages * 3).selectExpr("id", "id div 3 as p").where("p <> 2")
    C.write_pages(entries, path, "p", F.struct(F.concat(F.lit("S"), F.col("id").cast("string")).alias("Name")), pages - 1)


def test_pages_are_moved_to_their_places_by_tasks(spark, tmp_path):
    saved(spark, f"file://{tmp_path}/c", 5)
    files = sorted(p.relative_to(tmp_path / "c").as_posix() for p in (tmp_path / "c").rglob("*") if p.is_file())
    assert files == [f"skip={k}/page.json" for k in range(5)]
    assert json.loads((tmp_path / "c/skip=2/page.json").read_text())["value"] == []
    assert sorted(int(r.name[1:]) for r in C.read_catalogue(spark, f"file://{tmp_path}/c").select("name").collect()) == [k for k in range(15) if k // 3 != 2]


def test_tasks_of_a_reading_are_bounded_and_have_every_page_once(spark, tmp_path, monkeypatch):
    saved(spark, f"file://{tmp_path}/c", 50)
    monkeypatch.setattr(C, "TASKS", 7)
    ranges = C.CatalogueReader(f"file://{tmp_path}/c", "error", 4).partitions()
    pages = [p for r in ranges for p in r.pages]
    assert len(ranges) <= 7 and len(pages) == len(set(pages)) == 50
    assert pages == [f"{tmp_path}/c/skip={k}/page.json" for k in range(50)]
