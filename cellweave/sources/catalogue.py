"""Saved pages of a product catalogue as a data source.

A page lies under a folder whose name ends in `skip=N`, as the address it was asked for does, and holds `value`, a list of
entries, and `@odata.nextLink`, whose last number is the skip of the page that follows. A chain begins at the smallest
number of a folder. Pages that no link leads to are not part of it.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
)

from ..session import setting
from .files import listed, place

SCHEMA = "name string, mission string, tile string, measurement_day long, date timestamp, published timestamp, input_path string, size long, online boolean, x0 double, y0 double, x1 double, y1 double, outline array<array<double>>"
TYPES = [
    pa.string(), pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.timestamp("us", "UTC"), pa.string(), pa.int64(), pa.bool_(),
    *[pa.float64()] * 4, pa.list_(pa.list_(pa.float64())),
]
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
PAGES, TASKS, SAVED = 16, 1024, 64  # pages of a task; tasks at most of a reading, which then have more pages each; pages at once of a task that saves
PEEK, THREADS, LOCAL = 4096, 32, 2  # bytes at both ends of a page that are read for its link; how many pages at once, and of a local folder, where more only wait for each other
LINK = re.compile(rb'"@odata\.nextLink"\s*:\s*"[^"]*=([0-9]+)"')
NUMBER = re.compile(r"-?[0-9.]+(?:[eE][-+]?[0-9]+)?")
SKIP = re.compile(r"skip=([0-9]+)(?:/|$)")


def instant(text: str | None) -> datetime.datetime | None:
    """A time of the catalogue in UTC; text that is none gives null."""
    try:
        found = datetime.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except (AttributeError, ValueError):
        return None
    return found if found.tzinfo else found.replace(tzinfo=datetime.UTC)


def outline_of(entry: dict) -> list[list[float]] | None:
    """The outer ring of an entry's footprint as points, from its GeoJSON or else its text form."""
    shape = entry.get("GeoFootprint") or {}
    if shape.get("type") == "Polygon":
        return [[float(p[0]), float(p[1])] for p in shape["coordinates"][0]]
    text = entry.get("Footprint") or ""
    if "POLYGON" not in text:
        return None
    ring = text[text.index("POLYGON") :].split(")")[0]
    numbers = [float(x) for x in NUMBER.findall(ring)]
    return [list(p) for p in zip(numbers[::2], numbers[1::2], strict=False)]


def entry_row(entry: dict) -> tuple:
    """The columns of an entry. Mission, day and tile stand in the name's first, third and sixth part; where it has no
    such part they are null, and so is whatever else is missing."""
    name = entry.get("Name") or ""
    parts = name.split("_")
    day = parts[2].split("T")[0] if len(parts) > 2 else ""
    ring = outline_of(entry)
    xs, ys = ([p[k] for p in ring] for k in (0, 1)) if ring else ((), ())
    box = (min(xs), min(ys), max(xs), max(ys)) if ring else (None,) * 4
    return (
        entry.get("Name"), parts[0][:2] or None, parts[5] if len(parts) > 5 else None, int(day) if day.isdigit() else None, instant((entry.get("ContentDate") or {}).get("Start")),
        instant(entry.get("PublicationDate")), entry.get("S3Path"), entry.get("ContentLength"), entry.get("Online"), *box, ring,
    )


def next_skip(page: dict) -> int | None:
    link = page.get("@odata.nextLink")
    return int(link.split("=")[-1]) if link else None


TESTS = {
    EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x in v, StringContains: lambda x, v: v in x, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v),
}
PUSHED = set(NAMES) - {"outline"}


def comparable(value):
    return value.replace(tzinfo=datetime.UTC) if isinstance(value, datetime.datetime) and value.tzinfo is None else value


def link_of(system, path: str, size: int) -> int | None | str:
    """The skip of the page that follows, None at a chain's end, or "broken". A page names it at its end or beginning, so
    that is all that is read of it; a page that names none there is read in whole."""
    with system.open_input_file(path) as f:
        head, tail = f.read_at(min(size, PEEK), 0), f.read_at(min(size, PEEK), max(0, size - PEEK))
        for text in (tail, head):
            if (m := LINK.search(text)) and tail.rstrip().endswith(b"}"):
                return int(m[1])
        try:
            page = json.loads(f.read_at(size, 0))
            page["value"]
            return next_skip(page)
        except (ValueError, TypeError, KeyError, AttributeError):
            return "broken"


@dataclass
class PageRange(InputPartition):
    """Consecutive pages of one chain."""

    pages: list[str]


@dataclass
class CatalogueReader(DataSourceReader):
    path: str
    broken: str  # error, or skip: a page that is no JSON gives no rows, and the next one that is there follows
    pages: int
    filters: list[Filter] = field(default_factory=list)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons with values and searches in text; each entry is tested as its page is read."""
        for f in filters:
            if type(f) in TESTS and len(f.attribute) == 1 and f.attribute[0] in PUSHED:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[PageRange]:
        """Follows the links of each chain; their pages are read side by side, as far as their links, and no entry is."""
        system, _ = place(self.path)
        chains: dict[str, dict[int, tuple[str, int]]] = {}
        for path, size in listed(self.path):
            if m := SKIP.search(path.rsplit("/", 1)[0]):
                chains.setdefault(path[: m.start()], {})[int(m[1])] = path, size
        runs = []
        with ThreadPoolExecutor(LOCAL if system.type_name == "local" else THREADS) as threads:
            for chain in chains.values():
                numbers = sorted(chain)
                links = dict(zip(numbers, threads.map(lambda n: link_of(system, *chain[n]), numbers), strict=True))  # noqa: B023
                run, at = [], numbers[0]
                while at is not None:
                    run.append(chain[at][0])
                    after = links[at]
                    if after == "broken" or (self.broken == "skip" and after is not None and after not in chain):
                        after = min((n for n in numbers if n > at), default=None)
                    if after is not None and (after not in chain or after <= at):
                        raise ValueError(f"page {chain[at][0]} leads to {after}, which is not there or not further on")
                    at = after
                runs.append(run)
        width = max(self.pages, -(-sum(map(len, runs)) // TASKS))
        return [PageRange(run[k : k + width]) for run in runs for k in range(0, len(run), width)] or [PageRange([])]

    def keeps(self, row: tuple) -> bool:
        for f in self.filters:
            x = row[NAMES.index(f.attribute[0])]
            if x is None or not TESTS[type(f)](x, [comparable(v) for v in f.value] if isinstance(f, In) else comparable(f.value)):
                return False
        return True

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        system, _ = place(self.path)
        for path in partition.pages:
            with system.open_input_stream(path) as f:
                text = f.read()
            try:
                found = [row for e in json.loads(text)["value"] if self.keeps(row := entry_row(e))]
            except (ValueError, TypeError, KeyError, AttributeError) as e:
                if self.broken == "skip":
                    continue
                raise ValueError(f"page {path} of the catalogue is broken: {e}") from e
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), TYPES, strict=True)], NAMES)


class Catalogue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "catalogue"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CatalogueReader:
        return CatalogueReader(self.options["path"], self.options.get("broken", "error"), int(self.options.get("pages", PAGES)))


def read_catalogue(spark: SparkSession, path: str, broken: str = "error", pages: int = PAGES) -> DataFrame:
    """The entries of all chains of pages under a folder, a task for so many pages, or more where that would be over TASKS
    tasks; a task holds one page at a time. Filters on columns are tested while
    pages are read; Spark's setting that lets it pass them on is switched on for the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Catalogue)
    return spark.read.format("catalogue").option("broken", broken).option("pages", str(pages)).load(path)


def meets(outline: Column, area: list[tuple[float, float]]) -> Column:
    """Whether a ring and the ring of an area meet: a point of one lies in the other, or sides cross. Rings may be open or
    closed; null outlines meet nothing."""
    ring = [(float(x), float(y)) for x, y in area]
    ring = ring[:-1] if ring[0] == ring[-1] else ring
    sides = list(zip(ring, ring[1:] + ring[:1], strict=True))
    n = F.size(outline)

    def point(k: Column) -> tuple[Column, Column]:
        p = F.get(outline, F.pmod(k, n))
        return F.get(p, F.lit(0)), F.get(p, F.lit(1))

    def turn(a, b, c) -> Column:
        return F.signum((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))

    def crossed(k: Column) -> Column:
        a, b = point(k), point(k + 1)
        found = F.lit(False)
        for (px, py), (qx, qy) in sides:
            p, q = (F.lit(px), F.lit(py)), (F.lit(qx), F.lit(qy))
            found = found | ((turn(a, b, p) * turn(a, b, q) < 0) & (turn(p, q, a) * turn(p, q, b) < 0))
        return found

    def holds(k: Column) -> Column:
        """Whether the ray to the right of the area's first point crosses the side."""
        a, b = point(k), point(k + 1)
        x, y = ring[0]
        return ((a[1] > y) != (b[1] > y)) & (F.lit(x) < a[0] + (F.lit(y) - a[1]) * (b[0] - a[0]) / F.when(b[1] == a[1], 1.0).otherwise(b[1] - a[1]))

    def inside(k: Column) -> Column:
        x, y = point(k)
        odd = F.lit(0)
        for (px, py), (qx, qy) in sides:
            if py != qy:
                odd = odd + F.when(((F.lit(py) > y) != (F.lit(qy) > y)) & (x < F.lit(px) + (y - py) * (qx - px) / (qy - py)), 1).otherwise(0)
        return odd % 2 == 1

    places = F.sequence(F.lit(0), n - 1)
    around = F.size(F.filter(places, holds)) % 2 == 1
    return (n > 2) & (around | F.exists(places, inside) | F.exists(places, crossed))


def candidate_inputs(entries: DataFrame, condition: str, contains: str, today: datetime.date, published_days: int, measured_days: int,
                     tiles: list[str] | None = None, area: list[tuple[float, float]] | None = None) -> DataFrame:
    """Entries that may become inputs of a processing condition: name, published and measured within so many days before
    today (first and last day whole, ends themselves not), tile of the list if there is one, footprint meeting the area if
    there is one. Entries without what a filter looks at are left out."""

    def within(column: str, days: int) -> Column:
        first = datetime.datetime.combine(today - datetime.timedelta(days=days), datetime.time(), datetime.UTC)
        last = datetime.datetime.combine(today, datetime.time(23, 59, 59, 999000), datetime.UTC)
        return (F.col(column) > F.lit(first)) & (F.col(column) < F.lit(last))

    some = entries.where(F.col("name").contains(contains)).where(within("published", published_days)).where(within("date", measured_days))
    if tiles is not None:
        some = some.where(F.col("tile").isin(tiles))
    if area is not None:
        xs, ys = zip(*area, strict=True)
        some = some.where((F.col("x0") <= max(xs)) & (F.col("x1") >= min(xs)) & (F.col("y0") <= max(ys)) & (F.col("y1") >= min(ys))).where(meets(F.col("outline"), area))
    return some.select(F.lit(condition).alias("processing_condition_name"), "date", "tile", "measurement_day", "input_path", "mission")


def write_pages(entries: DataFrame, path: str, page: str, entry: Column, last: int) -> None:
    """Saves entries as pages: page is the column with a page's number from 0 to last; empty ones are there too, so that
    the chain is whole. Tasks move each page to its place themselves, so no commit goes over all of them, and one that is
    written again replaces itself. The folder must be new."""
    spark = entries.sparkSession
    system, top = place(path)
    if system.get_file_info(top).type != fs.FileType.NotFound:
        raise ValueError(f"{path} is there already")
    filled = entries.groupBy(F.col(page).cast("bigint").alias("skip")).agg(F.collect_list(entry).alias("value"))  # a page at most
    kind = filled.schema["value"].dataType
    pages = spark.range(last + 1).withColumnRenamed("id", "skip").join(filled, "skip", "left").withColumn("value", F.coalesce("value", F.array().cast(kind)))
    link = F.when(F.col("skip") < last, F.concat(F.lit("https://catalogue/products?$skip="), (F.col("skip") + 1).cast("string")))
    text = pages.select("skip", F.to_json(F.struct("value", link.alias("@odata.nextLink"))).alias("text"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = place(path)
        for batch in batches:
            for skip, text in zip(*[batch[c].to_pylist() for c in ("skip", "text")], strict=True):
                folder = f"{top}/skip={skip}"
                temporary = f"{folder}/_{uuid.uuid4().hex}"
                system.create_dir(folder)
                with system.open_output_stream(temporary) as f:
                    f.write(text.encode())
                system.move(temporary, f"{folder}/page.json")
            yield batch.select(["skip"])

    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", SAVED):
        text.mapInArrow(save, "skip bigint").write.format("noop").mode("overwrite").save()
