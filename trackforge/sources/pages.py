"""Recorded pages of browsing answers, read as a Python data source.

Layout: ``<folder>/<recording>/<offset>.json``, each file one page: an object
with the list ``releases`` and the number ``release-count``.  The folder is a
path or an address that all executors reach.  Pages are never put together in
one task: a partition holds ``pagesPerPartition`` of them (1 unless given), and
filters on ``recording`` by equality or list leave other folders unlisted.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

PAGE, MOST = 100, 1000
SCHEMA = "recording string, offset int, total int, releases array<string>"


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@dataclass
class Pages(InputPartition):
    """Paths of the pages of one partition with their recordings and offsets."""

    files: list[tuple[str, int, str]]


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.each = options["path"], int(options.get("pagesPerPartition", "1"))
        self.wanted: set[str] | None = None  # all recordings

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("recording",):
                values = {str(v) for v in (f.value if isinstance(f, In) else (f.value,)) if v is not None}
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[Pages]:
        store, root = _opened(self.folder)
        if self.wanted is None:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
        else:
            folders = (fs.FileSelector(f"{root}/{r}", allow_not_found=True) for r in sorted(self.wanted) if r and "/" not in r and r not in (".", ".."))
            found = [i for selector in folders for i in store.get_file_info(selector)]
        pages = [(i.path.split("/")[-2], i.base_name.removesuffix(".json"), i.path) for i in found if i.is_file and i.path.endswith(".json")]
        files = sorted((recording, int(offset), path) for recording, offset, path in pages if offset.isdigit())
        return [Pages(files[i : i + self.each]) for i in range(0, len(files), self.each)]

    def read(self, partition: Pages | None) -> Iterator[tuple]:
        store, _ = _opened(self.folder)
        for recording, offset, path in partition.files if partition else ():  # Spark makes one partition of no pages None
            with store.open_input_stream(path) as stream:
                page = json.loads(stream.read())
            if not isinstance(page, dict):
                raise ValueError(f"{path} holds no object")
            yield recording, offset, page.get("release-count"), [json.dumps(x, ensure_ascii=False) for x in page.get("releases") or ()]


class RecordedPages(DataSource):
    """spark.read.format("recorded_pages").load(folder), once ``read_pages`` or ``register`` has named it."""

    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def register(spark: SparkSession) -> None:
    """Name the source in this session and let filters reach Python sources, without which Spark refuses one that takes filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordedPages)


def read_pages(spark: SparkSession, folder: str, pages_per_partition: int = 1) -> DataFrame:
    """recording, offset, total, releases (JSON texts) of every recorded page."""
    register(spark)
    return spark.read.format("recorded_pages").option("pagesPerPartition", pages_per_partition).load(folder)


def collected_releases(pages: DataFrame, page_size: int = PAGE, most: int = MOST) -> DataFrame:
    """recording, position, release of pages (recording, offset, releases) as one reads them in turn.

    Reading starts at offset 0 and ends after a page that is empty or short,
    before one that is not there, and once ``most`` releases are reached.  The
    window holds a recording's offsets and sizes, not its releases.
    """
    turn = Window.partitionBy("recording").orderBy("offset")
    before = turn.rowsBetween(Window.unboundedPreceding, -1)
    first = pages.filter((F.col("offset") % page_size == 0) & (F.col("offset") < most))
    read = first.select("recording", "offset", F.size("releases").alias("n")).filter("recording <> ''")
    read = read.withColumn("no", F.row_number().over(turn)).withColumn("full", F.coalesce(F.min("n").over(before), F.lit(page_size)) >= page_size)
    kept = read.filter("full").filter(F.col("offset") == (F.col("no") - 1) * page_size).select("recording", "offset")
    return first.join(kept, ["recording", "offset"]).select("recording", "offset", F.posexplode("releases").alias("i", "release")).select(
        "recording", (F.col("offset") + F.col("i")).alias("position"), "release"
    ).filter(F.col("position") < most)
