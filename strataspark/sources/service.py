"""Index service (S3): sheets of the years and the box that a query asks for, page by page.

A service answers GetFeature requests with index elements in XML. ``source`` makes a data source of it whose partitions are
years: filters on the year choose partitions, filters on the sides of sheets become the request's box, and a partition asks
for pages until one is not full. Spark applies all filters again, so a service may answer with more than it was asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlencode
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from strataspark.functions.grid import SIDES
from strataspark.sources.index import INDEX_FIELDS

PAGE, TIMEOUT = 1000, (15.0, 60.0)
#: Fixed values of the protocol.
REQUEST = {"service": "WFS", "version": "2.0.0", "request": "GetFeature", "outputFormat": "text/xml; subType=gml/3.1.1"}
COLUMNS = ", ".join(["rok int", *(f"{f} string" for f in INDEX_FIELDS), *(f"{s} double" for s in SIDES), "lp long"])

#: (url, timeouts) to (status, content type, bytes); may raise TimeoutError or ConnectionError.
Fetch = Callable[[str, tuple[float, float]], tuple[int, str, bytes]]


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def elements(body: bytes, tag: str) -> tuple[int, list[tuple]]:
    """(number of index elements of a page, their fields and bounds); elements without both corners have no row."""
    count, rows = 0, []
    for entry in ElementTree.fromstring(body).iter():
        if local(entry.tag) != tag:
            continue
        count += 1
        fields = {local(e.tag): (e.text or "").strip() or None for e in entry.iter()}
        try:
            corners = [float(v) for c in ("lowerCorner", "upperCorner") for v in fields[c].split()[:2]]
        except (KeyError, AttributeError, ValueError):
            continue
        if len(corners) == 4:
            rows.append((*(fields.get(f) for f in INDEX_FIELDS), *corners))
    return count, rows


@dataclass
class Year(InputPartition):
    year: int


class ServiceReader(DataSourceReader):
    def __init__(self, fetch: Fetch, layers: dict[int, tuple[str, str]], tag: str, page: int, tries: int):
        self.fetch, self.layers, self.tag, self.page, self.tries = fetch, layers, tag, page, tries
        self.years = set(layers)
        self.box = [None, None, None, None]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Years and sides narrow the request; every filter is left to Spark as well."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("rok",):
                self.years &= {f.value} if isinstance(f, EqualTo) else set(f.value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == ("rok",):
                keep = {GreaterThan: int.__gt__, GreaterThanOrEqual: int.__ge__, LessThan: int.__lt__, LessThanOrEqual: int.__le__}[type(f)]
                self.years = {y for y in self.years if keep(y, f.value)}
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute in (("right",), ("top",)):
                k = 0 if f.attribute == ("right",) else 1  # a sheet must reach beyond the box's left or lower side
                self.box[k] = f.value if self.box[k] is None else max(self.box[k], f.value)
            elif isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute in (("left",), ("bottom",)):
                k = 2 if f.attribute == ("left",) else 3
                self.box[k] = f.value if self.box[k] is None else min(self.box[k], f.value)
            yield f

    def partitions(self) -> list[Year]:
        return [Year(y) for y in sorted(self.years)]

    def read(self, partition: Year) -> Iterator[tuple]:
        service, layer = self.layers[partition.year]
        asked = REQUEST | {"typeNames": layer, "count": self.page}
        if all(v is not None for v in self.box):
            asked["bbox"] = ",".join(f"{v:.15g}" for v in self.box)
        start = 0
        while True:
            count, rows = elements(self._page(f"{service}?{urlencode(asked | {'startIndex': start})}"), self.tag)
            for k, row in enumerate(rows):
                yield (partition.year, *row, start + k)
            start += self.page
            if count < self.page:
                return

    def _page(self, url: str) -> bytes:
        why = ""
        for _ in range(self.tries):
            try:
                status, _, body = self.fetch(url, TIMEOUT)
            except (TimeoutError, ConnectionError) as e:
                why = str(e) or type(e).__name__
                continue
            if status == 200:
                return body
            why = f"status {status}"
            if status != 429 and status < 500:
                break
        raise ConnectionError(f"{url}: {why}")


def source(fetch: Fetch, layers: dict[int, tuple[str, str]], tag: str, page: int = PAGE, tries: int = 3) -> type[DataSource]:
    """A data source ``sheet_index`` over ``layers``: the service's url and layer of each year. ``tag``: an element's name."""

    class SheetIndex(DataSource):
        @classmethod
        def name(cls) -> str:
            return "sheet_index"

        def schema(self) -> str:
            return COLUMNS

        def reader(self, schema) -> ServiceReader:
            return ServiceReader(fetch, layers, tag, page, tries)

    return SheetIndex


def read_service(spark: SparkSession, fetch: Fetch, layers: dict[int, tuple[str, str]], tag: str, page: int = PAGE, tries: int = 3) -> DataFrame:
    """(rok, fields, left, bottom, right, top, lp) of all years; ``lp`` is the place in a year's answers, gaps included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source(fetch, layers, tag, page, tries))
    return spark.read.format("sheet_index").load()


def near(index: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Sheets that share a point with a box, in filters that the request takes over."""
    left, bottom, right, top = map(float, box)
    return index.where((index["right"] >= left) & (index["top"] >= bottom) & (index["left"] <= right) & (index["bottom"] <= top))
