"""Archives and downloads (S4-S8, S18): members of ZIP files as rows, fetching with retries."""

from __future__ import annotations

import io
import time
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.operators.catalog import first_of
from strataspark.sources.ascii import is_ascii_name, kept_variant
from strataspark.sources.files import opened


def members(archives: DataFrame, with_text: bool = True) -> DataFrame:
    """(archive, member, text, error, place) of ``archives``(path, content); folders are flattened, ``place`` is the
    member's in its archive, and a corrupt archive gives one row with its error instead of members.

    Members come one by one, so a task holds one archive as it is packed and one unpacked member. An archive is tested as a
    whole first, since a member that cannot be unpacked makes it corrupt."""
    rows = archives.select("path", "content").lateralJoin(ZipMembers(F.col("path").outer(), F.col("content").outer(), F.lit(with_text)))
    return rows.select("archive", "member", "text", "error", "place")


@F.udtf(returnType="archive string, member string, text string, error string, place int")
class ZipMembers:
    """A table function: the members of one archive."""

    def eval(self, path: str, content: bytes, with_text: bool):
        archive = path.rsplit("/", 1)[-1]
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                if with_text and (bad := z.testzip()):
                    raise zipfile.BadZipFile(f"{bad} is damaged")
                for place, info in enumerate(z.infolist()):
                    if not info.is_dir():
                        text = z.read(info).decode("utf-8", "replace") if with_text else None
                        yield archive, info.filename.rsplit("/", 1)[-1], text, None, place
        except (zipfile.BadZipFile, zlib.error, OSError, RuntimeError) as e:
            yield archive, None, None, str(e), None


def read_archives(spark: SparkSession, folder: str, with_text: bool = True) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(folder)
    return members(files, with_text)


def without_ascii(found: DataFrame) -> DataFrame:
    """Archives none of whose members is a sheet text; unreadable ones are not among them."""
    return found.where("error is null").groupBy("archive").agg(F.bool_and(~is_ascii_name(F.col("member"))).alias("none")).where("none").select("archive")


def first_allowed(found: DataFrame) -> DataFrame:
    """Of each archive the first sheet text of an allowed variant, for archives that hold one sheet each."""
    allowed = found.where("error is null").where(is_ascii_name(F.col("member")) & kept_variant(F.col("member")))
    return first_of(allowed, ["archive"], [F.col("place")])


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(plik, path, text) of sheet texts below a folder, one per lower-cased path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(is_ascii_name(F.col("path")))
    once = files.withColumn("key", F.lower("path")).dropDuplicates(["key"])
    return once.select(F.element_at(F.split("path", "/"), -1).alias("plik"), "path", F.decode("content", "UTF-8").alias("text"))


Fetch = Callable[[str, tuple[float, float]], tuple[int, str, bytes]]


def download(url: str, folder: str, fetch: Fetch, tries: int = 4, timeout: tuple[float, float] = (15, 180), pause: float = 5, least: int = 5_000, sleep=time.sleep) -> str:
    """``present``, ``done`` or ``failed: ...``. ``fetch`` returns (status, content type, bytes) and may raise
    TimeoutError. Timeouts, 429, 5xx and HTML answers are tried again after pause times the attempt; other states not."""
    fs, target = opened(f"{folder}/{url.rsplit('/', 1)[-1]}")
    if (fs.get_file_info(target).size or 0) > least:
        return "present"
    why = ""
    for attempt in range(1, tries + 1):
        try:
            status, kind, body = fetch(url, timeout)
        except (TimeoutError, ConnectionError) as e:
            why = str(e) or type(e).__name__
        else:
            if status == 200 and "html" not in kind.lower():
                part = f"{target}.{uuid.uuid4().hex}.part"  # another attempt of the task writes its own
                with fs.open_output_stream(part) as out:
                    out.write(body)
                fs.move(part, target)
                return "done"
            why = f"status {status}, {kind}"
            if status != 200 and status != 429 and status < 500:
                break
        if attempt < tries:
            sleep(pause * attempt)
    return f"failed: {why}"


def download_all(urls: DataFrame, folder: str, fetch: Fetch, workers: int = 2, reissued: DataFrame | None = None, **options) -> DataFrame:
    """(url, result); ``workers`` tasks at a time load at most. ``folder`` is a path or URI that all executors reach.
    L11: a present archive that ``reissued`` (plik) names is deleted first, so it is loaded anew."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for url in part.url[part.again]:
                fs, target = opened(f"{folder}/{url.rsplit('/', 1)[-1]}")
                if fs.get_file_info(target).type != FileType.NotFound:
                    fs.delete_file(target)
            yield pd.DataFrame({"url": part.url, "result": [download(u, folder, fetch, **options) for u in part.url]})

    once = urls.select("url").distinct()
    if reissued is None:
        marked = once.withColumn("again", F.lit(False))
    else:
        old = reissued.select("plik").distinct().withColumn("again", F.lit(True))
        named = once.withColumn("plik", F.element_at(F.split("url", "/"), -1))
        marked = named.join(old, "plik", "left").select("url", F.coalesce("again", F.lit(False)).alias("again"))
    return marked.repartition(workers, "url").mapInPandas(run, "url string, result string")
