"""Typed sources: JSON files by key, keyed objects, listing pages, binary files, and policies."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesaquery.operators.tables import split_without
from mesaquery.sources.shared import filesystem

#: Record shapes. Unknown keys are dropped and missing ones are null.
DETAIL = "slug string, address string, lat double, lng double, phone string, listing_url string, error string"
SWEEP = "slug string, website string, method string, pages_fetched int, prices array<int>, error string, confidence string, comparable_3course int, gaps map<string,int>"
ITEM = "struct<slug:string,shortTitle:string,borough:string,neighborhood:string,mealTypes:array<string>,tags:array<string>,restaurantInclusionWeek:array<string>,menuFileUrl:string,website:string,summary:string,collections:array<string>,ecommerce:struct<partnerName:string,partnerId:string>>"
MANIFEST = "struct<url:string,file:string,sha256:string,error:string>"
PAYLOAD = "slug string, name string, borough string, neighborhood string, cuisines array<string>, price_tiers array<string>, meal_periods array<string>, end_date date, sunday boolean, rank int, verdict string, gap_usd double, gap_pct double, gap_basis string, rw_price int, menu_state string, flags array<string>, subway map<string,int>, recog_rank int, rubric double"
LISTING = f"fetched string, total int, count int, api_total int, items array<{ITEM}>"


def json_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder with one JSON document for each file; the schema isn't inferred."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


#: Bytes of files, about, that a task of ``small_files`` holds at once.
HELD_BYTES = 4 << 20


def small_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, content of the files in the folders of ``folder``, of which any number may be small.

    The driver lists the folders alone; tasks list and read what lies in them. Names that begin with
    an underscore or a dot are passed over, as Spark's readers do.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    names = sorted(f.getPath().getName() for f in found if f.isDirectory() and f.getPath().getName()[0] not in "_.")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSelector

        fs, root = filesystem(folder)
        kind = pa.schema([("path", pa.string()), ("content", pa.binary())])
        for batch in batches:
            for name in batch.column("name").to_pylist():
                paths, contents, held = [], [], 0
                for info in fs.get_file_info(FileSelector(f"{root}/{name}")):
                    if info.is_file and info.base_name[0] not in "_.":
                        with fs.open_input_stream(info.path) as file:
                            contents.append(file.read())
                        paths.append(info.path)
                        held += len(contents[-1])
                    if held >= HELD_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], schema=kind)
                        paths, contents, held = [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], schema=kind)

    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i long, name string")
    return rows.repartitionByRange(max(1, len(names)), "i").select("name").mapInArrow(read, "path string, content binary")


def json_documents(files: DataFrame, schema: str) -> DataFrame:
    """Rows of files (content) that hold a JSON document each, in UTF-8, as ``json_files`` has them."""
    text = F.col("content").cast("string")
    parsed = files.where(text.rlike(r"[^ \t\n\r]")).select(F.explode_outer(F.from_json(text, f"array<struct<{schema}>>")).alias("v"))
    return parsed.select("v.*")


#: What changes the state of a reader of JSON: quotes outside of escapes, and brackets.
_MARKS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)


def _after(text: str, quoted: bool, depth: int) -> tuple[bool, int]:
    """Whether a piece of JSON ends within a string, and how deep, if it begins so."""
    for mark in _MARKS.findall(text):
        if mark == '"':
            quoted = not quoted
        elif not quoted and len(mark) == 1:
            depth += 1 if mark in "{[" else -1
    return quoted, depth


def keyed_object(spark: SparkSession, path: str, value: str, key: str = "slug") -> DataFrame:
    """Files that hold one object each, from keys to records: a row for each key, keys as strings.

    A file of any size is read in pieces between commas, by as many tasks as its splits make. First each
    split says how it ends if it begins inside a string and if it doesn't, and how much deeper; one pass
    over these few rows tells how each split really begins. Then splits cut their pieces into records at
    the commas of the outer object; what begins in one split and ends in another is put together by
    order. Records that can't be parsed are left out.
    """
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    pieces = spark.read.option("lineSep", ",").text(path).select(*at, "value")

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], list[tuple[bool, int]]] = {}
        for batch in batches:
            for file, start, text in zip(batch["file"], batch["start"], batch["value"], strict=True):
                now = held.get((file, start), [(False, 0), (True, 0)])
                held[file, start] = [_after(text, *state) for state in now]
        yield pd.DataFrame([(f, s, *out, *within) for (f, s), (out, within) in held.items()], columns=["file", "start", "q0", "d0", "q1", "d1"])

    begins: dict[tuple[str, int], tuple[bool, int]] = {}
    last, quoted, depth = None, False, 0
    for r in sorted(pieces.mapInPandas(ends, "file string, start long, q0 boolean, d0 int, q1 boolean, d1 int").collect()):  # a row for each split
        quoted, depth = (quoted, depth) if r.file == last else (False, 0)
        begins[r.file, r.start] = quoted, depth
        last, quoted, depth = r.file, *((r.q1, depth + r.d1) if quoted else (r.q0, depth + r.d0))

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict[tuple[str, int], list] = {}  # of the split being read: in a string, depth, pieces, whether one record ended
        for batch in batches:
            out = []
            for file, start, text in zip(batch["file"], batch["start"], batch["value"], strict=True):
                if (file, start) not in state:
                    out += [(*k, "tail" if v[3] else "through", ",".join(v[2]), v[1] == 0) for k, v in state.items() if v[2]]
                    state = {(file, start): [*begins[file, start], [], False]}
                now = state[file, start]
                now[2].append(text)
                now[:2] = _after(text, *now[:2])
                if not now[0] and now[1] == 1:
                    out.append((file, start, "whole" if now[3] else "head", ",".join(now[2]), False))
                    now[2:] = [], True
            yield pd.DataFrame(out, columns=["file", "start", "kind", "text", "last"])
        yield pd.DataFrame([(*k, "tail" if v[3] else "through", ",".join(v[2]), v[1] == 0) for k, v in state.items() if v[2]], columns=["file", "start", "kind", "text", "last"])

    cut = pieces.mapInPandas(records, "file string, start long, kind string, text string, last boolean")
    parts = cut.where("kind <> 'whole'").withColumn("order", F.when(F.col("kind") == "head", 0).otherwise(1))
    before = Window.partitionBy("file").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn("number", F.coalesce(F.sum((F.col("kind") == "head").cast("int")).over(before), F.lit(0)))  # two rows a split at most
    joined = numbered.groupBy("file", "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "order", "text"))), lambda x: x["text"]), ",").alias("text"), F.max("last").alias("last"))
    every = cut.where("kind = 'whole'").select("text", "last").unionByName(joined.select("text", "last"))
    space = r"[ \t\n\r\x{FEFF}]*"
    inner = F.regexp_replace("text", rf"^{space}\{{", "")
    inner = F.when(F.col("last"), F.regexp_replace(inner, rf"\}}{space}$", "")).otherwise(inner)
    parsed = every.select(F.explode(F.from_json(F.concat(F.lit("{"), inner, F.lit("}")), f"map<string,{value}>")).alias(key, "v"))
    return parsed.select(key, "v.*")


def latest_file(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The JSON document whose file name is the last in order, as dated snapshots are; its path alone is read."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = sorted(f.getPath().toString() for f in files if f.isFile() and f.getPath().getName().endswith(".json"))
    if not names:
        raise FileNotFoundError(folder)
    return json_files(spark, names[-1], schema)


def listing_pages(spark: SparkSession, folder: str, stamp: str | None = None) -> DataFrame:
    """Landed pages of a listing with the number in each one's file name; pages of another day's stamp don't count.

    The stamp is a file ``_stamp`` beside the pages.
    """
    if stamp is not None:
        # One small file, which Spark's readers would pass over for its name.
        at = spark._jvm.org.apache.hadoop.fs.Path(folder, "_stamp")
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(at) or spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(at), "UTF-8").strip() != stamp:
            return json_files(spark, folder, LISTING).withColumn("page", F.lit(0)).limit(0)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1).cast("int")
    return json_files(spark, f"{folder}/*.json", LISTING).withColumn("page", number)


def listing_items(pages: DataFrame, page: str = "page") -> DataFrame:
    """Items of listing pages, the first of each slug by page number and place; blank strings stay blank."""
    flat = pages.select(F.col(page).alias("_page"), F.posexplode("items").alias("_at", "item"))
    first = flat.groupBy("item.slug").agg(F.min_by("item", F.struct("_page", "_at")).alias("item"))
    return first.select("item.*")


def binary_texts(spark: SparkSession, path: str, extract: Callable[[bytes], str], pages: int | None = None) -> DataFrame:
    """path, text, sha256 of binary files; a document that can't be read has an empty text.

    ``extract`` returns the text, or the texts of the pages, of which the first ``pages`` count.
    """
    return texts_of(spark.read.format("binaryFile").load(path), extract, pages)


def texts_of(files: DataFrame, extract: Callable[[bytes], str], pages: int | None = None) -> DataFrame:
    """``binary_texts`` of files (path, content)."""

    @F.pandas_udf("string")
    def read(contents: pd.Series) -> pd.Series:
        def one(content: bytes) -> str:
            try:
                found = extract(content)
                return found if isinstance(found, str) else "\n".join(x or "" for x in list(found)[:pages])
            except Exception:  # any fault of a damaged file
                return ""

        return contents.map(one)

    return files.select("path", read("content").alias("text"), F.sha2("content", 256).alias("sha256"))


def manifest(files: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """key, url, file, sha256, error of wanted ``links`` (key, url) and the ``files`` (path, sha256) that came of them."""
    named = files.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias(key), F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "sha256")
    return links.join(named, key, "left").select(key, "url", "file", "sha256", F.when(F.col("file").isNull(), "missing").alias("error"))


def valid_licences(rows: DataFrame, live: tuple[str, ...] = ("issued",)) -> DataFrame:
    """Licences in a live state with real coordinates, from untyped rows; kinds as two booleans."""
    number = lambda c: F.round(F.col(c).try_cast("double"), 6)
    plain = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    kind = F.lower(plain("license_type"))
    there = F.lower(plain("license_status")).isin(*live) & number("latitude").isNotNull() & number("longitude").isNotNull()
    names = {"name": "assumed_name_s", "legal": "business_legal_name", "street": "street", "borough": "borough", "postcode": "postcode"}
    return rows.where(there).select(*[plain(c).alias(n) for n, c in names.items()], kind.contains("sidewalk").alias("sidewalk"), kind.contains("roadway").alias("roadway"), number("latitude").alias("lat"), number("longitude").alias("lng"))


def valid_stations(rows: DataFrame, position: str) -> DataFrame:
    """Stations with a name, routes and real coordinates, from untyped rows: the first of each name and set of routes."""
    number = lambda c: F.round(F.col(c).try_cast("double"), 6)
    typed = rows.select(F.trim("stop_name").alias("name"), number("gtfs_latitude").alias("lat"), number("gtfs_longitude").alias("lng"), split_without(F.coalesce("daytime_routes", F.lit(""))).alias("routes"), "borough", position)
    good = typed.where((F.col("name") != "") & F.col("lat").isNotNull() & F.col("lng").isNotNull() & (F.size("routes") > 0))
    return good.groupBy("name", "routes").agg(F.min_by(F.struct("lat", "lng", "borough"), position).alias("_v")).select("name", "_v.lat", "_v.lng", "routes", "_v.borough")


def complete(items: DataFrame, key: str, expected: int, least: float = 0.9) -> bool:
    """Whether the distinct keys are at least a share of what the source says it has."""
    return items.select(key).distinct().count() >= least * expected


def banned_fields(schema: T.DataType, banned: frozenset[str], path: str = "") -> list[str]:
    """Paths of fields, at any depth, whose names must not be published."""
    if isinstance(schema, T.StructType):
        found = [f"{path}{f.name}" for f in schema if f.name in banned]
        return found + [x for f in schema for x in banned_fields(f.dataType, banned, f"{path}{f.name}.")]
    if isinstance(schema, T.ArrayType):
        return banned_fields(schema.elementType, banned, path)
    if isinstance(schema, T.MapType):
        return banned_fields(schema.valueType, banned, path)
    return []
