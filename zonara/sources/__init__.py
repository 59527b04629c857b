"""Readers: boundary files, series tables, packed rasters and grid files."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual

FEATURES = "features array<struct<properties:struct<NOMGEO:string>, geometry:struct<type:string, coordinates:array<array<array<double>>>>>>"
# The sixteen zones, in order.
ZONES = [
    "Azcapotzalco", "Coyoacán", "Cuajimalpa de Morelos", "Gustavo A. Madero", "Iztacalco", "Iztapalapa", "La Magdalena Contreras", "Milpa Alta",
    "Álvaro Obregón", "Tláhuac", "Tlalpan", "Xochimilco", "Benito Juárez", "Cuauhtémoc", "Miguel Hidalgo", "Venustiano Carranza",
]


def features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """ord, name, kind, coordinates of a boundary file (one JSON document, UTF-8), or of a document a line, which Spark reads in parts."""
    doc = spark.read.schema(FEATURES).option("multiLine", multi_line).option("encoding", "UTF-8").json(path)
    return feature_rows(doc)


def features_by_line(spark: SparkSession, path: str) -> DataFrame:
    """ord, name, kind, coordinates of boundary files that are larger than a task, as they are mostly written: each line holds whole
    features, with or without the collection's beginning and end around them. Lines are read in parts, a line is parsed as a list,
    and ord is the place in the whole of the files. A line that is neither whole features nor the collection's frame is an error: such
    a file (a feature over several lines) is for `features`. An empty file has no rows; a byte order mark is skipped."""
    block = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.text(path).select(block.alias("block"), F.monotonically_increasing_id().alias("line"), F.trim(F.regexp_replace("value", "^\\uFEFF|[\\r\\t]", " ")).alias("text")).filter("text <> ''")
    one = FEATURES.removeprefix("features ")
    inside = F.regexp_replace("text", r'^\{?[^{]*?(\{[^{}]*\}[^{]*?)*"features"\s*:\s*\[', "")
    plain, ended = (F.regexp_replace(t, r",\s*$", "") for t in (inside, F.regexp_replace(inside, r"\]\s*,?[^\[\]{}]*\}\s*$", "")))
    parsed = F.coalesce(*(F.when(F.trim(t).rlike("^[{]"), F.from_json(F.concat(F.lit("["), t, F.lit("]")), one, {"mode": "PERMISSIVE"})) for t in (plain, ended)))
    whole = F.forall(parsed, lambda f: f["geometry"].isNotNull() | f["properties"].isNotNull())
    frame = (~F.col("text").contains('"geometry"')) & (~F.col("text").contains('"NOMGEO"'))
    got = F.when(parsed.isNotNull() & whole, parsed).when(frame, F.array().cast(one)).otherwise(F.raise_error(F.concat(F.lit("not whole features: "), F.substring("text", 1, 80))).cast(one))
    found = lines.select("block", "line", F.posexplode(got).alias("at", "f"))
    sizes = found.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("first"))  # a row for each part of a file
    order = F.row_number().over(Window.partitionBy("block").orderBy("line", "at")) - 1
    ordered = found.select("block", order.alias("order"), "f").join(starts, "block")
    return ordered.select((F.col("first") + F.col("order")).cast("int").alias("ord"), F.col("f.properties.NOMGEO").alias("name"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def feature_rows(doc: DataFrame) -> DataFrame:
    """ord, name, kind, coordinates of documents with a list of features."""
    return doc.select(F.posexplode("features").alias("ord", "f")).select("ord", F.col("f.properties.NOMGEO").alias("name"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def zones(spark: SparkSession, names: list[str] = ZONES) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "ord int, zone string")


def series_csv(spark: SparkSession, path: str, label: str, periods: list[str]) -> DataFrame:
    """A wide table: semicolons, a header, one label column and periods as numbers."""
    schema = ", ".join([f"`{label}` string", *(f"`{p}` double" for p in periods)])
    return spark.read.schema(schema).option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)


def raster_parquet(spark: SparkSession, path: str, y: str, row: str) -> DataFrame:
    """Packed rows y, row; a filter on y reaches the scan."""
    return spark.read.parquet(path).select(F.col(y).alias("y"), F.col(row).alias("row"))


def tree(node, depth: int = 0):
    """(depth, name, is_group) of nested mappings, depth first."""
    for name in node:
        child = node[name]
        group = hasattr(child, "keys")
        yield depth, name, group
        if group:
            yield from tree(child, depth + 1)


def open_grid(path: str, opener: str = "hdf5"):
    """A grid file (h5py is needed only here), or with opener `parquet` a folder of Parquet tables in the form of one."""
    if opener == "parquet":
        return ParquetFolder(path)
    import h5py

    return h5py.File(path, "r")


class ParquetFolder:
    """A folder of Parquet tables as a grid file: a group for each table, in it a dataset for each column. A store that pyarrow knows by
    its address will do as well as a local folder."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def keys(self) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(self.path))
        return sorted(f.base_name.removesuffix(".parquet") for f in found if f.base_name.endswith(".parquet"))

    def __iter__(self):
        return iter(self.keys())

    def __getitem__(self, name: str):
        table, _, column = name.partition("/")
        group = ParquetTable(self.fs, f"{self.path}/{table}.parquet")
        return group[column] if column else group


class ParquetTable:
    def __init__(self, store, path: str):
        import pyarrow.dataset as ds

        self.data = ds.dataset(path, filesystem=store, format="parquet")

    def keys(self) -> list[str]:
        return self.data.schema.names

    def __iter__(self):
        return iter(self.keys())

    def __getitem__(self, name: str):
        return ParquetColumn(self.data, name)

    def text(self) -> str:
        """The table's schema as text."""
        return self.data.schema.to_string(show_schema_metadata=False)


class ParquetColumn:
    """Lines of a column of lists, read by row groups."""

    def __init__(self, data, name: str):
        self.data, self.name = data, name
        self.parts = [part for f in data.get_fragments() for part in f.split_by_row_group()]
        self.ends = np.cumsum([0, *(part.row_groups[0].num_rows for part in self.parts)]).tolist()
        self.shape = (self.ends[-1],)

    def blocks(self, lines: int) -> list[tuple[int, int]]:
        """The row groups, cut where one has more lines than asked for."""
        return [(a, min(hi, a + lines)) for lo, hi in zip(self.ends, self.ends[1:]) for a in range(lo, hi, lines)]

    def __getitem__(self, at: slice) -> np.ndarray:
        from itertools import chain

        got = []
        for part, lo, hi in zip(self.parts, self.ends, self.ends[1:]):
            if lo < at.stop and hi > at.start:
                column = part.to_table(columns=[self.name]).column(0).slice(max(0, at.start - lo), min(hi, at.stop) - max(lo, at.start))
                got.append(column.to_pylist())
        return np.array(list(chain(*got)), "float64")


class Lines(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


#: The lines from, and up to, which a filter on y leaves.
LINES = {
    EqualTo: lambda v: (v, v + 1), GreaterThan: lambda v: (v + 1, None), GreaterThanOrEqual: lambda v: (v, None), LessThan: lambda v: (0, v), LessThanOrEqual: lambda v: (0, v + 1), IsNotNull: lambda v: (0, None),
}


class GridReader(DataSourceReader):
    def __init__(self, options: dict, opened=None):
        self.options, self.opened = options, opened or partial(open_grid, opener=options.get("opener", "hdf5"))
        self.mode, self.block = options.get("mode", "rows"), int(options.get("lines", 256))
        self.lo, self.hi = 0, None

    def pushFilters(self, filters):
        """Bounds of y choose the lines to read; other filters go back to Spark."""
        for f in filters:
            if self.mode != "rows" or type(f) not in LINES or f.attribute != ("y",):
                yield f
                continue
            low, high = LINES[type(f)](getattr(f, "value", None))
            self.lo = max(self.lo, low)
            if high is not None:
                self.hi = high if self.hi is None else min(self.hi, high)

    def partitions(self):
        if self.mode != "rows":
            return [Lines(0, 0)]
        data = self.opened(self.options["path"])[self.options["dataset"]]
        n = data.shape[0]
        end = n if self.hi is None else min(n, self.hi)
        if hasattr(data, "blocks"):  # its own borders
            cut = [(max(a, self.lo), min(b, end)) for a, b in data.blocks(self.block)]
        else:
            cut = [(a, min(end, a + self.block)) for a in range(self.lo, end, self.block)]
        return [Lines(a, b) for a, b in cut if a < b] or [Lines(0, 0)]

    def read(self, part):
        grid = self.opened(self.options["path"])
        if self.mode == "catalog":
            yield from ((k, *row) for k, row in enumerate(tree(grid)))
        elif self.mode == "metadata":
            node = grid[self.options["dataset"]]
            yield (node.text() if hasattr(node, "text") else node[()].tobytes().decode("utf-8"),)
        elif part.lo < part.hi:
            block = np.asarray(grid[self.options["dataset"]][part.lo : part.hi], "float64")
            rows = pa.ListArray.from_arrays(np.arange(0, block.size + 1, block.shape[1], dtype="int32"), pa.array(block.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(part.lo, part.lo + len(block), dtype="int32")), rows], ["y", "row"])


class Grid(DataSource):
    """format("grid"): packed rows of a dataset by blocks of lines, its text (mode metadata), or the file's tree (mode catalog). Option
    opener: hdf5, or parquet for a folder of tables."""

    @classmethod
    def name(cls):
        return "grid"

    def schema(self):
        return {"catalog": "ord int, depth int, name string, is_group boolean", "metadata": "text string"}.get(self.options.get("mode"), "y int, row array<double>")

    def reader(self, schema):
        return GridReader(dict(self.options))


def grid(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Read a grid file; the source is registered with the session, and filters on y skip lines."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Grid)
    return spark.read.format("grid").options(path=path, **options).load()


def listing(catalog: DataFrame) -> DataFrame:
    """The catalogue as indented lines, in order."""
    return catalog.select("ord", F.concat(F.repeat(F.lit(" "), 2 * F.col("depth")), F.lit("- "), "name").alias("line")).orderBy("ord")
