"""Sources: documents as VARIANT rows with their path, delimited files, prefixes, XML, HTML tables, JDBC."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date
from functools import partial
from html import unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.exprs import iso_day_of_week, season_label, season_of
from tarn.functions.json import path_part

DOCS = "path string, doc variant"


def exists(spark: SparkSession, glob: str) -> bool:
    """Whether any file matches; asked of the file system that the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def _texts(spark: SparkSession, glob: str, whole: bool) -> DataFrame | None:
    if not exists(spark, glob):
        return None
    raw = spark.read.option("recursiveFileLookup", "true").text(glob, wholetext=whole)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("doc"))


def read_json_docs(spark: SparkSession, glob: str, explode_top: bool = False) -> DataFrame:
    """(path, doc), one row per file; ``explode_top``: one row per element of a top-level array.

    No file gives no rows with the same schema; a file that is no JSON gives a null document.
    """
    df = _texts(spark, glob, True)
    if df is None:
        return spark.createDataFrame([], DOCS)
    if explode_top:
        items = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
        return df.select("path", F.explode(items).alias("doc"))
    return df


def read_jsonl(spark: SparkSession, glob: str) -> DataFrame:
    """(path, doc), one row per non-empty line."""
    df = _texts(spark, glob, False)
    return spark.createDataFrame([], DOCS) if df is None else df.filter("doc is not null")


#: A comma outside of double quotes.
_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def csv_cells(line: str) -> Column:
    """The fields of a line; quotes around a field go, doubled ones inside become single."""
    plain = F.split(line, ",", -1)
    quoted = F.transform(F.split(line, _COMMA, -1), lambda c: F.when(c.rlike('^".*"$'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(F.instr(line, '"') > 0, quoted).otherwise(plain)


def csv_headers(raw: DataFrame) -> DataFrame:
    """(path, head, names) from (path, value, at): the first line of each file and its column names."""
    first = raw.filter("at = 0").groupBy("path").agg(F.first("value").alias("head"))
    bare = F.regexp_replace("head", "^\\x{FEFF}", "")
    return first.select("path", "head", bare.alias("_bare")).withColumn("names", F.transform(csv_cells("_bare"), lambda c: F.trim(c))).drop("_bare")


def read_csv_union(spark: SparkSession, glob: str, columns: list[str]) -> DataFrame:
    """(path, columns...) as strings: files with differing headers are united by name; unreadable lines go.

    One text scan, whatever the number of files and headers: every file's header, a small table on the cluster, is
    joined by path, and a line's fields are taken by the positions of the names in its own header. Lines whose
    number of fields differs from their header's, lines that repeat it and lines without any wanted field go.
    Empty fields are null; fields do not span lines.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["path", *columns]])
    if not exists(spark, glob):
        return spark.createDataFrame([], schema)
    raw = spark.read.option("recursiveFileLookup", "true").text(glob).select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_block_start").alias("at"))
    lines = raw.drop("at").join(csv_headers(raw), "path").filter(F.col("value") != F.col("head")).withColumn("cells", csv_cells("value"))
    field = lambda name: F.nullif(F.get("cells", F.coalesce(F.array_position("names", name), F.lit(0)).cast("int") - 1), F.lit(""))
    # all wanted fields as one array: a filter over many columns would repeat the splitting for each of them
    rows = lines.filter(F.size("cells") == F.size("names")).withColumn("_wanted", F.transform(F.array(*[F.lit(c) for c in columns]), field))
    return rows.filter(F.exists("_wanted", lambda v: F.trim(v) != "")).select("path", *[F.get("_wanted", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def header_names(spark: SparkSession, glob: str) -> DataFrame:
    """(path, name), one row per file and column: what ``schema_drift`` compares."""
    if not exists(spark, glob):
        return spark.createDataFrame([], "path string, name string")
    raw = spark.read.option("recursiveFileLookup", "true").text(glob).select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_block_start").alias("at"))
    return csv_headers(raw).select("path", F.explode("names").alias("name")).filter("name <> ''")


def _decode(batches: Iterator[pd.DataFrame], encodings: list[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, raw in zip(pdf["path"], pdf["content"], strict=True):
            for enc in encodings:
                try:
                    text = bytes(raw).decode(enc)
                    break
                except UnicodeDecodeError:
                    text = None
            lines = (text or "").splitlines()
            yield pd.DataFrame({"path": path, "line_no": range(len(lines)), "line": lines})


def read_lines(spark: SparkSession, glob: str, encodings: tuple[str, ...] = ("utf-8-sig", "latin-1", "cp1252")) -> DataFrame:
    """(path, line_no, line) of files whose encoding is the first that fits."""
    if not exists(spark, glob):
        return spark.createDataFrame([], "path string, line_no long, line string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob)
    return files.select("path", "content").mapInPandas(partial(_decode, encodings=list(encodings)), "path string, line_no long, line string")


def csv_of_lines(lines: DataFrame, columns: list[str]) -> DataFrame:
    """(path, columns...) of the lines of files whose first line is a header; columns are found by name."""
    heads = lines.filter("line_no = 0").select("path", F.transform(F.split("line", ","), lambda c: F.trim(c)).alias("_h"))
    cells = F.split("line", ",")
    j = lines.filter("line_no > 0 and trim(line) <> ''").join(heads, "path")
    at = lambda c: F.array_position("_h", c)
    return j.select("path", *[F.when(at(c) > 0, F.nullif(F.trim(F.try_element_at(cells, at(c).cast("int"))), F.lit(""))).alias(c) for c in columns])


def read_prefix(spark: SparkSession, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """All Parquet files below a prefix, schemas merged, with ``source_key``: the path below it."""
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(prefix)
    key = F.regexp_replace(F.col("_metadata.file_path"), r"^.*?" + prefix.rstrip("/").split("/")[-1] + "/", "")
    return df.select(*(columns or df.columns), key.alias("source_key"))


def reference_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed table of codes, small enough for every task."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def date_dim(spark: SparkSession, start: date | str, end: date | str, season_month: int = 7) -> DataFrame:
    """One row per day: parts, weekend flag, season and its label."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("date"))
    d = F.col("date")
    return days.select(
        "date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"), iso_day_of_week(d).alias("iso_dow"),
        F.weekofyear(d).alias("iso_week"), F.date_format(d, "EEEE").alias("day_name"), (iso_day_of_week(d) >= 6).alias("is_weekend"), season_of(d, season_month).alias("season"), season_label(season_of(d, season_month)).alias("season_label"),
    )


def read_alias_seed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source, alias, team_key) of comma files with # comments and stray blanks; missing files are skipped."""
    out = None
    for p in paths:
        if not exists(spark, p):
            continue
        df = spark.read.csv(p, header=True, comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        df = df.toDF(*[c.strip() for c in df.columns]).select(*[F.trim(c).alias(c) for c in ("source", "alias", "team_key")])
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], "source string, alias string, team_key string")
    return out.filter("alias is not null and alias <> ''").distinct()


def snapshot_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **options: str) -> DataFrame:
    """A database table, read in ``parts`` key ranges if a key and its bounds are given."""
    r = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        r = r.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return r.load()


def parse_xml_events(df: DataFrame, col: str, item: str, schema: str, keep: list[str]) -> DataFrame:
    """One row per ``<item>`` of an XML cell; cells that are null or no XML give none.

    schema: fields of an item, as a DDL string.
    """
    parsed = F.from_xml(F.col(col), f"{item} ARRAY<STRUCT<{schema}>>", {"mode": "PERMISSIVE"})
    return df.select(*keep, F.explode(parsed[item]).alias("_e")).select(*keep, "_e.*")


class _Tables(HTMLParser):
    """Cells of all tables, nested ones as tables of their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"rows": [], "cell": None, "at": len(self.done) + len(self.open)})
        elif self.open and tag == "tr":
            self._cell()
            self.open[-1]["rows"].append([])
        elif self.open and tag in ("td", "th"):
            self._cell()
            if not self.open[-1]["rows"]:
                self.open[-1]["rows"].append([])
            self.open[-1]["cell"] = []

    def _cell(self):
        t = self.open[-1]
        if t["cell"] is not None:
            t["rows"][-1].append(" ".join("".join(t["cell"]).split()))
            t["cell"] = None

    def handle_endtag(self, tag):
        if self.open and tag in ("td", "th", "tr"):
            self._cell()
        elif self.open and tag == "table":
            self._cell()
            self.done.append(self.open.pop())

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"].append(data)

    def tables(self):
        while self.open:
            self._cell()
            self.done.append(self.open.pop())
        return sorted(self.done, key=lambda t: t["at"])


#: A start or end tag of plain attributes. What it does not match (comments, self-closing tags, odd quotes) is read by ``_Tables``.
_TAG = re.compile(r"""<(/?[a-zA-Z][a-zA-Z0-9]*+)(?:[\t\n\r\f ]++[a-zA-Z_][a-zA-Z0-9_:.-]*+(?:=(?:"[^"<>]*+"|'[^'<>]*+'|[a-zA-Z0-9_.#%-]++))?+)*+[\t\n\r\f ]*+>""")
#: Elements whose content a parser may read as text.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}

#: What a tag does in ``_plain_tables``.
_ACTS = {"table": "table", "/table": "/table", "tr": "tr", "td": "td", "th": "td", "/td": "/td", "/th": "/td", "/tr": "/td"}


def _plain_tables(source: str) -> list[list[list[str]]] | None:
    """The rows of each table as ``_Tables`` finds them, by one split at tags; None for pages that are not plain."""
    parts = _TAG.split(source)
    if len(parts) != 2 * source.count("<") + 1 or "&" in parts[-1]:
        return None
    done, outer, rows, cell = [], [], None, None  # all tables by their beginning; rows and open cell of the tables around; of this one
    for tag, text in zip(parts[1::2], parts[2::2], strict=True):
        act = _ACTS.get(tag)
        if act is None:
            tag = tag.lower()
            if tag in _RAW:
                return None
            act = _ACTS.get(tag)
        if act == "table":
            outer.append((rows, cell))
            rows, cell = [], None
            done.append(rows)
        elif act and rows is not None:
            if cell is not None:
                rows[-1].append(" ".join("".join(cell).split()))
                cell = None
            if act == "td":
                if not rows:
                    rows.append([])
                cell = []
            elif act == "tr":
                rows.append([])
            elif act == "/table":
                rows, cell = outer.pop()
        if text and cell is not None:
            cell.append(unescape(text) if "&" in text else text)
    while rows is not None:
        if cell is not None:
            rows[-1].append(" ".join("".join(cell).split()))
        rows, cell = outer.pop()
    return done


def page_tables(source: str) -> list[list[list[str]]]:
    """Tables of rows of cells of a page."""
    plain = _plain_tables(source)
    if plain is not None:
        return plain
    p = _Tables()
    p.feed(source)
    return [t["rows"] for t in p.tables()]


def _html_rows(batches: Iterator[pa.RecordBatch], expected: int | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            pages, numbers, places, ends, cells = [], [], [], [0], []
            for i, source in enumerate(part.column(1).to_pylist()):
                tables = page_tables(source or "")
                if expected is not None and max((k + 1 for k, t in enumerate(tables) if t), default=0) != expected:
                    continue
                for k, rows in enumerate(tables):
                    for j, row in enumerate(rows):
                        pages.append(i)
                        numbers.append(k)
                        places.append(j)
                        cells += row
                        ends.append(len(cells))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells, pa.string()), type=schema.field(2).type)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(pages, pa.int32())), pa.array(numbers, pa.int32()), pa.array(places, pa.int32()), lists], names=[batch.schema.names[0], *schema.names])


def extract_html_tables(df: DataFrame, ident: str, html: str, expected: int | None = None) -> DataFrame:
    """(id, table_no, row_no, cells); ``expected``: pages with another number of tables go.

    A page is read once; tables without rows behind the last one with rows are not counted.
    """
    kind = df.schema[ident].dataType.simpleString()
    schema = pa.schema([("table_no", pa.int32()), ("row_no", pa.int32()), ("cells", pa.list_(pa.field("element", pa.string())))])
    return df.select(ident, html).mapInArrow(partial(_html_rows, expected=expected, schema=schema), f"`{ident}` {kind}, table_no int, row_no int, cells array<string>")


def with_partition(df: DataFrame, *keys: str, path: str = "path") -> DataFrame:
    """Adds the ``key=value`` parts of the path as columns."""
    return df.withColumns({k: path_part(k, path) for k in keys})


def readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def require(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Rows in which all the columns are present."""
    for c in cols:
        df = df.filter((F.col(c) if isinstance(c, str) else c).isNotNull())
    return df
