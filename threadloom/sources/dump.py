"""XML row dumps: one ``<row .../>`` element per line, the attributes are the columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import strip
from threadloom.schemas import CORRUPT, raw_schema

_ROW = "<row"
_XML_OPTIONS = {
    "attributePrefix": "",
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def parse_rows(lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of a DataFrame of text lines (column ``value``), batch or streaming.

    Lines without a row element are skipped.  ``<`` cannot occur inside an attribute
    value, so a line with several elements is cut before each of them.  A row that is
    not well-formed keeps its text in ``_corrupt_record`` and has no other column.

    ``inline`` rather than ``row.*``: a filter on the result is not pushed below a
    generator, where it would parse the XML again for each column it tests.
    """
    value = F.col("value")
    several = F.substring(F.ltrim(value), len(_ROW) + 1, 2**31 - 1).contains(_ROW)
    elements = F.when(several, F.split(value, f"(?={_ROW}[\\s/>])")).otherwise(F.array(value))
    return (
        lines.where(value.contains(_ROW))
        .select(F.explode(elements).alias("value"))
        .where(F.ltrim(value).rlike(f"^{_ROW}[\\s/>]"))
        .select(F.inline(F.array(F.from_xml(value, raw_schema(columns), _XML_OPTIONS)))))


def scan_dump(spark: SparkSession, path, columns: dict[str, str]) -> DataFrame:
    """Read a dump as text, so that one huge file is split over many tasks, then parse each line.

    A missing path fails when the plan is made.
    """
    return parse_rows(spark.read.text(path), columns)


# A start tag without its first characters: names and quoted values up to the first end of a tag outside of quotes.
_TAG = r"""^[^"'<>]*+(?:(?:"[^"]*+"|'[^']*+')[^"'<>]*+)*+>"""


def parse_elements(parts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows of a DataFrame of what lies between one row element's beginning and the next (column ``value``).

    ``<`` cannot occur inside an attribute value, so a part holds one element, however many lines it takes and whether
    or not it has an end tag; what follows its start tag is not read. The part before the first element and other
    elements whose names begin alike are skipped. An element that does not end keeps its text in
    ``_corrupt_record`` and has no other column.
    """
    value = F.col("value")
    element = value.rlike(r"^[\s/>]") & ~value.rlike(r"^\s*(<|$)")
    tag = F.regexp_extract(value, _TAG, 0)
    whole = F.when(tag == "", F.concat(F.lit(_ROW), value)).otherwise(
        F.concat(F.lit(_ROW), F.regexp_replace(tag, r"/?>$", ""), F.lit("/>")))
    return (parts.where(element).select(whole.alias("value"))
            .select(F.inline(F.array(F.from_xml(value, raw_schema(columns), _XML_OPTIONS)))))


def scan_dump_elements(spark: SparkSession, path, columns: dict[str, str]) -> DataFrame:
    """Read a dump of any layout: an element may span lines, and a line may hold several. The beginning of an element
    is the delimiter of the text reader, so that one huge file is split over many tasks here as well.
    """
    return parse_elements(spark.read.option("lineSep", _ROW).text(path), columns)


READERS = {"text": scan_dump, "xml": scan_dump_elements}


def stream_dump(spark: SparkSession, path: str, columns: dict[str, str], max_files: int | None = None,
                layout: str = "text") -> DataFrame:
    """Stream of the rows of dump files as they arrive in a folder; ``layout`` as in READERS."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if layout == "xml":
        return parse_elements(reader.option("lineSep", _ROW).load(path), columns)
    return parse_rows(reader.load(path), columns)


def dump_id(spark: SparkSession, path) -> str:
    """Name of a dump by its files: their paths, lengths and times. The same files give the same name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("bigint"))
    count, total = files.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(20,0)"))).first()
    return f"{count}-{total or 0}"


def preview(spark: SparkSession, path, n: int = 40) -> DataFrame:
    """First n lines of a dump, stripped; parts of a dump are taken in name order.

    Parts without lines do not count, however many there are; only as many parts are opened as it takes.
    """
    parts = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .where("length > 0").select("path"))
    files = [r[0] for r in parts.orderBy("path").toLocalIterator()]
    lines, at = [], 0
    while at < len(files) and len(lines) < n:
        more = reduce(DataFrame.union, [spark.read.text(f) for f in files[at:at + n]])
        # Taken in the order of the parts and of their splits; a limit that is written takes what a shuffle brings first.
        lines += [r[0] for r in more.take(n - len(lines))]
        at += n
    return spark.createDataFrame([(line,) for line in lines], "value string").select(strip(F.col("value")).alias("line"))


def line_count(spark: SparkSession, path, n: int = 40) -> DataFrame:
    """Lines of a dump, and how far a reader gets that stops after previewing n of them."""
    count = F.count(F.lit(1))
    return spark.read.text(path).agg(
        count.alias("lines"), F.least(count, F.lit(n + 1).cast("bigint")).alias("lines_seen"))


def to_dump_lines(df: DataFrame, separator: str = " ") -> DataFrame:
    """One ``<row .../>`` line per row of a DataFrame of strings; NULL attributes are left out. A ``separator`` of other
    blanks puts the attributes on lines of their own."""
    attributes = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f'{separator}{c}="'), _escape(F.col(c)), F.lit('"'))).otherwise(F.lit(""))
        for c in df.columns]
    return df.select(F.concat(F.lit("<row"), *attributes, F.lit(" />")).alias("value"))


def _escape(text: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                      ("\n", "&#xA;"), ("\r", "&#xD;"), ("\t", "&#x9;")):
        text = F.replace(text, F.lit(char), F.lit(ref))
    return text
