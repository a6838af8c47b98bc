"""XML record elements cut out of files of any size, each with a verdict of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adjudica.session import materialise
from adjudica.sources.documents import XML_NAMES, XML_RECORD, decoded
from adjudica.sources.repair import xml_text

REJECTED = "_rejected"
_COMPRESSED = r"(?i)\.(gz|bz2|zst|xz|lz4|snappy|deflate)$"


def _chunks(spark: SparkSession, paths: list[str], end: str) -> DataFrame:
    """Bytes of files up to each end tag, by a scan that Spark splits, with the place of each chunk in its file."""
    reader = spark.read.option("lineSep", end).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("place"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").cast("binary").alias("content"),
    )


def _files(chunks: DataFrame, end: str) -> DataFrame:
    """One row per file: declared encoding, its last chunk where the file ends without an end tag, and whether all was read."""
    head = F.decode(F.substring("content", 1, 200), "ISO-8859-1")
    declared = F.regexp_extract(head, r"""<\?xml[^>]*\bencoding\s*=\s*["']([^"']+)""", 1)
    read = F.sum(F.octet_length("content") + len(end))
    found = chunks.groupBy("path").agg(
        F.max(F.nullif(F.upper(declared), F.lit(""))).alias("encoding"), F.max("place").alias("last"), read.alias("read"), F.max("file_size").alias("size")
    )
    # Without an end tag the last chunk counts for more than it has; Spark leaves out a byte order mark, of three bytes.
    more, compressed = F.col("read") - F.col("size"), F.rlike("path", F.lit(_COMPRESSED))
    return found.select(
        "path", F.coalesce("encoding", F.lit("UTF-8")).alias("encoding"),
        F.when(more.isin(len(end), len(end) - 3) | compressed, F.col("last")).alias("open_end"),
        (compressed | (more >= -3)).alias("whole"),
    )


def read_elements(spark: SparkSession, *paths: str, tag: str = "marche") -> tuple[DataFrame, DataFrame]:
    """The elements of a tag in XML files, and the files they come from.

    Files are scanned by the end tag, so one of any size is read by many tasks. Encodings that keep ASCII bytes are
    taken as declared; control characters are dropped. An element that another one begins in, or that the file ends in,
    is ``cut``. Returns path, element and cut; and path, encoding and whole (false where reading stopped early).
    """
    end = f"</{tag}>"
    chunks = materialise(_chunks(spark, list(paths), end), "chunks")
    files = materialise(_files(chunks, end), "files")
    text = xml_text(decoded(F.col("content"), F.col("encoding")))
    starts = rf"(?=<{tag}[\s>])"
    pieces = chunks.join(files, "path").select("path", "place", "open_end", F.split(text, starts).alias("pieces"))
    each = pieces.select("path", "place", "open_end", F.size("pieces").alias("n"), F.posexplode("pieces").alias("i", "piece"))
    opened = each.where(F.col("piece").rlike(rf"^<{tag}[\s>]"))
    # The end tag was taken away with the cut; one that is written with a blank is still there.
    spaced = F.when(F.contains("piece", F.lit(f"</{tag}")), F.regexp_extract("piece", rf"(?s)^.*?</{tag}\s+>", 0)).otherwise("")
    unended = (F.col("i") < F.col("n") - 1) | F.coalesce(F.col("place") == F.col("open_end"), F.lit(False))
    element = F.when(spaced != "", spaced).when(unended, F.col("piece")).otherwise(F.concat("piece", F.lit(end)))
    return opened.select("path", element.alias("element"), ((spaced == "") & unended).alias("cut")), files.select("path", "encoding", "whole")


def judged(elements: DataFrame) -> DataFrame:
    """Records of elements, and in ``_rejected`` the text of an element that can't be read (its record is null throughout)."""
    options = {"columnNameOfCorruptRecord": "_corrupt", "ignoreSurroundingSpaces": "true", "mode": "PERMISSIVE"}
    origin = [c for c in elements.columns if c not in ("element", "cut")]
    record = F.from_xml("element", XML_RECORD + ", _corrupt string", options)
    # A row of its own, so that filters and columns take the record that was read and Spark never reads it again for each.
    parsed = elements.select(*origin, "element", F.explode(F.array(F.when(~F.col("cut"), record))).alias("record"))
    bad = F.col("record").isNull() | F.col("record._corrupt").isNotNull()
    return parsed.select(*origin, F.when(bad, F.col("element")).alias(REJECTED), *[F.when(~bad, F.col(f"record.{n}")).alias(n) for n in XML_NAMES])


def read_xml_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Records of XML documents: one row per ``marche`` element that can be read."""
    return judged(read_elements(spark, *paths)[0]).where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_elements(spark: SparkSession, *paths: str) -> DataFrame:
    """Elements that can't be read, with their file."""
    return judged(read_elements(spark, *paths)[0]).where(F.col(REJECTED).isNotNull()).select("path", F.col(REJECTED).alias("element"))

