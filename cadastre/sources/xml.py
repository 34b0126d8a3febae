"""XML files to text rows with the built-in XML reader."""

from __future__ import annotations

import codecs
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastre.sources import files

FILE = "__file"
# The predefined XML entities.
_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
_HEAD_BYTES = 64 << 10


def _decoded(head: bytes) -> str:
    """Text of a file's head, in the encoding that its mark or declaration names."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if head.startswith(mark):
            return head[len(mark):].decode(name, "replace")
    declared = re.match(rb"""<\?xml[^>]*?\sencoding\s*=\s*["']([A-Za-z0-9._-]+)""", head)
    return head.decode(declared[1].decode() if declared else "utf-8", "replace")


def _unescaped(value: str) -> str:
    def one(found: re.Match) -> str:
        name = found[1]
        if name.startswith("#"):
            return chr(int(name[2:], 16) if name[1] in "xX" else int(name[1:]))
        return _ENTITIES.get(name, found[0])

    return re.sub(r"&(#[xX][0-9A-Fa-f]+|#[0-9]+|\w+);", one, re.sub(r"[\t\n\r]", " ", value))


def _after_markup(text: str, at: int) -> int | None:
    """Where a comment, instruction or document type that begins at ``at`` ends; None if it does not."""
    for start, end in (("<!--", "-->"), ("<?", "?>")):
        if text.startswith(start, at):
            found = text.find(end, at + len(start))
            return None if found < 0 else found + len(end)
    # a document type: its inner subset, quoted texts and comments may hold any ">"
    depth, k = 0, at + 2
    while k < len(text):
        if text.startswith("<!--", k):
            k = text.find("-->", k)
            if k < 0:
                return None
            k += 3
            continue
        c = text[k]
        if c in "\"'":
            k = text.find(c, k + 1)
            if k < 0:
                return None
        elif c == ">" and not depth:
            return k + 1
        depth += (c in "[<") - (c in "]>")
        k += 1
    return None


def root_tag(text: str) -> dict[str, str] | None:
    """Attributes of the first element of an XML text; None where its start tag is not complete."""
    at = 0
    while True:
        at = text.find("<", at)
        if at < 0:
            return None
        if text.startswith(("<!", "<?"), at):
            end = _after_markup(text, at)
            if end is None:
                return None
            at = end
            continue
        name = re.compile(r"<[^\s/>]+").match(text, at)
        attributes, k = {}, name.end() if name else at + 1
        pattern = re.compile(r"""\s*([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
        while found := pattern.match(text, k):
            attributes[found[1]] = _unescaped(found[2] if found[2] is not None else found[3])
            k = found.end()
        return attributes if re.compile(r"\s*/?>").match(text, k) else None


def _root_of(spark: SparkSession, path: str) -> dict[str, str]:
    size = _HEAD_BYTES
    while True:
        head, whole = files.head(spark, path, size)
        found = root_tag(_decoded(head))
        if found is not None or whole:
            return found or {}
        size *= 4


def root_attributes(spark: SparkSession, path: str, attributes: Mapping[str, str]) -> DataFrame:
    """Attributes of each file's root tag, one row per file.

    Only the head of each file is read, by a few threads beside the driver's listing of the files:
    what comes to the driver is a file's name and these attributes.
    """
    found = [r[0] for r in spark.read.format("binaryFile").load(path).select("_metadata.file_path").collect()]
    with ThreadPoolExecutor(16) as pool:
        roots = list(pool.map(lambda p: _root_of(spark, p), found))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (FILE, *attributes.values())])
    return spark.createDataFrame([(p, *[r.get(a) for a in attributes]) for p, r in zip(found, roots)], schema)


def read_xml(spark: SparkSession, path: str, fields: Sequence[str],
             record_tag: str = "observation", group_tag: str | None = "country",
             group_attribute: str | None = "name", group_column: str | None = "country",
             root: Mapping[str, str] | None = None) -> DataFrame:
    """One row per record: root attributes, the group's attribute, child texts.

    ``fields`` are the child tags to keep; a present but empty child is the
    empty text, an absent one NULL.  Without ``group_tag`` records are taken
    anywhere below the root.  A group is one reader row, so it has to fit a
    task; choose the record as the row (no group) for files with huge groups.
    Malformed files fail the job that reads them.
    """
    root = {"unit": "unit"} if root is None else root
    record = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    reader = (spark.read.format("xml").option("mode", "FAILFAST").option("attributePrefix", "@")
              .option("nullValue", "\u0000").option("ignoreSurroundingSpaces", True))
    source = F.col("_metadata.file_path").alias(FILE)
    if group_tag:
        schema = T.StructType([T.StructField(record_tag, T.ArrayType(record))])
        if group_attribute:
            schema.add(f"@{group_attribute}", T.StringType())
        groups = reader.option("rowTag", group_tag).schema(schema).load(path)
        name = F.col(f"`@{group_attribute}`") if group_attribute else F.lit(None).cast("string")
        rows = groups.select(source, name.alias("__group"), F.explode(F.col(record_tag)).alias("r"))
        extra = [F.col("__group").alias(group_column)] if group_column else []
        rows = rows.select(FILE, *extra, *[F.trim(f"r.{f}").alias(f) for f in fields])
    else:
        records = reader.option("rowTag", record_tag).schema(record).load(path)
        rows = records.select(source, *[F.trim(F.col(f)).alias(f) for f in fields])
    if root:
        # one row per file on the right; the planner broadcasts it when it is small
        rows = rows.join(root_attributes(spark, path, root), FILE, "left")
    ordered = [*root.values(), *([group_column] if group_tag and group_column else []), *fields]
    return rows.select(*ordered)
