"""Actual files under a root, with size, digest and role."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.digest import content_digest
from ledgerloom.sources.records import relative_path

#: Bytes up to which a file is digested as one value; a larger one is read in pieces if its name has an extension.
WHOLE = 1 << 20

_MARK = b"\xef\xbb\xbf"


def _ending(name: Column) -> Column:
    """The extension by which a file is named to Hadoop as not to be unpacked or split; empty if it has none of letters, digits, - and _."""
    return F.regexp_extract(name, r"\.[0-9A-Za-z_-]+$", 0)


def _pieces_digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, size, digest) of files whose parts between line feeds come in order, a file whole after another.

    The reader leaves out a line feed at the end and a byte order mark at the start; the size tells whether they were there.
    """
    names = ["file", "size", "digest"]
    file, size, seen, plain, marked = None, 0, 0, None, None

    def row() -> pa.RecordBatch:
        left = size - seen
        if left not in (0, 1, 3, 4):
            raise ValueError(f"{file}: {seen} of {size} bytes were read")
        found = marked if left > 1 else plain
        found.update(b"\n" * (left % 3))
        return pa.RecordBatch.from_pydict(dict(zip(names, ([file], [size], [f"sha256:{found.hexdigest()}"]), strict=True)))

    for batch in batches:
        ends = batch.column("file").dictionary_encode()
        runs = ends.indices.to_numpy(zero_copy_only=False)
        at = 0
        while at < len(runs):
            same = runs[at:] == runs[at]
            to = len(runs) if same.all() else at + int(same.argmin())
            name = batch.column("file")[at].as_py()
            first = name != file
            if first:
                if file is not None:
                    yield row()
                file, size, seen, plain, marked = name, batch.column("size")[at].as_py(), 0, hashlib.sha256(), hashlib.sha256(_MARK)
            piece = b"\n".join([b""] * (not first) + batch.column("value").slice(at, to - at).to_pylist())
            seen += len(piece)
            plain.update(piece)
            marked.update(piece)
            at = to
    if file is not None:
        yield row()


def _large_files(spark: SparkSession, root: str, glob: str | None, ending: str) -> DataFrame:
    """``path, size, digest`` of the files of over WHOLE bytes whose names end so: a task reads a file from its start to its end and keeps a piece of it at a time.

    Spark's text reader passes the bytes on as they are. It splits files, and unpacks those with a packed one's extension, unless Hadoop's
    pass-through codec is named for their extension: so there is a reader for each.
    """
    reader = spark.read.format("text").option("recursiveFileLookup", True).option("lineSep", "\n")
    reader = reader.option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
    # Hadoop's own name of the option, and what it is called in the shaded client that Spark brings.
    for prefix in ("", "org.apache.hadoop.shaded."):
        reader = reader.option(f"{prefix}io.compress.passthrough.extension", ending)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    large = reader.load(root).where((F.col("_metadata.file_size") > WHOLE) & (_ending(F.col("_metadata.file_name")) == ending))
    pieces = large.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))
    digested = pieces.mapInArrow(_pieces_digested, "file string, size long, digest string")
    return digested.select(relative_path(F.col("file"), root).alias("path"), "size", "digest")


def file_inventory(
    spark: SparkSession, root: str, *, exact_roles: Mapping[str, str] | None = None,
    prefix_roles: Mapping[str, str] | None = None, suffix_roles: Mapping[str, str] | None = None,
    default_role: str = "artifact", glob: str | None = None,
) -> DataFrame:
    """(path, size, digest, role) of every file under ``root``, nested directories included.

    The role is an exact path match first, then a prefix, then a suffix, then the default. The extensions of large files are
    collected when the plan is made; a large file without one is a single value of its task.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found, large, ending = reader.load(root), F.col("length") > WHOLE, _ending(F.col("_metadata.file_name"))
    endings = {r.ending for r in found.where(large).select(ending.alias("ending")).distinct().collect()}

    def whole(some: DataFrame) -> DataFrame:
        return some.select(relative_path(F.col("path"), root).alias("path"), F.col("length").alias("size"), content_digest(F.col("content")).alias("digest"))

    # A condition on the length alone keeps the contents of other files from being read.
    files = whole(found.where(~large))
    if "" in endings:
        files = files.unionByName(whole(found.where(ending == "").where(large)))
    for name in sorted(endings - {""}):
        files = files.unionByName(_large_files(spark, root, glob, name))
    path, role = F.col("path"), F.lit(default_role)
    for suffix, name in reversed((suffix_roles or {}).items()):
        role = F.when(path.endswith(suffix), name).otherwise(role)
    for prefix, name in reversed((prefix_roles or {}).items()):
        role = F.when(path.startswith(prefix), name).otherwise(role)
    for exact, name in reversed((exact_roles or {}).items()):
        role = F.when(path == exact, name).otherwise(role)
    return files.withColumn("role", role)
