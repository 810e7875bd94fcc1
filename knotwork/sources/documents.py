"""Documents and JSON records as vertices."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from knotwork.functions.props import PROPS_TYPE, props_from
from knotwork.functions.text import fold_punctuation
from knotwork.model import shape_vertices
from knotwork.operators.merge import NODE_BATCH, batch_of


# Files of one folder.
SHELF = 1000
# Bytes of texts that a task reads before it hands them on.
READ_BYTES = 4_000_000


def write_text(documents: DataFrame, folder: str, name: Column, text: Column) -> None:
    """One text file per name and task below ``folder``, called by name, task and number, which
    holds the texts of that name, each ended by a line feed (a missing one is empty).

    The tasks put the files where they stay, some to a folder: Spark's own writer opens a folder
    per value, and with local files starts a process for each file's permissions.  A task that is
    repeated writes the same files again.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        task, number, last, out = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            for called, body in zip(batch.column("name").to_pylist(), batch.column("text")):
                if out is None or called != last:
                    if out is not None:
                        out.close()
                    shelf = f"{root}/shelf={task}-{number // SHELF}"
                    if number % SHELF == 0:
                        files.create_dir(shelf, recursive=True)
                    out = files.open_output_stream(f"{shelf}/{called}_{task}-{number}.txt")
                    last, number = called, number + 1
                out.write((body.as_py() or b"") + b"\n")
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([number])], ["written"])

    rows = documents.select(name.alias("name"), text.cast("binary").alias("text")).sortWithinPartitions("name")
    rows.mapInArrow(write, "written long").agg(F.sum("written")).first()


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as documents: one row per file with its name and path.

    A folder that ``write_text`` made is listed by the tasks, so that the driver holds an entry for
    SHELF files.  Spark's source reads all else; it keeps one for each file on the driver.
    """
    shelves = _shelves(path) if isinstance(path, str) else []
    if shelves:
        files = _read_shelves(spark, path, shelves)
    else:
        files = spark.read.text(path, wholetext=True).withColumn("file_path", F.input_file_name())
    name = F.element_at(F.split("file_path", "/"), -1)
    return files.select(
        F.col("value").alias("text"), "file_path", name.alias("file_name"),
        F.lit("text/plain").alias("file_type"),
    )


def _shelves(folder: str) -> list[str]:
    """The folders of ``write_text`` in ``folder``; none where there are other entries as well or
    the folder is not to be seen from here."""
    try:
        files, root = FileSystem.from_uri(folder)
        entries = files.get_file_info(FileSelector(root))
    except (pa.ArrowException, OSError):
        return []
    made = [x.base_name for x in entries if x.type == FileType.Directory and re.fullmatch(r"shelf=[0-9]+-[0-9]+", x.base_name)]
    return made if len(made) == len(entries) else []


def _hidden(name: str) -> bool:
    """What Spark's file sources pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _escaped(path: str) -> str:
    """``path`` as a part of a URI, as ``input_file_name`` writes it."""
    return re.sub(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0]', lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), path)


def _read_shelves(spark: SparkSession, folder: str, shelves: list[str]) -> DataFrame:
    """(value, file_path) of the files of the shelves, each of which is listed and read by a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        above = folder.rstrip("/") if "://" in folder else f"file://{_escaped(root)}"
        for batch in batches:
            for shelf in batch.column("shelf").to_pylist():
                texts, paths, held = [], [], 0
                for entry in files.get_file_info(FileSelector(f"{root}/{shelf}")):
                    if entry.type != FileType.File or _hidden(entry.base_name):
                        continue
                    with files.open_input_stream(entry.path, compression=None) as file:
                        texts.append(file.read())
                    paths.append(f"{above}/{shelf}/{_escaped(entry.base_name)}")
                    held += len(texts[-1])
                    if held >= READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(paths)], ["value", "file_path"])
                        texts, paths, held = [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(paths, pa.string())], ["value", "file_path"])

    listed = spark.createDataFrame(spark.sparkContext.parallelize([(s,) for s in shelves], len(shelves)), "shelf string")
    return listed.mapInArrow(read, "value binary, file_path string").withColumn("value", F.col("value").cast("string"))


def chunk_batch(documents: DataFrame, chunk_id: Column, ref_doc_id: Column, seq: Column,
                metadata: list[str] | None = None, text: str = "text") -> DataFrame:
    """Documents as a chunk batch; ``metadata`` columns become properties."""
    props = F.map_concat(
        props_from(documents, metadata or []),
        F.create_map(F.lit("ref_doc_id"), ref_doc_id.cast("string")),
    )
    return batch_of(
        documents, NODE_BATCH, kind=F.lit("chunk"), id=chunk_id, text=F.col(text), props=props, seq=seq
    )


def json_vertices(rows: DataFrame, column: str, label: str, key: Column,
                  embedding_field: str = "embedding") -> DataFrame:
    """JSON objects as vertices of a type: scalar fields as text, nested ones as
    JSON text, and the embedding as numbers."""
    fields = F.from_json(F.col(column), PROPS_TYPE)
    vector = F.from_json(
        F.get_json_object(F.col(column), f"$.{embedding_field}"), T.ArrayType(T.FloatType())
    )
    props = F.map_filter(fields, lambda k, v: v.isNotNull() & ~k.isin(embedding_field, "name"))
    return shape_vertices(
        rows, label, fold_punctuation(key), name=F.get_json_object(F.col(column), "$.name"),
        embedding=vector, props=props,
    )
