"""K1-K3: one named text file a storm, written by a Python data source with commit and abort."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.operators.ordering import ORDER_COLUMNS

SUFFIXES = (".dat", ".22")
FORMAT = "cyclone_track_files"


def _track_files():
    """The data source; its classes are made here, so that they travel to the executors by value."""
    from dataclasses import dataclass
    from urllib.parse import quote

    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    def store_of(path: str):
        """File system and folder of a path or URI, as every task and the driver see it."""
        from pyarrow import fs

        if path.startswith("file:/") and not path.startswith("file://"):
            path = path[len("file:"):]
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path)

    @dataclass
    class Written(WriterCommitMessage):
        folder: str
        names: list[str]

    class TrackWriter(DataSourceArrowWriter):
        def __init__(self, path: str, suffix: str, overwrite: bool, job: str):
            self.path, self.suffix, self.overwrite, self.job = path, suffix, overwrite, job

        def write(self, iterator):
            """Stream the partition's storms, each contiguous, to a folder of this attempt alone."""
            import uuid as ids

            from pyarrow import fs

            store, root = store_of(self.path)
            folder = f"{root}/{self.job}/{ids.uuid4().hex}"
            names: list[str] = []
            storm, out = None, None
            try:
                for batch in iterator:
                    keys, lines = batch.column("storm_id").to_pylist(), batch.column("line").to_pylist()
                    begin = 0
                    while begin < len(keys):
                        end = begin + 1
                        while end < len(keys) and keys[end] == keys[begin]:
                            end += 1
                        if keys[begin] != storm:
                            if out is not None:
                                out.close()
                            storm, out = keys[begin], None
                            name = quote(storm, safe=" ") + self.suffix
                            if self.overwrite or store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                                if not names:
                                    store.create_dir(folder, recursive=True)
                                out = store.open_output_stream(f"{folder}/{name}")
                                names.append(name)
                        if out is not None:
                            out.write("".join([f"{line or ''}\n" for line in lines[begin:end]]).encode())
                        begin = end
            finally:
                if out is not None:
                    out.close()
            return Written(folder, names)

        def commit(self, messages):
            from concurrent.futures import ThreadPoolExecutor

            store, root = store_of(self.path)
            store.create_dir(root, recursive=True)
            moves = [(f"{m.folder}/{name}", f"{root}/{name}") for m in messages if m is not None for name in m.names]
            with ThreadPoolExecutor(16) as pool:
                list(pool.map(lambda move: store.move(*move), moves))
            self._clear()

        def abort(self, messages):
            self._clear()

        def _clear(self):
            from pyarrow import fs

            store, root = store_of(self.path)
            if store.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
                store.delete_dir(f"{root}/{self.job}")

    class TrackFiles(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def writer(self, schema, overwrite):
            return TrackWriter(self.options["path"], self.options["suffix"], overwrite, self.options["job"])

    return TrackFiles


def write_track_files(lines: DataFrame, path: str, overwrite: bool = False, suffix: str = ".dat",
                      order: Sequence[str] = ORDER_COLUMNS) -> None:
    """Write ``line`` of each ``storm_id`` to ``<path>/<storm_id><suffix>``, lines in ``order``.

    ``suffix`` is ``.dat`` (ATCF) or ``.22`` (fort.22).  A storm whose file is there already is
    skipped, or replaced with ``overwrite``; files of other storms stay.  Tasks write to a hidden
    folder, one a task attempt; only when all have ended are the files moved to their names, so a failed
    job leaves none and a lost or repeated task leaves no second copy.  A job lost while files are
    being moved leaves whole files only; run again, it writes the rest.

    One file is one task's stream, held in memory a batch at a time.  ``path`` must be seen alike by driver
    and executors (a mounted folder, ``hdfs://``, ``s3://`` or ``gs://``).  Bytes outside letters, digits,
    blanks and ``_.-~`` are percent-encoded in names.  Rows with a NULL ``storm_id`` belong
    to no file and raise; a NULL line is an empty one.
    """
    if suffix not in SUFFIXES:
        raise NotImplementedError(f"suffix {suffix!r}: only '.dat' and '.22' can be written")
    spark: SparkSession = lines.sparkSession
    spark.dataSource.register(_track_files())
    storm = F.col("storm_id").cast("string")
    todo = lines.select(F.when(storm.isNull(), F.raise_error(F.lit("a record without storm_id has no file"))).otherwise(storm).alias("storm_id"), *order, "line")
    files = todo.repartition("storm_id").sortWithinPartitions("storm_id", *order).select("storm_id", "line")
    writer = files.write.format(FORMAT).option("suffix", suffix).option("job", f"_writing-{uuid.uuid4().hex}")
    writer.mode("overwrite" if overwrite else "append").save(path)
