"""Zip archives of CSV files as a Spark data source, and as a sink.

A source's classes go to the executors by value, so that these need not have this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa


def zip_csv_source() -> type:
    """The data source ``zip_csv``: one partition for each member of the archives at the path.

    The path is an archive, or a folder whose ``.zip`` files are read, in any store that pyarrow opens.
    Members are found by the archives' directories, which the driver reads; a task reads the bytes of
    its own member only. The schema must be given, of texts: columns are taken by header name.
    """
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    def opened(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    class Member(InputPartition):
        def __init__(self, archive: str, name: str):
            super().__init__((archive, name))
            self.archive, self.name = archive, name

    class ZipCsvReader(DataSourceReader):
        def __init__(self, path: str, columns: list[str]):
            self.path, self.columns = path, columns

        def partitions(self) -> list:
            import zipfile

            from pyarrow import fs

            store, path = opened(self.path)
            found = store.get_file_info(path)
            archives = [path]
            if found.type == fs.FileType.Directory:
                inside = store.get_file_info(fs.FileSelector(path, recursive=True))
                archives = sorted(f.path for f in inside if f.path.lower().endswith(".zip"))
            elif found.type == fs.FileType.NotFound:
                raise FileNotFoundError(self.path)
            members = []
            for archive in archives:
                with store.open_input_file(archive) as file, zipfile.ZipFile(file) as listed:
                    members += [Member(archive, m.filename) for m in listed.infolist() if not m.is_dir() and m.file_size]
            return members

        def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
            import zipfile

            import pyarrow as pa
            from pyarrow import csv

            store, _ = opened(self.path)
            texts = dict.fromkeys(self.columns, pa.string())
            convert = csv.ConvertOptions(column_types=texts, include_columns=self.columns, strings_can_be_null=True, null_values=[""])
            with store.open_input_file(partition.archive) as file, zipfile.ZipFile(file) as archive, archive.open(partition.name) as member:
                yield from csv.open_csv(member, parse_options=csv.ParseOptions(newlines_in_values=True), convert_options=convert)

    class ZipCsv(DataSource):
        @classmethod
        def name(cls) -> str:
            return "zip_csv"

        def reader(self, schema) -> ZipCsvReader:
            return ZipCsvReader(self.options["path"], schema.fieldNames())

    return ZipCsv


def zip_writer(path: str, names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: writes a task's rows to one archive below ``path``, named after the task.

    It is written under a name of the attempt's own and moved when complete, so a task that is
    repeated leaves one whole archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        import pyarrow as pa
        from pyarrow import csv, fs
        from pyspark import TaskContext

        store, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        context = TaskContext.get()
        store.create_dir(folder, recursive=True)
        member = f"part-{context.partitionId():05d}"
        own = f"{folder}/_{member}-{context.taskAttemptId()}"
        schema = pa.schema([(n, pa.string()) for n in names])
        rows = 0
        with store.open_output_stream(own) as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive, archive.open(f"{member}.csv", "w") as file:
                with csv.CSVWriter(file, schema) as lines:
                    for batch in batches:
                        lines.write_batch(pa.RecordBatch.from_arrays([c.cast(pa.string()) for c in batch.columns], schema=schema))
                        rows += batch.num_rows
        store.move(own, f"{folder}/{member}.zip")
        yield pa.RecordBatch.from_arrays([pa.array([f"{member}.zip"])], ["written"])

    return write
