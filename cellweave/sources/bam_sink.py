"""A data source that writes BAM part files, all or none."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from cellweave.sources import bgzf
from cellweave.sources.splits import file_system


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class _Part:
    """A file under way: data is packed into blocks as it comes, no record is cut by the end of one unless it is longer."""

    def __init__(self, file, head: bytes):
        self.file, self.held = file, bytearray()
        self.add(head)
        self.flush()

    def add(self, record: bytes) -> None:
        if self.held and len(self.held) + len(record) > bgzf.BLOCK_SIZE:
            self.flush()
        self.held += record

    def flush(self) -> None:
        for at in range(0, len(self.held), bgzf.BLOCK_SIZE):
            self.file.write(bgzf.pack(bytes(self.held[at : at + bgzf.BLOCK_SIZE])))
        self.held.clear()

    def close(self) -> None:
        self.flush()
        self.file.write(bgzf.END_BLOCK)
        self.file.close()


class BamWriter(DataSourceWriter):
    """Tasks write below ``_temporary``; the files of successful tasks move to their places on commit."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.by, self.overwrite = options["path"].rstrip("/"), options.get("by", ""), overwrite
        self.contigs = [(n, size) for n, size in json.loads(options["contigs"])]
        self.header = bgzf.header(self.contigs, options.get("header", ""))
        self.job = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        system, root = file_system(self.path)
        number = TaskContext.get().partitionId()
        places = {n: i for i, (n, _) in enumerate(self.contigs)} | {"*": -1, None: -1}
        files: list[str] = []
        part, label = None, None
        for row in iterator:
            if part is None or row.label != label:
                if part is not None:
                    part.close()
                label = row.label
                folder = f"{self.by}={'__null__' if label is None else quote(label, safe='')}/" if self.by else ""
                files.append(f"{folder}part-{number:05d}-{uuid.uuid4().hex[:12]}.bam")
                system.create_dir(f"{root}/{self.job}/{folder}", recursive=True)
                part = _Part(system.open_output_stream(f"{root}/{self.job}/{files[-1]}"), self.header)
            part.add(bgzf.encode(row, places))
        if part is not None:
            part.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        old = [x.path for x in system.get_file_info(fs.FileSelector(root)) if x.base_name != self.job] if self.overwrite else []
        for path in old:
            (system.delete_dir if system.get_file_info(path).type == fs.FileType.Directory else system.delete_file)(path)
        for file in (f for m in messages if m for f in m.files):
            system.create_dir(f"{root}/{file}".rpartition("/")[0], recursive=True)
            system.move(f"{root}/{self.job}/{file}", f"{root}/{file}")
        self._clear(system, root)

    def abort(self, messages: list) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        if system.get_file_info(f"{root}/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.job}")


class BamSink(DataSource):
    @classmethod
    def name(cls):
        return "bam_files"

    def schema(self):
        return f"label string, {bgzf.RECORD_SCHEMA}"

    def writer(self, schema, overwrite):
        return BamWriter(dict(self.options), overwrite)
