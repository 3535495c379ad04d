"""A sharded log as a streaming source with offsets of its own.

The log is a shared folder with Parquet files under ``shard=<id>``; records of a shard are
ordered by a sequence number. An offset holds the last number taken from each
shard. A micro-batch takes at most ``maxRowsPerBatch`` records, shared by the shards: what one
does not need the others get, so a hot shard neither starves the rest nor
waits for them. Every run of records is read by as many tasks as it needs, whichever
shard it belongs to. A shard with a ``_closed`` file is finished once it is read to
its end and is not looked at again; new shards are found by listing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.records import text_map

CLOSED = "_closed"
BEFORE_ALL = -(1 << 63)


def file_system(path: str):
    """The file system of a path and the path within it."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass(frozen=True)
class Run:
    """A row group of a file: its first and last sequence number and its rows."""

    path: str
    group: int
    first: int
    last: int
    rows: int


class Log:
    """What the folder holds; the footers of files, which do not change, are read once."""

    def __init__(self, path: str, seq: str, refresh: float):
        self.path, self.seq, self.refresh = path, seq, refresh
        self.listed, self.shards, self.runs = 0.0, [], {}

    def names(self) -> list[str]:
        """Shards, listed anew when the last listing is older than ``refresh`` seconds."""
        from pyarrow import fs

        if not self.listed or time.monotonic() - self.listed >= self.refresh:
            files, root = file_system(self.path)
            found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
            self.shards = sorted(i.base_name.partition("=")[2] for i in found if i.base_name.startswith("shard="))
            self.listed = time.monotonic()
        return self.shards

    def _footer(self, path: str) -> list[Run]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        files, _ = file_system(self.path)
        with files.open_input_file(path) as f:
            file = pq.ParquetFile(f)
            column = file.schema_arrow.get_field_index(self.seq)
            out = []
            for g in range(file.metadata.num_row_groups):
                group = file.metadata.row_group(g)
                stats = group.column(column).statistics
                if not group.num_rows:
                    continue
                if stats is not None and stats.has_min_max:
                    first, last = stats.min, stats.max
                else:
                    ends = pc.min_max(file.read_row_group(g, columns=[self.seq])[self.seq]).as_py()
                    first, last = ends["min"], ends["max"]
                out.append(Run(path, g, first, last, group.num_rows))
            return out

    def of(self, shard: str) -> tuple[list[Run], bool]:
        """Runs of a shard by their first number, and whether it is finished."""
        from pyarrow import fs

        files, root = file_system(self.path)
        found = files.get_file_info(fs.FileSelector(f"{root}/shard={shard}", allow_not_found=True))
        names = [i.path for i in found if i.base_name[0] not in "_." and i.base_name.endswith(".parquet")]
        with ThreadPoolExecutor(16) as pool:
            fresh = [n for n in names if n not in self.runs]
            self.runs.update(zip(fresh, pool.map(self._footer, fresh)))
        runs = sorted((r for n in names for r in self.runs[n]), key=lambda r: (r.first, r.path, r.group))
        return runs, any(i.base_name == CLOSED for i in found)

    def numbers(self, run: Run):
        """The sequence numbers of one row group: one column of it."""
        import numpy as np
        import pyarrow.parquet as pq

        files, _ = file_system(self.path)
        with files.open_input_file(run.path) as f:
            return np.asarray(pq.ParquetFile(f).read_row_group(run.group, columns=[self.seq])[self.seq])


def shares(waiting: dict[str, int], limit: int | None) -> dict[str, int]:
    """How many rows each shard may give: equal shares, what a shard does not need going to the others."""
    if limit is None:
        return dict(waiting)
    out, left = {}, limit
    for i, (shard, rows) in enumerate(sorted(waiting.items(), key=lambda x: (x[1], x[0]))):
        out[shard] = min(rows, left // (len(waiting) - i))
        left -= out[shard]
    return out


class RecordLogStream(DataSourceStreamReader):
    def __init__(self, options, schema):
        for needed in ("path", "positions"):
            if not options.get(needed):
                raise ValueError(f"recordlog needs the option {needed}")
        self.seq = options.get("seq", "seq")
        self.limit = int(options["maxRowsPerBatch"]) if options.get("maxRowsPerBatch") else None
        self.part = int(options.get("rowsPerPartition", 1_000_000))
        self.start = {k: int(v) for k, v in json.loads(options.get("startAfter") or "{}").items()}
        self.path, self.positions, self.schema = options["path"], options["positions"], schema
        self.refresh = float(options.get("refreshSeconds", 60))
        self.log, self.at = Log(self.path, self.seq, self.refresh), None

    def __getstate__(self):
        return {**self.__dict__, "log": None}

    # What was planned last. Spark asks for the next end without saying where the last one was, and a restarted
    # query has a new reader, so the end of every planned micro-batch is noted before it runs.

    def _note(self, offset: dict) -> None:
        files, folder = file_system(self.positions)
        files.create_dir(folder, recursive=True)
        name = f"{folder}/.{uuid.uuid4().hex}"
        with files.open_output_stream(name) as out:
            out.write(json.dumps(offset).encode())
        files.move(name, f"{folder}/planned.json")

    def _noted(self) -> dict | None:
        from pyarrow import fs

        files, folder = file_system(self.positions)
        if files.get_file_info(f"{folder}/planned.json").type != fs.FileType.File:
            return None
        with files.open_input_stream(f"{folder}/planned.json") as f:
            return json.loads(f.read())

    def initialOffset(self) -> dict:
        return {"at": dict(self.start), "done": {}}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._noted() or self.initialOffset()
        at, done = dict(self.at["at"]), dict(self.at["done"])
        names = self.log.names()
        found = {s: self.log.of(s) for s in names if s not in done}
        waiting = {s: [r for r in runs if r.last > at.get(s, BEFORE_ALL)] for s, (runs, _) in found.items()}
        allowed = shares({s: sum(r.rows for r in runs) for s, runs in waiting.items() if runs}, self.limit)
        for shard, rows in allowed.items():
            if rows:
                at[shard] = self._end(waiting[shard], at.get(shard, BEFORE_ALL), rows)
        for shard, (runs, closed) in found.items():
            if closed and all(r.last <= at.get(shard, BEFORE_ALL) for r in runs):
                done[shard] = at.pop(shard, BEFORE_ALL)
        # Finished shards are remembered as long as the log still lists them. The reader moves on only when a
        # micro-batch is planned: Spark may ask several times.
        return {"at": at, "done": {s: n for s, n in done.items() if s in names}}

    def _end(self, runs: list[Run], after: int, rows: int) -> int:
        """The number of the last of the next ``rows`` records: reads the numbers of the runs that hold them."""
        import numpy as np

        if sum(r.rows for r in runs) <= rows:
            return max(r.last for r in runs)
        held = np.empty(0, np.int64)
        for i, run in enumerate(runs):
            found = self.log.numbers(run)
            held = np.sort(np.concatenate([held, found[found > after]]))[:rows]
            if len(held) == rows and (i + 1 == len(runs) or runs[i + 1].first > held[-1]):
                break
        return int(held[-1])

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._note(end)
        self.at = end
        out = []
        for shard, high in {**end["at"], **end["done"]}.items():
            low = start["at"].get(shard, start["done"].get(shard, BEFORE_ALL))
            if shard in start["done"] or high <= low:
                continue
            held, size = [], 0
            for r in self.log.of(shard)[0]:
                if r.last <= low or r.first > high:
                    continue
                held.append((r.path, r.group))
                size += r.rows
                if size >= self.part:
                    out.append(InputPartition((shard, low, high, held)))
                    held, size = [], 0
            if held:
                out.append(InputPartition((shard, low, high, held)))
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.value is None:
            return
        shard, low, high, runs = partition.value
        wanted = to_arrow_schema(self.schema)
        files, _ = file_system(self.path)
        for path, group in runs:
            with files.open_input_file(path) as f:
                file = pq.ParquetFile(f)
                names = set(file.schema_arrow.names)
                columns = [n for n in wanted.names if n in names]
                for batch in file.iter_batches(10_000, [group], columns=list({*columns, self.seq})):
                    number = batch[self.seq]
                    batch = batch.filter(pc.and_(pc.greater(number, low), pc.less_equal(number, high)))
                    made = [
                        pa.array([shard] * batch.num_rows, pa.string()) if k.name == "shard"
                        else batch[k.name].cast(k.type) if k.name in names
                        else pa.nulls(batch.num_rows, k.type)
                        for k in wanted
                    ]
                    if batch.num_rows:
                        yield pa.RecordBatch.from_arrays(made, schema=wanted)

    def commit(self, end: dict) -> None:
        """Nothing to free: the log is kept by its owner."""


class RecordLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recordlog"

    def schema(self):
        raise ValueError("recordlog needs the schema of its records")

    def streamReader(self, schema):
        return RecordLogStream(self.options, schema)


def read_record_log(
    spark: SparkSession,
    path: str,
    schema: str,
    positions: str,
    seq: str = "seq",
    max_rows: int | None = None,
    rows_per_partition: int = 1_000_000,
    start_after: dict[str, int] | None = None,
    refresh_seconds: float = 60,
) -> DataFrame:
    """The log as a stream: the columns of ``schema``, shard, src_partition and src_offset.

    ``positions`` is a folder of the query, beside its checkpoint. ``start_after`` gives the number after which a
    shard is read by a new query. Records that arrive with a number below the position of their shard are not read;
    a column that a file lacks is null; null numbers are not read. A shard without records and an empty log give none.

    Scale: the driver reads footers of new files, and one column of the row groups in which a capped
    micro-batch ends; records are read by tasks of about ``rows_per_partition`` rows, row group by row group.
    """
    spark.dataSource.register(RecordLog)
    reader = spark.readStream.format("recordlog").schema(f"{schema}, shard string")
    options = {
        "path": path, "positions": positions, "seq": seq, "rowsPerPartition": rows_per_partition,
        "refreshSeconds": refresh_seconds, "startAfter": json.dumps(start_after or {}),
    }
    if max_rows:
        options["maxRowsPerBatch"] = max_rows
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load().withColumns(
        {"src_partition": text_map({"shard": F.col("shard")}), "src_offset": text_map({"seq": F.col(seq)})}
    )


def close_shard(path: str, shard: str) -> None:
    """Marks a shard as finished: nothing will be added to it."""
    files, root = file_system(path)
    files.create_dir(f"{root}/shard={shard}", recursive=True)
    with files.open_output_stream(f"{root}/shard={shard}/{CLOSED}") as out:
        out.write(b"")
