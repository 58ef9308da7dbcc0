"""Media columns: payloads stored as images in archives, read by a custom data source.

``store`` writes each payload as the samples of an 8-bit greyscale PNG image,
192 samples in a row, into ZIP archives in the shared folder; an archive holds
about 32 MB and gets its name only when it is complete, so a task that is run
again puts the same file in the same place.

``MediaSource`` is a Python data source ("tessaphon_media").  Its planner only
lists archives and their sizes, compares them with the manifest that ``store``
wrote, and deals out byte ranges; a range owns the
members whose headers begin inside it, which its task finds in the archive's
own directory.  Members stream out in Arrow batches of bounded size.  A member
that can't be read (an error of the store, a wrong checksum) is read again by
its offset, alone, without the others; after the last attempt the task fails,
or with on_error=null the row has a null and the error.  So it is for an archive that
is lost, cut or has no directory: an error, or one row without key and offset.
``features`` keeps rows with an error: their digests are null, and error tells why.

Defined cases: a null or empty text is 192 spaces; the unpadded length is kept
in the image; equal texts give equal images; a null id stays null; repeated
rows are members each; an empty table gives an empty result; other columns are
ignored.  Payloads are whole texts of any length.
"""

from __future__ import annotations

import contextlib
import hashlib
import io
import struct
import time
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import fresh

WIDTH, ARCHIVE_BYTES, RANGE_BYTES, BATCH_BYTES, ATTEMPTS = 192, 32 << 20, 8 << 20, 8 << 20, 4
# The PNG signature, and the chunk that holds the unpadded length.
SIGNATURE, LENGTH_CHUNK = b"\x89PNG\r\n\x1a\n", b"naTv"
#: What reading a lost, cut or changed file raises.
BROKEN = (OSError, ValueError, EOFError, struct.error, zlib.error, zipfile.BadZipFile, NotImplementedError)


def padded(data: bytes) -> bytes:
    """Spaces up to a positive multiple of the width."""
    return data + b" " * (-len(data) % WIDTH if data else WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(data: bytes) -> bytes:
    """The image whose samples are the padded data."""
    samples = np.frombuffer(padded(data), np.uint8).reshape(-1, WIDTH)
    rows = np.zeros((len(samples), WIDTH + 1), np.uint8)
    rows[:, 1:] = samples
    head = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(LENGTH_CHUNK, struct.pack(">Q", len(data))) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + _chunk(b"IEND", b"")


def from_png(image: bytes) -> tuple[bytes, int]:
    """The samples of an image that ``to_png`` made, and the unpadded length."""
    if image[:8] != SIGNATURE:
        raise ValueError("not a PNG image")
    at, packed, length, height = 8, [], 0, 0
    while at < len(image):
        size, kind = struct.unpack(">I4s", image[at : at + 8])
        data = image[at + 8 : at + 8 + size]
        if zlib.crc32(kind + data) != struct.unpack(">I", image[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("wrong checksum in a PNG chunk")
        if kind == b"IHDR":
            height = struct.unpack(">I", data[4:8])[0]
        elif kind == LENGTH_CHUNK:
            length = struct.unpack(">Q", data)[0]
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, WIDTH + 1)
    return rows[:, 1:].tobytes(), length


def store(docs: DataFrame, id_col: str, text_col: str) -> str:
    """Write the texts of docs to archives; the folder that holds them."""
    spark = docs.sparkSession
    root = fresh(spark, "media")
    folder = f"{root}/archives"

    def write(batches):
        from pyspark import TaskContext

        fs, where = pafs.FileSystem.from_uri(folder)
        fs.create_dir(where, recursive=True)
        part, number, members, buffer = TaskContext.get().partitionId(), 0, 0, io.BytesIO()
        archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED)

        def close():
            archive.close()
            own = f"{where}/.{uuid.uuid4().hex}"
            with fs.open_output_stream(own) as out:
                out.write(buffer.getbuffer())
            name = f"part-{part:07d}-{number:05d}.zip"
            fs.move(own, f"{where}/{name}")
            return pa.RecordBatch.from_pydict({"archive": [name], "members": [members], "n_bytes": [buffer.tell()]}, schema=pa.schema([("archive", pa.string()), ("members", pa.int64()), ("n_bytes", pa.int64())]))

        for batch in batches:
            for key, text in zip(batch[0], batch[1], strict=True):
                key = key.as_py()
                name = "-" if key is None else "+" + key.encode().hex()
                archive.writestr(zipfile.ZipInfo(name), to_png((text.as_py() or "").encode()))
                members += 1
                if buffer.tell() >= ARCHIVE_BYTES:
                    yield close()
                    number, members, buffer = number + 1, 0, io.BytesIO()
                    archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED)
        if members:
            yield close()

    listed = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(write, "archive string, members long, n_bytes long")
    listed.write.parquet(f"{root}/manifest")
    return folder


class Range(InputPartition):
    def __init__(self, archive: str | None, start: int = 0, end: int = 0, lost: str | None = None):
        self.archive, self.start, self.end, self.lost = archive, start, end, lost


class MediaReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))
        self.on_error = options.get("on_error", "fail")

    def partitions(self):
        """Byte ranges of the archives in the manifest, as it lists them: one that isn't there, or has another size, is an error."""
        fs, where = pafs.FileSystem.from_uri(self.folder)
        there = {i.base_name: i for i in fs.get_file_info(pafs.FileSelector(where, allow_not_found=True)) if i.is_file and i.base_name.endswith(".zip") and i.base_name[0] != "."}
        listed = self.manifest()
        lost = sorted(name for name, size in listed.items() if name not in there or there[name].size != size) if listed is not None else []
        if lost and self.on_error != "null":
            raise FileNotFoundError(f"{len(lost)} archives of the manifest are missing or have another size, the first: {lost[0]}")
        found = [Range(None, lost=name) for name in lost]
        for name in sorted(there if listed is None else listed.keys() - set(lost)):
            for start in range(0, there[name].size, self.range_bytes):
                found.append(Range(there[name].path, start, start + self.range_bytes))
        return found or [Range(None)]

    def manifest(self) -> dict[str, int] | None:
        """Archives and their sizes, as they were stored; None where a folder has no manifest."""
        import pyarrow.parquet as pq

        fs, where = pafs.FileSystem.from_uri(self.folder.rstrip("/").rpartition("/")[0] + "/manifest")
        files = [i.path for i in fs.get_file_info(pafs.FileSelector(where, allow_not_found=True)) if i.is_file and i.base_name.endswith(".parquet")]
        if not files:
            return None
        held = [pq.read_table(f, filesystem=fs, columns=["archive", "n_bytes"]).to_pydict() for f in files]
        return {name: size for t in held for name, size in zip(t["archive"], t["n_bytes"], strict=True)}

    def open(self, archive: str):
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        return fs.open_input_file(archive)

    def directory(self, archive: str) -> list[zipfile.ZipInfo]:
        return self._again(lambda: self._directory(archive))

    def _directory(self, archive: str):
        with self.open(archive) as file, zipfile.ZipFile(file) as held:
            return held.infolist()

    def member(self, archive: str, info: zipfile.ZipInfo, file=None) -> bytes:
        """The bytes of one member, by its offset, against its checksum."""
        with contextlib.ExitStack() as stack:
            file = file or stack.enter_context(self.open(archive))
            file.seek(info.header_offset)
            head = file.read(30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError("no member at this offset")
            file.seek(info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30])))
            data = file.read(info.compress_size)
        if zlib.crc32(data) != info.CRC or len(data) != info.file_size:
            raise ValueError("wrong checksum of a member")
        return bytes(data)

    def _again(self, what):
        for k in range(self.attempts):
            try:
                return what()
            except BROKEN:
                if k + 1 == self.attempts:
                    raise
                time.sleep(0.05 * 2**k)

    def read(self, partition):
        if partition.archive is None:
            if partition.lost is not None:
                yield self.batch([(None, partition.lost, None, None, "the archive is missing or has another size")])
            return
        name = partition.archive.rpartition("/")[2]
        rows, held = [], 0
        try:
            members = self.directory(partition.archive)
        except BROKEN as failed:
            if self.on_error != "null":
                raise
            if partition.start == 0:
                yield self.batch([(None, name, None, None, str(failed) or type(failed).__name__)])
            return
        with contextlib.ExitStack() as stack:
            file = None
            for info in members:
                if not partition.start <= info.header_offset < partition.end:
                    continue
                error, data = None, None
                try:
                    try:
                        file = file or stack.enter_context(self.open(partition.archive))
                        data = self.member(partition.archive, info, file)
                    except BROKEN:
                        data = self._again(lambda info=info: self.member(partition.archive, info))
                except BROKEN as failed:
                    if self.on_error != "null":
                        raise
                    error = str(failed) or type(failed).__name__
                key = None if info.filename == "-" else bytes.fromhex(info.filename[1:]).decode()
                rows.append((key, name, info.header_offset, data, error))
                held += len(data or b"")
                if held >= BATCH_BYTES:
                    yield self.batch(rows)
                    rows, held = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows):
        kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "archive", "offset", "media", "error"])


class MediaSource(DataSource):
    """Members of archives: key, archive, offset, media, error."""

    @classmethod
    def name(cls):
        return "tessaphon_media"

    def schema(self):
        return "key string, archive string, offset long, media binary, error string"

    def reader(self, schema):
        return MediaReader(self.options)


def read(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The members of all archives in a folder."""
    spark.dataSource.register(MediaSource)
    return spark.read.format("tessaphon_media").options(**options).load(folder)


def feature(payload: bytes) -> str:
    """Mean, deviation and crossings of the samples, then levels of 8 bands (means over frames of the width)."""
    power, crossings, total, squares = np.zeros(WIDTH // 2 + 1), 0, 0, 0
    for at in range(0, len(payload), WIDTH * 4096):
        x = np.frombuffer(payload[at : at + WIDTH * 4096], np.uint8)
        total, squares = total + int(x.sum(dtype=np.int64)), squares + int((x.astype(np.int64) ** 2).sum())
        crossings += int(np.count_nonzero(np.diff(x >= 97)))
        power += (np.abs(np.fft.rfft(x.reshape(-1, WIDTH).astype(np.float64) - 97)) ** 2).sum(axis=0)
    n = len(payload)
    mean = total / n
    bands = [10 * np.log10(b.sum() * WIDTH / n + 1e-9) for b in np.array_split(power[1:], 8)]
    return f"mean={mean:.3f};std={max(0.0, squares / n - mean * mean) ** 0.5:.3f};cross={crossings};bands=" + ",".join(f"{b:.1f}" for b in bands)


def features(members: DataFrame, id_type: str = "long") -> DataFrame:
    """One row for each member: digests of payload and image, and the feature text; where there is an error, nulls and the error."""

    def run(batches):
        for batch in batches:
            out = []
            for image, error in zip(batch[1], batch[2].to_pylist(), strict=True):
                image = image.as_py()
                try:
                    payload, n = from_png(image) if image is not None else (None, None)
                except BROKEN as failed:
                    payload, error = None, str(failed) or type(failed).__name__
                if payload is None:
                    out.append((None,) * 7 + (error or "no image",))
                else:
                    out.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(image), hashlib.sha256(image).hexdigest(), feature(payload), None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            columns = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([batch[0], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"]
    kinds = "id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"
    found = members.select("key", "media", "error").mapInArrow(run, kinds)
    return found.withColumn("id", F.col("id").cast(id_type))
