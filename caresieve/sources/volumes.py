"""Image volumes as slice rows: NRRD, NIfTI-1, uncompressed DICOM and grey PNG, read by a Python data source.

Sizes are those of the files: w columns run fastest, then h rows, then slices. Places
and directions are in the patient system left, posterior, superior in all formats.
"""

from __future__ import annotations

import gzip
import io
import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from caresieve.functions.text import normal_path
from caresieve.session import ship
from caresieve.sources.files import SourceError

SCHEMA = (
    "path string, format string, fault string, slice_idx int, n_slices int, h int, w int, z double, position array<double>, spacing array<double>, cosines array<double>, "
    "modality string, photometric string, bits int, slope double, intercept double, tags string, pixels array<double>"
)
_NUMBERS = pa.list_(pa.float64())
_KINDS = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<double>": _NUMBERS}
ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (x.strip().split(" ") for x in SCHEMA.split(", "))])
#: Small files share a partition up to this size; a row batch holds about so many bytes of pixels.
PARTITION_BYTES, BATCH_BYTES = 64 << 20, 4 << 20
EXTENSIONS = (".nrrd", ".nii", ".nii.gz", ".dcm", ".png", ".npy")


class Fault(ValueError):
    """A file isn't a volume that can be read."""


@dataclass
class Head:
    """What a file says about its voxels, and the stream that stands before them."""

    format: str
    shape: tuple[int, int, int]
    dtype: np.dtype
    stream: BinaryIO
    spacing: tuple[float, ...] = (1.0, 1.0, 1.0)
    origin: tuple[float, ...] = (0.0, 0.0, 0.0)
    axes: np.ndarray = field(default_factory=lambda: np.eye(3))
    slope: float = 1.0
    intercept: float = 0.0
    modality: str | None = None
    photometric: str | None = None
    bits: int | None = None
    tags: dict = field(default_factory=dict)


def _take(stream: BinaryIO, n: int) -> bytes:
    try:
        data = stream.read(n)
    except (EOFError, OSError, zlib.error) as e:
        raise Fault(f"compressed data can't be read: {e}") from None
    if len(data) < n:
        raise Fault(f"the file ends {n - len(data)} bytes early")
    return data


# ---- NRRD

_NRRD_TYPES = {
    **dict.fromkeys(("signed char", "int8", "int8_t"), "i1"), **dict.fromkeys(("uchar", "unsigned char", "uint8", "uint8_t"), "u1"),
    **dict.fromkeys(("short", "short int", "signed short", "int16", "int16_t"), "i2"), **dict.fromkeys(("ushort", "unsigned short", "uint16", "uint16_t"), "u2"),
    **dict.fromkeys(("int", "signed int", "int32", "int32_t"), "i4"), **dict.fromkeys(("uint", "unsigned int", "uint32", "uint32_t"), "u4"), "float": "f4", "double": "f8",
}


def _numbers(text: str) -> list[float]:
    return [float(x) for x in text.replace("(", " ").replace(")", " ").replace(",", " ").split()]


def _nrrd(stream: BinaryIO) -> Head:
    fields: dict[str, str] = {}
    stream.readline()
    while line := stream.readline():
        text = line.decode("latin-1").rstrip("\r\n")
        if not text:
            break
        if not text.startswith("#"):
            key, _, value = text.partition(":")
            fields[key.strip().lower()] = value.lstrip("= ").strip()
    else:
        raise Fault("the header doesn't end")
    try:
        sizes, kind = [int(x) for x in fields["sizes"].split()], _NRRD_TYPES[fields["type"].lower()]
    except (KeyError, ValueError) as e:
        raise Fault(f"the header has no usable sizes or type: {e}") from None
    if len(sizes) not in (2, 3) or min(sizes) < 1 or "data file" in fields or "datafile" in fields:
        raise Fault("only attached data of two or three dimensions can be read")
    encoding = fields.get("encoding", "raw").lower()
    if encoding not in ("raw", "gzip", "gz"):
        raise Fault(f"the encoding {encoding} can't be read")
    order = ">" if fields.get("endian", "little").lower() == "big" else "<"
    head = Head("nrrd", (*sizes, 1)[:3], np.dtype(order + kind), gzip.GzipFile(fileobj=stream) if encoding != "raw" else stream, tags=fields)
    turn = np.array([-1, -1, 1]) if fields.get("space", "").lower() in ("right-anterior-superior", "ras") else np.ones(3)
    if "space directions" in fields and len(sizes) == 3 and "none" not in fields["space directions"]:
        directions = np.array(_numbers(fields["space directions"])).reshape(3, 3) * turn
        head.spacing = tuple(np.linalg.norm(directions, axis=1).tolist())
        head.axes = directions / np.maximum(np.array(head.spacing)[:, None], 1e-300)
    elif "spacings" in fields:
        head.spacing = (*_numbers(fields["spacings"]), 1.0)[:3]
    if len(origin := _numbers(fields.get("space origin", ""))) == 3:
        head.origin = tuple((np.array(origin) * turn).tolist())
    return head


# ---- NIfTI-1

_NIFTI_TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4"}


def _nifti(stream: BinaryIO) -> Head:
    raw = _take(stream, 348)
    order = "<" if struct.unpack("<i", raw[:4])[0] == 348 else ">"
    dim = struct.unpack(f"{order}8h", raw[40:56])
    code = struct.unpack(f"{order}h", raw[70:72])[0]
    pixdim = struct.unpack(f"{order}8f", raw[76:108])
    offset, slope, intercept = struct.unpack(f"{order}3f", raw[108:120])
    if code not in _NIFTI_TYPES or not 2 <= dim[0] <= 7 or min(dim[1 : dim[0] + 1]) < 1 or any(d > 1 for d in dim[4 : dim[0] + 1]):
        raise Fault("only two or three dimensions of plain numbers can be read")
    q_code, s_code = struct.unpack(f"{order}2h", raw[252:256])
    if s_code > 0:
        affine = np.array(struct.unpack(f"{order}12f", raw[280:328])).reshape(3, 4)
    elif q_code > 0:
        b, c, d, *shift = struct.unpack(f"{order}6f", raw[256:280])
        a = max(0.0, 1 - b * b - c * c - d * d) ** 0.5
        turn = np.array([[a * a + b * b - c * c - d * d, 2 * (b * c - a * d), 2 * (b * d + a * c)], [2 * (b * c + a * d), a * a + c * c - b * b - d * d, 2 * (c * d - a * b)], [2 * (b * d - a * c), 2 * (c * d + a * b), a * a + d * d - b * b - c * c]])
        size = np.array(pixdim[1:4]) * [1, 1, -1 if pixdim[0] < 0 else 1]
        affine = np.concatenate([turn * size, np.array(shift)[:, None]], axis=1)
    else:
        affine = np.concatenate([np.diag(pixdim[1:4]), np.zeros((3, 1))], axis=1)
    affine = affine * np.array([[-1], [-1], [1]])  # right, anterior, superior in the file
    spacing = np.linalg.norm(affine[:, :3], axis=0)
    _take(stream, max(0, int(offset) - 348))
    shape = (*dim[1 : dim[0] + 1], 1, 1)[:3]
    axes = (affine[:, :3] / np.maximum(spacing, 1e-300)).T
    scale = (slope, intercept) if slope and np.isfinite(slope) else (1.0, 0.0)
    return Head("nifti", shape, np.dtype(order + _NIFTI_TYPES[code]), stream, tuple(spacing.tolist()), tuple(affine[:, 3].tolist()), axes, *scale)


# ---- DICOM

#: Keywords of the tags that are read here or that commonly identify a patient.
KEYWORDS = {
    "00020010": "TransferSyntaxUID", "00080018": "SOPInstanceUID", "00080020": "StudyDate", "00080050": "AccessionNumber", "00080060": "Modality", "00080080": "InstitutionName", "00080090": "ReferringPhysicianName",
    "00100010": "PatientName", "00100020": "PatientID", "00100030": "PatientBirthDate", "00100040": "PatientSex", "00101010": "PatientAge", "00101040": "PatientAddress", "00120062": "PatientIdentityRemoved",
    "00185101": "ViewPosition", "0020000D": "StudyInstanceUID", "0020000E": "SeriesInstanceUID", "00200013": "InstanceNumber", "00200020": "PatientOrientation", "00200032": "ImagePositionPatient", "00200037": "ImageOrientationPatient",
    "00280002": "SamplesPerPixel", "00280004": "PhotometricInterpretation", "00280008": "NumberOfFrames", "00280010": "Rows", "00280011": "Columns", "00280030": "PixelSpacing", "00280100": "BitsAllocated", "00280103": "PixelRepresentation",
    "00281052": "RescaleIntercept", "00281053": "RescaleSlope", "00180088": "SpacingBetweenSlices", "00180050": "SliceThickness", "00081140": "ReferencedImageSequence", "00081110": "ReferencedStudySequence", "00400275": "RequestAttributesSequence",
}
_LONG = frozenset(("OB", "OD", "OF", "OL", "OV", "OW", "SQ", "SV", "UC", "UN", "UR", "UT", "UV"))
_BINARY = {"US": "H", "SS": "h", "UL": "I", "SL": "i", "FL": "f", "FD": "d"}
_OPEN = 0xFFFFFFFF
#: Values of more bytes than this aren't tags to look at.
_TAG_BYTES = 1 << 16


def _elements(stream: BinaryIO, explicit: bool, end: int | None = None, pixels: Callable[[int], None] | None = None) -> dict:
    """The tags up to `end`, or up to the mark that closes an item; sequences are lists of such dicts."""
    out: dict = {}
    while end is None or stream.tell() < end:
        raw = stream.read(8)
        if not raw and end is None:
            break
        if len(raw) < 8:
            raise Fault("the file ends in a tag")
        group, number = struct.unpack("<HH", raw[:4])
        if (group, number) in ((0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)):
            break
        vr = ""
        if explicit or group == 2:
            vr = raw[4:6].decode("latin-1")
            size = struct.unpack("<I", _take(stream, 4))[0] if vr in _LONG else struct.unpack("<H", raw[6:])[0]
        else:
            size = struct.unpack("<I", raw[4:])[0]
        if (group, number) == (0x7FE0, 0x0010) and pixels:
            pixels(size)
            break
        key = KEYWORDS.get(f"{group:04X}{number:04X}", f"{group:04X}{number:04X}")
        if vr == "SQ" or size == _OPEN:
            out[key] = _sequence(stream, explicit, size)
        elif size > _TAG_BYTES:
            stream.seek(size, io.SEEK_CUR)
        else:
            value = _take(stream, size)
            if not vr and value[:4] == b"\xfe\xff\x00\xe0":  # a sequence that doesn't say so
                out[key] = _sequence(io.BytesIO(value), explicit, size)
            elif vr in _BINARY:
                many = [x[0] for x in struct.iter_unpack(f"<{_BINARY[vr]}", value)]
                out[key] = many[0] if len(many) == 1 else many
            elif not vr and key in ("Rows", "Columns", "BitsAllocated", "PixelRepresentation", "SamplesPerPixel"):
                out[key] = struct.unpack("<H", value[:2])[0]
            elif vr not in _LONG or vr in ("UC", "UR", "UT"):
                out[key] = value.decode("utf-8", "replace").strip(" \0")
    return out


def _sequence(stream: BinaryIO, explicit: bool, size: int) -> list[dict]:
    end, items = None if size == _OPEN else stream.tell() + size, []
    while end is None or stream.tell() < end:
        group, number, n = struct.unpack("<HHI", _take(stream, 8))
        if (group, number) == (0xFFFE, 0xE0DD):
            break
        if (group, number) != (0xFFFE, 0xE000):
            raise Fault("a sequence holds something else than items")
        items.append(_elements(stream, explicit, None if n == _OPEN else stream.tell() + n))
    return items


def _dicom(stream: BinaryIO) -> Head:
    stream.seek(132)
    # the tags of the file itself come first, always explicit, and say how the others are written
    start = struct.unpack("<HHHHI", _take(stream, 12))
    meta = _elements(stream, True, stream.tell() + start[4])
    syntax = meta.get("TransferSyntaxUID", "")
    if syntax not in ("1.2.840.10008.1.2", "1.2.840.10008.1.2.1"):
        raise Fault(f"the transfer syntax {syntax} can't be read")
    sizes: list[int] = []
    tags = meta | _elements(stream, syntax.endswith(".2.1"), None, sizes.append)
    if not sizes:
        raise Fault("there are no pixels")
    try:
        bits, samples, frames = int(tags.get("BitsAllocated", 16)), int(tags.get("SamplesPerPixel", 1)), int(tags.get("NumberOfFrames") or 1)
        shape = (int(tags["Columns"]), int(tags["Rows"]), frames)
    except (KeyError, ValueError, TypeError) as e:
        raise Fault(f"the size of the image isn't given: {e}") from None
    if sizes[0] == _OPEN or samples != 1 or bits not in (8, 16, 32):
        raise Fault("only plain pixels of one sample and 8, 16 or 32 bits can be read")

    def several(name: str) -> list[float]:
        value = tags.get(name) or ""
        return [float(x) for x in value.split("\\")] if isinstance(value, str) and value else []

    head = Head("dicom", shape, np.dtype(f"<{'i' if tags.get('PixelRepresentation') else 'u'}{bits // 8}"), stream, modality=tags.get("Modality"), photometric=tags.get("PhotometricInterpretation"), bits=bits, tags=tags)
    try:
        between = float(tags.get("SpacingBetweenSlices") or tags.get("SliceThickness") or 1)
        if len(gap := several("PixelSpacing")) == 2:
            head.spacing = (gap[1], gap[0], between)
        if len(place := several("ImagePositionPatient")) == 3:
            head.origin = tuple(place)
        if len(turn := several("ImageOrientationPatient")) == 6:
            head.axes = np.array([turn[:3], turn[3:], np.cross(turn[:3], turn[3:])])
        head.slope, head.intercept = float(tags.get("RescaleSlope") or 1), float(tags.get("RescaleIntercept") or 0)
    except ValueError as e:
        raise Fault(f"a number can't be read: {e}") from None
    return head


# ---- PNG


def _png(stream: BinaryIO) -> Head:
    stream.seek(8)
    packed, size = [], None
    while True:
        n, kind = struct.unpack(">I4s", _take(stream, 8))
        data = _take(stream, n)
        if struct.unpack(">I", _take(stream, 4))[0] != zlib.crc32(kind + data):
            raise Fault("a block has a wrong checksum")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            packed.append(data)
        elif kind == b"IEND":
            break
    if not size or size[3] != 0 or size[2] not in (8, 16) or size[6]:
        raise Fault("only grey images of 8 or 16 bits without interlace can be read")
    w, h, bits = size[:3]
    step = bits // 8
    try:
        lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    except zlib.error as e:
        raise Fault(f"compressed data can't be read: {e}") from None
    if len(lines) != h * (w * step + 1):
        raise Fault("the image has a wrong size")
    lines = lines.reshape(h, w * step + 1)
    out, above = np.zeros((h, w * step), np.uint8), np.zeros(w * step, np.uint8)
    for i in range(h):
        above = out[i] = _unfiltered(int(lines[i, 0]), lines[i, 1:], above, step)
    return Head("png", (w, h, 1), np.dtype(">u2" if step == 2 else "u1"), io.BytesIO(out.tobytes()), photometric="MONOCHROME2", bits=bits)


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A line of bytes from its differences to the bytes to the left, above, or both."""
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    if kind not in (3, 4):
        raise Fault(f"there is no filter {kind}")
    out, up = [0] * step + line.tolist(), [0] * step + above.tolist()
    for i in range(step, len(out)):
        a, b, c = out[i - step], up[i], up[i - step]
        if kind == 3:
            near = (a + b) // 2
        else:
            near = min((a, b, c), key=lambda v: abs(a + b - c - v))  # of equal distances the first
        out[i] = (out[i] + near) & 255
    return np.array(out[step:], np.uint8)


# ---- arrays


def _npy(stream: BinaryIO) -> Head:
    """An array file of two or three dimensions, (slices,) rows and columns: what preparation hands on."""
    try:
        version = np.lib.format.read_magic(stream)
        shape, by_columns, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(stream)
    except ValueError as e:
        raise Fault(f"the header can't be read: {e}") from None
    if len(shape) not in (2, 3) or by_columns or dtype.kind not in "iuf" or not all(shape):
        raise Fault("only plain numbers of two or three dimensions, row by row, can be read")
    return Head("npy", (*shape[::-1], 1)[:3], dtype, stream)


# ---- rows


def head_of(stream: BinaryIO) -> Head:
    """The head of a volume, by the first bytes of its file and not by its name."""
    first = stream.read(348)
    stream.seek(0)
    if first[:2] == b"\x1f\x8b":
        return _nifti(gzip.GzipFile(fileobj=stream))
    if first[:6] == b"\x93NUMPY":
        return _npy(stream)
    if first[:4] == b"NRRD":
        return _nrrd(stream)
    if first[:8] == b"\x89PNG\r\n\x1a\n":
        return _png(stream)
    if first[128:132] == b"DICM":
        return _dicom(stream)
    if len(first) == 348 and first[344:348] == b"n+1\0":
        return _nifti(stream)
    raise Fault("no format that can be read")


def slice_rows(path: str, stream: BinaryIO, pixels: bool = True) -> Iterator[dict]:
    """The slices of a file, one held at a time; where it breaks off comes a row with the fault."""
    row: dict = {"path": path}
    try:
        head = head_of(stream)
        w, h, n = head.shape
        normal = np.cross(head.axes[0], head.axes[1])
        row |= {"format": head.format, "n_slices": n, "h": h, "w": w, "spacing": list(head.spacing), "cosines": [*head.axes[0].tolist(), *head.axes[1].tolist()], "modality": head.modality, "photometric": head.photometric}
        row |= {"bits": head.bits or head.dtype.itemsize * 8, "slope": head.slope, "intercept": head.intercept, "tags": json.dumps(head.tags) if head.tags else None}
        for i in range(n):
            values = np.frombuffer(_take(head.stream, w * h * head.dtype.itemsize), head.dtype) if pixels else None
            place = np.array(head.origin) + i * head.spacing[2] * head.axes[2]
            yield row | {"slice_idx": i, "position": place.tolist(), "z": float(place @ normal), "pixels": None if values is None else values.astype(np.float64)}
        if pixels and isinstance(head.stream, gzip.GzipFile):
            head.stream.read(1)  # its checksum is tested at the end
    except Fault as e:
        yield row | {"fault": str(e)}
    except (ValueError, struct.error, IndexError, EOFError, OSError, MemoryError, OverflowError) as e:  # a damaged head can lead anywhere
        yield row | {"fault": f"the file can't be read: {e}"}


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 8 * len(row["pixels"]) + 1000 if row.get("pixels") is not None else 1000
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=ARROW)


class Files(InputPartition):
    """Files that one task reads."""

    def __init__(self, paths: list[str]):
        self.paths = paths


class VolumeReader(DataSourceReader):
    """Lists a folder on the driver, by names and sizes alone; tasks read the files."""

    def __init__(self, options: dict):
        self.root, self.pixels = local_path(options["path"]), str(options.get("pixels", "true")).lower() == "true"

    def partitions(self) -> list[Files]:
        found = [self.root] if os.path.isfile(self.root) else sorted(os.path.join(d, f) for d, _, names in os.walk(self.root) for f in names if f.lower().endswith(EXTENSIONS))
        out, held, size = [], [], 0
        for path in found:
            n = os.path.getsize(path)
            if held and size + n > PARTITION_BYTES:
                out.append(Files(held))
                held, size = [], 0
            held.append(path)
            size += n
        return [*out, Files(held)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        def rows():
            for path in partition.paths:
                try:
                    with open(path, "rb") as stream:
                        yield from slice_rows(path, stream, self.pixels)
                except OSError as e:
                    yield {"path": path, "fault": f"the file can't be opened: {e}"}

        return _batches(rows())


class VolumeSource(DataSource):
    """spark.read.format("volumes").load(folder): slices of all volumes below a folder that driver and executors mount."""

    @classmethod
    def name(cls) -> str:
        return "volumes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> VolumeReader:
        return VolumeReader(dict(self.options))


def local_path(path: str) -> str:
    """A path of a mounted file system, with or without file: before it."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise SourceError(f"{path} isn't mounted: load it as binaryFile and use slices_of")
    return path


def read_volumes(spark: SparkSession, folder: str, pixels: bool = True) -> DataFrame:
    """SCHEMA's columns, a row per slice of every volume below a mounted folder; fault rows for what can't be read.

    The rows before the place at which a file breaks off stay. Without `pixels` only heads are read.
    """
    ship(spark).dataSource.register(VolumeSource)
    return spark.read.format("volumes").option("pixels", str(pixels).lower()).load(folder)


def slices_of(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """The same rows from a column of whole files, as Spark's binaryFile source gives them from any store."""
    ship(files.sparkSession)

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                if data.is_valid:
                    yield from _batches(slice_rows(name.as_py(), io.BytesIO(data.as_py())))
                else:
                    yield from _batches(iter([{"path": name.as_py(), "fault": "the file can't be opened"}]))

    return files.select(path, content).mapInArrow(run, SCHEMA)


# ---- writing


def encode_nrrd(voxels: np.ndarray, spacing=(1.0, 1.0, 1.0), origin=(0.0, 0.0, 0.0), axes=None, packed: bool = False) -> bytes:
    """voxels (slices, rows, columns) as an NRRD file; axes: directions of columns, rows and slices."""
    kind = {"i1": "int8", "u1": "uint8", "i2": "int16", "u2": "uint16", "i4": "int32", "u4": "uint32", "f4": "float", "f8": "double"}[voxels.dtype.str[1:]]
    directions = (np.eye(3) if axes is None else np.asarray(axes)) * np.array(spacing)[:, None]
    vector = lambda v: "(" + ",".join(repr(float(x)) for x in v) + ")"
    head = ["NRRD0004", f"type: {kind}", "dimension: 3", "space: left-posterior-superior", f"sizes: {' '.join(map(str, voxels.shape[::-1]))}", f"space directions: {' '.join(map(vector, directions))}", "kinds: domain domain domain", "endian: little", f"encoding: {'gzip' if packed else 'raw'}", f"space origin: {vector(origin)}", "", ""]
    data = voxels.astype(voxels.dtype.newbyteorder("<")).tobytes()
    return "\n".join(head).encode() + (gzip.compress(data, mtime=0) if packed else data)


def encode_nifti(voxels: np.ndarray, spacing=(1.0, 1.0, 1.0), origin=(0.0, 0.0, 0.0), axes=None, packed: bool = False) -> bytes:
    """The same as a NIfTI-1 file."""
    code = {v: k for k, v in _NIFTI_TYPES.items()}[voxels.dtype.str[1:]]
    affine = np.concatenate([((np.eye(3) if axes is None else np.asarray(axes)) * np.array(spacing)[:, None]).T, np.array(origin)[:, None]], axis=1) * [[-1], [-1], [1]]
    raw = bytearray(352)
    struct.pack_into("<i", raw, 0, 348)
    struct.pack_into("<8h", raw, 40, 3, *voxels.shape[::-1], 1, 1, 1, 1)
    struct.pack_into("<2h", raw, 70, code, voxels.dtype.itemsize * 8)
    struct.pack_into("<8f", raw, 76, 1, *spacing, 1, 1, 1, 1)
    struct.pack_into("<3f", raw, 108, 352, 1, 0)
    struct.pack_into("<2h", raw, 252, 0, 1)
    struct.pack_into("<12f", raw, 280, *affine.ravel())
    raw[344:348] = b"n+1\0"
    data = bytes(raw) + voxels.astype(voxels.dtype.newbyteorder("<")).tobytes()
    return gzip.compress(data, mtime=0) if packed else data


def encode_dicom(voxels: np.ndarray, tags: dict | None = None, explicit: bool = True) -> bytes:
    """voxels as one DICOM file, a frame a slice; tags: keyword or eight hex digits to text, number or list of such dicts."""
    numbers = {v: k for k, v in KEYWORDS.items()}
    shorts = {"SamplesPerPixel": 1, "Rows": voxels.shape[1], "Columns": voxels.shape[2], "BitsAllocated": voxels.dtype.itemsize * 8, "PixelRepresentation": int(voxels.dtype.kind == "i")}

    def element(key: str, value, plain: bool) -> bytes:
        tag = bytes.fromhex(numbers.get(key, key))
        tag = tag[1::-1] + tag[3:1:-1]
        if isinstance(value, list):
            body = b"".join(struct.pack("<HHI", 0xFFFE, 0xE000, len(x := elements(item, plain))) + x for item in value)
            vr = b"SQ"
        elif isinstance(value, int):
            body, vr = struct.pack("<H", value), b"US"
        elif isinstance(value, bytes):
            body, vr = value + b"\0" * (len(value) % 2), b"OW"
        else:
            body, vr = value.encode() + b" " * (len(value.encode()) % 2), b"LO"
        if not plain:
            return tag + struct.pack("<I", len(body)) + body
        return tag + vr + (struct.pack("<HI", 0, len(body)) if vr.decode() in _LONG else struct.pack("<H", len(body))) + body

    def elements(items: dict, plain: bool) -> bytes:
        return b"".join(element(k, items[k], plain) for k in sorted(items, key=lambda k: numbers.get(k, k)))

    syntax = element("TransferSyntaxUID", "1.2.840.10008.1.2" + ".1" * explicit, True)
    whole = {"Modality": "CT", "PhotometricInterpretation": "MONOCHROME2", "NumberOfFrames": str(len(voxels)), **(tags or {}), **shorts}
    data = voxels.astype(voxels.dtype.newbyteorder("<")).tobytes()
    pixels = element("7FE00010", data, explicit)
    return b"\0" * 128 + b"DICM" + struct.pack("<HH2sHI", 2, 0, b"UL", 4, len(syntax)) + syntax + elements(whole, explicit) + pixels


def encode_png(plane: np.ndarray) -> bytes:
    """A grey image of 8 or 16 bits as a PNG file."""
    step = plane.dtype.itemsize
    lines = np.ascontiguousarray(plane.astype(plane.dtype.newbyteorder(">"))).view(np.uint8).reshape(len(plane), -1)

    def block(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    body = np.concatenate([np.zeros((len(lines), 1), np.uint8), lines], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + block(b"IHDR", struct.pack(">IIBBBBB", plane.shape[1], plane.shape[0], 8 * step, 0, 0, 0, 0)) + block(b"IDAT", zlib.compress(body)) + block(b"IEND", b"")


def encode_npy(voxels: np.ndarray, *_) -> bytes:
    """voxels as an array file; places and directions aren't part of it."""
    out = io.BytesIO()
    np.save(out, voxels)
    return out.getvalue()


#: Formats that `volume_files` writes, and their extensions.
WRITERS = {"nrrd": (encode_nrrd, ".nrrd", {}), "nrrd.gz": (encode_nrrd, ".nrrd", {"packed": True}), "nifti": (encode_nifti, ".nii", {}), "nifti.gz": (encode_nifti, ".nii.gz", {"packed": True}), "npy": (encode_npy, ".npy", {})}


def volume_files(slices: DataFrame, volume: str, dtype: str = "f4", form: str | None = None) -> DataFrame:
    """(name, content): one file a volume from rows (volume, slice_idx, h, w, pixels), in order of slice_idx.

    Spacing, the first slice's position and cosines are written where there are such columns. form:
    a key of WRITERS, else each volume's own column `form` says it. A task holds one volume.
    """
    own = form or "nrrd"
    rows = slices if form is None and "form" in slices.columns else slices.withColumn("form", F.lit(own))

    def encode(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice_idx")
        first = {c: table.column(c)[0].as_py() for c in table.column_names if c != "pixels"}
        voxels = np.array(table.column("pixels").combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype).reshape(-1, first["h"], first["w"])
        turn = first.get("cosines")
        axes = np.array([turn[:3], turn[3:], np.cross(turn[:3], turn[3:])]) if turn else None
        function, extension, more = WRITERS[first["form"]]
        content = function(voxels, first.get("spacing") or (1.0, 1.0, 1.0), first.get("position") or (0.0, 0.0, 0.0), axes, **more)
        return pa.table({"name": pa.array([f"{first[volume]}{extension}"]), "content": pa.array([content], pa.binary())})

    ship(slices.sparkSession)
    return rows.groupBy(volume).applyInArrow(encode, "name string, content binary")


def write_files(files: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """(path, length) of the files written to a mounted folder, each by the task that holds it; names may hold folders.

    A file appears whole under its name, so a task that runs again does no harm.
    """
    root = local_path(folder)
    ship(files.sparkSession)

    def run(batches):
        for batch in batches:
            paths, sizes = [], []
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                path, body = os.path.join(root, n), data.as_py()
                os.makedirs(os.path.dirname(path), exist_ok=True)
                part = f"{path}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(body)
                os.replace(part, path)
                paths.append(path)
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "length"])

    return files.select(name, content).mapInArrow(run, "path string, length bigint")


def image_files(slices: DataFrame, name: str, pixels: str = "pixels") -> DataFrame:
    """(name, content): each slice, or projection of slices, as a grey PNG of 8 bits, scaled from its least to its greatest value; constant ones are black."""
    ship(slices.sparkSession)

    def run(batches):
        for batch in batches:
            names, contents = [], []
            for n, p, h, w in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if p.is_valid and h and w:
                    x = p.values.to_numpy(zero_copy_only=False).reshape(h, w)
                    top = x.max() - x.min()
                    names.append(f"{n}.png")
                    contents.append(encode_png(np.rint((x - x.min()) / (top if top else 1) * 255).astype(np.uint8)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])

    return slices.select(name, F.transform(pixels, lambda v: v.cast("double")).alias("p"), "h", "w").mapInArrow(run, "name string, content binary")


def copy_files(manifest: DataFrame, root: str, folder: str) -> DataFrame:
    """(path, length) of the files of a manifest (source_path, target_path) below root, copied to a mounted folder.

    Sources are read by Spark from any store, each whole (2 GB at most), by the task that writes it.
    """
    files = manifest.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    own = lambda c: normal_path(F.regexp_replace(c, "^file:/+", "/"))
    source = manifest.select(own(F.col("source_path")).alias("source"), "target_path")
    return write_files(files.join(source, own(F.col("path")) == F.col("source")).select("target_path", "content"), folder, "target_path", "content")
