"""Media columns: Netpbm and BMP bytes as arrays, area-resized tiles in NPY form and difference hashes.

Decoders cover P1 to P6 (8-bit samples) and uncompressed BMP with 1, 4, 8, 24 or 32 bits.
Nulls: a null text is an empty one; null media yield null columns. An empty text becomes one row of
padding. Repeated rows and equal texts give equal values; extra input columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import slices

#: A stored image row: 64 pixels of three 8-bit samples.
ROW_PIXELS, ROW_BYTES = 64, 192
TILE = 16


# ---- formats -------------------------------------------------------------------------------------
def encode_ppm(pixels: np.ndarray) -> bytes:
    height, width, _ = pixels.shape
    return b"P6\n%d %d\n255\n" % (width, height) + pixels.tobytes()


def encode_pgm(gray: np.ndarray) -> bytes:
    height, width = gray.shape
    return b"P5\n%d %d\n255\n" % (width, height) + gray.tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """A bottom-up 24-bit BMP of an RGB array."""
    height, width, _ = pixels.shape
    pad = -width * 3 % 4
    rows = np.zeros((height, width * 3 + pad), np.uint8)
    rows[:, : width * 3] = pixels[::-1, :, ::-1].reshape(height, -1)
    body = rows.tobytes()
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


def _header(data: bytes, count: int) -> tuple[list[int], int]:
    """count decimal numbers after the magic, comments skipped, and where the raster begins."""
    found: list[int] = []
    at = 2
    while len(found) < count:
        while at < len(data) and (data[at : at + 1].isspace() or data[at : at + 1] == b"#"):
            at = (data.find(b"\n", at) if data[at : at + 1] == b"#" else at) + 1
            if at == 0:
                raise ValueError("an unfinished comment")
        end = at
        while end < len(data) and data[end : end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("a number is missing in the header")
        found.append(int(data[at:end]))
        at = end
    return found, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """An (h, w) or (h, w, 3) array of 8-bit samples; bitmaps become 0 (black) and 255."""
    kind = data[:2]
    if kind in (b"P1", b"P4"):
        (width, height), at = _header(data, 2)
        if kind == b"P4":
            raster = np.frombuffer(data, np.uint8, height * ((width + 7) // 8), at).reshape(height, -1)
            bits = np.unpackbits(raster, axis=1)[:, :width]
        else:
            digits = np.frombuffer(data, np.uint8, offset=at)
            bits = (digits[(digits == 48) | (digits == 49)] - 48)[: width * height].reshape(height, width)
        return ((1 - bits) * 255).astype(np.uint8)
    if kind not in (b"P2", b"P3", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    (width, height, top), at = _header(data, 3)
    if not 0 < top < 256:
        raise ValueError("only 8-bit samples are read")
    depth = 3 if kind in (b"P3", b"P6") else 1
    if kind in (b"P5", b"P6"):
        samples = np.frombuffer(data, np.uint8, width * height * depth, at)
    else:
        samples = np.array(data[at:].split()[: width * height * depth], dtype=np.uint16).astype(np.uint8)
    return samples.reshape((height, width, 3) if depth == 3 else (height, width))


def decode_bmp(data: bytes) -> np.ndarray:
    """An (h, w, 3) RGB array of an uncompressed BMP."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP image")
    (at,) = struct.unpack_from("<I", data, 10)
    size, width, height, _, bits, packed = struct.unpack_from("<IiiHHI", data, 14)
    if packed not in (0, 3) or bits not in (1, 4, 8, 24, 32):
        raise ValueError("only uncompressed BMP is read")
    rows, stride = abs(height), (width * bits + 31) // 32 * 4
    raster = np.frombuffer(data, np.uint8, rows * stride, at).reshape(rows, stride)
    if bits <= 8:
        table = np.frombuffer(data, np.uint8, (struct.unpack_from("<I", data, 46)[0] or 1 << bits) * 4, 14 + size).reshape(-1, 4)
        if bits < 8:
            units = np.unpackbits(raster, axis=1).reshape(rows, -1, bits)
            index = (units * (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)).sum(axis=2)[:, :width]
        else:
            index = raster[:, :width]
        pixels = table[index][:, :, 2::-1]
    else:
        step = bits // 8
        pixels = raster[:, : width * step].reshape(rows, width, step)[:, :, 2::-1]
    return np.ascontiguousarray(pixels[::-1] if height > 0 else pixels)


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


# ---- features ------------------------------------------------------------------------------------
def _edges(length: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(parts + 1) * (length / parts)
    low = np.minimum(at.astype(np.int64), length - 1)
    return low, at - low


def _boxes(table: np.ndarray, low: np.ndarray, part: np.ndarray, axis: int) -> np.ndarray:
    """Sums between consecutive edges from a running-sum table with a leading zero."""
    shape = [1] * table.ndim
    shape[axis] = -1
    here, after = np.take(table, low, axis), np.take(table, low + 1, axis)
    return np.diff(here + (after - here) * part.reshape(shape), axis=axis)


def area_resize(image: np.ndarray, height: int, width: int, block: int = 1 << 15) -> np.ndarray:
    """The mean of each target cell's area, from integral images; float64.

    The integral image is separable: running sums along x are cut at the target's
    columns block by block, then summed along y, so memory follows the target's width.
    """
    planes = image[:, :, None] if image.ndim == 2 else image
    rows, columns, depth = planes.shape
    low, part = _edges(columns, width)
    strips = np.empty((rows + 1, width, depth))
    strips[0] = 0
    for start in range(0, rows, block):
        chunk = planes[start : start + block]
        table = np.zeros((len(chunk), columns + 1, depth))
        np.cumsum(chunk, axis=1, out=table[:, 1:])
        strips[start + 1 : start + 1 + len(chunk)] = _boxes(table, low, part, 1)
    np.cumsum(strips, axis=0, out=strips)
    cells = _boxes(strips, *_edges(rows, height), 0) / (rows / height * columns / width)
    return cells[:, :, 0] if image.ndim == 2 else cells


def luma(image: np.ndarray) -> np.ndarray:
    return image.astype(float) if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each cell of an 8 by 9 luma grid is brighter than its left neighbour."""
    grid = np.round(luma(area_resize(image, 8, 9)), 6)
    return np.packbits(grid[:, 1:] > grid[:, :-1]).tobytes().hex()


def npy_tile(image: np.ndarray, side: int = TILE) -> bytes:
    """The image area-resized to side by side 8-bit samples, in NPY form."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(image, side, side)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


# ---- operators -----------------------------------------------------------------------------------
def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's bytes as a stored PPM image, 64 pixels wide: (id, n_bytes, media). JVM only.

    Bytes 32 fill the payload up to a positive multiple of a row of 192 bytes.
    """
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = F.greatest(F.lit(1), F.ceil(F.octet_length("raw") / F.lit(ROW_BYTES))).cast("int")
    return (
        docs.select(F.col(id_col), raw.alias("raw"))
        .withColumn("n_bytes", F.octet_length("raw").cast("long"))
        .withColumn("rows", rows)
        .select(
            id_col,
            "n_bytes",
            F.concat(F.encode(F.format_string(f"P6\n{ROW_PIXELS} %d\n255\n", F.col("rows")), "UTF-8"), F.col("raw"), F.encode(F.repeat(F.lit(" "), F.col("rows") * ROW_BYTES - F.col("n_bytes").cast("int")), "UTF-8")).alias("media"),
        )
    )


_FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, height int, width int, tile binary, dhash string"


def media_features(media: DataFrame, keep: dict[str, str], media_col: str = "media") -> DataFrame:
    """Reads stored images back: sample digests, an NPY tile and a difference hash beside the columns in keep (name to type)."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, media_col):
            out: list[tuple] = []
            for stored in batch.column(media_col):
                if not stored.is_valid:
                    out.append((None,) * 9)
                    continue
                data = stored.as_py()
                image = decode(data)
                samples = image.tobytes()
                out.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(data), hashlib.sha256(data).hexdigest(), image.shape[0], image.shape[1], npy_tile(image), difference_hash(image)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + columns, names=[*names, *(x.split()[0] for x in _FEATURES.split(", "))])

    return media.select(*names, media_col).mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in keep.items()), _FEATURES]))


def op1(docs: DataFrame) -> DataFrame:
    keep = {"doc_id": "long", "n_bytes": "long"}
    out = media_features(text_media(docs), keep)
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.col("dhash").alias("feature"))


def stored_media(files: DataFrame) -> DataFrame:
    """Features of files read by spark.read.format('binaryFile'): (path, ...)."""
    return media_features(files.select("path", F.col("content").alias("media")), {"path": "string"})


def is_image(media: Column) -> Column:
    """Whether bytes start as one of the formats read here."""
    return F.decode(F.substring(media, 1, 2), "ISO-8859-1").rlike("^(P[1-6]|BM)$")
