"""Map extracts in the PBF format as a data source: spark.read.format("osm_pbf").option("element", "way").load(path).

element is node, way or relation. A partition is a run of blobs, found on the driver by their headers alone. The path
is to be one that driver and executors can open, such as a shared mount.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMAS = {
    "node": "id long, lng double, lat double, tags map<string,string>",
    "way": "id long, refs array<long>, tags map<string,string>",
    "relation": "id long, members array<struct<type:string,ref:long,role:string>>, tags map<string,string>",
}
MEMBER_TYPES = ("node", "way", "relation")


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message; groups are not used by the format."""
    at = 0
    while at < len(data):
        key, at = read_varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = read_varint(data, at)
        elif kind == 2:
            n, at = read_varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


def packed(data: bytes, signed: bool = False, delta: bool = False) -> list[int]:
    out, at, last = [], 0, 0
    while at < len(data):
        n, at = read_varint(data, at)
        if signed:
            n = n >> 1 ^ -(n & 1)
        last = last + n if delta else n
        out.append(last)
    return out


def blob_places(path: str) -> list[tuple[int, int]]:
    """(offset, length) of the data blobs of a file."""
    places = []
    with open(path, "rb") as file:
        while head := file.read(4):
            header = dict(fields(file.read(struct.unpack(">I", head)[0])))
            if header[1] == b"OSMData":
                places.append((file.tell(), header[3]))
            file.seek(header[3], 1)
    return places


def unpack_blob(data: bytes) -> bytes:
    blob = dict(fields(data))
    if 1 in blob:
        return blob[1]
    if 3 in blob:
        return zlib.decompress(blob[3])
    raise ValueError("a blob is neither raw nor zlib")


def elements(block: bytes, element: str) -> Iterator[tuple]:
    """Rows of one kind of a block, as in SCHEMAS."""
    strings: list[str] = []
    groups, granularity, lat0, lng0 = [], 100, 0, 0
    for number, value in fields(block):
        if number == 1:
            strings = [v.decode("utf-8", "replace") for _, v in fields(value)]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            granularity = value
        elif number == 19:
            lat0 = value if value < 1 << 63 else value - (1 << 64)
        elif number == 20:
            lng0 = value if value < 1 << 63 else value - (1 << 64)

    def place(lng: int, lat: int) -> tuple[float, float]:
        return (lng0 + granularity * lng) / 1e9, (lat0 + granularity * lat) / 1e9

    def tags(m: dict) -> dict[str, str]:
        return {strings[k]: strings[v] for k, v in zip(packed(m.get(2, b"")), packed(m.get(3, b"")))}

    for group in groups:
        for number, value in fields(group):
            if element == "node" and number == 1:
                m = dict(fields(value))
                zig = [n >> 1 ^ -(n & 1) for n in (m[1], m[9], m[8])]
                yield (zig[0], *place(zig[1], zig[2]), tags(m))
            elif element == "node" and number == 2:
                m = dict(fields(value))
                ids, lats, lngs = (packed(m.get(k, b""), True, True) for k in (1, 8, 9))
                words, at = packed(m.get(10, b"")), 0
                for i, node in enumerate(ids):
                    own = {}
                    while at < len(words) and words[at]:
                        own[strings[words[at]]] = strings[words[at + 1]]
                        at += 2
                    at += 1
                    yield (node, *place(lngs[i], lats[i]), own)
            elif element == "way" and number == 3:
                m = dict(fields(value))
                yield m[1], packed(m.get(8, b""), True, True), tags(m)
            elif element == "relation" and number == 4:
                m = dict(fields(value))
                roles, refs, kinds = packed(m.get(8, b"")), packed(m.get(9, b""), True, True), packed(m.get(10, b""))
                yield m[1], [(MEMBER_TYPES[k], ref, strings[r]) for r, ref, k in zip(roles, refs, kinds)], tags(m)


class Blobs(InputPartition):
    def __init__(self, places: list[tuple[int, int]]) -> None:
        super().__init__(places)


class Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"].removeprefix("file://")
        self.element = options.get("element", "node")
        self.blobs = int(options.get("blobs", 8))

    def partitions(self) -> list[InputPartition]:
        places = blob_places(self.path)
        return [Blobs(places[i : i + self.blobs]) for i in range(0, len(places), self.blobs)] or [Blobs([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not partition.value:
            return
        with open(self.path, "rb") as file:
            for offset, length in partition.value:
                file.seek(offset)
                yield from elements(unpack_blob(file.read(length)), self.element)


class OsmPbf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("element", "node")]

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OsmPbf)
