"""Token ids in a bit-packed binary format.

*Segment.* Ids are stored in the fewest bits that the vocabulary needs. A segment is

    magic ``TKPK``, width (1 byte), 3 zero bytes, ids a block (u32), ids (u64), documents (u64)
    block offsets: (blocks + 1) x u64, in bytes from the start of the data
    document ends: documents x u64, in ids from the start of the segment
    data: each block's ids, most significant bit first, padded to whole bytes

all little-endian. ``Segment`` reads any run of ids or any document by decoding
only the blocks that it touches, with numpy.

*Table.* ``write`` puts documents in ascending order of their ids into segments
of about ``SEGMENT_IDS`` ids (whole documents), one row each, in a folder of Parquet
files that Spark commits: ``part, segment, before, n_ids, doc_ids, payload``. ``part``
numbers ranges of document ids in their order; ``before`` counts the part's ids in
earlier segments. ``read`` gives the documents back with their global position.

Cases: null and empty texts have no tokens of their own, only the end id; null
document ids come first; rows with equal ids stand side by side, in an order fixed
by their ids' hash; an empty table gives an empty folder of files.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .bpe import byte_symbols

MAGIC = b"TKPK"
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 20

# Fixed value: the split pattern of byte-level BPE files.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE = {symbol: byte for byte, symbol in enumerate(byte_symbols())}

_HEADER = struct.Struct("<4sB3xIQQ")


def width_of(vocabulary: int) -> int:
    """Bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_block(ids: np.ndarray, width: int) -> bytes:
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpack_block(data: bytes, n: int, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    whole = np.zeros((n, 32), np.uint8)
    whole[:, 32 - width :] = bits
    return np.packbits(whole, axis=1).view(">u4").ravel().astype(np.uint32)


def pack(documents: list[np.ndarray], width: int) -> bytes:
    """One segment of whole documents."""
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {ids.max()} needs more than {width} bits")
    blocks = [pack_block(ids[s : s + BLOCK_IDS], width) for s in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    ends = np.cumsum([len(d) for d in documents]).astype("<u8")
    head = _HEADER.pack(MAGIC, width, BLOCK_IDS, len(ids), len(documents))
    return b"".join([head, offsets.tobytes(), ends.tobytes(), *blocks])


class Segment:
    """Random access to a packed segment."""

    def __init__(self, payload: bytes) -> None:
        magic, self.width, self.block, self.n_ids, n_docs = _HEADER.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        blocks = -(-self.n_ids // self.block)
        at = _HEADER.size
        self.offsets = np.frombuffer(payload, "<u8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.ends = np.frombuffer(payload, "<u8", n_docs, at)
        self.payload, self.data = payload, at + 8 * n_docs
        self._held: tuple[int, np.ndarray] | None = None

    def _block(self, k: int) -> np.ndarray:
        if self._held is None or self._held[0] != k:
            start, end = self.data + int(self.offsets[k]), self.data + int(self.offsets[k + 1])
            n = min(self.block, self.n_ids - k * self.block)
            self._held = (k, unpack_block(self.payload[start:end], n, self.width))
        return self._held[1]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, exclusive."""
        parts = []
        while start < end:
            k = start // self.block
            stop = min(end, (k + 1) * self.block)
            parts.append(self._block(k)[start - k * self.block : stop - k * self.block])
            start = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


# --- encoding -----------------------------------------------------------------------------


def _bytes_of(symbols: str) -> bytes:
    return bytes(_BYTE[c] for c in symbols)


class Encoder:
    """Whole texts under a byte-level BPE file of the tokenizers library.

    The file's vocabulary is handed to tiktoken, which gives the same ids several
    times as fast: it merges by id, so the file's merges must stand in the order of
    the ids that they make, and it splits by the file's pattern. Files of another
    form are refused. Special tokens in a text become their ids, as the library does.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            t = json.load(f)
        model, pre, special = t["model"], t["pre_tokenizer"], t["added_tokens"]
        vocab = model["vocab"]
        made = [vocab["".join(m)] for m in model["merges"]]
        supported = (
            model["type"] == "BPE" and not model["ignore_merges"] and not any(model[k] for k in ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and t["normalizer"] is None and t["post_processor"] is None
            and made == sorted(made) and all(x["special"] and not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]) for x in special)
        )
        if not supported:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        specials = {x["content"]: x["id"] for x in special}
        ranks = {_bytes_of(s): i for s, i in vocab.items() if s not in specials}
        self.encoding = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self.vocabulary = max([*vocab.values(), *specials.values()]) + 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(t, allowed_special="all") for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def item_type(vocabulary: int) -> str:
    """The little-endian whole-number type for ids in memory and on the way."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encode(df: DataFrame, path: str, end_id: int | None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Appends each text's ids, and the end id, as binary of ``item_type`` numbers."""

    def make():
        encoder = encoder_of(path)
        kind = item_type(encoder.vocabulary)
        tail = b"" if end_id is None else np.array([end_id], kind).tobytes()

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([x.astype(kind).tobytes() + tail for x in encoder.encode(common.texts_of(part, text_col))], pa.binary())]

        return compute

    return common.with_arrow_columns(df, text_col, [T.StructField(ids_col, T.BinaryType())], make)


# --- files --------------------------------------------------------------------------------


def _cut_segments(vocabulary: int, id_type: pa.DataType, target: int):
    width, kind = width_of(vocabulary), item_type(vocabulary)

    def row(part, number, before, names, documents) -> pa.RecordBatch:
        values = [[part], [number], [before], [sum(map(len, documents))], [names], [pack(documents, width)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_type), pa.binary()]
        columns = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "segment", "before", "n_ids", "doc_ids", "payload"])

    def run(batches):
        part, number, before, held = None, 0, 0, 0
        names, documents = [], []
        for batch in batches:
            for own, name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if names and (own != part or held >= target):
                    yield row(part, number, before, names, documents)
                    number, before = (number + 1, before + held) if own == part else (0, 0)
                    names, documents, held = [], [], 0
                part = own
                names.append(name)
                documents.append(np.frombuffer(ids.as_buffer() or b"", kind))
                held += len(documents[-1])
        if names:
            yield row(part, number, before, names, documents)
        names, documents = [], []
        common.release_memory()

    return run


def _part_of(ids: DataFrame, parts: int) -> Column:
    """The number of the range of ids that a row's id falls into.

    The ranges come from range-partitioning the ids alone; their first ids, one a
    range, are all that the driver sees. Null ids come before, in parts of their own
    with numbers below 0: as many as their share of the rows calls for, ranges of their token ids' hash.
    """
    known = ids.where(F.col("doc_id").isNotNull())
    firsts = known.repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("first"))
    bounds = sorted(r["first"] for r in firsts.collect())
    size = ids.agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    null_parts = -(-parts * size["nulls"] // max(size["n"], 1))
    share = F.xxhash64("ids") / F.lit(2.0**64) + F.lit(0.5)
    null_part = F.least(F.floor(share * null_parts), F.lit(null_parts - 1)) - F.lit(null_parts)
    above = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    return F.when(F.col("doc_id").isNull(), null_part).otherwise(above)


def write(encoded: DataFrame, path: str, vocabulary: int, id_col: str = "doc_id", ids_col: str = "ids", target: int = SEGMENT_IDS, ids_from: DataFrame | None = None) -> None:
    """Writes the documents in ascending order of ``id_col``.

    ``ids_from``: a table with the same ids that is cheaper to read than ``encoded``,
    such as the texts; the ranges are taken from it. A range of ids is one part, sorted and packed by one task; there are four times
    as many parts as shuffle partitions.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = encoded.schema[id_col].dataType
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("part", _part_of((ids_from or encoded).select(F.col(id_col).alias("doc_id")), 4 * partitions).cast("int")).select("part", "doc_id", "ids")
    ordered = placed.repartition(partitions, "part").sortWithinPartitions("part", "doc_id", F.xxhash64("ids"))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()), T.StructField("before", T.LongType()),
        T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("payload", T.BinaryType())])
    common.arrow(ordered, _cut_segments(vocabulary, to_arrow_type(kind), target), schema).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: where each document's ids stand among all, and the
    ids as binary of little-endian 32-bit integers."""
    segments = spark.read.parquet(path)
    # one number a part, a few times as many as the writing job had tasks
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    offsets = spark.createDataFrame(starts, "part int, part_start long")
    placed = segments.join(F.broadcast(offsets), "part").select((F.col("part_start") + F.col("before")).alias("at"), "doc_ids", "payload")
    schema = T.StructType([
        T.StructField("doc_id", segments.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                segment = Segment(batch.column(2)[k].as_py())
                ends = segment.ends.astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                ids = [segment.ids(int(s), int(e)).astype("<u4").tobytes() for s, e in zip(starts, ends, strict=True)]
                columns = [batch.column(1)[k].values, pa.array(starts + batch.column(0)[k].as_py()), pa.array(ends - starts), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return common.arrow(placed, run, schema)

