"""Token ids in an entropy-coded block format: static range asymmetric numeral system.

Writing: all ids are counted, the counts become one frequency table shared by
all blocks, and each task codes its documents, in ascending order of doc_id, in
independent blocks of whole documents. The symbols of a block are dealt in turn
to ``LANES`` interleaved coders, so that numpy advances all of them at once.
After every ``EVERY`` rounds the coders' states and the place in the payload are
noted as a checkpoint. A checksum covers payload and checkpoints.

Reading: blocks are decoded independently, and all stretches between the
checkpoints of a block at the same time.

The format is a Parquet table with one row per block (payload, checkpoints,
doc_ids, doc_lengths, checksum, lanes) next to a small table with the frequencies:
any store that Spark can write holds it.

Defined results: a null or empty text has the end id only; rows with the same
doc_id are kept, ordered by their text; null doc_ids come first; an empty table
gives an empty file. A document longer than a block gets a block of its own.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemill.llm.bpe_tree import encoder
from tastemill.llm.common import Batches, id_and_text, in_slices
from tastemill.staging import stage_table

END_ID = 2
BITS = 20
LOW = np.uint64(1 << 31)
BLOCK_IDS = 1 << 18
LANES = 512
EVERY = 128

TOKENS = "doc_id bigint, part int, row int, ids binary"
BLOCKS = (
    "part int, block int, n_ids bigint, lanes int, payload binary, checkpoints binary, "
    "doc_ids array<bigint>, doc_lengths array<bigint>, checksum bigint"
)


@dataclass(frozen=True)
class Table:
    """Frequencies of all symbols, at least 1 each, that sum to 2**BITS."""

    freq: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Table:
        size, total = len(counts), max(1, int(counts.sum()))
        room = (1 << BITS) - size
        if room < 0:
            raise ValueError(f"a vocabulary of {size} does not fit {BITS} bits")
        freq = 1 + np.array([int(c) * room // total for c in counts.tolist()], dtype=np.int64)
        freq[int(np.argmax(counts))] += (1 << BITS) - int(freq.sum())
        return cls(freq.astype(np.uint64))

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.freq) - self.freq


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> tuple[int, bytes, bytes]:
    """Lanes used, payload and checkpoints of one block."""
    lanes = max(1, min(lanes, len(ids)))
    rounds = -(-len(ids) // lanes)
    padded = np.full(rounds * lanes, int(np.argmax(table.freq)), dtype=np.int64)
    padded[: len(ids)] = ids
    freq = table.freq[padded].reshape(rounds, lanes)
    start = table.start[padded].reshape(rounds, lanes)
    full = freq << np.uint64(63 - BITS)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * rounds
    states: dict[int, bytes] = {}
    for t in range(rounds - 1, -1, -1):
        over = state >= full[t]
        words[t] = state[over].astype(np.uint32)
        state = np.where(over, state >> np.uint64(32), state)
        quotient = state // freq[t]
        state = (quotient << np.uint64(BITS)) + (state - quotient * freq[t]) + start[t]
        if t % every == 0:
            states[t] = state.tobytes()
    before = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    checkpoints = b"".join(struct.pack("<QQ", t, before[t]) + states[t] for t in sorted(states))
    return lanes, np.concatenate(words).astype("<u4").tobytes() if words else b"", checkpoints


def decode_block(n_ids: int, lanes: int, payload: bytes, checkpoints: bytes, table: Table, symbols: np.ndarray) -> np.ndarray:
    """The ids of one block; ``symbols`` maps each of the 2**BITS slots to its symbol."""
    if n_ids == 0:
        return np.zeros(0, dtype=np.int64)
    rounds = -(-n_ids // lanes)
    size = 16 + 8 * lanes
    heads = [struct.unpack_from("<QQ", checkpoints, k) for k in range(0, len(checkpoints), size)]
    first = np.array([h[0] for h in heads])
    place = np.array([h[1] for h in heads], dtype=np.int64)
    state = np.stack([np.frombuffer(checkpoints, dtype="<u8", count=lanes, offset=k + 16) for k in range(0, len(checkpoints), size)])
    words = np.frombuffer(payload, dtype="<u4").astype(np.uint64)
    stretch = np.diff(np.append(first, rounds))
    out = np.empty((rounds, lanes), dtype=np.int64)
    freq, start = table.freq, table.start
    mask, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    for k in range(int(stretch.max())):
        live = int((stretch > k).sum())  # only the last stretch may be shorter
        slot = state[:live] & mask
        symbol = symbols[slot.astype(np.int64)]
        out[first[:live] + k] = symbol
        now = freq[symbol] * (state[:live] >> shift) + slot - start[symbol]
        low = now < LOW
        nth = np.cumsum(low, axis=1)
        from_words = (place[:live, None] + nth - 1)[low]
        now[low] = (now[low] << np.uint64(32)) | words[from_words]
        place[:live] += nth[:, -1]
        state[:live] = now
    return out.reshape(-1)[:n_ids]


def tokenize_sorted(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Ids with the end id, by ascending doc_id: ``part`` numbers the range, ``row`` the document in it."""

    def run(batches: Batches) -> Batches:
        encode, part, row = encoder(tokenizer_path).encode, TaskContext.get().partitionId(), 0
        for batch in in_slices(batches):
            ids, lengths = encode(batch.column("text"))
            ends = np.cumsum(lengths)
            width = "<u4" if end_id > 0xFFFF or (len(ids) and int(ids.max()) > 0xFFFF) else "<u2"
            raw = [np.append(ids[e - n : e], end_id).astype(width).tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
            wide = width == "<u4"
            rows = pa.array(range(row, row + len(raw)), pa.int32())
            row += len(raw)
            # The first byte tells the width of the ids.
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * len(raw), pa.int32()), rows, pa.array([(b"\4" if wide else b"\2") + r for r in raw], pa.binary())],
                ["doc_id", "part", "row", "ids"],
            )

    # Within a doc_id the text's hash decides, so that many rows of one doc_id still spread.
    keyed = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    return ordered.drop("h").mapInArrow(run, TOKENS)


def _widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u4" if raw[:1] == b"\4" else "<u2", offset=1).astype(np.int64)


def count_ids(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs; what comes to the driver is as long as the vocabulary."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("ids").to_pylist():
                counts += np.bincount(_widen(raw), minlength=vocabulary)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], ["id", "n"])

    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in tokens.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    return counts


def encode_blocks(tokens: DataFrame, freq: list[int], block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the documents of each ``part``, in order of ``row``."""

    def run(batches: Batches) -> Batches:
        table, part, block = Table(np.array(freq, dtype=np.uint64)), None, 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            lanes, payload, checkpoints = encode_block(ids, table)
            check = zlib.crc32(checkpoints, zlib.crc32(payload))
            row = [[part], [block], [len(ids)], [lanes], [payload], [checkpoints], [[d for d, _ in held]], [[len(x) for _, x in held]], [check]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for doc_id, of, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ids"))):
                if held and (of != part or size + len(raw) // 2 > block_ids):
                    yield close()
                    block, held, size = block + 1 if of == part else 0, [], 0
                part = of
                held.append((doc_id, _widen(raw)))
                size += len(held[-1][1])
        if held:
            yield close()

    return tokens.mapInArrow(run, BLOCKS)


def write_file(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID) -> None:
    """Write all documents' ids under ``path``: ``blocks`` and ``frequencies``."""
    spark = docs.sparkSession
    tokens = stage_table("ids", tokenize_sorted(docs, tokenizer_path, end_id))
    vocabulary = max(len(encoder(tokenizer_path).n_bytes), end_id + 1)
    table = Table.of(count_ids(tokens, vocabulary))
    freq = [int(f) for f in table.freq]
    spark.createDataFrame([(i, f) for i, f in enumerate(freq)], "id int, freq bigint").coalesce(1).write.parquet(f"{path}/frequencies")
    # Files of the staged table can be read in any cut; each part has to be whole and in order again.
    ordered = tokens.repartition("part").sortWithinPartitions("part", "row")
    encode_blocks(ordered, freq).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document; ids are little-endian 32-bit integers."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    freq = [r.freq for r in spark.read.parquet(f"{path}/frequencies").orderBy("id").collect()]
    # One number per range partition of the writer comes to the driver.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    ends = np.cumsum([r.n for r in sizes])
    starts = [(r.part, int(e) - r.n) for r, e in zip(sizes, ends)]
    first = spark.createDataFrame(starts, "part int, part_start bigint")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    index = blocks.select("part", "block", "n_ids").join(first, "part").select(
        "part", "block", (F.col("part_start") + F.coalesce(F.sum("n_ids").over(before), F.lit(0))).alias("block_start")
    )
    out = "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def run(batches: Batches) -> Batches:
        table = Table(np.array(freq, dtype=np.uint64))
        symbols = np.repeat(np.arange(len(freq)), np.array(freq))
        for batch in batches:
            for row in batch.to_pylist():
                if zlib.crc32(row["checkpoints"], zlib.crc32(row["payload"])) != row["checksum"]:
                    raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                ids = decode_block(row["n_ids"], row["lanes"], row["payload"], row["checkpoints"], table, symbols)
                lengths = np.array(row["doc_lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                data = ids.astype("<u4").tobytes()
                raw = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["block_start"] + ends - lengths), pa.array(lengths), pa.array(raw, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.join(index, ["part", "block"]).mapInArrow(run, out)
