"""Token ids in files, compressed by a Re-Pair grammar per block.

Documents are range-partitioned and sorted by id, encoded with a public vocabulary, ended with one end id each, and gathered
into blocks of about ``BLOCK_IDS`` ids. A block holds its documents' ids, its rules with the length of every nonterminal's
expansion, the symbols, and per document the number of symbols and ids, so one document decodes from its slice alone. Blocks are
rows of Parquet files written by Spark, which any shared store can hold.

* Null text: encoded as empty, so it has its end id only.
* Null ids come first. Repeated ids stand in the order of a hash of their text; wholly equal rows in any order.
* A document longer than a block is a block of its own. Other columns are not carried. An empty table writes no block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm import repair
from hackstand.llm.common import narrow, shared_path, text_slices
from hackstand.llm.tokens import encoder, vocabulary

BLOCK_IDS = 1 << 20
END_ID = 2
TERMINALS = 50_257
SCHEMA = ("part int, block int, n_ids long, doc_ids array<long>, doc_ids_n binary, doc_symbols binary, rules binary, lengths binary, symbols binary")


def _block(part: int, number: int, held: list, terminals: int) -> pa.RecordBatch:
    names = [x for ids, _, _ in held for x in ids]
    sizes = np.concatenate([x for _, x, _ in held])
    ids = np.concatenate([x for _, _, x in held])
    last = np.cumsum(sizes) - 1
    ends = np.zeros(len(ids), bool)
    ends[last] = True
    symbols, marks, rules, lengths = repair.compress(ids, ends, terminals)
    kind = np.uint16 if terminals + len(rules) <= 1 << 16 else np.uint32
    per_doc = np.diff(np.append(-1, np.flatnonzero(marks)))
    row = [part, number, len(ids), names, sizes.astype(np.uint32).tobytes(), per_doc.astype(np.uint32).tobytes(), rules.astype(kind).tobytes(),
           lengths.tobytes(), symbols.astype(kind).tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
    fields = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], fields)


def _encode(path: str, end_id: int, terminals: int, block_ids: int):
    def run(batches):
        part, number, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for piece in text_slices(batch):
                ids, bounds = encoder(path).encode(piece.column("text"))
                sizes = np.diff(bounds) + 1
                closed = np.full(len(ids) + len(sizes), end_id, np.uint32)
                body = np.ones(len(closed), bool)
                body[np.cumsum(sizes) - 1] = False
                closed[body] = ids
                names, done, where = piece.column("doc_id").to_pylist(), 0, 0
                for k in range(len(sizes)):  # a block closes with the document that fills it
                    count += int(sizes[k])
                    if count >= block_ids:
                        stop = where + int(sizes[done : k + 1].sum())
                        held.append((names[done : k + 1], sizes[done : k + 1], closed[where:stop]))
                        yield _block(part, number, held, terminals)
                        number, held, count, done, where = number + 1, [], 0, k + 1, stop
                if done < len(sizes):
                    held.append((names[done:], sizes[done:], closed[where:]))
        if held:
            yield _block(part, number, held, terminals)

    return run


def write_ids(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, end_id: int = END_ID,
              terminals: int = TERMINALS, block_ids: int = BLOCK_IDS) -> None:
    docs = narrow(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    blocks = ordered.mapInArrow(_encode(vocab or vocabulary(), end_id, terminals, block_ids), SCHEMA)
    blocks.write.option("compression", "zstd").parquet(path)


def _decode(terminals: int, starts):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                cell = lambda c: batch.column(c)[k]
                raw = lambda c, kind: np.frombuffer(cell(c).as_buffer(), kind)
                lengths = raw("lengths", np.uint32)
                kind = np.uint16 if terminals + len(lengths) <= 1 << 16 else np.uint32
                ids = repair.expand(raw("symbols", kind), raw("rules", kind).reshape(-1, 2), lengths, terminals)
                sizes = raw("doc_ids_n", np.uint32).astype(np.int64)
                stops = np.cumsum(sizes)
                first = starts[cell("part").as_py(), cell("block").as_py()]
                at = 0
                names, whole = cell("doc_ids").values, pa.py_buffer(ids)
                while at < len(sizes):  # rows of about 16 MB
                    stop = max(at + 1, int(np.searchsorted(stops, stops[at] + (4 << 20))))
                    cuts = np.concatenate([[stops[at] - sizes[at]], stops[at:stop]])
                    body = pa.Array.from_buffers(pa.binary(), stop - at, [None, pa.py_buffer(((cuts - cuts[0]) * 4).astype(np.int32)), whole.slice(int(cuts[0]) * 4, int(cuts[-1] - cuts[0]) * 4)])
                    yield pa.RecordBatch.from_arrays([names[at:stop], pa.array(first + cuts[:-1]), pa.array(sizes[at:stop]), body], ["doc_id", "start", "n_tokens", "ids"])
                    at = stop

    return run


def read_ids(spark, path: str, terminals: int = TERMINALS) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian unsigned 32-bit) of every document."""
    blocks = spark.read.parquet(path)
    # one small row per block of a million ids: less than the list of files that the driver holds anyway
    table = blocks.select("part", "block", "n_ids").orderBy("part", "block").toPandas()
    before = table["n_ids"].cumsum() - table["n_ids"]
    starts = {(p, b): int(s) for p, b, s in zip(table["part"], table["block"], before)}
    return blocks.mapInArrow(_decode(terminals, starts), "doc_id long, start long, n_tokens long, ids binary")


def decode_document(block: dict, index: int, terminals: int = TERMINALS) -> np.ndarray:
    """Random access: the ids of the ``index``-th document of one block row, from its own symbols."""
    lengths = np.frombuffer(block["lengths"], np.uint32)
    kind = np.uint16 if terminals + len(lengths) <= 1 << 16 else np.uint32
    stops = np.cumsum(np.frombuffer(block["doc_symbols"], np.uint32))
    own = np.frombuffer(block["symbols"], kind)[stops[index - 1] if index else 0 : stops[index]]
    return repair.expand(own, np.frombuffer(block["rules"], kind).reshape(-1, 2), lengths, terminals)


def digest(df: DataFrame) -> DataFrame:
    path = shared_path(df.sparkSession, "ids")
    write_ids(df, path)
    return read_ids(df.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
