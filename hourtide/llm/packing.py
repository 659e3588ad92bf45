"""Token ids packed into rows of one length, best fit decreasing.

A map task encodes its documents, cuts overlong ones into pieces and packs groups of pieces of a bounded
number of tokens: longest first, each into the fullest row that still holds it. A segment tree over the
free places of the open rows finds that row. A group of some millions of tokens fills its rows almost
completely, so nothing is gained by packing over tasks, and nothing is shuffled.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hourtide.llm.common import renamed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the public vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The vocabulary's free id, which ends every document.
END_ID = 50256
ROW_TOKENS = 2048
GROUP_TOKENS = 1 << 22
#: Runs of white space, as the pattern has it, whose look-ahead could exhaust the matcher's stack.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
ROWS_PER_BATCH = 512


class FreePlaces:
    """Which amounts of free places have an open row: a segment tree of counts."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << max(1, most).bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, free: int, rows: int) -> None:
        node = free + self.leaves
        while node:
            self.counts[node] += rows
            node >>= 1

    def smallest(self, wanted: int) -> int | None:
        """The smallest amount of at least ``wanted`` that has a row."""
        node = wanted + self.leaves
        if self.counts[node]:
            return wanted
        # Up to the first right-hand neighbour that has one, then down its left side.
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.counts[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(lengths: list[int], row_tokens: int) -> list[list[int]]:
    """Rows of piece numbers; no length may exceed ``row_tokens``. Ties go to the earlier piece and to the
    row opened last."""
    free, by_free, rows = FreePlaces(row_tokens), [[] for _ in range(row_tokens + 1)], []
    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        room = free.smallest(lengths[piece])
        if room is None:
            room, row = row_tokens, len(rows)
            rows.append([])
        else:
            row = by_free[room].pop()
            free.add(room, -1)
        rows[row].append(piece)
        by_free[room - lengths[piece]].append(row)
        free.add(room - lengths[piece], 1)
    return rows


def encoder(vocabulary: str) -> tiktoken.Encoding:
    """Byte-level BPE from a file of ranks, without special tokens: their strings are ordinary text."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(vocabulary), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a whole text. A long run of white space is given to the merges as the one piece that the pattern
    makes of it: all of it at the end of a text, else all but its last letter, with which what follows begins."""
    parts, begin = [], 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        parts += [bpe.encode_ordinary(text[begin : run.start()]), bpe._encode_single_piece(text[run.start() : end])]
        begin = end
    parts.append(bpe.encode_ordinary(text[begin:]))
    return np.concatenate([np.array(p, dtype=np.uint32) for p in parts])


def _packed(vocabulary: str, end_id: int, row_tokens: int, group_tokens: int, id_type: pa.DataType, batches: Iterator[pa.RecordBatch]):
    bpe = encoder(vocabulary)
    width = np.dtype("<u2") if max(bpe.max_token_value, end_id) < 1 << 16 else np.dtype("<u4")
    first, done = TaskContext.get().partitionId() << 32, 0
    pieces: list[tuple[object, int, np.ndarray]] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal done
        rows = best_fit([len(p[2]) for p in pieces], row_tokens)
        for begin in range(0, len(rows), ROWS_PER_BATCH):
            part = rows[begin : begin + ROWS_PER_BATCH]
            matrix = np.full((len(part), row_tokens), end_id, dtype=width)
            ends, resets, ids, offsets, tokens = [], [], [], [], []
            for r, row in enumerate(part):
                at = [0]
                for p in row:
                    matrix[r, at[-1] : at[-1] + len(pieces[p][2])] = pieces[p][2]
                    at.append(at[-1] + len(pieces[p][2]))
                ends.append(at)
                resets.append(at[:-1])
                ids.append([pieces[p][0] for p in row])
                offsets.append([pieces[p][1] for p in row])
                tokens.append(at[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(first + done, first + done + len(part)), pa.int64()),
                    pa.array(tokens, pa.int32()),
                    pa.array([matrix[r].tobytes() for r in range(len(part))], pa.binary()),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(resets, pa.list_(pa.int32())),
                    pa.array(ids, pa.list_(id_type)),
                    pa.array(offsets, pa.list_(pa.int64())),
                ],
                ["row_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "piece_offsets"],
            )
            done += len(part)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "").to_pylist()):
            ids = np.append(encode(bpe, text), np.uint32(end_id))
            for offset in range(0, len(ids), row_tokens):
                pieces.append((doc_id, offset, ids[offset : offset + row_tokens]))
                held += len(pieces[-1][2])
                if held >= group_tokens:
                    yield from flush()
                    pieces, held = [], 0
    if pieces:
        yield from flush()


def pack_tokens(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    row_tokens: int = ROW_TOKENS,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Packed rows: row_id, n_tokens, ids, cu_seqlens, position_resets, doc_ids, piece_offsets.

    ``ids`` is one line of the id matrix: ``row_tokens`` little-endian numbers of 2 bytes (4 for a
    vocabulary beyond 65,536), filled up with ``end_id`` behind the first ``n_tokens``. ``cu_seqlens``
    starts at 0 and has the end of each segment; positions count from 0 again at each of
    ``position_resets``. Segment i belongs to document ``doc_ids[i]`` and continues it at token
    ``piece_offsets[i]``. Every document ends with ``end_id``, so null and empty texts are one token and
    nothing is lost: the segments of a document, by offset, are its ids. Documents longer than a row are
    cut every ``row_tokens``; only the last piece may be shorter. Repeated rows are packed again, and a
    missing id is null in the list. An empty table gives no rows. ``vocabulary`` is read by every task and
    must be present on every executor. Row numbers are unique and come out the same if a task runs again.
    """
    rows = renamed(df, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType
    shape = (
        "row_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
        f"doc_ids array<{kind.simpleString()}>, piece_offsets array<bigint>"
    )
    id_type = pa.string() if kind.simpleString() == "string" else pa.int64() if kind.simpleString() == "bigint" else pa.int32()
    return rows.mapInArrow(lambda batches: _packed(vocabulary, end_id, row_tokens, group_tokens, id_type, batches), shape)


def write_packed(packed: DataFrame, path: str) -> None:
    """The binary output: Parquet files whose ``ids`` column is the id matrix, one line a row."""
    packed.write.option("compression", "zstd").parquet(path)
