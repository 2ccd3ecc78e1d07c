"""Packing by order-preserving dynamic programming over windows of the token stream."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import lean, row_ids, table
from featherline.llm.encode import default_path, encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def best_cuts(pos: np.ndarray, penalty: np.ndarray, size: int, open_end: bool = False, each: float = 0.0) -> list[int]:
    """Indices of the cuts that minimise padding plus penalties.

    pos: rising places where a cut is allowed, the first being 0, neighbours at most `size` apart; penalty: of a cut there.
    A window from pos[i] to pos[j] is padded to `size`, unless its length is a power of two; each costs `each` besides. As padding is
    size - pos[j] + pos[i], the best i is the least f[i] + pos[i] of those in reach, kept in a monotone queue; lengths that
    are powers of two are looked up besides. open_end: the last window is still open and costs nothing.
    """
    n = len(pos)
    f, back, queue = [0.0] * n, [0] * n, deque([0])
    exact: list[list[int]] = [[] for _ in range(n)]
    m = 1
    while m <= size:
        at = np.searchsorted(pos, pos - m)
        for j in np.flatnonzero((pos >= m) & (pos[at] == pos - m)).tolist():
            exact[j].append(int(at[j]))
        m *= 2
    p, w = pos.tolist(), penalty.tolist()
    g = [0.0] * n  # f + pos
    for j in range(1, n):
        here = p[j]
        while here - p[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        best = g[i] + size - here
        if open_end and j == n - 1:
            i = min((k for k in range(j) if here - p[k] <= size), key=f.__getitem__)
            best = f[i]
        for k in exact[j]:
            if f[k] < best:
                best, i = f[k], k
        f[j], back[j] = best + w[j] + each, i
        g[j] = f[j] + here
        while queue and g[queue[-1]] >= g[j]:
            queue.pop()
        queue.append(j)
    cuts, j = [n - 1], n - 1
    while j:
        j = back[j]
        cuts.append(j)
    return cuts[::-1]


def pack(docs: DataFrame, *, size: int = 1024, sentence_penalty: float = 4.0, inner_penalty: float = 24.0, window_cost: float = 16.0, grain: int = 64, block: int = 1 << 18, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """Pack whole documents, in table order, into sequences of at most `size` tokens.

    Cuts are allowed at the ends of documents (free), after tokens that end a sentence (sentence_penalty) and, where none
    comes for `grain` tokens, there (inner_penalty); window_cost keeps windows of short powers of two rare. Each task packs its own run of the table; within a block of the stream
    the dynamic programme is optimal and the last window stays open into the next block, so memory is bounded by the block
    and the longest document. No shuffle. A null or empty text is its end token alone; repeated rows are packed each.
    A sequence's id holds the task's number and a count, and its pieces are gapless.
    """
    path = tokenizer_path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sequences = encoder(path), row_ids()
        ends = np.array([s.rstrip(b"\"')").endswith((b".", b"!", b"?")) or b"\n" in s for s in enc.strings])
        held: list[tuple[int | None, int, np.ndarray, int]] = []  # id, start, rest of its ids, all its tokens
        total = 0

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal held, total
            stream = np.concatenate([x[2] for x in held])
            edge = np.cumsum([len(x[2]) for x in held])
            cost = np.full(total + 1, np.inf)
            cost[1:][ends[np.minimum(stream, len(ends) - 1)] & (stream < len(ends))] = sentence_penalty
            cost[edge], cost[0] = 0, 0
            at = np.flatnonzero(cost < np.inf)
            gap = np.diff(at)
            more = [np.arange(a + grain, a + g, grain) for a, g in zip(at[:-1][gap > grain], gap[gap > grain], strict=True)]
            if more:
                more = np.concatenate(more)
                cost[more] = inner_penalty
                at = np.sort(np.concatenate([at, more]))
            cuts = at[best_cuts(at, cost[at], size, not last, window_cost)]
            done = cuts if last else cuts[:-1]
            rows = []
            doc, begin = 0, 0  # the document at hand and its place in the stream
            for a, b in zip(done[:-1].tolist(), done[1:].tolist(), strict=True):
                seq = next(sequences)
                while a < b:
                    key, start, ids, n = held[doc]
                    stop = min(b, begin + len(ids))
                    piece = ids[a - begin : stop - begin]
                    rows.append((key, start + a - begin, len(piece), zlib.crc32(piece.tobytes()), n, seq, 0, piece.astype(np.int32)))
                    if stop == begin + len(ids):
                        doc, begin = doc + 1, stop
                    a = stop
            rest, total = [], total - int(done[-1])
            for k in range(doc, len(held)):
                key, start, ids, n = held[k]
                skip = int(done[-1]) - begin if k == doc else 0
                rest.append((key, start + skip, ids[skip:], n))
            held = rest
            if not rows:
                return None
            cols = list(zip(*rows, strict=True))
            seqs, lens = np.array(cols[5]), np.array(cols[2])
            before = np.cumsum(lens) - lens
            first = np.concatenate([[True], seqs[1:] != seqs[:-1]])
            offset = before - np.maximum.accumulate(np.where(first, before, 0))
            flat = pa.array(np.concatenate(cols[7]) if cols[7] else np.empty(0, np.int32))
            ids_ = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), flat)
            i64 = pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], i64), pa.array(cols[1], i64), pa.array(lens, i64), pa.array(cols[3], i64), pa.array(cols[4], i64), pa.array(seqs, i64), pa.array(offset, i64), ids_], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        for b in batches:
            for key, ids in zip(b.column(0).to_pylist(), enc.rows(b.column(1)), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                held.append((key, 0, ids, len(ids)))
                total += len(ids)
                if total >= block and (out := flush(False)) is not None:
                    yield out
        if held and (out := flush(True)) is not None:
            yield out

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(lean(run), SCHEMA)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
