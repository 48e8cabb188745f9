"""Byte-level BPE by overlapping chunks.

Texts above a chunk length are cut in chunks that reach into the next one. Every chunk is pre-tokenised
on its own, from its first character on; chunk and follower are stitched at the first place in their
overlap where both have a pre-token boundary: from there on both cuts agree, since a match of the
pattern depends only on what follows. The pieces between two stitches are then encoded, each chunk as
a row of its own, and the ids are joined in chunk order. Where an overlap holds no common boundary
(one pre-token longer than the overlap), the rest of that text is cut as one run.
Decoding looks up the bytes of the ids and joins them.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.llm.common import materialize, prepare, slices, text_bytes

CHUNK = 1 << 17  # characters
OVERLAP = 1 << 12
CACHE = 400_000  # pieces whose ids a Python worker remembers; a fixed amount of memory
LONG_PIECE = 48
NO_RANK = 1 << 32


def ranks_of(path: str) -> dict[bytes, int]:
    """The rank file, read by the driver and broadcast: a vocabulary has a fixed size."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equal ones."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
    while pairs and (best := min(pairs)) < NO_RANK:
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_RANK)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NO_RANK)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over a linked list, for pre-tokens of any length."""
    n = len(piece)
    end = list(range(1, n + 1))  # part that starts at i ends before end[i]; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if before[i] >= 0 and (rank := ranks.get(piece[before[i] : stop])) is not None:
            heapq.heappush(heap, (rank, before[i], stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def boundaries(text: str, pattern: str, start: int, stop: int) -> list[int]:
    """Ends of the pre-tokens of ``text`` that lie in [start, stop) and where a text can be cut.

    After white space it cannot: the look-ahead of the pattern would then miss the next character.
    """
    found = []
    for match in regex.finditer(pattern, text):
        end = match.end()
        if end >= stop:
            break
        if end >= start and not regex.match(r"\s", text[end - 1]):
            found.append(end)
    return found


class _Pieces(dict):
    """Ids of the pieces met so far, as bytes; long pieces are not kept, and a full memory starts anew."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode("utf-8", "surrogatepass"), self.ranks), "<u4").tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids


class _Codec:
    """Pattern, ranks and remembered pieces, one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pieces = _Pieces(ranks)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def _coder(shared, pattern: str):
    """Batches (_box, _text, _from, _tail) to ids and decoded bytes of the text from _from on, its last _tail characters left out."""
    held: list[_Codec] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(_Codec(shared.value, pattern))
        codec = held[0]
        for whole in batches:
            for batch in slices(whole, "_text", 1 << 20):
                _, texts, starts, tails = (c.to_pylist() for c in batch.columns)
                ids = [codec.encode(t[a : len(t) - b]) for t, a, b in zip(map(_text, texts), starts, tails)]
                plain = [codec.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(plain, pa.binary())], ["_box", "n_tokens", "ids", "decoded"]
                )

    return run


def _cutter(chunk: int, overlap: int):
    """Batches (_box, _row, _text) to one row per chunk: its own characters and those it shares with the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(map(_text, batch.column(2).to_pylist())):
                for n, start in enumerate(range(0, len(text), chunk)):
                    own, shared = text[start : start + chunk].encode(), text[start + chunk : start + chunk + overlap]
                    row = batch.slice(i, 1)
                    yield pa.RecordBatch.from_arrays(
                        [row.column(0), row.column(1), pa.array([n], pa.int32()), pa.array([own], pa.binary()), pa.array([shared.encode()], pa.binary()), pa.array([len(shared)], pa.int32())],
                        ["_box", "_row", "_n", "_own", "_over", "_reach"],
                    )

    return run


def _edges(pattern: str, chunk: int, overlap: int):
    """Batches of chunks to the boundaries in the overlap with the one before and with the one after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            heads, tails = [], []
            for own, over in zip(*(batch.column(i).to_pylist() for i in (2, 3))):
                text = _text(own) + _text(over)
                # the last character that is seen only serves as what follows
                heads.append(boundaries(text, pattern, 0, min(overlap, len(text)) - 1))
                tails.append([b - chunk for b in boundaries(text, pattern, chunk, len(text) - 1)] if over else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, kind), pa.array(tails, kind)], ["_row", "_n", "_head", "_tail"])

    return run


def encode(docs: DataFrame, carry: Column, ranks: dict[bytes, int], pattern: str, text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``carry`` as ``_box``, n_tokens, ids (little-endian unsigned 32-bit integers) and the bytes they decode to.

    Each match of the pattern is merged by the ranks on its own; there are no special tokens. A null
    text is empty and has no ids. Texts longer than ``chunk`` characters are cut, stitched and joined
    again as the module says, one row per chunk. Repeated rows are encoded each; an empty table gives
    no rows. Only ``carry`` and the text leave ``docs``, so other names cannot clash.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(ranks)
    body = F.col(text_col).cast("string")
    size = F.coalesce(F.length(body), F.lit(0))
    inside = docs.select(carry.alias("_box"), F.when(size <= chunk, text_bytes(text_col)).alias("_text"), F.lit(0).alias("_from"), F.lit(0).alias("_cut"), (size <= chunk).alias("_short"))
    box = inside.schema["_box"].dataType.simpleString()
    result = "n_tokens long, ids binary, decoded binary"
    short = inside.where("_short").drop("_short").mapInArrow(_coder(shared, pattern), f"_box {box}, {result}")

    long = docs.where(size > chunk).select(carry.alias("_box"), F.monotonically_increasing_id().alias("_row"), text_bytes(text_col).alias("_text"))
    chunks = materialize(long.mapInArrow(_cutter(chunk, overlap), f"_box {box}, _row long, _n int, _own binary, _over binary, _reach int"))
    cuts = chunks.select("_row", "_n", "_own", "_over").repartition("_row", "_n").mapInArrow(_edges(pattern, chunk, overlap), "_row long, _n int, _head array<int>, _tail array<int>")
    order = Window.partitionBy("_row").orderBy("_n")
    common = F.array_min(F.array_intersect(F.lag("_tail").over(order), F.col("_head")))
    stitched = cuts.select("_row", "_n", F.when(F.col("_n") == 0, F.lit(0)).otherwise(common).alias("_from"))
    # without a common boundary nothing later is proven either: the rest of that text is one run
    proven = F.min(F.col("_from").isNotNull()).over(order)
    runs = stitched.select("_row", "_n", F.when(proven, F.col("_from")).alias("_from"))
    runs = runs.withColumn("_run", F.count("_from").over(order))
    parts = chunks.join(runs, ["_row", "_n"]).groupBy("_row", "_run").agg(
        F.max("_from").alias("_from"),
        F.min_by("_box", "_n").alias("_box"),
        F.array_sort(F.collect_list(F.struct("_n", "_own"))).alias("_owns"),
        F.max_by("_over", "_n").alias("_over"),
        F.max_by("_reach", "_n").alias("_reach"),
    )
    runs_in_order = Window.partitionBy("_row").orderBy("_run")
    whole = F.concat(F.aggregate("_owns", F.lit(b""), lambda held, part: F.concat(held, part["_own"])), "_over")
    pieces = parts.select(
        F.struct("_row", "_run", "_box").alias("_box"), whole.alias("_text"), "_from", (F.col("_reach") - F.coalesce(F.lead("_from").over(runs_in_order), F.lit(0))).alias("_cut")
    )
    kind = pieces.schema["_box"].dataType.simpleString()
    coded = pieces.mapInArrow(_coder(shared, pattern), f"_box {kind}, {result}")

    def joined(name: str) -> Column:
        return F.aggregate("_parts", F.lit(b""), lambda held, part: F.concat(held, part[name]))

    texts = coded.groupBy("_box._row").agg(
        F.min_by("_box._box", "_box._run").alias("_box"), F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct(F.col("_box._run").alias("_run"), "ids", "decoded"))).alias("_parts")
    )
    return short.unionByName(texts.select("_box", "n_tokens", joined("ids").alias("ids"), joined("decoded").alias("decoded")))


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and the digests of the ids and of the decoded bytes."""
    out = encode(docs, F.col(id_col), ranks_of(path), pattern, text_col)
    return out.select(F.col("_box").alias(id_col), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
