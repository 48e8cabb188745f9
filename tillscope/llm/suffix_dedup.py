"""Suffix-array dedup of a corpus: bytes covered by a 50-byte string of an earlier document go.

A document-wide suffix array would send every suffix to some range of the sort. Here the suffixes are
dealt by an anchor that each 50-byte window chooses from its own bytes (``suffix_sort.anchors``), so
equal windows meet, and only where it matters:

1. ``_offer``: every task sends each anchor it saw once, with the smallest document, in packed arrays
   by anchor range. An anchor of a single document stays silent from then on. The others are answered
   per document (``_answer``).
2. ``_extract``: documents meet their answers. Windows with a shared anchor are sorted by deep-shallow
   sorting inside the batch; later documents of a run of equal windows are marked at once, the first
   ones are sent on with their bytes. So a passage of a third of all documents is sent once a batch.
3. ``_settle``: the same sort over all that was sent to a bucket; again later documents are marked.
4. ``_cut``: documents meet their marks.

Whole copies of an earlier text (same SHA-256) are removed beforehand: all their windows are repeated.

The windows around a very common passage share its anchors without being equal. Anchors of very many
documents (their number is bounded by the share that makes one common) are therefore not used to deal
windows: these go by a hash of the whole window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tillscope.llm import suffix_sort as ss
from tillscope.llm.common import bitmap, materialize, prepare, text_bytes, with_hit

BUFFER = 1 << 20  # bytes of text whose anchors are taken together
OFFER_BYTES = 1 << 24  # bytes of text whose anchors are sent together
BUCKET_BYTES = 8 << 20  # bytes of text for each bucket
LEAST_BUCKETS = 48
COMMON_PARTS = 100_000  # at most twice as many anchors can be common
COMMON_LEAST = 10_000
FIRST_BITS = 1 << 26
TEXT_LEVEL = 9  # of zstandard, for texts and windows on their way

_PACKED = "key int, kind int, data binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length as byte planes: planes of zeros cost nothing."""
    planes = [a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.uint64(len(arrays[0])).tobytes() + b"".join(planes))


def _unpack(data: bytes) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(plain[:8], np.uint64)[0])
    cells = np.frombuffer(plain, np.uint8, offset=8).reshape(-1, 8, n)
    return [np.ascontiguousarray(c.T).view(np.uint64).reshape(-1) for c in cells] if n else [np.zeros(0, np.uint64)] * len(cells)


def _batch(keys: list[int], kinds: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())], ["key", "kind", "data"])


def _spread(values: np.ndarray, buckets: int) -> np.ndarray:
    return (ss.mix(values.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _home(doc: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a document; the same as pmod in Spark."""
    return doc.astype(np.int64) % buckets


def _pack_pairs(doc: np.ndarray, anchor: np.ndarray, total: np.ndarray, buckets: int) -> bytes:
    """Pairs of one document bucket, anchors ascending: documents by their place in the bucket, anchors by their steps."""
    return _pack(doc.astype(np.int64) // buckets, np.diff(anchor, prepend=np.uint64(0)), total)


def _unpack_pairs(data: bytes, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    turn, step, total = _unpack(data)
    return (turn.astype(np.int64) * buckets + bucket).astype(np.uint64), np.cumsum(step, dtype=np.uint64), total


def _within(anchor: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Anchor ids of a space of their own; space 0 leaves them as they are."""
    if not space.any():
        return anchor
    return np.where(space == 0, anchor, ss.mix(anchor ^ ss.mix(space.astype(np.uint64))) >> np.uint64(64 - ss.ANCHOR_BITS))


def _prime(least: int) -> int:
    """A prime number of buckets deals out ids of any step evenly."""
    n = max(2, least)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _cuts(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, begin, end) of the runs of a sorted array."""
    begin = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) else []
    for a, b in zip(begin, [*begin[1:], len(sorted_keys)]):
        yield int(sorted_keys[a]), int(a), int(b)


def buffers(texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ends, text number, offset in the text); longer texts come in overlapping pieces."""
    held: list[bytes] = []
    numbers: list[int] = []
    offsets: list[int] = []
    size = 0

    def full():
        ends = np.cumsum([len(p) for p in held])
        return np.frombuffer(b"".join(held), np.uint8), ends - [len(p) for p in held], ends, np.array(numbers), np.array(offsets)

    for number, text in enumerate(texts):
        for start in range(0, len(text), BUFFER):
            piece = text[start : start + BUFFER + ss.LENGTH - 1]
            if size + len(piece) > BUFFER and held:
                yield full()
                held, numbers, offsets, size = [], [], [], 0
            held.append(piece)
            numbers.append(number)
            offsets.append(start)
            size += len(piece)
    if held:
        yield full()


def _offer(buckets: int):
    """Batches (_doc, _space, _text) to packed rows: anchors by range (kind 0), and shared anchors of further documents (kind 1)."""

    def flush(docs: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        doc, anchor = np.concatenate(docs), np.concatenate(ids)
        order = np.lexsort((doc, anchor))
        doc, anchor = doc[order], anchor[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
        doc, anchor = doc[fresh], anchor[fresh]
        head = ss._heads(anchor)
        begin = np.flatnonzero(head)
        count = np.diff(np.append(begin, len(anchor)))
        keys, kinds, data = [], [], []
        sent, first = anchor[begin], doc[begin]
        least = first.min()
        for key, a, b in _cuts((sent * np.uint64(buckets) >> np.uint64(ss.ANCHOR_BITS)).astype(np.int64)):
            part = sent[a:b]
            keys.append(key)
            kinds.append(0)
            data.append(_pack(np.diff(part, prepend=np.uint64(0)), (first[a:b] - least).astype(np.uint64), count[a:b], np.full(b - a, least).astype(np.uint64)))
        rest = ~head
        if rest.any():
            doc, anchor = doc[rest], anchor[rest]
            place = _home(doc, buckets)
            order = np.argsort(place, kind="stable")
            for key, a, b in _cuts(place[order]):
                keys.append(buckets + key)
                kinds.append(1)
                data.append(_pack_pairs(doc[order[a:b]], anchor[order[a:b]], np.zeros(b - a), buckets))
        return _batch(keys, kinds, data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        size = 0
        for batch in batches:
            names, spaces = (np.array(batch.column(i).to_pylist(), np.int64) for i in (0, 1))
            for raw, starts, ends, number, _ in buffers(batch.column(2).to_pylist()):
                head, _, _, anchor = ss.anchors(raw, starts, ends)
                where = number[np.searchsorted(ends, head, "right")]
                docs.append(names[where])
                ids.append(_within(anchor, spaces[where]))
                size += len(raw)
                if size >= OFFER_BYTES:
                    yield flush(docs, ids) if any(map(len, ids)) else _batch([], [], [])
                    docs, ids, size = [], [], 0
        if any(map(len, ids)):
            yield flush(docs, ids)

    return run


def _answer(buckets: int):
    """Offers of one anchor range to answers by document bucket: anchors that a document shares, with their weight."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, docs, counts = [], [], []
        for batch in batches:
            names = batch.schema.names
            for kind, data in zip(batch.column(names.index("kind")).to_pylist(), batch.column(names.index("data")).to_pylist()):
                if kind == 1:
                    yield _batch([key[0].as_py() - buckets], [1], [data])
                    continue
                step, doc, count, least = _unpack(data)
                anchors.append(np.cumsum(step, dtype=np.uint64))
                docs.append(doc + least)
                counts.append(count)
        if not anchors:
            return
        anchor, doc, count = np.concatenate(anchors), np.concatenate(docs), np.concatenate(counts)
        order = np.argsort(anchor, kind="stable")
        anchor, doc, count = anchor[order], doc[order], count[order]
        head = ss._heads(anchor)
        begin = np.flatnonzero(head)
        total = np.add.reduceat(count, begin)
        low, high = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
        group = np.cumsum(head) - 1
        several = ((low != high) | (np.maximum.reduceat(count, begin) > 1))[group]
        anchor, doc, total = anchor[several], doc[several], total[group][several]
        total = np.where(total >= COMMON_LEAST, total, 0)  # no other weight is looked at
        place = _home(doc, buckets)
        order = np.argsort(place, kind="stable")
        keys, data = [], []
        for bucket, a, b in _cuts(place[order]):
            part = order[a:b]
            keys.append(bucket)
            data.append(_pack_pairs(doc[part], anchor[part], total[part], buckets))
        yield _batch(keys, [0] * len(keys), data)

    return run


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to (anchor, weight) of the anchors that are worth a look."""
    for batch in batches:
        for data in batch.column(2).to_pylist():
            _, anchor, total = _unpack_pairs(data, 0, 1)
            heavy = total >= COMMON_LEAST
            if heavy.any():
                found, where = np.unique(anchor[heavy], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(total[heavy][where].astype(np.int64))], ["anchor", "weight"])


def _windows(head: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of runs, and the run of each."""
    run = np.repeat(np.arange(len(head)), number)
    return head[run] + np.arange(len(run)) - (np.cumsum(number) - number)[run], run


def _whole_hash(chars: np.ndarray, windows: np.ndarray) -> np.ndarray:
    value = np.zeros(len(windows), np.uint64)
    for at in (*ss.SHALLOW, *ss.DEEP):
        value = ss.mix(value ^ chars[windows + at])
    return value


def _marks(doc: np.ndarray, text: np.ndarray, place: np.ndarray) -> bytes:
    """Marked window starts as ranges (doc, text, first, number)."""
    order = np.lexsort((place, text, doc))
    doc, text, place = doc[order], text[order], place[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(head)
    number = np.diff(np.append(begin, len(doc)))
    return _pack(doc[begin], text[begin], place[begin], number)


def _place(buckets: int):
    """Batches (_doc, _tag, _space, _text) to the texts of each document bucket, compressed together."""

    def flush(docs: list[int], tags: list[int], spaces: list[int], texts: list[bytes]) -> pa.RecordBatch:
        columns = [np.array(v, np.int64) for v in (docs, tags, spaces)]
        home = _home(columns[0], buckets)
        order = np.argsort(home, kind="stable")
        keys, data = [], []
        for key, a, b in _cuts(home[order]):
            part = order[a:b]
            held = [texts[i] for i in part.tolist()]
            numbers = _pack(*(c[part].astype(np.uint64) for c in columns), np.array([len(t) for t in held], np.uint64))
            keys.append(key)
            data.append(len(numbers).to_bytes(4, "little") + numbers + zstandard.ZstdCompressor(level=TEXT_LEVEL).compress(b"".join(held)))
        return _batch(keys, [0] * len(keys), data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, ...] = ([], [], [], [])
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for column, v in zip(held, row):
                    column.append(v)
                size += len(row[3])
                if size >= OFFER_BYTES:
                    yield flush(*held)
                    held, size = ([], [], [], []), 0
        if held[0]:
            yield flush(*held)

    return run


def _placed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The documents of a bucket: _doc, _tag, _space and their texts."""
    columns, texts = [], []
    for data in table.column("data").to_pylist():
        cut = 4 + int.from_bytes(data[:4], "little")
        *numbers, size = (v.astype(np.int64) for v in _unpack(data[4:cut]))
        columns.append(numbers)
        raw = zstandard.ZstdDecompressor().decompress(data[cut:])
        ends = np.cumsum(size).tolist()
        texts += [raw[a:b] for a, b in zip([0, *ends], ends)]
    names, tags, spaces = (np.concatenate(c) for c in zip(*columns)) if columns else [np.zeros(0, np.int64)] * 3
    return names, tags, spaces, texts


def _extract(buckets: int, shared, judge):
    """Documents of a bucket and their answers to marks (kind 1) and to first windows with their bytes (kind 0)."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        common = shared.value
        if not right.num_rows:
            return _batch([], [], []).schema.empty_table()
        docs, anchors = [], []
        for data in right.column("data").to_pylist():
            doc, anchor, _ = _unpack_pairs(data, key[0].as_py(), buckets)
            docs.append(doc)
            anchors.append(anchor)
        doc, anchor = np.concatenate(docs), np.concatenate(anchors)
        # (document, anchor) pairs as one sorted array of hashes; a false hit only adds candidates
        known = np.sort(ss.mix(doc ^ (anchor * np.uint64(ss.BASE))))
        names, tags, spaces, texts = _placed(left)
        out: list[pa.RecordBatch] = []
        for raw, starts, ends, number, offset in buffers(texts):
            head, count, place, found = ss.anchors(raw, starts, ends)
            piece = np.searchsorted(ends, head, "right")
            found = _within(found, spaces[number[piece]])
            pair = ss.mix(names[number[piece]].astype(np.uint64) ^ (found * np.uint64(ss.BASE)))
            at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
            held = known[at] == pair
            if not held.any():
                continue
            head, count, place, found, piece = head[held], count[held], place[held], found[held], piece[held]
            window, of = _windows(head, count)
            owner = names[number[piece]][of]
            order, first = ss.deep_shallow(raw, window, found[of] * np.uint64(64) + (place[of] - window).astype(np.uint64))
            again, kept = judge(owner, order, first)
            if len(again):
                where = number[piece[of[again]]]
                packed = _marks(names[where].astype(np.uint64), tags[where].astype(np.uint64), (window[again] - starts[piece[of[again]]] + offset[piece[of[again]]]).astype(np.uint64))
                out.append(_batch([buckets + key[0].as_py()], [1], [packed]))
            out.append(_send(raw, np.sort(kept), window, of, found, place, piece, starts, number, offset, names, tags, spaces, common, buckets))
        return pa.Table.from_batches(out, schema=_batch([], [], []).schema)

    return run


def _send(raw, kept, window, of, found, place, piece, starts, number, offset, names, tags, spaces, common, buckets) -> pa.RecordBatch:
    """First windows as byte runs by bucket: runs of one anchor, or single windows where the anchor is common."""
    window, of = window[kept], of[kept]
    frequent = np.isin(found[of], common) if len(common) else np.zeros(len(of), bool)
    head = np.ones(len(of), bool)
    head[1:] = (of[1:] != of[:-1]) | (window[1:] != window[:-1] + 1) | frequent[1:]
    begin = np.flatnonzero(head)
    count = np.diff(np.append(begin, len(of)))
    window, of, frequent = window[begin], of[begin], frequent[begin]
    key, ahead = found[of].copy(), (place[of] - window).astype(np.uint64)
    if frequent.any():
        whole = _whole_hash(ss.characters(raw), window[frequent]) >> np.uint64(64 - ss.ANCHOR_BITS)
        key[frequent] = _within(whole, spaces[number[piece[of[frequent]]]])
        ahead[frequent] = ss.REACH  # windows dealt by their hash are never next to the others
    bucket = _spread(key, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, data = [], []
    part_of = piece[of]
    for value, a, b in _cuts(bucket[order]):
        rows = order[a:b]
        run, _ = _windows(window[rows], count[rows] + ss.LENGTH - 1)
        where = number[part_of[rows]]
        numbers = _pack(
            key[rows], ahead[rows], count[rows], names[where].astype(np.uint64), tags[where].astype(np.uint64), (window[rows] - starts[part_of[rows]] + offset[part_of[rows]]).astype(np.uint64)
        )
        text = zstandard.ZstdCompressor(level=TEXT_LEVEL).compress(raw[run].tobytes())
        keys.append(value)
        data.append(len(numbers).to_bytes(4, "little") + numbers + text)
    return _batch(keys, [0] * len(keys), data)


def _settle(judge):
    """First windows of a bucket to marks, a part of its anchors at a time; marks (kind 1) pass through."""

    def part(numbers: list[np.ndarray], raw: np.ndarray, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchor, ahead, count, doc, tag, offset = numbers
        size = count.astype(np.int64) + ss.LENGTH - 1
        run, _ = _windows(begin, size)
        window, of = _windows(np.cumsum(size) - size, count.astype(np.int64))
        step = window - (np.cumsum(size) - size)[of]
        order, head = ss.deep_shallow(raw[run], window, anchor[of] * np.uint64(64) + ahead[of] - step.astype(np.uint64))
        again, _ = judge(doc.astype(np.int64)[of], order, head)
        if len(again):
            yield _batch([0], [1], [_marks(doc[of[again]], tag[of[again]], offset[of[again]] + step[again].astype(np.uint64))])

    def run(_key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, texts = [], []
        for batch in batches:
            names = batch.schema.names
            for kind, data in zip(batch.column(names.index("kind")).to_pylist(), batch.column(names.index("data")).to_pylist()):
                if kind == 1:
                    yield _batch([0], [1], [data])
                    continue
                cut = 4 + int.from_bytes(data[:4], "little")
                numbers.append(_unpack(data[4:cut]))
                texts.append(zstandard.ZstdDecompressor().decompress(data[cut:]))
        if not numbers:
            return
        columns = [np.concatenate(c) for c in zip(*numbers)]
        raw = np.frombuffer(b"".join(texts), np.uint8)
        del numbers, texts
        size = columns[2].astype(np.int64) + ss.LENGTH - 1
        begin = np.cumsum(size) - size
        order = np.argsort(columns[0], kind="stable")
        columns, size, begin = [c[order] for c in columns], size[order], begin[order]
        # parts of about BUFFER bytes that end between anchors
        head = np.flatnonzero(ss._heads(columns[0]))
        after = np.cumsum(size)
        lot = (after[head] - size[head]) // BUFFER
        cuts = [*head[ss._heads(lot)].tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            yield from part([c[a:b] for c in columns], raw, begin[a:b])

    return run


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            doc, tag, first, number = (a.astype(np.int64) for a in _unpack(data))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(first), pa.array(number)], ["_doc", "_tag", "_first", "_number"])


def keep(text: bytes, first: list[int], number: list[int]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text and the removed byte spans, from ranges of window starts."""
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, np.array(first, np.int64), 1)
    np.add.at(edge, np.array(first, np.int64) + np.array(number, np.int64) + ss.LENGTH - 1, -1)
    gone = np.concatenate(([False], np.cumsum(edge[:-1]) > 0, [False]))
    turn = np.flatnonzero(gone[1:] != gone[:-1])
    spans = list(zip(turn[::2].tolist(), turn[1::2].tolist()))
    return np.frombuffer(text, np.uint8)[~gone[1:-1]].tobytes(), spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        left = [keep(t, f or [], n or []) for t, f, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x for x, _ in left], pa.binary()), pa.array([[{"begin": a, "end": b} for a, b in s] for _, s in left], spans)], ["_box", "kept", "spans"]
        )


def _copies(long: DataFrame) -> DataFrame:
    """Texts that are whole copies of the text of a smaller document: all their windows are repeated."""
    narrow = long.select("_doc", "_tag", "_space", F.sha2("_text", 256).alias("_s"), F.length("_text").cast("long").alias("_n"))
    firsts = narrow.groupBy("_space", "_s").agg(F.min("_doc").alias("_least"), F.max("_doc").alias("_most")).where("_least < _most").drop("_most")
    return materialize(narrow.join(firsts, ["_space", "_s"]).where("_doc > _least").select("_doc", "_tag", "_n").distinct())


def _without(long: DataFrame, copies: DataFrame) -> DataFrame:
    """The other texts; only those that a bitmap of the copies may hold are looked up."""
    cells = bitmap(copies.select(F.xxhash64("_doc", "_tag").alias("_h")), "_h", FIRST_BITS)
    flagged = with_hit(long, F.xxhash64("_doc", "_tag"), cells, FIRST_BITS)
    return flagged.where("NOT _hit").unionByName(flagged.where("_hit").join(copies.select("_doc", "_tag"), ["_doc", "_tag"], "left_anti")).drop("_hit")


def repeated(texts: DataFrame, buckets: int | None = None, every: bool = False) -> DataFrame:
    """Ranges of window starts (_doc, _tag, _first, _number as arrays) whose 50-byte string is repeated.

    ``texts`` holds _doc, _tag, _space and _text (bytes); strings are compared inside a space. A window is
    marked if its string also starts in a smaller document or, with ``every``, in any other document.
    """
    spark = prepare(texts.sparkSession)
    if buckets is None:
        total = texts.agg(F.sum(F.length("_text").cast("long"))).first()[0] or 0
        buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    buckets = _prime(buckets)
    judge = ss.common if every else ss.repeats
    long = texts.where(F.length("_text") >= ss.LENGTH)
    if not every:
        copies = _copies(long)
        long = _without(long, copies)

    offers = long.select("_doc", "_space", "_text").mapInArrow(_offer(buckets), _PACKED)
    answers = materialize(offers.groupBy("key").applyInArrow(_answer(buckets), _PACKED))
    weights = materialize(answers.mapInArrow(_weights, "anchor long, weight long").groupBy("anchor").agg(F.max("weight").alias("weight")))
    limit = max(COMMON_LEAST, (weights.agg(F.sum("weight")).first()[0] or 0) // COMMON_PARTS)
    # at most COMMON_PARTS anchors reach the limit
    common = np.sort(np.array([r[0] for r in weights.where(F.col("weight") >= limit).select("anchor").toLocalIterator()], np.uint64))

    placed = long.select("_doc", "_tag", "_space", "_text").mapInArrow(_place(buckets), _PACKED)
    asked = answers.select("key", "data").groupBy("key")
    sent = placed.groupBy("key").cogroup(asked).applyInArrow(_extract(buckets, spark.sparkContext.broadcast(common), judge), _PACKED)
    marks = sent.groupBy("key").applyInArrow(_settle(judge), _PACKED).select("data").mapInArrow(_ranges, "_doc long, _tag long, _first long, _number long")
    if not every:
        marks = marks.unionByName(copies.select("_doc", "_tag", F.lit(0).cast("long").alias("_first"), (F.col("_n") - ss.LENGTH + 1).alias("_number")))
    return materialize(marks.groupBy("_doc", "_tag").agg(F.collect_list("_first").alias("_first"), F.collect_list("_number").alias("_number")))


def document_key(identity: Column, tag: Column) -> Column:
    """The id as a number; null ids come after all others, ordered by a hash of the text."""
    return F.coalesce(identity.cast("long"), F.shiftrightunsigned(tag, 2).bitwiseOR(F.lit(1 << 62)))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Per row: id, n_bytes, the bytes that are kept, and the removed spans (begin, end) in the input bytes.

    A byte goes if a 50-byte string that covers it also starts in a document with a smaller id. A null
    text is empty; texts under 50 bytes stay whole. Null ids come after all others, ordered by a hash
    of their text. Rows that share an id are one document: they remove nothing from each other. An
    empty table gives no rows. Only id and text are read. ``docs`` is read three times and must give
    the same rows each time.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text")).withColumn("_tag", F.xxhash64("_text"))
    rows = rows.withColumn("_doc", document_key(F.col("_id"), F.col("_tag")))
    marked = repeated(rows.select("_doc", "_tag", F.lit(0).cast("long").alias("_space"), "_text"), buckets)

    cells = bitmap(marked.select(F.xxhash64("_doc", "_tag").alias("_h")), "_h", FIRST_BITS)
    flagged = with_hit(rows, F.xxhash64("_doc", "_tag"), cells, FIRST_BITS)
    touched = flagged.where("_hit").join(marked, ["_doc", "_tag"], "left").select("_id", "_text", "_first", "_number")
    whole = flagged.where("NOT _hit").select("_id", F.length("_text").cast("long").alias("n_bytes"), F.col("_text").alias("kept"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans"))
    cut = touched.select(F.struct("_id", F.length("_text").cast("long").alias("n")).alias("_box"), "_text", "_first", "_number")
    kind = cut.schema["_box"].dataType.simpleString()
    left = cut.mapInArrow(_cut, f"_box {kind}, kept binary, spans array<struct<begin:bigint,end:bigint>>")
    out = whole.unionByName(left.select(F.col("_box._id").alias("_id"), F.col("_box.n").alias("n_bytes"), "kept", "spans"))
    return out.withColumnRenamed("_id", id_col)
