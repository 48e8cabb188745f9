"""SimHash near-dedup by multi-index hashing.

The 64-bit fingerprints are cut in two halves. Two fingerprints within two bits differ in at most one
bit of the high half, or agree in the low half. So a fingerprint probes the table of high halves with
the ball of radius one around its own, and the table of low halves with its own; every match is
verified on all 64 bits. Where many fingerprints share a half, listing them would give all pairs of a
group; there the ball is enumerated in the other half too, and the probe is an exact look-up of a
whole fingerprint: at most 529 probes per fingerprint and no pair that is not a link. Probes meet a
bitmap of what exists before any join, so nearly all die in the task that made them.

Only distinct fingerprints are linked. Components come from alternating star contraction over the
links, written to the shared folder after every round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillscope.llm.common import bitmap, materialize, prepare, slices, text_bytes, with_hit

SEED = 42
CROWD = 32  # halves shared by more fingerprints are probed by whole fingerprints
FIRST_BITS = 1 << 26
ROUNDS_AT_ONCE = 8192  # hashes whose bits are counted together


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    words = text.lower().split()  # of bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        return _majority([b" ".join(words)])
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    view = memoryview(joined)
    last = words_per_shingle - 1
    return _majority([view[a:b] for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist())])


def _majority(shingles: list) -> int:
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, len(shingles), ROUNDS_AT_ONCE):
        hashes = np.array([digest(s, SEED) for s in shingles[start : start + ROUNDS_AT_ONCE]], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(shingles)).tolist()))


def _hash_batches(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text", 4 << 20):
                found = np.array([fingerprint(t, words_per_shingle) for t in batch.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["_box", "_fp"])

    return run


def fingerprints(docs: DataFrame, carry: Column, text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """``carry`` as ``_box`` and the fingerprint of each row as a signed 64-bit ``_fp``."""
    prepare(docs.sparkSession)
    rows = docs.select(carry.alias("_box"), text_bytes(text_col).alias("_text"))
    kind = rows.schema["_box"].dataType.simpleString()
    return rows.mapInArrow(_hash_batches(words_per_shingle), f"_box {kind}, _fp long")


def _high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _flips(radius: int, exact: bool = True) -> list[int]:
    """Masks of 32 bits with at most (or, not ``exact``, exactly) ``radius`` bits set."""
    one = [1 << i for i in range(32)]
    two = [a | b for i, a in enumerate(one) for b in one[:i]] if radius > 1 else []
    return ([0] + one if exact or radius == 1 else []) + two


def _masks(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if len(values) < 40 else F.from_json(F.lit(str(values)), "array<bigint>")


def _known(probes: DataFrame, values: DataFrame, name: str, bits: int) -> DataFrame:
    """The probes whose column ``name`` may hold one of ``values``, by a bitmap of fixed size."""
    cells = bitmap(values.select(F.xxhash64(name).alias("_h")), "_h", bits)
    return with_hit(probes, F.xxhash64(name), cells, bits).where("_hit").drop("_hit")


def links(distinct: DataFrame, max_bits: int = 2, crowd: int = CROWD, bits: int = FIRST_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in one or two bits; ``distinct`` holds ``_fp``."""
    if max_bits not in (0, 1, 2):
        raise ValueError("the enumeration is laid out for at most two bits")
    high = distinct.groupBy(_high(F.col("_fp")).alias("_half")).agg(F.count(F.lit(1)).alias("_n"))
    low = distinct.groupBy(_low(F.col("_fp")).alias("_half")).agg(F.count(F.lit(1)).alias("_n"))
    fp = F.col("_fp")

    # ball of radius one around the high half; a probe that a bitmap of the halves surely has not never moves, nor does
    # a fingerprint's own half that no other has
    own = distinct.withColumn("_mask", F.lit(0).cast("long")).withColumn("_half", _high(fp))
    around = distinct.select("_fp", F.explode(_masks(_flips(1)[1:]).cast("array<bigint>")).alias("_mask")).withColumn("_half", _high(fp).bitwiseXOR(F.col("_mask")))
    probes = _known(own, high.where("_n > 1"), "_half", bits).unionByName(_known(around, high, "_half", bits)).join(high, "_half")
    near = probes.where(F.col("_n") <= crowd).join(distinct.select(F.col("_fp").alias("_other"), _high(F.col("_fp")).alias("_half")), "_half").select("_fp", "_other")
    # a crowded half: the rest of the distance is enumerated in the low half
    crowded = probes.where(F.col("_n") > crowd)
    tail = F.explode(F.when(F.col("_mask") == 0, _masks(_flips(2))).otherwise(_masks(_flips(1)).cast("array<bigint>")))
    far = crowded.select("_fp", "_half", tail.alias("_tail")).select("_fp", F.shiftleft("_half", 32).bitwiseOR(_low(fp).bitwiseXOR(F.col("_tail"))).alias("_other"))

    # equal low halves, two bits of the high half apart
    mates = _known(distinct.withColumn("_half", _low(fp)), low.where("_n > 1"), "_half", bits).join(low.where("_n > 1"), "_half")
    same = mates.where(F.col("_n") <= crowd).join(distinct.select(F.col("_fp").alias("_other"), _low(F.col("_fp")).alias("_half")), "_half").select("_fp", "_other")
    packed = mates.where(F.col("_n") > crowd).select("_fp", "_half", F.explode(_masks(_flips(2, exact=False))).alias("_tail"))
    wide = packed.select("_fp", F.shiftleft(_high(fp).bitwiseXOR(F.col("_tail")), 32).bitwiseOR(F.col("_half")).alias("_other"))

    known = distinct.select(F.col("_fp").alias("_other"))
    looked_up = _known(far.unionByName(wide).where("_fp < _other"), known, "_other", bits).join(known, "_other").select("_fp", "_other")
    found = near.unionByName(same).where("_fp < _other").unionByName(looked_up).where(F.bit_count(fp.bitwiseXOR(F.col("_other"))) <= max_bits)
    return found.select(F.col("_fp").alias("a"), F.col("_other").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node that can be reached.

    Alternating star contraction: every node joins the smallest neighbour, first its larger
    neighbours, then its smaller ones, until nothing changes. Each round is two aggregations and is
    written to the shared folder, so a lost executor repeats one round at most.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large.where("u <> v"))
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = materialize(small.unionByName(floor.select("u", F.col("m").alias("v"))).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        before = state


def _classes(hashed: DataFrame, key: Column, max_bits: int) -> DataFrame:
    """Per distinct ``_fp`` of ``hashed`` the smallest ``key`` of its component, as ``_least``."""
    classes = materialize(hashed.groupBy("_fp").agg(F.min(key).alias("_own")))
    groups = components(links(classes.select("_fp"), max_bits))
    grouped = classes.join(groups, classes["_fp"] == groups["node"], "left").select("_fp", "_own", F.coalesce("root", "_fp").alias("_root"))
    names = grouped.groupBy("_root").agg(F.min("_own").alias("_least"))
    return grouped.join(names, "_root").select("_fp", "_least")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id, the smallest reachable id.

    Texts are lower-cased in A-Z only; null and texts without a word have fingerprint zero, which is
    linked like any other. Texts with fewer words than a shingle are one shingle. Repeated rows and
    equal texts share a fingerprint and so a component. Null ids are passed over in the minimum; a
    component of null ids only has a null id. An empty table gives no rows. Only id and text are read.
    """
    hashed = materialize(fingerprints(docs, F.col(id_col), text_col, words_per_shingle).withColumnRenamed("_box", "_id"))
    labels = _classes(hashed, F.col("_id"), max_bits)
    return hashed.join(labels, "_fp").select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), F.col("_least").alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component: that of the smallest id.

    Null ids come last; rows with the same id are told apart by their place in the written copy, so
    exactly one row of a component stays.
    """
    boxed = docs.select(F.col(text_col).alias("_body"), F.struct(F.col(id_col).alias("id"), F.struct("*").alias("row")).alias("_keep"))
    hashed = materialize(fingerprints(boxed, F.col("_keep"), "_body", words_per_shingle).withColumn("_place", F.monotonically_increasing_id()))
    key = F.struct(F.col("_box.id").isNull().alias("none"), F.col("_box.id").alias("id"), F.col("_place").alias("place"))
    labels = _classes(hashed, key, max_bits).select("_fp", F.col("_least.place").alias("_stays"))
    gone = materialize(hashed.select("_fp", "_place").join(labels, "_fp").where("_place <> _stays").select("_place"))
    # rows that surely stay never move; those that the bitmap of the others may hold are looked up exactly
    cells = bitmap(gone.select(F.xxhash64("_place").alias("_h")), "_h", FIRST_BITS)
    flagged = with_hit(hashed.select("_box", "_place"), F.xxhash64("_place"), cells, FIRST_BITS)
    left = flagged.where("NOT _hit").select("_box.row.*")
    return left.unionByName(flagged.where("_hit").join(gone, "_place", "left_anti").select("_box.row.*"))
