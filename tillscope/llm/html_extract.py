"""Main text of web pages by structure and by a suffix array over each host's pages.

A page is cut in blocks. The blocks that are not menus, forms, adverts, comments and the like are one
stream per page, and strings repeated across distinct pages of a host are found by the suffix sort of
``suffix_dedup``. Blocks that such strings cover are boilerplate, the unique runs between them are the
text. A main element that the page names is the article as it stands (its repeated lines are still the
article), unless the unique blocks outside it hold more text: then it only names teasers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillscope.llm import suffix_sort as ss
from tillscope.llm.common import bitmap, materialize, prepare, slices, text_bytes, with_hit
from tillscope.llm.html_blocks import MAIN, OPEN, blocks
from tillscope.llm.suffix_dedup import document_key, repeated

COVERED = 0.9  # share of a block's bytes that repeated strings must cover
BITS = 1 << 26


def page_blocks(data: bytes) -> tuple[list[str], bool]:
    """The candidate blocks of a page, and whether its structure already decides."""
    found = list(blocks(data.decode("utf-8", "replace")))
    main = [t for zone, t in found if zone == MAIN]
    return (main, True) if main else ([t for zone, t in found if zone == OPEN], False)


def candidates(data: bytes) -> tuple[list[str], list[bool]]:
    """The blocks of a page that may be its text, and which of them stand in its main element."""
    found = [(t, zone == MAIN) for zone, t in blocks(data.decode("utf-8", "replace")) if zone in (MAIN, OPEN)]
    return [t for t, _ in found], [inside for _, inside in found]


def settled(texts: list[str], inside: list[bool]) -> bool:
    """Whether all blocks outside the main element hold no more text than it: then no repeats can change the choice."""
    main = sum(len(t) for t, m in zip(texts, inside) if m)
    return any(inside) and sum(map(len, texts)) - main <= main


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (_box, _doc, _tag, _space, _html) to the streams of the pages' candidate blocks, one block a line."""
    for whole in batches:
        for batch in slices(whole, "_html", 4 << 20):
            found = [candidates(d) for d in batch.column(4).to_pylist()]
            texts = ["\n".join(t).encode() for t, _ in found]
            inside = pa.array([m for _, m in found], pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(texts, pa.binary()), inside, pa.array([settled(*f) for f in found], pa.bool_())], ["_box", "_doc", "_tag", "_space", "_text", "_inside", "_settled"]
            )


def uncovered(texts: list[str], first: list[int], number: list[int]) -> list[bool]:
    """Which blocks repeated windows do not cover."""
    sizes = [len(t.encode()) for t in texts]
    edge = np.zeros(sum(sizes) + len(sizes) + 1, np.int64)
    np.add.at(edge, np.array(first, np.int64), 1)
    np.add.at(edge, np.array(first, np.int64) + np.array(number, np.int64) + ss.LENGTH - 1, -1)
    gone = np.concatenate(([0], np.cumsum(np.cumsum(edge) > 0)))
    left, at = [], 0
    for size in sizes:
        left.append(bool(gone[at + size] - gone[at] < COVERED * size))
        at += size + 1
    return left


def chosen_blocks(texts: list[str], inside: list[bool], first: list[int], number: list[int]) -> list[str]:
    """The blocks of the article, by the main element and the repeated windows of the stream."""
    unique = uncovered(texts, first, number)
    outside = sum(len(t) for t, u, m in zip(texts, unique, inside) if u and not m)
    if any(inside) and outside <= sum(len(t) for t, m in zip(texts, inside) if m):
        return [t for t, m in zip(texts, inside) if m]
    return [t for t, u in zip(texts, unique) if u] or texts


def _choose_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (_box, _text, _inside, _first, _number) to main texts."""
    for batch in batches:
        texts = []
        for data, inside, first, number in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
            lines = data.decode().split("\n") if inside else []
            texts.append("\n".join(chosen_blocks(lines, inside, first or [], number or [])))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_box", "text"])


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text. Blocks are joined by a line break; a page without article text has an empty one.

    Null or empty html gives an empty text. Pages without a url, or with one that names no host, are
    compared with nothing. Rows that repeat an id are one page; null ids are told apart by their html.
    Pages of any length are read whole; an empty table gives no rows. Other columns are not read.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.struct(F.col(id_col).alias("id"), F.col(url_col).alias("url")).alias("_box"), text_bytes(html_col).alias("_html"))
    rows = rows.withColumn("_tag", F.xxhash64("_html")).withColumn("_doc", document_key(F.col("_box.id"), F.col("_tag")))
    name = F.coalesce(host(F.col("_box.url").cast("string")), F.lit(""))
    space = F.when(name != "", F.xxhash64(name)).otherwise(F.xxhash64(F.col("_doc")))
    box = rows.schema["_box"].dataType.simpleString()
    cut = rows.select("_box", "_doc", "_tag", space.bitwiseOR(F.lit(1)).alias("_space"), "_html").mapInArrow(
        _streams, f"_box {box}, _doc long, _tag long, _space long, _text binary, _inside array<boolean>, _settled boolean"
    )
    streams = materialize(cut)
    marked = repeated(streams.select("_doc", "_tag", "_space", "_text"), every=True)

    # marks travel to the pages whose blocks they can change; those of the others have told the other pages of the host
    key = F.xxhash64("_doc", "_tag")
    flagged = with_hit(streams.where("NOT _settled"), key, bitmap(marked.select(key.alias("_h")), "_h", BITS), BITS)
    none = F.array().cast("array<bigint>")
    parts = ("_box", "_text", "_inside")
    plain = streams.where("_settled").unionByName(flagged.where("NOT _hit").drop("_hit")).select(*parts, none.alias("_first"), none.alias("_number"))
    met = flagged.where("_hit").join(marked, ["_doc", "_tag"], "left").select(*parts, "_first", "_number")
    kind = f"_box {box}, text string"
    out = plain.mapInArrow(_choose_batches, kind).unionByName(met.mapInArrow(_choose_batches, kind))
    return out.select(F.col("_box.id").alias(id_col), F.col("_box.url").alias(url_col), "text")
