"""Cross-tokenizer alignment by an associative fragment monoid.

Two tokenizers cut the same bytes: A (byte-level BPE, given " " + text) and B (a sentencepiece model,
which adds the space itself). Byte offsets where an A token and a B token both end cut the tokens into
groups; every A-B token pair inside a group is a link.

Method. A text's tokens are dealt by their end byte into byte-range chunks of ``chunk_bytes``. Each
chunk yields a *fragment*: either one open piece (no common end inside it), or an open prefix (tokens up
to the first common end, whose group began in an earlier chunk), the closed groups, and an open suffix.
Composing two neighbouring fragments is associative (the suffix of the left one and the prefix of the
right one fuse into one group), so the fragments of a document are composed by a tree reduction:
every level groups neighbours (chunk // 2) across Spark tasks, and only documents that still have more
than one fragment take part in the next level. Short documents have one fragment and no reduction.

Units. Where both tokenizers always cut (a single space between two other characters, checked on the
two models, see ``_splitter``) a text falls into units whose tokens do not depend on what stands around
them. A unit's tokens, groups and links are found once while a worker holds it (``_Units``) and a text's
fragment is composed of its units'. With models that do not allow it a unit is the whole text.

Corpus side: each document's distinct linked (A id, B id) pairs, with their link multiplicity, are
counted per pair over distinct documents (partial aggregation before the shuffle; only doc_ids that may
occur on several rows are made distinct by a shuffle); the best count of each A id follows by one more
aggregate. The counts of the pairs on most rows (at most ``HOT_PAIRS``) are broadcast and looked up in
the links where they lie; the links of all other pairs, each on a small share of the rows, are joined on
(A id, B id).

Defined results: null, empty, and texts whose joined A or B token bytes are not " " + text have no
tokens: all counts 0 and groups_sha256 ''. Repeated rows each get the same row. Extra input columns
are ignored (only doc_id and text are read), so clashing names cannot interfere. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillscope.llm.common import bitmap, materialize, prepare, slices, with_hit

CHUNK_BYTES = 1 << 14
SLICE_BYTES = 1 << 20  # text bytes tokenized at once in a task, so that a task's memory stays bounded
UNIT_CHARS = 3 << 20  # characters of different units that a worker holds before it gives up the rare ones
RUN_UNITS = 64  # units that are tokenized as one string, where both tokenizers cut between them
LEARN_CHARS = 1 << 18  # characters of units that are tokenized at once
HOT_PAIRS = 1 << 19  # pairs whose counts are broadcast
ID_BITS = 1 << 26
FOLDED = "_row long, doc_id long, chunk long, _n long, cut boolean, pa array<int>, pb array<int>, closed string, sa array<int>, sb array<int>"
FRAGMENT = "_row long, doc_id long, chunk long, cut boolean, pa array<int>, pb array<int>, closed string, sa array<int>, sb array<int>"


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet of byte BPE vocabularies: printable Latin-1 bytes stand for themselves,
    the other 68 bytes take the code points from 256 upward in byte order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {}, 0
    for b in range(256):
        if b in kept:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


@lru_cache(maxsize=4)
def _tokenizers(a_path: str, b_path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task: Spark gives the parallelism
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    alphabet = _byte_alphabet()
    found = {i: bytes(alphabet[c] for c in s) for s, i in a.get_vocab().items()}
    vocab = [found.get(i, b"") for i in range(max(found) + 1)]
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = []
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        pieces.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode("utf-8"))
    lengths = (np.array([len(v) for v in vocab], np.int64), np.array([len(v) for v in pieces], np.int64))
    return a, vocab, b, pieces, lengths


# no white space in any Unicode version, and nothing that B reads as a space
_SOLID = r"[^\s\u180e\u200b\u2581\ufeff]"
_JOINS = re.compile(f"{_SOLID}(?:.*{_SOLID})?", re.DOTALL).fullmatch


def _flat(texts: list[str], a_path: str, b_path: str) -> tuple[np.ndarray, ...]:
    """Of texts that are not empty: A ids one after another, A tokens per text, the same of B, and whether both join to " " + text."""
    a, vocab, b, pieces, (a_len, b_len) = _tokenizers(a_path, b_path)
    wholes = [(" " + t).encode("utf-8", "surrogatepass") for t in texts]
    sides = []
    good = np.ones(len(texts), bool)
    for found, lengths, entry in (([e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], a_len, vocab), (b.encode(texts), b_len, pieces)):
        count = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(count.sum()))
        edge = np.concatenate([[0], np.cumsum(count)])
        size = np.concatenate([[0], np.cumsum(lengths[ids])])[edge]
        good &= np.diff(size) == np.fromiter(map(len, wholes), np.int64, len(wholes))
        joined = b"".join(map(entry.__getitem__, ids.tolist()))
        if joined != b"".join(wholes):
            good &= [joined[x:y] == w for x, y, w in zip(size[:-1].tolist(), size[1:].tolist(), wholes)]
        sides += [ids, count]
    return *sides, good


def tokens(texts: list[str | None], a_path: str, b_path: str) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None]:
    """Per text: A ids, A end offsets, B ids, B end offsets (bytes of " " + text); None where it has no tokens."""
    a_len, b_len = _tokenizers(a_path, b_path)[4]
    found: list = [None] * len(texts)
    live = [i for i, t in enumerate(texts) if t]
    if live:
        a_ids, n_a, b_ids, n_b, good = _flat([texts[i] for i in live], a_path, b_path)
        for i, x, y, ok in zip(live, np.split(a_ids, np.cumsum(n_a)[:-1]), np.split(b_ids, np.cumsum(n_b)[:-1]), good):
            if ok:
                found[i] = (x, np.cumsum(a_len[x]), y, np.cumsum(b_len[y]))
    return found


def _whole(text: str) -> list[str]:
    return [text]


@lru_cache(maxsize=4)
def _splitter(a_path: str, b_path: str):
    """A function that cuts a text at spaces where both tokenizers always cut; the space itself is dropped.

    A: a byte-level BPE with its own pattern never lets a match reach over a space that follows a character
    other than white space. B: a BPE without normalisation, none of whose pieces has a space after another
    character, cannot merge over it either, and adds the space at the front of each unit by itself. The
    character after the space is no white space, so that runs of spaces stay together. Models of any other
    kind: texts are not cut.
    """
    try:
        from sentencepiece import sentencepiece_model_pb2 as proto
    except ImportError:
        return _whole
    a = json.load(open(a_path, encoding="utf-8"))
    pre, model = a.get("pre_tokenizer") or {}, a.get("model") or {}
    a_cuts = (
        a.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")) and all(t["special"] for t in a.get("added_tokens") or [])
    )
    b = proto.ModelProto()
    with open(b_path, "rb") as f:
        b.ParseFromString(f.read())
    spec = b.normalizer_spec
    b_cuts = (
        b.trainer_spec.model_type == proto.TrainerSpec.BPE and b.trainer_spec.byte_fallback and not b.trainer_spec.treat_whitespace_as_suffix
        and not spec.precompiled_charsmap and not spec.normalization_rule_tsv and spec.add_dummy_prefix and spec.escape_whitespaces and not spec.remove_extra_whitespaces
        and not any(p.type == proto.ModelProto.SentencePiece.USER_DEFINED or "▁" in p.piece.lstrip("▁") for p in b.pieces)
    )
    if not (a_cuts and b_cuts):
        return _whole
    return re.compile(f"(?<={_SOLID}) (?={_SOLID})").split


def _group(a, b) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def fragment(a_ids, a_ends, b_ids, b_ends) -> tuple:
    """The fragment of a run of tokens (both streams ordered by end): (cut, prefix A, prefix B, closed, suffix A, suffix B)."""
    a_ids, a_ends, b_ids, b_ends = (np.asarray(v, np.int64) for v in (a_ids, a_ends, b_ids, b_ends))
    common = np.intersect1d(a_ends, b_ends)
    if not len(common):
        return (False, a_ids.tolist(), b_ids.tolist(), "", [], [])
    # a token belongs to the group of the first common end at or after its own end
    ga, gb = np.searchsorted(common, a_ends, "left"), np.searchsorted(common, b_ends, "left")
    (a_first, a_last), (b_first, b_last) = (np.searchsorted(g, [1, len(common)], "left") for g in (ga, gb))
    inner = _groups_text(a_ids[a_first:a_last], ga[a_first:a_last] - 1, b_ids[b_first:b_last], gb[b_first:b_last] - 1, len(common) - 1)
    return (True, a_ids[:a_first].tolist(), b_ids[:b_first].tolist(), inner, a_ids[a_last:].tolist(), b_ids[b_last:].tolist())


def compose(left: tuple, right: tuple) -> tuple:
    """The fragment of two neighbouring runs; associative, with the empty open piece as unit."""
    lc, lpa, lpb, lclosed, lsa, lsb = left
    rc, rpa, rpb, rclosed, rsa, rsb = right
    if not lc and not rc:
        return (False, lpa + rpa, lpb + rpb, "", [], [])
    if not lc:
        return (True, lpa + rpa, lpb + rpb, rclosed, rsa, rsb)
    if not rc:
        return (True, lpa, lpb, lclosed, lsa + rpa, lsb + rpb)
    middle = _group(lsa + rpa, lsb + rpb)
    return (True, lpa, lpb, ";".join(p for p in (lclosed, middle, rclosed) if p), rsa, rsb)


def _groups_text(a_ids: np.ndarray, ga: np.ndarray, b_ids: np.ndarray, gb: np.ndarray, groups: int, ends: np.ndarray | None = None) -> str:
    """The groups as text: per group its A ids, "|", its B ids, groups joined by ";" (every group has tokens of both).

    The groups numbered in ``ends`` end a line.
    """
    if not groups:
        return ""
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    start = np.concatenate([[0], np.cumsum(na + nb)[:-1]])
    first_a, first_b = np.concatenate([[0], np.cumsum(na)[:-1]]), np.concatenate([[0], np.cumsum(nb)[:-1]])
    values = np.empty(len(a_ids) + len(b_ids), np.int64)
    values[start[ga] + np.arange(len(a_ids)) - first_a[ga]] = a_ids
    values[start[gb] + na[gb] + np.arange(len(b_ids)) - first_b[gb]] = b_ids
    seps = np.full(len(values), ",", dtype="<U1")
    seps[start + na - 1] = "|"
    last = start + na + nb - 1
    seps[last] = ";"
    if ends is not None:
        seps[last[ends]] = "\n"
    return "".join(map(str.__add__, map(str, values.tolist()), seps.tolist()))[:-1]


def _pairs(a_ids: np.ndarray, ga: np.ndarray, b_ids: np.ndarray, gb: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Every A token with every B token of its group, as A << 32 | B, and the group of each."""
    nb = np.bincount(gb, minlength=groups)
    first_b = np.cumsum(nb) - nb
    reps = nb[ga]
    at = np.repeat(first_b[ga] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
    return np.repeat(a_ids, reps) << 32 | b_ids[at], np.repeat(ga, reps)


def _take(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs (start, size) of an array, one after another."""
    return values[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def _counted(owner: np.ndarray, pair: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multiplicities summed by owner and pair, in that order."""
    if not len(pair):
        return owner, pair, m
    pairs, number = np.unique(pair, return_inverse=True)
    key = owner * len(pairs) + number
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    owner, number = np.divmod(key[head], len(pairs))
    return owner, pairs[number], np.add.reduceat(m[order], head)


class _Units:
    """The units met so far, numbered, with their token ids, groups and links; the rare ones are given up when they hold too much text."""

    def __init__(self, a_path: str, b_path: str, chunk_bytes: int):
        self.paths, self.chunk_bytes = (a_path, b_path), chunk_bytes
        self.split = _splitter(a_path, b_path)
        self.joins = self.split is not _whole
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        # columns: has tokens, bytes, A tokens, B tokens, groups, links
        self.figures = np.zeros((0, 6), np.int64)
        self.a_ids, self.b_ids = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pair, self.times = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.held, self.met = 0, np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Keep the units that several slices of text held, or none where these are still many."""
        keep = np.flatnonzero(self.met > 1)
        names = list(self.number)
        names, text = [names[i] for i in keep.tolist()], [self.text[i] for i in keep.tolist()]
        figures, (a_ids, b_ids) = self.figures[keep], self.ids(keep)
        pair, times = (_take(v, self.start[keep, 5], figures[:, 5]) for v in (self.pair, self.times))
        self._clear()
        if 2 * sum(map(len, names)) <= UNIT_CHARS:
            self._number(names, text, figures, a_ids, b_ids)
            self.pair, self.times = pair, times
            self.held = sum(map(len, names))
            self.met = np.ones(len(names), np.int64)

    def numbers(self, units: list[str]) -> np.ndarray:
        if self.held > UNIT_CHARS:
            self._shrink()
        new = [u for u in dict.fromkeys(units) if u not in self.number]
        lots, held = [[]], 0
        for u in new:
            if held > LEARN_CHARS:
                lots.append([])
                held = 0
            lots[-1].append(u)
            held += len(u)
        for lot in lots:
            if lot:
                self._learn(lot)
        self.start = np.cumsum(self.figures, axis=0) - self.figures
        found = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        self.met = np.concatenate([self.met, np.zeros(len(self.text) - len(self.met), np.int64)])
        self.met[found] += 1  # once for a slice
        return found

    def _learn(self, new: list[str]) -> None:
        """Tokenize units, runs of them as one string; a run that does not come out alone, each of its units alone."""
        joined, alone = [], []
        for u in new:
            (joined if self.joins and len(u) <= self.chunk_bytes and _JOINS(u) else alone).append(u)
        again = self._add([joined[i : i + RUN_UNITS] for i in range(0, len(joined), RUN_UNITS)], False)
        self._add([[u] for u in (*again, *alone)], True)
        self.held += sum(map(len, new))

    def _add(self, runs: list[list[str]], last: bool) -> list[str]:
        """Add the units of runs; gives those of runs that fail, with ``last`` these have no tokens."""
        if not runs:
            return []
        a_len, b_len = _tokenizers(*self.paths)[4]
        a_ids, n_a, b_ids, n_b, good = _flat([" ".join(r) for r in runs], *self.paths)
        units = [u for r in runs for u in r]
        size = np.fromiter((len(u.encode("utf-8", "surrogatepass")) + 1 for u in units), np.int64, len(units))
        run = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        run_a, run_b = np.repeat(np.arange(len(runs)), n_a), np.repeat(np.arange(len(runs)), n_b)
        # a unit must end where both have a token's end; offsets are counted over all runs that are good
        for _ in range(2):
            keep_a, keep_b, keep = good[run_a], good[run_b], good[run]
            a_ends, b_ends, ends = np.cumsum(a_len[a_ids[keep_a]]), np.cumsum(b_len[b_ids[keep_b]]), np.cumsum(size[keep])
            common = np.intersect1d(a_ends, b_ends)
            at = np.searchsorted(common, ends)
            missed = common[np.minimum(at, max(0, len(common) - 1))] != ends if len(common) else np.ones(len(ends), bool)
            if not missed.any():
                break
            good[run[keep][missed]] = False
        again = [u for u, k in zip(units, keep.tolist()) if not k]
        kept = [u for u, k in zip(units, keep.tolist()) if k]
        a_ids, b_ids, size = a_ids[keep_a], b_ids[keep_b], size[keep]
        ga, gb = np.searchsorted(common, a_ends, "left"), np.searchsorted(common, b_ends, "left")
        if kept:
            of = np.searchsorted(at, np.arange(len(common)), "left")  # the unit of each group
            figures = np.column_stack([np.ones(len(kept), np.int64), size, *(np.bincount(v, minlength=len(kept)) for v in (of[ga], of[gb], of)), np.zeros(len(kept), np.int64)])
            short = size <= self.chunk_bytes  # texts with longer units are cut in chunks and need their tokens only
            if short.all():
                text = _groups_text(a_ids, ga, b_ids, gb, len(common), at).split("\n")
                pair, group = _pairs(a_ids, ga, b_ids, gb, len(common))
                owner, pair, m = _counted(of[group], pair, np.ones(len(pair), np.int64))
                figures[:, 5] = np.bincount(owner, minlength=len(kept))
                self.pair, self.times = np.concatenate([self.pair, pair]), np.concatenate([self.times, m.astype(np.int32)])
                self._number(kept, text, figures, a_ids, b_ids)
            else:
                long = ~short
                self._number([u for u, s in zip(kept, long.tolist()) if s], [""] * int(long.sum()), figures[long], a_ids[long[of[ga]]], b_ids[long[of[gb]]])
                self._add([[u] for u, s in zip(kept, short.tolist()) if s], last)
        if last and again:
            self._number(again, [""] * len(again), np.zeros((len(again), 6), np.int64), a_ids[:0], b_ids[:0])
            return []
        return again

    def _number(self, units: list[str], text: list[str], figures: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> None:
        self.number.update(zip(units, range(len(self.text), len(self.text) + len(units))))
        self.text += text
        self.figures = np.concatenate([self.figures, figures])
        self.a_ids, self.b_ids = np.concatenate([self.a_ids, a_ids.astype(np.int32)]), np.concatenate([self.b_ids, b_ids.astype(np.int32)])

    def ids(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_take(v, self.start[unit, k], self.figures[unit, k]).astype(np.int64) for v, k in ((self.a_ids, 2), (self.b_ids, 3)))

    def links(self, doc: np.ndarray, unit: np.ndarray, docs: int) -> tuple[np.ndarray, ...]:
        """From (doc, unit) occurrences: links per doc, and A ids, B ids, multiplicities by doc and pair."""
        both, seen = np.unique(doc * len(self.text) + unit, return_counts=True)
        doc, unit = np.divmod(both, max(1, len(self.text)))
        start, size = self.start[unit, 5], self.figures[unit, 5]
        doc, pair, m = _counted(np.repeat(doc, size), _take(self.pair, start, size), _take(self.times, start, size) * np.repeat(seen, size))
        return np.bincount(doc, minlength=docs), pair >> 32, pair & 0xFFFFFFFF, m


@lru_cache(maxsize=1)
def _store(a_path: str, b_path: str, chunk_bytes: int) -> _Units:
    """The units of a worker process: a task finds what earlier ones met."""
    return _Units(a_path, b_path, chunk_bytes)


def _chunked(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    units = _store(a_path, b_path, chunk_bytes)
    a_len, b_len = _tokenizers(a_path, b_path)[4]
    for batch in (s for whole in batches for s in slices(whole, "text", SLICE_BYTES)):
        rows, ids, texts = (batch.column(i).to_pylist() for i in range(3))
        parts = [units.split(t) if t else [] for t in texts]
        count = np.array([len(p) for p in parts], np.int64)
        unit = units.numbers([u for p in parts for u in p])
        doc = np.repeat(np.arange(len(texts)), count)
        edge = np.concatenate([[0], np.cumsum(count)])
        total = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(units.figures[unit], axis=0)])
        total = total[edge[1:]] - total[edge[:-1]]
        good = (count > 0) & (total[:, 0] == count)  # a unit without tokens leaves its text without any
        single = good & (total[:, 1] <= chunk_bytes)
        # one chunk: the whole text is finished here; nothing of it is written but its result
        done = np.flatnonzero(~good | single)
        if len(done):
            mine = single[doc]
            size, a, b, m = units.links(doc[mine], unit[mine], len(texts))
            digest = [hashlib.sha256(";".join([units.text[u] for u in unit[edge[i] : edge[i + 1]].tolist()]).encode()).hexdigest() if single[i] else "" for i in done.tolist()]
            n_a, n_b, groups = (np.where(single, total[:, k], 0)[done] for k in (2, 3, 4))
            links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size[done])]).astype(np.int32)), _link_structs(a, b, m))
            n, empty = len(done), [[]] * len(done)
            out = dict(
                _row=[rows[i] for i in done], doc_id=[ids[i] for i in done], chunk=[0] * n, _n=[1] * n, cut=[False] * n, pa=empty, pb=empty, closed=[""] * n, sa=empty, sb=empty,
                n_a=n_a, n_b=n_b, n_groups=groups, groups_sha256=digest, links=links,
            )
            yield pa.RecordBatch.from_arrays([v if f.name == "links" else pa.array(v, f.type) for f, v in zip(_CHUNKED_ARROW, out.values())], schema=_CHUNKED_ARROW)
        for i in np.flatnonzero(good & ~single).tolist():
            a_ids, b_ids = units.ids(unit[edge[i] : edge[i + 1]])
            a_ends, b_ends = np.cumsum(a_len[a_ids]), np.cumsum(b_len[b_ids])
            n = int((int(a_ends[-1]) + chunk_bytes - 1) // chunk_bytes)
            edges = np.arange(1, n) * chunk_bytes
            # a token goes to the chunk that holds its last byte
            sa_, sb_ = np.searchsorted(a_ends, edges, "right"), np.searchsorted(b_ends, edges, "right")
            pieces = zip(np.split(a_ids, sa_), np.split(a_ends, sa_), np.split(b_ids, sb_), np.split(b_ends, sb_))
            rows_out = [dict(zip(_CHUNKED_ARROW.names, (rows[i], ids[i], k, n, *fragment(*p)))) for k, p in enumerate(pieces)]
            yield pa.RecordBatch.from_pylist(rows_out, schema=_CHUNKED_ARROW)


_LINKS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("m", pa.int64())]))
_CHUNKED_ARROW = pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("_n", pa.int64()), ("cut", pa.bool_()), ("pa", pa.list_(pa.int32())), ("pb", pa.list_(pa.int32())), ("closed", pa.string()), ("sa", pa.list_(pa.int32())), ("sb", pa.list_(pa.int32())), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("links", _LINKS)])
_FOLDED_ARROW = pa.schema(list(_CHUNKED_ARROW)[:10])
CHUNKED = FRAGMENT.replace("chunk long,", "chunk long, _n long,") + ", n_a long, n_b long, n_groups long, groups_sha256 string, links array<struct<a:int,b:int,m:long>>"


def _fold(table: pa.Table) -> pa.Table:
    """One level of the tree: the (at most two) fragments of (row, chunk // 2), in chunk order."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    done = None
    for r in rows:
        part = tuple(r[c] for c in ("cut", "pa", "pb", "closed", "sa", "sb"))
        done = part if done is None else compose(done, part)
    first = rows[0]
    out = (first["_row"], first["doc_id"], first["chunk"] // 2, (first["_n"] + 1) // 2, *done)
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(out, _FOLDED_ARROW)], schema=_FOLDED_ARROW)


def reduce_fragments(frags: DataFrame) -> DataFrame:
    """Compose the fragments of each row (``_n`` of them, chunks 0 to _n - 1) by a tree over chunk numbers:
    each level pairs chunk 2i with 2i + 1, so a row has ceil(_n / 2) fragments after it."""
    done = None
    open_ = frags
    while not open_.isEmpty():
        level = materialize(open_.groupBy("_row", F.floor(F.col("chunk") / 2).alias("_pair")).applyInArrow(_fold, FOLDED))
        ended = level.where("_n = 1").drop("_n")
        done = ended if done is None else done.unionByName(ended)
        open_ = level.where("_n > 1")
    return done if done is not None else frags.drop("_n")


def summary(frag: tuple) -> tuple:
    """From a row's single (whole) fragment: n_a, n_b, n_groups, groups_sha256 and its distinct linked pairs (A << 32 | B) with multiplicity."""
    cut, pa_, pb_, closed, sa, sb = frag
    texts = []
    if cut:
        texts.append(_group(pa_, pb_))
        if closed:
            texts.append(closed)
        if len(sa) or len(sb):
            texts.append(_group(sa, sb))
    text = ";".join(texts)
    # equal groups are read once: a text repeats few distinct groups many times
    seen = Counter(text.split(";")) if text else {}
    links: dict[int, int] = defaultdict(int)
    n_a = n_b = 0
    for g, times in seen.items():
        left, right = g.split("|")
        ga, gb = [int(x) << 32 for x in left.split(",") if x], [int(x) for x in right.split(",") if x]
        n_a += times * len(ga)
        n_b += times * len(gb)
        for x in ga:
            for y in gb:
                links[x | y] += times
    digest = hashlib.sha256(text.encode()).hexdigest() if texts else ""
    return n_a, n_b, sum(seen.values()), digest, links


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = batch.to_pydict()
        done = [summary((d["cut"][i], d["pa"][i], d["pb"][i], d["closed"][i], d["sa"][i], d["sb"][i])) for i in range(batch.num_rows)]
        edge = np.cumsum([0, *(len(r[4]) for r in done)])
        pair, m = (np.fromiter(chain.from_iterable(v), np.int64, int(edge[-1])) for v in ((r[4] for r in done), (r[4].values() for r in done)))
        links = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), _link_structs(pair >> 32, pair & 0xFFFFFFFF, m))
        plain = [pa.array([r[k] for r in done], _FINISHED.field(k + 2).type) for k in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array(d["_row"], pa.int64()), pa.array(d["doc_id"], pa.int64()), *plain, links], schema=_FINISHED)


def _link_structs(a: np.ndarray, b: np.ndarray, m: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(m.astype(np.int64))], names=["a", "b", "m"])


_FINISHED = pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("m", pa.int64())])))])
FINISHED = "_row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<struct<a:int,b:int,m:long>>"


OUT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SCORED = "_row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long, rest array<struct<a:int,b:int,m:long>>"


def _flag_repeated(rows: DataFrame) -> DataFrame:
    """Add ``_again``: whether the row's doc_id may stand on other rows too (never false where it does)."""
    key = F.coalesce(F.xxhash64("doc_id"), F.lit(0))
    several = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(key.alias("_h"))
    return with_hit(rows, key, bitmap(several, "_h", ID_BITS), ID_BITS, "_again")


def _hot_rows(pairs: DataFrame) -> int:
    """The least power of two of rows that at most HOT_PAIRS pairs reach; each pair below stands on few of the rows."""
    sizes = {r["_p"]: r["count"] for r in pairs.groupBy(F.floor(F.log2("n_rows")).cast("int").alias("_p")).count().collect()}  # at most 64 rows
    held, power = 0, max(sizes, default=0) + 1
    while power and held + sizes.get(power - 1, 0) <= HOT_PAIRS:
        power -= 1
        held += sizes.get(power, 0)
    return 1 << power


def _look_up(known):
    """Sums over the links of broadcast pairs; the links of the other pairs are left in ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n_docs, is_best = known.value
        for batch in batches:
            names = batch.schema.names
            links = batch.column(names.index("links"))
            flat = links.flatten()
            a, b, m = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            size = links.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            edge = np.concatenate([[0], np.cumsum(size)])
            key = a << 32 | b
            at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            at = at[hit]

            def per_row(values: np.ndarray) -> np.ndarray:
                run_ = np.concatenate([[0], np.cumsum(values)])
                return run_[edge[1:]] - run_[edge[:-1]]

            best, total = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            best[hit], total[hit] = m[hit] * is_best[at], m[hit] * n_docs[at]
            left = np.concatenate([[0], np.cumsum(per_row((~hit).astype(np.int64)))])
            rest = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), flat.filter(pa.array(~hit)))
            columns = [batch.column(names.index(c)) for c in ("_row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(per_row(m)), pa.array(per_row(best)), pa.array(per_row(total)), rest], ["_row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum", "rest"])

    return run


def alignment(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id bigint, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Rows without tokens (null, empty, or bytes that do not join back to " " + text) have all counts 0 and
    groups_sha256 ''. Pair counts count distinct doc_id values; repeated rows get equal rows. Empty input:
    empty output.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunked = materialize(rows.mapInArrow(lambda it: _chunked(it, a_path, b_path, chunk_bytes), CHUNKED))
    whole = chunked.where("_n = 1").select("_row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    parts = chunked.where("_n > 1").select(*[c.split()[0] for c in FOLDED.split(", ")])
    finished = whole.unionByName(materialize(reduce_fragments(parts).mapInArrow(_finish, FINISHED)))
    finished = _flag_repeated(finished)
    links = finished.select("doc_id", "_again", F.explode("links").alias("l")).select("doc_id", "_again", "l.a", "l.b")
    # a doc_id on one row holds a pair once; the others are made distinct first
    once = links.where("NOT _again").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"), F.count(F.lit(1)).alias("n_rows"))
    again = links.where("_again").groupBy("doc_id", "a", "b").agg(F.count(F.lit(1)).alias("_n")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("_n").alias("n_rows"))
    counts = materialize(once.unionByName(again).groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_rows").alias("n_rows")))
    best = counts.groupBy("a").agg(F.max("n_docs").alias("best"))
    pairs = materialize(counts.join(best, "a").select("a", "b", "n_docs", "n_rows", (F.col("n_docs") == F.col("best")).alias("is_best")))
    least = _hot_rows(pairs)
    hot = pairs.where(F.col("n_rows") >= least).select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("k"), "n_docs", F.col("is_best").cast("long")).toArrow().sort_by("k")  # at most HOT_PAIRS rows
    known = spark.sparkContext.broadcast(tuple(c.to_numpy() for c in hot.columns))
    scored = finished.drop("_again").mapInArrow(_look_up(known), SCORED)
    if least <= 1:
        return scored.select(*OUT)
    scored = materialize(scored)
    rare = scored.select("_row", F.explode("rest").alias("l")).select("_row", "l.a", "l.b", "l.m").join(pairs.where(F.col("n_rows") < least), ["a", "b"])
    per_row = rare.groupBy("_row").agg(F.sum(F.when(F.col("is_best"), F.col("m")).otherwise(0)).alias("_best"), F.sum(F.col("m") * F.col("n_docs")).alias("_sum"))
    added = scored.drop("rest").join(per_row, "_row", "left")
    added = added.withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("_sum", F.lit(0)))
    return added.select(*[F.col(c).cast("long").alias(c) if c != "groups_sha256" else F.col(c) for c in OUT])
