"""Repeated passages: maximal repeats of at least ``SIZE`` bytes from enhanced suffix arrays.

No task can hold a suffix array of the whole corpus, so strings that may be equal are brought
together first. Of every ``SIZE - GRAM + 1`` consecutive grams of ``GRAM`` bytes the one of least
hash is an anchor (winnowing): equal strings of ``SIZE`` bytes contain an anchor of equal hash. An
anchor's context is all that a string of ``SIZE`` bytes with that anchor can cover.

1. anchors meet by hash, with a hash of their context; those that occur once leave
2. an occurrence that is not the first of its context repeats that whole context: it is marked
3. where an anchor has several contexts, the first occurrence of each goes into a suffix array with
   the array of common prefixes; a stack scan walks the tree of common-prefix intervals and gives
   each interval of ``SIZE`` bytes or more whose occurrences differ in the byte before them (or
   begin a context), that is, each maximal repeat with all its occurrences; all but the first
   occurrence are marked
4. marks meet the texts, and the bytes they cover go

An anchor so common that its contexts would burden one task (``HOT``, estimated on a hash sample of
the documents) is replaced by all strings of ``SIZE`` bytes around it, each its own context: these
spread over all tasks and need no suffix array. Nothing is dropped or capped.

Order: by document id (null last), then hash of the text, then place. Rows equal in id and text are
one document and get the same result. Null texts are empty; a text shorter than ``SIZE`` keeps all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimsmith.llm.common import chunked, mixed, narrowed

SIZE, GRAM = 100, 32
AROUND = SIZE - GRAM
#: Bytes worked on at once, contexts in one suffix array (or one anchor's), and contexts too many for one.
PIECE, ARRAY, HOT = 1 << 18, 1_000, 20_000
#: Suffixes compared, and texts taken apart, at once.
COMPARED, TEXTS = 1 << 15, 500
#: One document in so many is looked at for hot anchors.
SAMPLE = 50
INDEX = np.uint64((1 << 22) - 1)
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15
MARK = "th int, start int, stop int"

Settle = Callable[[DataFrame], DataFrame]
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + (PIECE >> 2))
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate(([np.uint64(1)], np.full(size - 1, np.uint64(b), np.uint64))).cumprod(dtype=np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(0)], ((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0]).cumsum(dtype=np.uint64)))


def hashes(sums: np.ndarray, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
    """Hashes of the strings between two places, equal wherever the strings lie."""
    with np.errstate(over="ignore"):
        return mixed((sums[stop] - sums[start]) * powers(len(sums))[1][start])


def windows_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, NEVER, np.uint64)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def thinned(places: np.ndarray, grams: np.ndarray, width: int) -> np.ndarray:
    """Which anchors to keep: in a run of equal ones, as many as leave no gap wider than ``width``."""
    keep = np.ones(len(places), bool)
    same = grams[1:] == grams[:-1]
    for i in np.flatnonzero(same[1:] & same[:-1]) + 1:
        last = i - 1
        while not keep[last]:
            last -= 1
        keep[i] = places[i + 1] - places[last] > width
    return keep


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of texts that lie one after the other, and the prefix sums."""
    sums = prefix_sums(data)
    width = AROUND + 1
    if len(data) < SIZE:
        return np.empty(0, np.int64), np.empty(0, np.uint64), sums
    grams = hashes(sums, slice(0, len(data) - GRAM + 1), slice(GRAM, len(data) + 1))
    value = (grams & ~INDEX) | np.arange(len(grams), dtype=np.uint64)
    for end in ends[:-1]:  # grams across two texts are none
        value[max(0, end - GRAM + 1) : end] = NEVER
    least = windows_least(value, width)
    least = least[np.concatenate(([True], least[1:] != least[:-1]))]
    places = (least[least != NEVER] & INDEX).astype(np.int64)
    keep = thinned(places, grams[places], width)
    return places[keep], grams[places[keep]], sums


def text_hash(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) % (1 << 31)


def contexts(batch_texts: list[bytes], hot: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Index of the text, anchor, context hash, start and stop of the contexts of SIZE bytes or more."""
    long = [i for i, raw in enumerate(batch_texts) if len(raw) >= SIZE]
    pieces = []  # text, offset, bytes: long texts in overlapping pieces
    for i in long:
        raw, at = batch_texts[i], 0
        while True:
            pieces.append((i, at, raw[at : at + PIECE]))
            if at + PIECE >= len(raw):
                break
            at += PIECE - 2 * SIZE
    for a, b in chunked((len(p[2]) for p in pieces), PIECE):
        own = pieces[a:b]
        data = np.frombuffer(b"".join(p[2] for p in own), np.uint8)
        sizes = np.array([len(p[2]) for p in own])
        ends = sizes.cumsum()
        places, grams, sums = anchors(data, ends)
        which = np.searchsorted(ends, places, side="right")
        low, high = (ends - sizes)[which], ends[which]
        start, stop = np.maximum(low, places - AROUND), np.minimum(high, places + SIZE)
        keep = stop - start >= SIZE
        common = np.isin(grams, hot) & keep
        keep &= ~common
        found = [(which[keep], grams[keep], start[keep], stop[keep], False)]
        if common.any():
            counts = (stop - start)[common] - SIZE + 1
            first = np.repeat(start[common], counts) + np.concatenate([np.arange(c) for c in counts])
            first, at = np.unique(first, return_index=True)
            found.append((np.repeat(which[common], counts)[at], None, first, first + SIZE, True))
        for w, g, s, e, single in (f for f in found if len(f[0])):
            own_hash = hashes(sums, s, e) ^ (e - s).astype(np.uint64)
            shift = np.array([p[1] for p in own])[w] - (ends - sizes)[w]
            yield np.array([p[0] for p in own])[w], own_hash if single else g, own_hash, s + shift, e + shift


def anchored(documents: DataFrame, hot: np.ndarray) -> DataFrame:
    """(anchor, context, doc_id, th, start, stop, copy). ``copy``: the context came earlier in the same batch.

    Such copies need not meet anything: they carry a key of their own, so that copies of a passage spread.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raws = [(t or "").encode() for t in batch["text"]]
            th = np.array([text_hash(r) for r in raws], np.int32)
            ids = batch["doc_id"].array
            blank = np.asarray(pd.isna(ids))
            keys = [blank, pd.Series(ids).rank(method="dense", na_option="bottom").to_numpy(), th]
            place = pd.MultiIndex.from_arrays(keys).factorize(sort=True)[0]
            for text, anchor, context, start, stop in contexts(raws, hot):
                # the first of each context in this batch, by document and place
                order = np.lexsort((start, place[text], context, anchor))
                a, c = anchor[order], context[order]
                fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))
                first = order[np.flatnonzero(fresh)[fresh.cumsum() - 1]]
                copy = np.empty(len(order), bool)
                copy[order] = (place[text[order]] != place[text[first]]) | (start[order] != start[first])
                once = np.ones(len(order), bool)
                once[order] = fresh | copy[order]  # rows that occur twice are one occurrence
                text, anchor, context, start, stop, copy = (x[once] for x in (text, anchor, context, start, stop, copy))
                with np.errstate(over="ignore"):
                    spread = mixed(place[text].astype(np.uint64) * np.uint64(BASE) + start.astype(np.uint64) + context)
                yield pd.DataFrame(
                    {
                        "anchor": np.where(copy, spread, anchor).view(np.int64),
                        "context": context.view(np.int64),
                        "doc_id": pd.Series(ids).iloc[text].array,
                        "th": th[text],
                        "start": start.astype(np.int32),
                        "stop": stop.astype(np.int32),
                        "copy": copy,
                    }
                )

    return documents.mapInPandas(work, f"anchor long, context long, doc_id {kind}, {MARK}, copy boolean")


def hot_anchors(documents: DataFrame, limit: int, sample: int) -> np.ndarray:
    """Anchors that a hash sample of the documents expects in ``limit`` places or more.

    Only the way of working depends on them, never a result. At most sampled anchors * sample / limit.
    """
    few = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
    counted = anchored(few, np.empty(0, np.uint64)).where(~F.col("copy")).groupBy("anchor").agg(F.count("*").alias("n"))
    return np.array([r.anchor for r in counted.where(F.col("n") * sample >= limit).select("anchor").collect()], np.int64).view(np.uint64)


def suffixes(texts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """Enhanced suffix array of the suffixes that begin a repeated string of ``size`` bytes.

    Returns text, offset and remaining length of each suffix in sorted order, the common prefix with
    the next one, and the byte before (-1 at a text's beginning, which counts as unlike any other).
    """
    sizes = np.array([len(t) for t in texts])
    width = int(sizes.max())
    flat = np.frombuffer(b"".join(t.ljust(2 * width, b"\0") for t in texts), np.uint8).reshape(len(texts), 2 * width)
    counts = np.maximum(sizes - size + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(counts.cumsum() - counts, counts)
    sums = prefix_sums(flat.ravel())
    at = text * 2 * width + offset
    own = hashes(sums, at, at + size)
    _, back, times = np.unique(own, return_inverse=True, return_counts=True)
    repeated = times[back] > 1
    text, offset, at = text[repeated], offset[repeated], at[repeated]
    rows = np.lib.stride_tricks.sliding_window_view(flat.ravel(), width)[at]
    order = np.ascontiguousarray(rows).view(f"S{width}").ravel().argsort(kind="stable") if len(rows) else np.empty(0, np.int64)
    text, offset = text[order], offset[order]
    rest = sizes[text] - offset
    common = np.empty(max(len(order) - 1, 0), np.int64)
    for a in range(0, len(common), COMPARED):
        some = rows[order[a : a + COMPARED + 1]]
        unlike = some[1:] != some[:-1]
        common[a : a + COMPARED] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    before = np.where(offset > 0, flat[text, np.maximum(offset - 1, 0)].astype(np.int64), -1)
    return text, offset, rest, common, before


def maximal_repeats(common: np.ndarray, before: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """Length, first and last + 1 of each common-prefix interval that is a maximal repeat.

    An interval is as long as it can be to the right; it is so to the left if the bytes before its
    occurrences differ, which each interval learns from its children and members as they close.
    """
    lengths = np.where(common >= size, common, 0).tolist() + [0]
    left = before.tolist()
    stack: list[list[int]] = []
    for i, length in enumerate(lengths[: len(left)], 1):
        first, seen = i - 1, left[i - 1]
        while stack and stack[-1][0] > length:
            own, first, mine = stack.pop()
            if mine != seen:
                seen = -1
            if seen == -1:
                yield own, first, i
        if length:
            if stack and stack[-1][0] == length:
                if stack[-1][2] != seen:
                    stack[-1][2] = -1
            else:
                stack.append([length, first, seen])


def repeat_marks(groups: DataFrame) -> DataFrame:
    """Marks of the repeats within each anchor's contexts (anchor, doc_id, th, start, bytes)."""
    kind = groups.schema["doc_id"].dataType.simpleString()

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        text, offset, _, common, before = suffixes(list(rows["bytes"]), SIZE)
        key = rows["doc_id"].rank(method="dense", na_option="bottom").to_numpy()
        document = pd.MultiIndex.from_arrays([key, rows["th"]]).factorize(sort=True)[0]
        start = rows["start"].to_numpy(np.int64)[text] + offset
        order = document[text].astype(np.int64) << 40 | start
        reach = np.zeros(len(text), np.int64)
        for length, first, last in maximal_repeats(common, before, SIZE):
            later = order[first:last] > order[first:last].min()
            own = reach[first:last]
            own[later] = np.maximum(own[later], length)
        held = reach > 0
        out = rows.iloc[text[held]][["doc_id", "th"]].copy()
        out["start"] = start[held].astype(np.int32)
        out["stop"] = (start + reach)[held].astype(np.int32)
        return out

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= ARRAY:
                rows = pd.concat(held, ignore_index=True)
                last = rows["anchor"].iloc[-1]
                done = (rows["anchor"] != last).to_numpy()
                cuts = np.flatnonzero(np.diff(rows["anchor"].to_numpy()[done])) + 1 if done.any() else np.empty(0, int)
                whole = rows[done]
                for a, b in chunked(np.diff(np.concatenate(([0], cuts, [len(whole)]))), ARRAY) if len(whole) else ():
                    edges = np.concatenate(([0], cuts, [len(whole)]))
                    yield solve(whole.iloc[edges[a] : edges[b]].reset_index(drop=True))
                held, count = [rows[~done]], int((~done).sum())
        if count:
            rows = pd.concat(held, ignore_index=True)
            edges = np.concatenate(([0], np.flatnonzero(np.diff(rows["anchor"].to_numpy())) + 1, [len(rows)]))
            for a, b in chunked(np.diff(edges), ARRAY):
                yield solve(rows.iloc[edges[a] : edges[b]].reset_index(drop=True))

    return groups.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(work, f"doc_id {kind}, {MARK}")


def packed(documents: DataFrame) -> DataFrame:
    """(doc_id, th, packed): compressed texts, so that they move at a third of their size."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            raws = [(t or "").encode() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "th": np.array([text_hash(r) for r in raws], np.int32), "packed": [packer.compress(r) for r in raws]})

    return documents.mapInPandas(pack, f"doc_id {kind}, th int, packed binary")


def in_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of at most ``TEXTS`` rows, so that no more texts than these are held unpacked."""
    for batch in batches:
        for a in range(0, len(batch), TEXTS):
            yield batch.iloc[a : a + TEXTS]


def _listed(texts: DataFrame, *fields: str) -> DataFrame:
    """The fields of the places as lists of numbers, which take a task's Python far less memory than rows."""
    return texts.select("doc_id", "th", "packed", *[F.col(f"places.{f}").alias(f) for f in fields])


def cut_contexts(wanted: DataFrame) -> DataFrame:
    """The bytes of contexts: from (doc_id, th, packed, places) to (anchor, doc_id, th, start, bytes)."""
    kind = wanted.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in in_slices(batches):
            rows = []
            ids = batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None)
            for doc_id, th, raw, *places in zip(ids, batch["th"], batch["packed"], batch["anchor"], batch["start"], batch["stop"]):
                raw = unpacker.decompress(raw)
                rows += [(anchor, doc_id, th, start, raw[start:stop]) for anchor, start, stop in zip(*places)]
            yield pd.DataFrame(rows, columns=["anchor", "doc_id", "th", "start", "bytes"])

    return _listed(wanted, "anchor", "start", "stop").mapInPandas(cut, f"anchor long, doc_id {kind}, th int, start int, bytes binary")


def removed(texts: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) from (doc_id, packed, places), places null if there are none."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(raw: bytes, start, stop) -> tuple[int, int, int, bytes]:
        if start is None or not len(start):
            return len(raw), 0, 0, raw
        edge = np.zeros(len(raw) + 1, np.int32)
        np.add.at(edge, start, 1)
        np.add.at(edge, stop, -1)
        gone = edge[:-1].cumsum() > 0
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        return len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in in_slices(batches):
            out = pd.DataFrame([cut(unpacker.decompress(raw), *places) for raw, *places in zip(batch["packed"], batch["start"], batch["stop"])], columns=["n_bytes", "n_removed", "n_spans", "kept"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return _listed(texts, "start", "stop").mapInPandas(work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def _with_places(documents: DataFrame, places: DataFrame, fields: tuple[str, ...], how: str) -> DataFrame:
    by_document = places.groupBy(F.col("doc_id").alias("its_id"), F.col("th").alias("its_th")).agg(F.collect_list(F.struct(*fields)).alias("places"))
    own = packed(documents)
    return own.join(by_document, own["doc_id"].eqNullSafe(F.col("its_id")) & (own["th"] == F.col("its_th")), how).select("doc_id", "th", "packed", "places")


def without_repeats(documents: DataFrame, settle: Settle, hot: int = HOT, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each document without the bytes that repeat earlier ones.

    ``settle`` writes the repeated anchors and the marks (places, no texts) once.
    """
    documents = narrowed(documents, "doc_id", "text")
    found = anchored(documents, hot_anchors(documents, hot, sample))
    order = [F.col("doc_id").asc_nulls_last(), "th", "start"]
    each, all_ = Window.partitionBy("anchor", "context").orderBy(*order), Window.partitionBy("anchor")
    met = found.withColumn("place", F.row_number().over(each)).withColumn("low", F.min("context").over(all_)).withColumn("high", F.max("context").over(all_))
    # equal ids, texts and places are one occurrence: rows that occur twice do not repeat each other
    first = F.first(F.struct("doc_id", "th", "start")).over(each.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = met.withColumn("again", F.col("copy") | ((F.col("place") > 1) & ~first.eqNullSafe(F.struct("doc_id", "th", "start"))))
    met = met.where(F.col("again") | (F.col("low") != F.col("high"))).select("anchor", "doc_id", "th", "start", "stop", "again", "place", "copy")
    met = settle(met)
    full = met.where("again").select("doc_id", "th", "start", "stop")
    wanted = met.where(~F.col("again") & (F.col("place") == 1) & ~F.col("copy"))
    groups = cut_contexts(_with_places(documents, wanted, ("anchor", "start", "stop"), "inner"))
    marks = settle(full.unionByName(repeat_marks(groups)))
    return removed(_with_places(documents, marks, ("start", "stop"), "left"))
