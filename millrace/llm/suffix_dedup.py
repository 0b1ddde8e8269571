"""Removal of byte strings that already stand in a document with a smaller doc_id, by sampled suffixes in buckets.

Of all suffixes only those at anchors are sorted: of the ``GRAM``-byte strings within each window of ``length`` bytes the
one of least hash (the last of equal ones). Equal windows have their anchor at the same place, so equal windows lie in
the same bucket of anchors, wherever they stand. Windows in a row with one anchor are a run.

1. Documents are laid down in chunks of about ``chunk_bytes``, in a table bucketed by chunk, so that later passes meet
   what concerns a chunk without moving texts again. A chunk lists its distinct runs, by anchor and content, with the
   smallest doc_id of each.
2. Initial buckets: the lists are dealt by anchor. A run whose content has a smaller doc_id elsewhere is removed whole.
   A bucket with several contents from several documents has to be refined.
3. Bucket-pointer refinement: of each such content one copy is sent, dealt by anchor. Its suffixes start out in buckets
   of 8 bytes and are refined by sorting on (own bucket, bucket at a later offset): 16 bytes by offset 8, 32 by 16, the
   full length by the rest. A pointer updated for one suffix serves all that look at it from before, and a suffix alone
   in its bucket is done. Equal final buckets are equal windows; each window learns its smallest doc_id.
4. Verdicts go back to the chunks as bits, and each document's windows are put together.

Strings are judged on the input. Texts count as UTF-8 bytes, null as empty. A null doc_id ranks above all others; rows
with the same doc_id don't remove from each other. Texts below the length keep everything. Documents of any size are
worked through in pieces of bounded memory.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import as_table, dealt, only, release, scratch, squeezed, tidy, unsqueezed, written
from millrace.llm.shingles import buffer_of, mix, powers

LENGTH = 50
GRAM = 24
PIECE = 512 << 10
LAST = np.iinfo(np.int64).max


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, piece: int = PIECE) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: row, first and last start, hash of the anchor and of the content."""
    found = []
    for at in range(0, max(1, len(data)), piece):
        end = min(len(data), at + piece + length - 1)
        if end - at >= length:
            inner = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, end, "left")] - at
            found.append([x + shift for x, shift in zip(_runs(data[at:end], inner, length, gram), (at, at, np.uint64(0), np.uint64(0)))])
    if not found:
        first, last, anchor, content = (np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    else:
        first, last, anchor, content = (np.concatenate(x) for x in zip(*found))
    return {"row": np.searchsorted(offsets, first, "right") - 1, "first": first, "last": last, "anchor": anchor, "content": content}


def _runs(data: np.ndarray, breaks: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Likewise for one piece; breaks: where rows begin inside it."""
    n = len(data)
    up, down = powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    low = np.uint64(0xFFFFFFFF)
    least = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: have - width], least[width - have :])
    anchor = (low - (least & low)).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int32)  # windows across a break
    np.add.at(inside, np.clip(breaks - length + 1, 0, len(anchor)), 1)
    np.add.at(inside, np.clip(breaks, 0, len(anchor)), -1)
    across = np.cumsum(inside[:-1]) > 0
    cut = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (across[1:] != across[:-1])])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(anchor)) - 1
    keep = ~across[first]
    first, last = first[keep], last[keep]
    at = anchor[first]
    content = mix((sums[last + length] - sums[first]) * down[first] + mix((at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)))
    # anchors have small hashes, being the least of many: mixed again, they deal out evenly
    return first, last, mix(grams[at] ^ np.uint64(0xA0761D6478BD642F)), content


def renamed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of keys in sorted order, and which keys share theirs."""
    _, bucket, size = np.unique(keys, return_inverse=True, return_counts=True)
    return bucket, size[bucket] > 1


def refined(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket numbers of the windows at the given starts: equal for equal windows, by bucket-pointer refinement.

    Every suffix that a window at one of the starts can look at (up to length bytes on) gets a pointer.
    """
    depth = 8 if length >= 8 else 1
    n = len(data) - depth + 1
    if n <= 0 or not len(starts):
        return np.zeros(len(starts), np.int64)
    keys = np.zeros(n, np.uint64)
    for k in range(depth):
        keys = keys << np.uint64(8) | data[k : k + n]
    pointer, shared = renamed(keys)
    while depth < length:
        step = min(depth, length - depth)
        alone = ~shared
        active = np.flatnonzero(shared)
        short = active[active >= n - step]  # too near the end: no window looks at them
        active = active[active < n - step]
        bucket, still = renamed(pointer[active].astype(np.uint64) << np.uint64(32) | pointer[active + step].astype(np.uint64))
        base = int(np.count_nonzero(alone))
        pointer[alone] = np.arange(base)
        pointer[active] = base + bucket
        pointer[short] = base + len(active) + np.arange(len(short))
        shared = np.zeros(n, bool)
        shared[active] = still
        depth += step
    return pointer[starts]


class Chunk:
    """The distinct runs of a chunk, in order of anchor and content."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        ids = table.column("doc_id").combine_chunks().cast(pa.int64()).fill_null(LAST).to_numpy()
        data, offsets = buffer_of(table.column("text").combine_chunks())
        digest = np.array([int.from_bytes(hashlib.blake2b(data[a:b], digest_size=8).digest(), "big") for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
        order = np.lexsort((digest, ids))
        self.table = table.take(pa.array(order))
        del table, data, offsets
        self.ids = ids[order]
        self.data, self.offsets = buffer_of(self.table.column("text").combine_chunks())
        self.runs = runs(self.data, self.offsets)
        r = self.runs
        # rows are in order of doc_id, runs in order of rows: a stable sort leaves the smallest doc_id first
        self.order = np.lexsort((r["content"], r["anchor"]))
        a, c = r["anchor"][self.order], r["content"][self.order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])]) if len(a) else np.empty(0, bool)
        self.entry = np.cumsum(new) - 1  # of each run in order
        self.lead = self.order[new]  # the first run of each entry
        self.anchor, self.content = a[new], c[new]
        self.owner = self.ids[r["row"][self.lead]]

    def slices(self, parts: int) -> Iterator[tuple[int, int, int]]:
        """Part, first and last entry of it."""
        if len(self.anchor):
            part = dealt(self.anchor, parts)
            ends = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            for start, end in zip(ends, np.append(ends[1:], len(part))):
                yield int(part[start]), int(start), int(end)


LISTED = "part int, chunk long, n int, runs binary, owners binary"
VERDICT = "chunk long, level int, part int, bits binary"
SENT = "part int, chunk long, n int, heads binary, bytes binary"
#: A part's anchors are dealt to so many shelves, and shelves worked through until they hold so many bytes.
SHELVES, SHELF_BYTES = 256, 1 << 20
#: Verdicts on a run: nothing known, its content is in a smaller document, to be refined.
OPEN, REMOVED, REFINE = 0, 1, 2


def listed(parts: int):
    def run(table: pa.Table) -> pa.Table:
        chunk, number, rows = Chunk(table), table.column("chunk")[0].as_py(), []
        for part, start, end in chunk.slices(parts):
            owners, index = np.unique(chunk.owner[start:end], return_inverse=True)
            content = np.ascontiguousarray(chunk.content[start:end].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
            rows.append((part, number, end - start, squeezed(chunk.anchor[start:end], content, index.astype("<u4")), squeezed(owners)))
        del chunk
        release()
        return as_table(rows, LISTED)

    return run


def judged(table: pa.Table) -> pa.Table:
    """Verdicts on the listed runs of one part."""
    rows = table.sort_by("chunk").to_pylist()
    anchors, contents, owners = [], [], []
    for r in rows:
        n = r["n"]
        anchor, content, index = unsqueezed(r["runs"], n, "u8", "V6", "<u4")
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = content.view(np.uint8).reshape(n, 6)
        anchors.append(anchor)
        contents.append(wide.reshape(-1).view("<u8"))
        count = int(index.max()) + 1
        owners.append(unsqueezed(r["owners"], count, "i8")[0][index])
    ends = np.cumsum([0, *map(len, anchors)])
    anchor, content, owner = (np.concatenate(x) for x in (anchors, contents, owners))
    order = np.lexsort((owner, content, anchor))
    a, c, o = anchor[order], content[order], owner[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new_run = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    run = np.cumsum(new_run) - 1
    least = o[new_run]  # of each content
    starts = np.flatnonzero(new_anchor[new_run])
    bucket = np.cumsum(new_anchor) - 1
    several = np.minimum.reduceat(least, starts) != np.maximum.reduceat(least, starts)
    verdict = np.where(o > least[run], REMOVED, np.where(new_run & several[bucket], REFINE, OPEN)).astype(np.uint8)
    # copies with the same smallest doc_id (rows that repeat it) are refined one by one
    verdict[(verdict == OPEN) & several[bucket]] = REFINE
    del anchors, contents, owners, anchor, content, a, c
    release()
    out = np.empty(len(order), np.uint8)
    out[order] = verdict
    return as_table([(r["chunk"], 1, r["part"], squeezed(out[s:e])) for r, s, e in zip(rows, ends, ends[1:]) if out[s:e].any()], VERDICT)


def verdicts(chunk: Chunk, table: pa.Table, parts: int) -> np.ndarray:
    found = {r["part"]: r["bits"] for r in table.to_pylist() if r["level"] == 1}
    out = np.zeros(len(chunk.anchor), np.uint8)
    for part, start, end in chunk.slices(parts):
        if part in found:
            out[start:end] = unsqueezed(found[part], end - start, "u1")[0]
    return out


def sent(parts: int):
    """One copy of each content that has to be refined, dealt by anchor."""

    def run(texts: pa.Table, bits: pa.Table) -> pa.Table:
        if not texts.num_rows or not bits.num_rows:
            return as_table([], SENT)
        chunk, number, rows = Chunk(texts), texts.column("chunk")[0].as_py(), []
        shelf = (dealt(chunk.anchor, parts * SHELVES) % SHELVES).astype(np.uint8)
        verdict = verdicts(chunk, bits, parts)
        for part, start, end in chunk.slices(parts):
            pick = np.flatnonzero(verdict[start:end] == REFINE) + start
            if len(pick):
                lead = chunk.lead[pick]
                first, size = chunk.runs["first"][lead], (chunk.runs["last"][lead] - chunk.runs["first"][lead] + LENGTH).astype("<u2")
                at = np.repeat(first - np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)]), size) + np.arange(int(size.sum()))
                rows.append((part, number, len(pick), squeezed(size, shelf[pick], chunk.owner[pick]), pa.compress(chunk.data[at].tobytes(), codec="zstd", asbytes=True)))
        del chunk
        release()
        return as_table(rows, SENT)

    return run


def settled(table: pa.Table) -> pa.Table:
    """Bits for the windows of the contents of one part: which are in a smaller document.

    Buckets of an anchor lie on one shelf, so a few shelves at a time are refined on their own.
    """
    rows = table.sort_by("chunk").to_pylist()
    heads = [unsqueezed(r["heads"], r["n"], "<u2", "u1", "i8") for r in rows]
    size, shelf, owner = (np.concatenate(x) for x in zip(*heads))
    size = size.astype(np.int64)
    data = np.frombuffer(b"".join(pa.decompress(r["bytes"], int(h[0].sum(dtype=np.int64)), codec="zstd", asbytes=True) for r, h in zip(rows, heads)), np.uint8)
    keys, ends = [(r["chunk"], r["part"]) for r in rows], np.cumsum([0, *(r["n"] for r in rows)])
    del rows, heads, table
    begin = np.cumsum(size) - size
    held = np.cumsum(np.bincount(shelf, size, minlength=SHELVES).astype(np.int64))
    mask = np.zeros(len(size), "<u4")
    low = 0
    while low < SHELVES:
        before = held[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(held, before + SHELF_BYTES, "right")))
        pick = np.flatnonzero((shelf >= low) & (shelf < high))
        low = high
        if len(pick):
            own = size[pick]
            first = np.cumsum(own) - own
            at = np.repeat(begin[pick] - first, own) + np.arange(int(own.sum()))
            mask[pick] = smaller_elsewhere(data[at], first, own, owner[pick])
    del data
    release()
    return as_table([(chunk, 2, part, squeezed(mask[s:e])) for (chunk, part), s, e in zip(keys, ends, ends[1:])], VERDICT)


def smaller_elsewhere(data: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For contents laid end to end, a bit for each of their windows: whether a content with a smaller owner has it."""
    windows = size - LENGTH + 1
    mine = np.repeat(np.arange(len(size)), windows)
    place = np.arange(len(mine)) - np.repeat(np.cumsum(windows) - windows, windows)
    bucket = refined(data, begin[mine] + place)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0]))
    least = np.minimum.reduceat(owner[mine[order]], starts)
    smallest = np.empty(len(bucket), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    return np.bincount(mine, np.where(owner[mine] > smallest, 1 << place, 0), minlength=len(size)).astype("<u4")


def removed(chunk: Chunk, bits: pa.Table, parts: int) -> np.ndarray:
    """Whether each byte of the chunk goes."""
    verdict = verdicts(chunk, bits, parts)
    masks = {r["part"]: r["bits"] for r in bits.to_pylist() if r["level"] == 2}
    mask = np.zeros(len(verdict), np.uint32)
    for part, start, end in chunk.slices(parts):
        pick = np.flatnonzero(verdict[start:end] == REFINE) + start
        if len(pick) and part in masks:
            mask[pick] = unsqueezed(masks[part], len(pick), "<u4")[0]
    r, order, entry = chunk.runs, chunk.order, chunk.entry
    whole = (chunk.ids[r["row"][order]] > chunk.owner[entry]) | (verdict[entry] == REMOVED)
    gone = np.zeros(len(chunk.data) + 1, np.int32)
    first, last = r["first"][order], r["last"][order]
    np.add.at(gone, first[whole], 1)
    np.add.at(gone, last[whole] + LENGTH, -1)
    some = ~whole & (mask[entry] > 0)
    for k in range(LENGTH - GRAM + 1):
        hit = first[some][(mask[entry[some]] >> np.uint32(k) & np.uint32(1)) == 1] + k
        np.add.at(gone, hit, 1)
        np.add.at(gone, hit + LENGTH, -1)
    return np.cumsum(gone[:-1]) > 0


RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])


def finished(parts: int, names: list[str], cut: bool):
    """The rows of a chunk with what was found out, or (cut) with what stays as their text."""

    def run(texts: pa.Table, bits: pa.Table) -> pa.Table:
        if not texts.num_rows:
            extra = [] if cut else zip(RESULT.names, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))
            return pa.table({**{n: pa.array([], texts.schema.field(n).type) for n in names}, **{n: pa.array([], t) for n, t in extra}})
        chunk = Chunk(texts)
        gone = removed(chunk, bits, parts)
        out, columns = chunk.table.select(names), ([], [], [], [])
        texts = chunk.table.column("text").combine_chunks()
        for k, (a, b) in enumerate(zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist())):
            own = gone[a:b]
            count = int(own.sum())
            kept = chunk.data[a:b][~own].tobytes() if count or not cut else None
            for column, value in zip(columns, (b - a, count, int(np.count_nonzero(own[1:] & ~own[:-1])) + int(len(own) > 0 and own[0]), kept)):
                column.append(value)
        if cut:
            fresh = pa.array([texts[k].as_py() if kept is None else kept.decode("utf-8", "ignore") for k, kept in enumerate(columns[3])], texts.type)
            out = out.set_column(out.schema.get_field_index("text"), "text", fresh)
        else:
            for name, column, kind in zip(RESULT.names, columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary())):
                out = out.append_column(name, pa.array(column, kind))
        del chunk, gone, columns
        release()
        return out

    return run


def laid_down(df: DataFrame, chunk_bytes: int) -> tuple[DataFrame, int]:
    """df in chunks, as a table bucketed by chunk, and the number of parts that anchors are dealt to."""
    schema = T.StructType([T.StructField("chunk", T.LongType()), *df.schema.fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        own, room = 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            chunks = []
            for size in sizes:
                if room < size or not own:
                    own, room = int.from_bytes(os.urandom(8), "big") >> 1, chunk_bytes
                room -= size
                chunks.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), *batch.columns], schema.names)

    spark = df.sparkSession
    total = only(df, "text").agg(F.sum(F.octet_length("text")).alias("x")).first()["x"] or 0
    parts = max(12, -(-total // (8 << 20)))
    name = f"millrace_{uuid.uuid4().hex}"
    df.mapInArrow(tidy(number), schema).write.option("path", scratch(spark, "chunks")).bucketBy(min(parts, 100_000), "chunk").saveAsTable(name)
    chunks = spark.table(name)
    # the catalogue is needed for the buckets only; the frame keeps them, and an external table's files stay
    spark.sql(f"DROP TABLE {name}")
    return chunks, int(parts)


def deduplicated(df: DataFrame, chunk_bytes: int = 2 << 20, cut: bool = False) -> DataFrame:
    """df (with doc_id and text) with n_bytes, n_removed, n_spans and kept, the bytes that stay; or (cut) df with what stays as its text."""
    names = df.columns
    inner = df.toDF(*[n if n in ("doc_id", "text") else f"_{k}" for k, n in enumerate(names)])
    texts, parts = laid_down(inner, chunk_bytes)
    grouped = texts.groupBy("chunk")
    pairs = texts.select("chunk", "doc_id", "text").groupBy("chunk")
    first = written(pairs.applyInArrow(listed(parts), LISTED).groupBy("part").applyInArrow(judged, VERDICT), "verdicts")
    copies = pairs.cogroup(first.groupBy("chunk")).applyInArrow(sent(parts), SENT)
    second = written(copies.groupBy("part").applyInArrow(settled, VERDICT), "verdicts")
    extra = [] if cut else RESULT.fields
    out = grouped.cogroup(first.union(second).groupBy("chunk")).applyInArrow(finished(parts, inner.columns, cut), T.StructType([*inner.schema.fields, *extra]))
    return out.toDF(*names, *(f.name for f in extra))


def summary(documents: DataFrame) -> DataFrame:
    """For each document its bytes, those removed, in how many spans, and the digest of what stays."""
    out = deduplicated(only(documents, "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def cleaned(documents: DataFrame) -> DataFrame:
    """The documents with what stays as their text (characters cut apart by a removal go), n_chars following it."""
    text = deduplicated(documents, cut=True)
    return text.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else text
