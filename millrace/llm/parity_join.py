"""Jaccard self-join of documents on word shingles by parity sketches, and the components of its links.

Two texts link when 100 * |A & B| >= percent * |A | B| for their sets of shingles. With sizes a and b that bounds the
symmetric difference by D = a + b - 2 * ceil(percent * (a + b) / (100 + percent)).

1. Each text becomes a node, the 128-bit digest of its set; equal sets are one node. A node has a parity sketch of 512
   bits, each shingle flipping one, so the Hamming distance of two sketches is at most their symmetric difference.
2. Sizes fall into bands by a factor of 1.4, and a size that can link into the next band joins there too. In a band the
   shingles are dealt by hash into D + 1 + e parts for the band's largest D; parts are XORed to 64-bit words. A pair
   that links has at least e + 1 equal parts. Each node leaves out up to e parts, those of no shingle first and then those
   of one, which say little, in order of their keys: of e + 1 equal parts the last in that order is kept by both.
3. Keys are dealt by hash, packed, and nodes that share one meet. The keys whose smallest node is the same make one
   cluster with all their nodes: two nodes with a key in common are in a cluster in common, and a node of a group of near
   copies is in a few clusters, while it has many keys. Clusters beyond ``block`` are cut into blocks, each pair of blocks
   being a cell, so no task holds more than two blocks. Sketches and sizes discard pairs that can't link. A cell of a few
   nodes gives the pairs of neighbours, a larger one for each node the nearest before it; of those each node keeps the
   nearest over all its cells.
4. Wider sketches, of twelve bits for each possible difference, discard most false pairs; the others are verified on the
   sets themselves, and links joined to components. Then the clusters with several components, now with wider sketches,
   give every pair across two components, which are verified as well: no link between components can be missed, and no
   pair inside a component needs to be looked at.

Null and empty texts and those without words have no shingles and link with nothing. Fewer words than the width are one
shingle. For ``joined``, rows with a null doc_id keep a null component and link nothing else, and rows that repeat a
doc_id are documents of their own with that id. ``one_of_each`` decides by row: of rows that are linked, whatever their
ids, one stays. Equal rows and ties change nothing, an empty table gives an empty one, and other columns, whatever their
names, are kept by ``one_of_each`` and left out by ``joined``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import as_table, components, dealt, dropped, only, release, sieve, sifted, squeezed, tidy, unsqueezed, written
from millrace.llm.shingles import mix, shingle_sets, slices

WIDTH, PERCENT = 5, 80
FACTOR = 1.4
FEW = 8
SKETCH = 512


def most_apart(total, percent: int):
    """The largest symmetric difference of linked sets whose sizes add up to total; negative if none link."""
    return total - 2 * -(-percent * total // (100 + percent))


def edges_of_bands() -> np.ndarray:
    """Lower ends of the size bands."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, int(ends[-1] * FACTOR)))
    return np.array(ends)


BANDS = edges_of_bands()


def plan(band: int, percent: int) -> tuple[int, int]:
    """Number of parts and spare parts of a band; no parts if only equal sets link there."""
    top = 2 * (int(BANDS[band + 1]) - 1)
    most = max(most_apart(s, percent) for s in range(max(2, top - 6), top + 1))
    spare = 1 + (most + 1) // 4
    return (most + 1 + spare, spare) if most > 0 else (0, 0)


def node_of(shingles: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        return np.array([mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64).tobytes()


def sketch_of(shingles: np.ndarray) -> bytes:
    bits = np.bincount((mix(shingles + np.uint64(0x632BE59BD9B4E019)) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def wide_of(shingles: np.ndarray, percent: int) -> bytes:
    """A parity sketch with at least twelve bits for each difference that linked sets of this size can have."""
    bits = 1 << max(9, int(12 * most_apart(2 * len(shingles), percent)).bit_length())
    flips = np.bincount((mix(shingles + np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def wide_apart(a: bytes, b: bytes) -> int:
    """Hamming distance; the longer sketch is folded to the length of the other."""
    if len(a) == len(b):
        return (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()
    x, y = folded([a, b])
    return int(np.bitwise_count(x ^ y).sum())


def words_of(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the parts that a node joins on."""
    n = len(shingles)
    own = int(np.searchsorted(BANDS, n, "right")) - 1
    out = []
    for band in (own, own + 1):
        if band > own and 100 * n < percent * int(BANDS[band]):
            continue
        parts, spare = plan(band, percent)
        if not parts:
            continue
        part = ((shingles >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # rises with the sorted hashes
        ends = np.searchsorted(part, np.arange(parts + 1))
        sizes = np.diff(ends)
        folded = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(mix(shingles + np.uint64(0x1D8E4E27C47D124F)))])
        words = folded[ends[1:]] ^ folded[ends[:-1]]
        keys = mix(mix(words) + mix(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)))
        left_out = min(spare, int(np.count_nonzero(sizes < 2)))
        out.append(keys[np.lexsort((keys, np.minimum(sizes, 2)))[left_out:]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, mark, node (null without shingles), n and sketches of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), width)
                columns = [pa.array([f(s) if len(s) else None for s in sets], pa.binary()) for f in (node_of, sketch_of, lambda s: wide_of(s, percent))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), pa.array(list(map(len, sets)), pa.int64()), *columns], ["doc_id", "mark", "n", "node", "sketch", "wide"])

    return docs.mapInArrow(tidy(run), "doc_id long, mark long, n long, node binary, sketch binary, wide binary")


KEYED = "part int, n int, nodes binary, keys binary"
MET = "cluster long, node binary"


def keyed(docs: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """The keys that texts join on, dealt by key: rows of many keys, each with the number of its node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies met by the same task add nothing
        for batch in batches:
            for part in slices(batch, "text"):
                keys, nodes = [], []
                for s in shingle_sets(part.column("text"), width):
                    if len(s) and (node := node_of(s)) not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        seen.add(node)
                        keys.append(words_of(s, percent))
                        nodes.append(node)
                if nodes:
                    flat, number = np.concatenate(keys), np.repeat(np.arange(len(nodes), dtype="<u4"), list(map(len, keys)))
                    order = np.argsort(flat)
                    flat, number = flat[order], number[order]
                    place = dealt(flat, parts)
                    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else []
                    rows = []
                    for start, end in zip(starts, np.append(starts[1:], len(place)) if len(place) else []):
                        used, index = np.unique(number[start:end], return_inverse=True)
                        rows.append((int(place[start]), int(end - start), b"".join(nodes[k] for k in used.tolist()), squeezed(flat[start:end], index.astype("<u4"))))
                    yield from as_table(rows, KEYED).to_batches()

    return docs.mapInArrow(tidy(run), KEYED)


def met(table: pa.Table) -> pa.Table:
    """Of one part, the nodes of keys that several nodes have, each with its clusters: the smallest nodes of its keys."""
    keys, nodes = [], []
    for row in table.to_pylist():
        key, index = unsqueezed(row["keys"], row["n"], "<u8", "<u4")
        keys.append(key)
        nodes.append(np.frombuffer(row["nodes"], "<u8").reshape(-1, 2)[index])
    key, node = np.concatenate(keys), np.concatenate(nodes)
    del keys, nodes, table
    order = np.lexsort((node[:, 1], node[:, 0], key))
    key, node = key[order], node[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    fresh = new | np.concatenate([[True], (node[1:] != node[:-1]).any(axis=1)])
    key, node = key[fresh], node[fresh]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(starts, len(key)))
    cluster, keep = np.repeat(node[starts, 0], size), np.repeat(size, size) > 1
    cluster, node = cluster[keep], node[keep]
    order = np.lexsort((node[:, 1], node[:, 0], cluster))
    cluster, node = cluster[order], node[order]
    if len(cluster):
        fresh = np.concatenate([[True], (cluster[1:] != cluster[:-1]) | (node[1:] != node[:-1]).any(axis=1)])
        cluster, node = cluster[fresh], np.ascontiguousarray(node[fresh])
    column = pa.Array.from_buffers(pa.binary(16), len(node), [None, pa.py_buffer(node.tobytes())]).cast(pa.binary())
    release()
    return pa.table({"cluster": pa.array(cluster.view(np.int64)), "node": column})


def apart(sketches: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64)


def may_link(n: np.ndarray, sketches: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs sizes and sketches leave, and their Hamming distances."""
    total = n[i] + n[j]
    near = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    distance = np.full(len(i), 1 << 30)
    if near.any():
        distance[near] = apart(sketches, i[near], j[near])
    return distance <= most_apart(total, percent), distance


def folded(raw: list[bytes]) -> np.ndarray:
    """Sketches folded to the length of the shortest: parities of parts add up."""
    least = min(map(len, raw)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, least), axis=0) for x in raw])


def compared(n: np.ndarray, sketches: np.ndarray, percent: int, label: np.ndarray | None, rows: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a cell that may link: all with different labels, or without labels for each row the nearest before it. Rows are taken in strips, so memory is bounded by a strip. The third array has their distances."""
    some, other, far = [], [], []
    columns = np.ascontiguousarray(sketches.T)
    for at in range(1, len(n), rows):
        j = np.arange(at, min(len(n), at + rows))
        if len(j) * len(n) * sketches.shape[1] < 1 << 19:
            distance = np.bitwise_count(sketches[j][:, None] ^ sketches[None, : j[-1]]).sum(axis=2, dtype=np.int32)
        else:
            distance = np.zeros((len(j), j[-1]), np.int32)
            for w in range(sketches.shape[1]):
                distance += np.bitwise_count(columns[w, j][:, None] ^ columns[w, None, : j[-1]])
        total = n[j][:, None] + n[None, : j[-1]]
        ok = (distance <= most_apart(total, percent)) & (np.arange(j[-1])[None, :] < j[:, None])
        ok &= 100 * np.minimum(n[j][:, None], n[None, : j[-1]]) >= percent * np.maximum(n[j][:, None], n[None, : j[-1]])
        if label is None:
            nearest = np.where(ok, distance, np.int32(1 << 30)).argmin(axis=1)
            hit = ok[np.arange(len(j)), nearest]
            some.append(nearest[hit])
            other.append(j[hit])
            far.append(distance[np.flatnonzero(hit), nearest[hit]])
        else:
            ok &= label[j][:, None] != label[None, : j[-1]]
            r, i = np.nonzero(ok)
            some.append(i)
            other.append(j[r])
            far.append(distance[r, i])
    return np.concatenate(some), np.concatenate(other), np.concatenate(far)


def pairs_of(rows: DataFrame, percent: int, across: bool) -> DataFrame:
    """Pairs (a, b) to verify from rows (cluster, cell, node, n, sketch, label) of cells. across: all pairs with different labels; else for each b the nearest a found in its cells."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            key = np.stack([batch.column(c).to_numpy() for c in ("cluster", "cell")])
            last = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if len(last):  # all but the last cell are complete
                table = pa.Table.from_batches(held).combine_chunks()
                end = table.num_rows - (batch.num_rows - 1 - int(last[-1])) if len(last) else 0
                if end:
                    yield from found(table.slice(0, end))
                    held = table.slice(end).to_batches()
        if held:
            yield from found(pa.Table.from_batches(held))

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        key, cell, n = (table.column(c).to_numpy() for c in ("cluster", "cell", "n"))
        nodes = table.column("node").to_pylist()
        raw = table.column("sketch").to_pylist()
        sketches = None if across else np.frombuffer(b"".join(raw), np.uint64).reshape(-1, SKETCH // 64)
        label = np.unique(np.array([x or b"" for x in table.column("label").to_pylist()], object), return_inverse=True)[1] if across else None
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
        lengths = np.diff(np.append(starts, len(key)))
        some, other, far = [], [], []
        row = np.arange(len(key))
        if not across:
            limit = np.repeat(np.where(lengths <= FEW, starts + lengths, 0), lengths)
            i = row[row + 1 < limit]
            ok, distance = may_link(n, sketches, i, i + 1, percent)
            some.append(i[ok])
            other.append(i[ok] + 1)
            far.append(distance[ok])
        for start, length in zip(starts.tolist(), lengths.tolist()):
            if length < 2 or length <= FEW and not across:
                continue
            if length <= FEW:  # pair by pair
                few = [(i, j) for i in range(start, start + length) for j in range(i + 1, start + length) if label[i] != label[j] and 100 * min(n[i], n[j]) >= percent * max(n[i], n[j])]
                few = [(i, j, d) for i, j in few if (d := wide_apart(raw[i], raw[j])) <= most_apart(int(n[i] + n[j]), percent)]
                if few:
                    x, y, d = (np.array(v) for v in zip(*few))
                    some.append(x)
                    other.append(y)
                    far.append(d)
                continue
            cell_rows = slice(start, start + length)
            i, j, d = compared(n[cell_rows], folded(raw[cell_rows]) if across else sketches[cell_rows], percent, label[cell_rows] if across else None)
            i, j = i + start, j + start
            if across:  # sketches were folded to the shortest of the cell: look at longer ones in full
                full = np.array([min(len(raw[x]), len(raw[y])) for x, y in zip(i.tolist(), j.tolist())], np.int64) > min(map(len, raw[cell_rows]))
                d = d.copy()
                d[full] = [wide_apart(raw[x], raw[y]) for x, y in zip(i[full].tolist(), j[full].tolist())]
                near = d <= most_apart(n[i] + n[j], percent)
                i, j, d = i[near], j[near], d[near]
            some.append(i)
            other.append(j)
            far.append(d)
        pairs: dict[tuple[bytes, bytes], int] = {}
        for x, y, d in zip(some, other, far):
            pairs.update(zip(zip((nodes[k] for k in x.tolist()), (nodes[k] for k in y.tolist())), d.tolist()))
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary()), pa.array(list(pairs.values()), pa.int32())], ["a", "b", "far"])

    # rows of a cell come in order of node, so a is the smaller one
    ordered = rows.select("cluster", "cell", "node", "n", "sketch", "label").repartition("cluster", "cell").sortWithinPartitions("cluster", "cell", "node")
    found_pairs = ordered.mapInArrow(tidy(cells), "a binary, b binary, far int")
    if across:
        return found_pairs.select("a", "b").distinct()
    return found_pairs.groupBy("b").agg(F.min(F.struct("far", "a")).alias("nearest")).select(F.col("nearest.a").alias("a"), "b")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))


def among(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The nodes that may be among the wanted ones, sifted before they are shuffled."""
    return sifted(nodes, sieve(wanted, F.xxhash64("node")), F.xxhash64("node"))


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wider sketches leave."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [wide_apart(x, y) <= most_apart(m + n, percent) for x, y, m, n in zip(*(batch.column(c).to_pylist() for c in ("wa", "wb", "na", "nb")))]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    known = among(nodes, ends_of(pairs)).select("node", "n", "wide")
    left, right = known.toDF("a", "na", "wa"), known.toDF("b", "nb", "wb")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "wa", "wb").mapInArrow(tidy(near), "a binary, b binary")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link, as links (u, v)."""
    ends = written(ends_of(pairs).distinct(), "ends")
    # one row has the text of a node: a bitmap of these rows lets few others through, so texts are worked on where they are read
    rows = ends.join(among(nodes, ends).select("node", "row"), "node").select("row.doc_id", "row.mark")
    docs = sifted(docs, sieve(rows, F.xxhash64("doc_id", "mark")), F.xxhash64("doc_id", "mark"))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s for s in shingle_sets(part.column("text"), width) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([f(s) for s in sets], pa.binary()) for f in (node_of, lambda s: s.tobytes())], ["node", "shingles"])

    sets = docs.select("text").mapInArrow(tidy(shingled), "node binary, shingles binary").dropDuplicates(["node"])
    sets = written(sets.join(ends, "node", "left_semi"), "sets")
    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([x, y]))
                same = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["u", "v"])

    links = written(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(tidy(link), "u binary, v binary"), "verified")
    dropped(sets, ends)
    return links


def linked(docs: DataFrame, width: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Of docs (doc_id, mark, text): doc_id, mark, n and node of each row, and the root of each node, the same for all that links reach.

    mark tells rows of one doc_id apart.
    """
    each = written(described(docs, width, percent), "sketches")
    row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("row")
    nodes = each.filter("node IS NOT NULL").groupBy("node").agg(row, F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"))
    nodes = written(nodes, "nodes")
    total = each.agg(F.sum("n").alias("x")).first()["x"] or 0
    parts = max(12, -(-total * (100 - percent) // (50 * 1_000_000)))  # about a million keys each
    meet = written(keyed(docs, width, percent, parts).groupBy("part").applyInArrow(met, MET).distinct(), "clusters")
    big = meet.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
    # a row is in the cells of its block with every block
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = meet.join(big, "cluster", "left").fillna(1, ["blocks"]).withColumn("mine", mine).withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = cells.select("cluster", (F.least("mine", "with") * F.lit(1 << 20).cast("long") + F.greatest("mine", "with")).alias("cell"), "node")
    cells = written(cells.join(among(nodes, meet).select("node", "n", "sketch"), "node"), "cells")
    nearest = written(pairs_of(cells.withColumn("label", F.lit(None).cast("binary")), percent, False), "nearest")
    nearest = written(plausible(nearest, nodes, percent), "pairs")
    links = verified(nearest, docs, nodes, width, percent)
    labelled = cells.drop("sketch").join(components(links), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    # only clusters whose nodes are in several components can add a link
    several = labelled.groupBy("cluster").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("cluster")
    again = written(labelled.join(several, "cluster", "left_semi"), "open")
    dropped(meet, cells, nearest)
    more = written(pairs_of(again.join(among(nodes, again).select("node", F.col("wide").alias("sketch")), "node"), percent, True), "pairs")
    dropped(again)
    if not more.isEmpty():
        links = links.union(verified(more, docs, nodes, width, percent))
    dropped(more)
    roots = components(links)
    placed = nodes.select("node", "row").join(roots, "node", "left").select("node", "row", F.coalesce("root", "node").alias("root"))
    return each.drop("sketch", "wide"), placed


def joined(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = 4_096) -> DataFrame:
    """doc_id, n_shingles and component_id of each document, the smallest doc_id reachable by links."""
    docs = only(documents, "doc_id", "text").withColumn("mark", F.xxhash64("text"))
    known = F.col("doc_id").isNotNull()
    each, placed = linked(docs.filter(known), width, percent, block)
    smallest = placed.groupBy("root").agg(F.min("row.doc_id").alias("component_id"))
    belongs = placed.join(smallest, "root").select("node", "component_id")
    out = each.join(belongs, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    others = described(docs.filter(~known), width, percent)
    return out.union(others.select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))


def one_of_each(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = 4_096) -> DataFrame:
    """The documents without those that are linked, directly or over others, to one with a smaller doc_id (null is largest).

    Of linked rows with the same doc_id the one whose text has the smallest hash stays, of equal ones any.
    """
    names = documents.columns
    docs = only(documents, "doc_id", "text").withColumn("mark", F.xxhash64("text"))
    each, placed = linked(docs, width, percent, block)
    first = placed.groupBy("root").agg(F.min("row").alias("first"))
    ranked = each.filter("node IS NOT NULL").groupBy("node", "doc_id", "mark").agg(F.count("*").alias("copies")).join(placed.select("node", "root"), "node").join(first, "root")
    stays = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("mark") == F.col("first.mark"))
    # gone rows, and rows that stay once though they are there several times
    told = written(ranked.withColumn("stays", stays).filter("NOT stays OR copies > 1").select(F.col("doc_id").alias("id"), "mark", "stays"), "told")
    dropped(each, placed)
    own = documents.toDF(*[n if n in ("doc_id", "text") else f"_{k}" for k, n in enumerate(names)]).withColumn("hash", F.xxhash64("text"))
    same = own["doc_id"].eqNullSafe(told["id"]) & (own["hash"] == told["mark"])
    # rows that the sieve holds back are not told of: only the others are shuffled
    bits = sieve(told, F.col("mark"))
    maybe = sifted(own, bits, F.col("hash"))
    out = sifted(own, bits, F.col("hash"), keep=False).union(maybe.join(told, same, "left_anti"))
    once = told.filter("stays")
    if not once.isEmpty():
        out = out.union(maybe.join(once, same, "left_semi").dropDuplicates(["doc_id", "hash"]))
    return out.drop("hash").toDF(*names)
