"""n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence, cut down by size-derived bounds.

The product's columns are taken rare first. Two sets that are alike enough share one of the first
``n - ceil(p n / 100) + 1`` columns of each (the size-derived bound), so only these columns are multiplied to find which
rows can meet; those rows, in families, are multiplied tile by tile over all their columns, and pairs whose overlap is
under the bound that their sizes give are discarded inside the tile. Only links leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join
from ledgerloom.llm.components import components
from ledgerloom.llm.messages import by_shard, pack_keys, pack_numbers, summed, unpack_keys, unpack_numbers
from ledgerloom.llm.shared import partitions, written
from ledgerloom.llm.tiles import deal
from ledgerloom.llm.words import Words, mix, shingles, slices, split_words, text_bytes

_U = np.uint64

#: Columns of a tile that are multiplied at once.
_COLUMNS = 4096


def distinct_shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles in order of text and hash, and each text's number of them."""
    doc, hashed = shingles(words, words.hashes(), width)
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    doc, hashed = doc[new], hashed[new]
    return doc, hashed, np.bincount(doc, minlength=len(words.first) - 1)


def set_identities(doc: np.ndarray, hashed: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each text's set: 0 for the empty set."""
    total = np.zeros(len(count), dtype=np.uint64)
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    if len(doc):
        total[doc[starts]] = np.add.reduceat(mix(hashed ^ _U(0x1B873593CC9E2D51)), starts)
    return np.where(count > 0, mix(total + count.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1), _U(0))


def _sets_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    doc, hashed, count = distinct_shingles(split_words(*text_bytes(column)), width)
    return doc, hashed, count, set_identities(doc, hashed, count)


def describe(docs: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """``id, n_shingles, set_id`` of every row; ``set_id`` is null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "body"):
                _, _, count, identity = _sets_of(piece.column("body"), width)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(count.astype(np.int64)), pa.array(identity.view(np.int64), mask=identity == 0)], names=["id", "n_shingles", "set_id"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, f"id {kind}, n_shingles long, set_id long")


def _block(id_col: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(id_col.cast("string")), F.lit(blocks)).cast("int").alias("block")


def _own_sets(texts: pa.Table, own: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, hash), sizes and identities per piece of a block's texts, for the first text with each set in ``own``."""
    left = set(own.tolist())
    for batch in texts.select(["body"]).to_batches():
        for piece in slices(batch, "body"):
            doc, hashed, count, identity = _sets_of(piece.column("body"), width)
            mine = np.zeros(len(count), dtype=bool)
            for k, s in enumerate(identity.tolist()):
                if s in left:
                    left.discard(s)
                    mine[k] = True
            keep = mine[doc]
            yield doc[keep], hashed[keep], count, identity


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.drop_null().to_numpy().astype(np.int64).view(np.uint64)


def _candidate_columns(docs: DataFrame, owners: DataFrame, id_col: str, text: str, width: int, percent: int) -> DataFrame:
    """For every set that can meet another: its size and shingles (``body``), and a row per column that it must be multiplied in.

    Two exchanges of messages: blocks name their shingles and how many of their sets hold each; shards answer with those that
    two sets or more hold, and the number. Shingles of one set alone fill the front of its rare-first order and are never sent back.
    """
    blocks = shards = 2 * partitions(docs.sparkSession)
    kind = owners.schema["id"].dataType.simpleString()
    texts = docs.select(_block(F.col(f"`{id_col}`"), blocks), F.col(f"`{text}`").cast("string").alias("body")).where("body is not null")
    own = owners.select(_block(F.col("id"), blocks), "set_id", "id", "copies")

    def name(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes, bytes]] = []
        if left.num_rows and right.num_rows:
            found = [h for _, h, _, _ in _own_sets(left, _unsigned(right.column("set_id")), width)]
            keys, held = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, dtype=np.uint64), np.zeros(0))
            block = left.column("block")[0].as_py()
            rows = [(k, block, pack_keys(keys[s]), pack_numbers(held[s])) for k, s in by_shard(keys, shards)]
        return _table(rows, ["shard", "block", "keys", "held"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

    def answer(table: pa.Table) -> pa.Table:
        named = [unpack_keys(x.as_py()) for x in table.column("keys")]
        keys, held = summed(named, [unpack_numbers(x.as_py()) for x in table.column("held")])
        rows = []
        for block, mine in zip(table.column("block").to_pylist(), named, strict=True):
            n = held[np.searchsorted(keys, mine)]
            if (n > 1).any():
                rows.append((block, pack_keys(mine[n > 1]), pack_numbers(np.minimum(n[n > 1], (1 << 32) - 1))))
        return _table(rows, ["block", "keys", "held"], [pa.int32(), pa.binary(), pa.binary()])

    named = texts.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(name, "shard int, block int, keys binary, held binary")
    answers = named.groupBy("shard").applyInArrow(answer, "block int, keys binary, held binary")
    none = F.lit(None)
    told = answers.select("block", "keys", "held", none.cast("long").alias("set_id"), none.cast(kind).alias("id"), none.cast("long").alias("copies")).union(
        own.select("block", none.cast("binary").alias("keys"), none.cast("binary").alias("held"), "set_id", "id", "copies")
    )

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        owner = right.filter(right.column("set_id").is_valid())
        ids = dict(zip(_unsigned(owner.column("set_id")).tolist(), zip(owner.column("id").to_pylist(), owner.column("copies").to_pylist(), strict=True), strict=True))
        said = right.filter(right.column("keys").is_valid())
        keys = [unpack_keys(x.as_py()) for x in said.column("keys")]
        rows: list[tuple] = []
        if left.num_rows and keys:
            every, held = np.concatenate(keys), np.concatenate([unpack_numbers(x.as_py()) for x in said.column("held")]).astype(np.int64)
            order = np.argsort(every)
            every, held = every[order], held[order]
            for doc, hashed, count, identity in _own_sets(left, np.array(list(ids), dtype=np.uint64), width):
                at = np.minimum(np.searchsorted(every, hashed), len(every) - 1)
                shared = every[at] == hashed
                alone = np.bincount(doc[~shared], minlength=len(count))
                take = count - -(-percent * count // 100) + 1 - alone
                d, h, n = doc[shared], hashed[shared], held[at[shared]]
                order = np.lexsort((h, n, d))
                d, h = d[order], h[order]
                rank = np.arange(len(d)) - np.searchsorted(d, d)
                chosen = rank < take[d]
                d, h = d[chosen], h[chosen]
                bounds = np.searchsorted(doc, np.arange(len(count) + 1))
                for k in np.unique(d).tolist():
                    s = int(identity[k])
                    rows.append((_signed(s), *ids[s], int(count[k]), None, hashed[bounds[k] : bounds[k + 1]].tobytes()))
                rows += [(_signed(int(identity[k])), None, None, None, _signed(x), None) for k, x in zip(d.tolist(), h.tolist(), strict=True)]
        types = [pa.int64(), right.schema.field("id").type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return _table(rows, ["set_id", "id", "copies", "n", "shingle", "body"], types)

    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(choose, f"set_id long, id {kind}, copies long, n long, shingle long, body binary")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, types, strict=True))})


def _meeting(columns: DataFrame, salts: int) -> DataFrame:
    """Edges that connect all sets of each column: stars within salted parts of it, then a star of their centres."""
    salted = columns.withColumn("salt", F.pmod(F.xxhash64("set_id"), F.lit(salts)))
    near = salted.select("shingle", "set_id", F.min("set_id").over(Window.partitionBy("shingle", "salt")).alias("centre"))
    centres = near.select("shingle", "centre").distinct()
    far = centres.select(F.col("centre").alias("set_id"), F.min("centre").over(Window.partitionBy("shingle")).alias("centre"))
    return near.select("set_id", "centre").union(far).where("set_id <> centre").distinct()


def multiply(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Overlap counts of the sets ``left`` with the sets ``right``, summed over blocks of columns that two sets or more have."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, held = np.unique(every, return_inverse=True, return_counts=True)
    number = np.cumsum(held > 1) - 1
    shared = held[column] > 1
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(left), len(right)), dtype=np.int64)
    for low in range(0, int(number[-1]) + 1, _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        # A block's sums are at most its columns, which 32-bit floats hold exactly; sets of any size are summed as integers.
        counts += (part[left] @ part[right].T).astype(np.int64)
    return counts


def tile_links(ids: list, copies: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, object, int]]:
    """(set, smallest id it is connected to within the tile, documents it is linked with) for the sets of a tile."""
    size = np.array([len(s) for s in sets])
    overlap = multiply(sets, left, right)
    linked = 100 * overlap >= percent * (size[left][:, None] + size[right][None, :] - overlap)
    linked &= left[:, None] != right[None, :]
    links = np.zeros(len(sets), dtype=np.int64)
    links[left] += linked @ copies[right]
    if not np.array_equal(left, right):
        links[right] += linked.T @ copies[left]
    up = list(range(len(sets)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in zip(*np.nonzero(linked), strict=True):
        x, y = root(int(left[a])), root(int(right[b]))
        if x != y:
            up[max(x, y, key=lambda k: ids[k])] = min(x, y, key=lambda k: ids[k])
    return [(k, ids[root(k)], int(links[k])) for k in range(len(sets))]


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """``set_id, id, root, links`` per set and tile. ``members``: family, set_id, id, copies, body."""
    kind = members.schema["id"].dataType.simpleString()

    def product(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = list(zip(*(table.column(c).to_pylist() for c in ("family", "low", "high")), strict=True))
        groups: dict[tuple, list[int]] = {}
        for row, key in enumerate(keys):
            groups.setdefault(key, []).append(row)
        part, set_id, id_, copies, body = (table.column(c) for c in ("part", "set_id", "id", "copies", "body"))
        rows = []
        for (_, low, high), at in groups.items():
            if len(at) < 2:
                continue
            sets = [np.frombuffer(body[r].as_py(), dtype=np.uint64) for r in at]
            side = np.array([part[r].as_py() for r in at])
            ids = [id_[r].as_py() for r in at]
            found = tile_links(ids, np.array([copies[r].as_py() for r in at]), sets, np.flatnonzero(side == low), np.flatnonzero(side == high), percent)
            rows += [(set_id[at[k]].as_py(), ids[k], root, links) for k, root, links in found if links]
        return _table(rows, ["set_id", "id", "root", "links"], [pa.int64(), table.schema.field("id").type, table.schema.field("id").type, pa.int64()])

    return deal(members, "family", "set_id").groupBy("tile").applyInArrow(product, f"set_id long, id {kind}, root {kind}, links long")


def jaccard_groups(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``id, n_shingles, n_links, component_id`` of every row of ``docs``.

    A document's set: its distinct ``width``-word shingles (words between spaces, A-Z as a-z); with fewer words the whole
    sequence is the one shingle. Two documents link when 100 overlap >= ``percent`` union. ``component_id`` is the smallest
    id that links reach. Equal sets are one row of the product, so copies cost no pairs. Texts without words, null texts
    and rows with a null id link with nothing (``component_id`` is their own id); rows with the same id and text are copies.
    Every true link is found: the columns that are skipped cannot be the only shared ones.
    """
    spark = docs.sparkSession
    all_rows = written(describe(docs, id_col, text, width), "sets")
    usable = all_rows.where("set_id is not null and id is not null")
    owners = usable.groupBy("set_id").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    columns = written(_candidate_columns(docs, owners, id_col, text, width, percent), "columns")
    families = components(_meeting(columns.where("shingle is not null").select("shingle", "set_id"), partitions(spark)), "set_id", "centre")
    members = columns.where("body is not null").select("set_id", "id", "copies", "body").join(families.select(F.col("node").alias("set_id"), F.col("component").alias("family")), "set_id")
    tiles = written(_tiles(members, percent), "tiles")
    degrees = tiles.groupBy("set_id").agg(F.sum("links").alias("links"))
    reached = components(tiles.where("id <> root"), "id", "root").select(F.col("node").alias("id"), F.col("component").alias("component_id"))
    per_set = owners.join(degrees, "set_id", "left").join(reached, "id", "left").select(
        "set_id", F.coalesce("component_id", "id").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    joined = lookup_join(usable, per_set, ["set_id"]).select("id", "n_shingles", "n_links", "component_id")
    rest = all_rows.where("set_id is null or id is null").select("id", "n_shingles", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.union(rest)


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id. Rows with a null id stay."""
    groups = jaccard_groups(docs, id_col=id_col, text=text, width=width, percent=percent)
    gone = groups.where("id <> component_id").select(F.col("id").alias("gone_id")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("gone_id"), "left_anti")
