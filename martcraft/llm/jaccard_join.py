"""N-gram Jaccard join by parity sketches.

Two sets with a Jaccard similarity of at least ``percent`` / 100 differ in few
elements: if the smaller one has ``a``, in at most ``T = a (100 - percent) / percent``.
Sizes fall into bands, each wider than that ratio, so linked documents are in
the same band or in neighbouring ones. In the space of a band every set is
hashed into ``T + 1 + s`` chunks, and each chunk keeps the XOR of its elements'
hashes; beside them, each element flips one bit of the set's parity bits, so the
Hamming distance of two sets' bits is at most the size of their difference. By
the pigeonhole principle ``1 + s`` chunks at least are equal in linked sets; one of
them isn't empty unless a set has more than ``s`` empty chunks, and such a set
files its empty chunks too. So joining on (space, chunk, XOR) finds every link.
``s`` is one more than twice the empty chunks to be expected, so that few sets
file those.

Sets with equal content are one class from the start, so copies cost one entry
per task. Classes that share a key form a group. Inside groups, classes are
compared by Hamming distance, and those that pass, directly or by others, form
a cluster; inside clusters they are compared exactly. Both steps work alike:
a group or cluster is cut into tiles of bounded size, and pairs of tiles are
compared inside tasks. In round one each tile meets itself and the first tile;
if a component doesn't hold the whole unit then, classes are dealt anew by the component found so far, and in round two all
other pairs of tiles meet, except tiles that lie in one component already. A
pair of tiles emits the edges of a spanning forest only, so the rows grow with
the classes and not with the pairs.

Defined cases: words are split at bytes 0x20 and 0x09-0x0D with A-Z lower-cased.
A set holds the distinct ``n``-word shingles; with fewer words, the whole
sequence; a null or wordless text has an empty set and no link. Rows with a null
doc_id are returned with a null component and link nothing. Elements are
compared by 64-bit hashes.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from martcraft.llm import text as T
from martcraft.llm.components import connected_components
from martcraft.llm.tables import dropped, fresh, saved, ship, text_bytes

TILE = 256
KEY_BYTES = 6
CALL_ROWS = 2048
SHARD_BYTES = 12 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after the other, and the offsets of the rows."""
    w = T.words(T.lower_ascii(data), offsets)
    h = w.hashes()
    grams = T.ngrams(h, n)
    inside = w.row[:len(grams)] == w.row[n - 1:] if len(grams) else np.zeros(0, dtype=bool)
    g, row = grams[inside], w.row[:len(grams)][inside]
    per = w.per_row()
    short = np.flatnonzero((per > 0) & (per < n))
    if len(short):
        whole = T.span_hashes(h, w.first[short], w.first[short + 1])
        g, row = np.append(g, whole), np.append(row, short)
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(len(offsets)))


def class_of(g: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A hash of each row's set as a long (0: empty)."""
    size = np.diff(off)
    prefix = np.zeros(len(g) + 1, dtype=T.U)
    np.cumsum(T.mix(g ^ T.U(0x5851F42D4C957F2D)), out=prefix[1:])
    c = T.mix(prefix[off[1:]] - prefix[off[:-1]] + size.astype(T.U))
    c[size == 0] = 0
    return c.view(np.int64)


def bands(percent: int, top: int) -> np.ndarray:
    """The least size of each band: a set in one band can link to the next one, but not beyond."""
    edges = [1]
    while edges[-1] <= max(top, 1):
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, dtype=np.int64)


def chunk_xors(g: np.ndarray, off: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XOR of the elements' hashes in every chunk of each set (``chunks`` per set), and the offsets of the sets."""
    size = np.diff(off)
    base = np.append(0, np.cumsum(chunks))
    r = T.mix(g)
    at = np.repeat(base[:-1], size) + (r % np.repeat(chunks, size).astype(T.U)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    xor = np.zeros(base[-1], dtype=T.U)
    if len(order):
        begin = np.flatnonzero(np.diff(at[order], prepend=-1))
        xor[at[order][begin]] = np.bitwise_xor.reduceat(r[order], begin)
    return xor, base


def differences(size: np.ndarray, percent: int) -> np.ndarray:
    return size * (100 - percent) // percent


def spares(most: np.ndarray, percent: int) -> np.ndarray:
    """Chunks beyond those that the pigeonhole principle needs."""
    return 1 + (2 * (most + 1) * np.exp(-percent / (100 - percent))).astype(np.int64)


def keys_of(g: np.ndarray, off: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Join keys and the set that each belongs to."""
    size = np.diff(off)
    edges = bands(percent, int(size.max(initial=0)))
    own = np.searchsorted(edges, size, side="right") - 1
    out_key, out_row = [], []
    for back in (0, 1):
        space = own - back
        most = differences(edges[np.maximum(space, 0) + 1] - 1, percent)
        use = np.flatnonzero((size > 0) & (space >= 0) & (most > 0))  # without any difference the sets are one class
        if not len(use):
            continue
        sub = np.concatenate([g[off[i]:off[i + 1]] for i in use])
        sub_off = np.append(0, np.cumsum(size[use]))
        spare = spares(most[use], percent)
        chunks = most[use] + 1 + spare
        xor, base = chunk_xors(sub, sub_off, chunks)
        chunk = np.arange(base[-1]) - np.repeat(base[:-1], chunks)
        row = np.repeat(np.arange(len(use)), chunks)
        empty = xor == 0
        n_empty = np.bincount(row[empty], minlength=len(use))
        filed = ~empty | (n_empty > spare)[row]
        key = T.mix(T.mix(xor + chunk.astype(T.U)) ^ (space[use][row].astype(T.U) + T.U(1)) * T.U(0x9E3779B97F4A7C15))
        out_key.append(key[filed])
        out_row.append(use[row[filed]])
    if not out_key:
        return np.zeros(0, dtype=T.U), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_key), np.concatenate(out_row)


def parity(g: np.ndarray) -> np.ndarray:
    """Parity bits of a whole set, at least four a element, a power of two of 64-bit words; halves fold onto each other by XOR."""
    words = 1 << max(0, (4 * len(g) - 1).bit_length() - 6)
    place = T.mix(g ^ T.U(0x2545F4914F6CDD1D)) & T.U(64 * words - 1)
    bits = np.zeros(words, dtype=T.U)
    np.bitwise_xor.at(bits, (place >> T.U(6)).astype(np.int64), T.U(1) << (place & T.U(63)))
    return bits


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def _forest(rows: list[dict], percent: int, exact: bool) -> list[tuple[int, int]]:
    """Links between the classes of one tile, or of two (then from one to the other), as a spanning forest: by Hamming distance, or exactly too."""
    rows.sort(key=lambda r: (r["tile"], r["size"], r["cls"]))
    size = np.array([r["size"] for r in rows], dtype=np.int64)
    bits = [np.frombuffer(r["bits"], dtype=T.U) for r in rows]
    words = min(len(b) for b in bits)
    bits = np.stack([_folded(b, words) for b in bits])
    sets = [np.frombuffer(r["grams"], dtype=T.U) for r in rows] if exact else None
    parent = np.arange(len(rows))
    comp: dict[int, int] = {}
    for i, r in enumerate(rows):
        parent[i] = comp.setdefault(r["comp"], i)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tile = np.array([r["tile"] for r in rows])
    inside = tile[0] == tile[-1]
    edges = []
    for i in range(1, len(rows)):
        before = np.arange(i)
        small = np.minimum(size[:i], size[i])
        ok = (100 * small >= percent * np.maximum(size[:i], size[i])) & (inside | (tile[:i] != tile[i]))
        before = before[ok]
        if not len(before):
            continue
        far = np.bitwise_count(bits[before] ^ bits[i]).sum(axis=1, dtype=np.int64)
        before = before[far <= differences(small[ok], percent)]
        for j in before.tolist():
            if find(i) != find(j) and (sets is None or _similar(sets[i], sets[j], percent)):
                parent[find(i)] = find(j)
                edges.append((rows[i]["cls"], rows[j]["cls"]))
    return edges


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_UNIT = pa.schema([("unit", pa.int64()), ("cls", pa.int64()), ("n_tiles", pa.int64())])


def _edges_table(edges: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": [a for a, _ in edges], "b": [b for _, b in edges]}, schema=_EDGE)


def link_classes(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles, cls)`` for every row, and ``(cls, component)`` for classes that have links."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shards = max(1, -(-text_bytes(src) // SHARD_BYTES))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                g, off = shingle_sets(*T.utf8(s.column("text")), n)
                yield pa.RecordBatch.from_arrays([s.column("id"), pa.array(np.diff(off)), pa.array(class_of(g, off))], names=["doc_id", "n_shingles", "cls"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                s = s.filter(s.column("id").is_valid())
                g, off = shingle_sets(*T.utf8(s.column("text")), n)
                cls, code = np.unique(class_of(g, off), return_inverse=True)  # a row of the shuffle lists its classes once
                key, row = keys_of(g, off, percent)
                code = code[row].astype(np.uint16)  # a slice has 2 ** 16 rows at most
                shard = (key >> T.U(40)).astype(np.int64) % shards
                order = np.lexsort((code, key, shard))
                key, code, shard = key[order], code[order], shard[order]
                new = np.ones(len(key), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
                key, code, shard = key[new], code[new], shard[new]
                cut = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
                parts = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_pydict({
                    "shard": [int(shard[i]) for i, _ in parts], "classes": [cls.tobytes()] * len(parts),
                    "key": [key[i:j].view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes() for i, j in parts], "code": [code[i:j].tobytes() for i, j in parts],
                }, schema=pa.schema([("shard", pa.int64()), ("classes", pa.binary()), ("key", pa.binary()), ("code", pa.binary())]))

    def shared(t: pa.Table) -> pa.Table:
        """The groups of a shard: keys that several classes have; groups of the same classes count once."""
        key, cls = [], []
        for k, c, names in zip(t.column("key").to_pylist(), t.column("code").to_pylist(), t.column("classes").to_pylist(), strict=True):
            m = len(k) // KEY_BYTES
            wide = np.zeros((m, 8), dtype=np.uint8)
            wide[:, :KEY_BYTES] = np.frombuffer(k, dtype=np.uint8).reshape(m, KEY_BYTES)
            key.append(wide.view(T.U).reshape(-1))
            cls.append(np.frombuffer(names, dtype=np.int64)[np.frombuffer(c, dtype=np.uint16)])
        key, cls = np.concatenate(key), np.concatenate(cls)
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        key, cls = key[new], cls[new]
        begin = np.flatnonzero(np.diff(key, prepend=~key[:1]))
        size = np.diff(np.append(begin, len(key)))
        many = np.flatnonzero(size > 1)
        at = np.repeat(begin[many] - np.append(0, np.cumsum(size[many])[:-1]), size[many]) + np.arange(size[many].sum())
        end = np.cumsum(size[many])
        group = T.span_hashes(cls[at].view(T.U), end - size[many], end)  # by content
        first = np.unique(group, return_index=True)[1]
        keep = np.zeros(len(many), dtype=bool)
        keep[first] = True
        rows = np.repeat(keep, size[many])
        return pa.table({"unit": np.repeat(group, size[many])[rows].view(np.int64), "cls": cls[at][rows], "n_tiles": np.repeat(-(-size[many] // TILE), size[many])[rows]}, schema=_UNIT)

    members = saved(src.mapInArrow(classes, "doc_id long, n_shingles long, cls long"), "classes")
    dealt = src.mapInArrow(keys, "shard long, classes binary, key binary, code binary")
    groups = saved(dealt.groupBy("shard").applyInArrow(shared, "unit long, cls long, n_tiles long").distinct(), "groups")

    # One text of each class in a group, as its set and parity bits.
    leads = members.where("doc_id is not null and n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("id"))
    wanted = groups.select("cls").distinct().join(leads, "cls").select("id", "cls")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, "text"):
                g, off = shingle_sets(*T.utf8(s.column("text")), n)
                own = class_of(g, off) == s.column("cls").to_numpy()  # rows with one doc_id may hold different texts
                size = np.diff(off)
                g, off = g[np.repeat(own, size)], np.append(0, np.cumsum(size[own]))
                s = s.filter(pa.array(own))
                each = [g[i:j] for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "cls": s.column("cls"), "size": np.diff(off),
                    "bits": pa.array([parity(x).tobytes() for x in each], pa.binary()), "grams": pa.array([x.tobytes() for x in each], pa.binary())})

    pool = src.where("id is not null").join(wanted, "id").select("cls", "text").mapInArrow(
        sets, "cls long, size long, bits binary, grams binary")
    # A class whose text stands in several rows of one doc_id may be there more than once; its edges to itself are ignored.
    pool = saved(pool, "sets")

    near = _links(groups, pool, percent, exact=False)
    comp = saved(connected_components(near).select(F.col("node").alias("cls"), F.col("component").alias("unit")), "clusters")
    sizes = comp.groupBy("unit").agg(F.ceil(F.count("*") / TILE).alias("n_tiles"))
    clusters = saved(comp.join(sizes, "unit").select("unit", "cls", "n_tiles"), "clusters")
    links = _links(clusters, pool, percent, exact=True)
    comp = saved(connected_components(links), "components")
    for t in (pool, clusters, groups):
        dropped(t)
    return members, comp.select(F.col("node").alias("cls"), "component")


def _links(units: DataFrame, pool: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Edges that connect, in every unit, all classes whose pairs pass, directly or by others.

    ``units`` has ``(unit, cls, n_tiles)``, the last by the unit's size; a class may be
    in several. Without ``exact`` pairs pass by Hamming distance.
    """

    columns = ["size", "bits", "grams"] if exact else ["size", "bits"]

    def forests(t: pa.Table) -> pa.Table:
        t = t.sort_by([("unit", "ascending"), ("t1", "ascending"), ("t2", "ascending")])
        keys = np.stack([t.column(c).to_numpy() for c in ("unit", "t1", "t2")])
        cut = np.append(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))), t.num_rows)
        t = t.select(["cls", "comp", "tile", *columns])
        edges = []
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if j > i + 1:
                edges += _forest(t.slice(i, j - i).to_pylist(), percent, exact)
        return _edges_table(edges)

    def compare(rows: DataFrame, n: int) -> DataFrame:
        """Edges between the two tiles of each (unit, t1, t2), or inside one; a call gets many of them, up to about ``CALL_ROWS`` rows."""
        rows = rows.withColumn("call", F.pmod(F.xxhash64("unit", "t1", "t2"), F.lit(max(1, -(-n // CALL_ROWS)))))
        return rows.join(pool.select("cls", *columns), "cls").groupBy("call").applyInArrow(forests, "a long, b long")

    # Each row goes to its own tile's meetings; the first tile meets all others, so it is repeated as often as there are tiles.
    meets = """if(tile = 0, transform(sequence(0L, n_tiles - 1), t -> struct(0L as t1, t as t2)), array(struct(0L as t1, tile as t2), struct(tile as t1, tile as t2)))"""
    tiles = units.selectExpr("unit", "cls", "cls as comp", "pmod(xxhash64(cls), n_tiles) as tile", "n_tiles")
    tiles = tiles.select("unit", "cls", "comp", "tile", F.explode(F.expr(meets)).alias("m")).select("unit", "cls", "comp", "tile", "m.t1", "m.t2")
    total = units.agg(F.sum(F.expr("if(n_tiles = 1, 1, 3)")), F.max("n_tiles")).first()
    first = saved(compare(tiles, total[0] or 0), "links")
    if (total[1] or 0) <= 1:
        return first

    # Units of several tiles, dealt anew: large components in tiles of their own, the others mixed.
    comp = connected_components(first).withColumnRenamed("node", "cls")
    t = units.where("n_tiles > 1").select("unit", "cls").join(comp, "cls", "left").select("unit", "cls", F.coalesce("component", "cls").alias("comp"))
    t = saved(t, "large")
    size = t.groupBy("unit", "comp").agg(F.count("*").alias("n"))
    rest = size.groupBy("unit").agg(F.sum(F.expr(f"if(n < {TILE}, n, 0)")).alias("rest"), F.count("*").alias("comps")).where("comps > 1")
    size = saved(size.join(rest, "unit"), "sizes")
    if size.isEmpty():
        return first
    again = t.join(size, ["unit", "comp"]).selectExpr(
        "unit", "cls", "comp",
        f"if(n < {TILE}, pmod(xxhash64(cls), ceil(rest / {TILE})), xxhash64(comp, pmod(xxhash64(cls), ceil(n / {TILE})))) as tile")
    again = saved(again, "tiles")
    sides = saved(again.groupBy("unit", "tile").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")), "tiles")
    pairs = sides.selectExpr("unit", "tile as t1", "lo", "hi", "n as n1").join(
        sides.selectExpr("unit", "tile as t2", "lo as lo2", "hi as hi2", "n as n2"), "unit").where(
        "t1 <= t2 and not (lo = hi and lo2 = hi2 and lo = lo2)").selectExpr("unit", "t1", "t2", "if(t1 = t2, n1, n1 + n2) as n")
    pairs = saved(pairs, "pairs")
    n = pairs.agg(F.sum("n")).first()[0] or 0
    sides = pairs.select("unit", "t1", "t2", F.explode(F.array_distinct(F.array("t1", "t2"))).alias("tile"))
    return saved(first.unionByName(compare(sides.join(again, ["unit", "tile"]), n)), "links")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id long, n_shingles long, component_id long``, one row per input row.

    The component is the smallest doc_id that links reach, the row's own included.
    """
    members, comp = link_classes(docs, id_col, text_col, n, percent)
    linked = members.where("doc_id is not null and n_shingles > 0").join(comp, "cls", "left")
    group = F.coalesce("component", "cls")
    linked = linked.select("doc_id", "n_shingles", group.alias("g"))
    # Written, so that both sides of the join are plain shuffles and a large component's part can be split.
    least = saved(linked.groupBy("g").agg(F.min("doc_id").alias("component_id")), "least")
    got = linked.join(least, "g").select("doc_id", "n_shingles", "component_id")
    rest = members.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return got.unionByName(rest)


def with_class(docs: DataFrame, name: str, text_col: str = "text", n: int = 3) -> DataFrame:
    """``docs`` with a column ``name``: the hash of the row's set (0: no words)."""
    ship(docs.sparkSession)
    schema = StructType([*docs.schema.fields]).add(name, LongType())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in T.slices(batch, text_col):
                cls = class_of(*shingle_sets(*T.utf8(s.column(text_col)), n))
                yield pa.RecordBatch.from_arrays([*s.columns, pa.array(cls)], names=schema.names)

    return docs.mapInArrow(add, schema)


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component stays.

    That is a row with the component's smallest doc_id. Rows with one doc_id and
    different sets are different documents: each is judged by its own links, and
    where several of a component share its smallest doc_id, the one with the least
    class stays. Of rows with one doc_id and equal sets one stays, by a hash of its
    columns. Rows without a doc_id or without words are in no component and stay.
    """
    members, comp = link_classes(docs, id_col, text_col, n, percent)
    known = members.where("doc_id is not null")
    sets = known.where("n_shingles > 0").select("doc_id", "cls").distinct()
    sets = saved(sets.join(comp, "cls", "left").select("doc_id", "cls", F.coalesce("component", "cls").alias("g")), "sets")
    least = sets.groupBy("g").agg(F.min("doc_id").alias("doc_id"))
    stay = saved(sets.join(least, ["g", "doc_id"]).groupBy("g", "doc_id").agg(F.min("cls").alias("cls")).select("doc_id", "cls"), "stay")

    # Ids of one row stay or go by their id alone; the rows of the others are told apart by their sets.
    rows = known.groupBy("doc_id").agg(F.count("*").alias("n_rows"), F.max("n_shingles").alias("most"))
    rows = rows.join(stay.select("doc_id", F.lit(True).alias("stays")).distinct(), "doc_id", "left")
    mark = fresh("judged_id", docs.columns)
    judged = saved(rows.where("n_rows > 1 or (most > 0 and stays is null)").select(F.col("doc_id").alias(mark), (F.col("n_rows") > 1).alias("several")), "judged")
    key = docs[id_col].cast("long")
    alone = docs.join(judged.select(mark), key == F.col(mark), "left_anti")

    name = fresh("cls", docs.columns)
    several = with_class(docs.join(judged.where("several").select(mark), key == F.col(mark), "left_semi"), name, text_col, n)
    wordless = several.where(F.col(name) == 0).select(*docs.columns)
    chosen = stay.select(F.col("doc_id").alias(mark), F.col("cls").alias(f"{mark}_cls"))
    linked = several.join(chosen, (several[id_col].cast("long") == chosen[mark]) & (several[name] == chosen[f"{mark}_cls"]), "left_semi")
    order = F.xxhash64(*[f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    linked = linked.groupBy(F.col(id_col).cast("long").alias("k"), F.col(name).alias("c")).agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return alone.unionByName(wordless).unionByName(linked)
