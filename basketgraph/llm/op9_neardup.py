"""Near-duplicate groups by a chosen-path set similarity join.

A document's set holds its distinct word shingles as 64-bit hashes of the words' keyed hashes
(``hashing.keyed``), which no text can be built against without the key; documents
with equal sets are one vertex from then on. Each vertex has ``SKETCH`` minwise values. A
tree branches a vertex by one or two of them, chosen by the node, 1 / THRESHOLD
on average, so that documents above the threshold keep about one common path
on every level. Nodes of up to ``LEAF`` vertices are compared exhaustively on
sketches; larger ones branch on, and one that does not fall apart is dealt into blocks that share
a pivot. ``TREES`` independent trees bring the recall of a link at the threshold
above 0.9999. Candidates are confirmed on the full sets.

Two rounds keep the rows linear in the nodes: the first confirms a spanning
forest of every node; the second compares the full sets of all vertices that still have a
candidate of another component, inside their node (a dealt node: every vertex outside its
largest component with all of it, in tiles of bounded size), and returns a spanning forest of
the links. No list of pairs is ever written out. Components come from min-label propagation with pointer jumping.

Defined results: a null, empty or blank text has the empty set and is linked
with nothing; fewer words than a shingle make one shingle of all words. Rows that agree in doc_id and text are one
document; different texts of one doc_id are different documents, and so is every row with a null doc_id (``common.keyed``).
component_id is the least doc_id of the component, null if it has none; one document of a component is kept, of least
doc_id (null last) and then of least ``_v``. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.hashing import BASE, keyed, mix
from basketgraph.llm.registry import query

SHINGLE = 5
THRESHOLD = 0.85
SKETCH = 256
TREES, FIRST_DEPTH, LAST_DEPTH = 14, 3, 9
LEAF, BLOCK = 128, 96
#: A large node that kept this share of its parent is dealt into blocks rather than branched on.
TIGHT = 0.6
#: Least equal minwise values of a candidate: more than four standard deviations below the mean at the threshold.
LEAST_EQUAL = 193
#: From here on a pair is very likely a link.
SURE_EQUAL = 230
#: Most vertices and shingles of one side of a tile, and matrix columns held at a time.
TILE_ROWS, TILE_SHINGLES, TILE_COLUMNS = 2048, 2_000_000, 2048
BUFFER = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = (np.random.default_rng(20).integers(1 << 62, 1 << 63, SKETCH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    at = held = 0
    raw = [(t or "").encode() for t in texts]
    for k, t in enumerate(raw):
        if held and held + len(t) > BUFFER:
            out += _sets(raw[at:k])
            at, held = k, 0
        held += len(t) + 1
    return out + (_sets(raw[at:]) if raw else [])


def _sets(raw: list[bytes]) -> list[np.ndarray]:
    size = np.array([len(t) + 1 for t in raw], np.int64)
    begin = np.cumsum(size) - size
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
    first, last = edge[0::2], edge[1::2]
    word = keyed(data[~space], last - first)
    owner = np.searchsorted(begin, first, side="right") - 1
    n_words = np.bincount(owner, minlength=len(raw))
    if len(word) >= SHINGLE:
        m = len(word) - SHINGLE + 1
        h = np.zeros(m, np.uint64)
        for j in range(SHINGLE):
            h = h * BASE + word[j : j + m]
        h = mix(h)
        whole = owner[:m] == owner[SHINGLE - 1 :]
        h, of = h[whole], owner[:m][whole]
    else:
        h, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    cut = np.searchsorted(of, np.arange(len(raw) + 1))
    upto = np.r_[0, np.cumsum(n_words)]
    sets = []
    for k in range(len(raw)):
        if 0 < n_words[k] < SHINGLE:
            one = np.uint64(n_words[k])
            for w in word[upto[k] : upto[k + 1]]:
                one = mix(np.array([one], np.uint64) * BASE + w)[0]
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.unique(h[cut[k] : cut[k + 1]]))
    return sets


def sketch(s: np.ndarray) -> np.ndarray:
    """The last 16 bits of each minwise value: different values agree in one of 65,536 cases, and candidates are confirmed."""
    low = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(s), 2048):
        low = np.minimum(low, ((s[k : k + 2048, None] * _FACTORS[None, :]) >> np.uint64(32)).min(0).astype(np.uint32))
    return low.astype(np.uint16)


def signatures(docs: DataFrame) -> DataFrame:
    """row (unique), doc_id, _v, n (set size), lo and hi (fingerprint of the set), sketch; stable once it is written."""

    @common.lean
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (part for whole in batches for part in common.slices(whole, whole["text"].map(lambda t: len(t or "")))):
            sets = shingle_sets(list(batch["text"]))
            lo = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
            hi = np.array([mix(s ^ BASE).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "_v": batch["_v"], "n": [len(s) for s in sets], "lo": lo.view(np.int64), "hi": hi.view(np.int64), "sketch": [sketch(s).tobytes() if len(s) else b"" for s in sets]})

    signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_v", "text").mapInPandas(sign, "doc_id long, _v long, n long, lo long, hi long, sketch binary")
    return signed.withColumn("row", F.monotonically_increasing_id())


def _branch(keys: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: each (row, key) goes to the child of one chosen minwise value, and with the rest of 1 / THRESHOLD to a second."""
    chosen = mix(keys ^ np.uint64(0x5851F42D4C957F2D))
    second = (chosen >> np.uint64(40)).astype(float) / (1 << 24) < 1 / THRESHOLD - 1
    a = (chosen % np.uint64(SKETCH)).astype(np.int64)
    b = (a + 1 + ((chosen >> np.uint64(20)) % np.uint64(SKETCH - 1)).astype(np.int64)) % SKETCH

    def child(sel: np.ndarray, coord: np.ndarray) -> np.ndarray:
        return mix(keys[sel] * BASE + mix(coord.astype(np.uint64) * np.uint64(0x100000001) + values[rows[sel], coord].astype(np.uint64)))

    every = np.arange(len(keys))
    two = np.flatnonzero(second)
    return np.concatenate([child(every, a), child(two, b[two])]), np.concatenate([rows, rows[two]])


def first_nodes(reps: DataFrame) -> DataFrame:
    """(node, doc) after FIRST_DEPTH levels of every tree."""

    @common.lean
    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch["sketch"]), np.uint16).reshape(-1, SKETCH)
            ids = batch["doc"].to_numpy(np.int64)
            rows = np.repeat(np.arange(len(ids)), TREES)
            keys = np.tile(mix(np.arange(1, TREES + 1, dtype=np.uint64)), len(ids))
            for _ in range(FIRST_DEPTH):
                keys, rows = _branch(keys, values, rows)
            yield pd.DataFrame({"node": keys.view(np.int64), "doc": ids[rows]})

    return reps.select("doc", "sketch").mapInPandas(grow, "node long, doc long")


def next_nodes(nodes: DataFrame) -> DataFrame:
    @common.lean
    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch["sketch"]), np.uint16).reshape(-1, SKETCH)
            keys, rows = _branch(batch["node"].to_numpy(np.int64).view(np.uint64), values, np.arange(len(batch)))
            yield pd.DataFrame({"node": keys.view(np.int64), "doc": batch["doc"].to_numpy(np.int64)[rows], "parent": batch["size"].to_numpy(np.int64)[rows]})

    return nodes.select("node", "doc", "size", "sketch").mapInPandas(grow, "node long, doc long, parent long")


def _sized(nodes: DataFrame) -> DataFrame:
    """Nodes of two vertices or more, each set of vertices once: (node, doc, size)."""
    members = nodes.groupBy("node").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("doc")).alias("s1"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("s2"))
    once = members.where("size > 1").groupBy("size", "s1", "s2").agg(F.min("node").alias("node")).select("node", "size")
    return nodes.join(once, "node")


def tree_nodes(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(small, large): rows (node, doc) of nodes to compare exhaustively, rows (node, doc, size) of nodes that did not fall apart."""
    found = common.stored(_sized(first_nodes(reps)), "op9-nodes")
    small = found.where(F.col("size") <= LEAF).select("node", "doc")
    big = found.where(F.col("size") > LEAF).select("node", "doc", "size")
    tight = big.limit(0)
    for depth in range(FIRST_DEPTH, LAST_DEPTH):
        if not big.limit(1).count():
            break
        found = common.stored(_sized(next_nodes(big.join(reps.select("doc", "sketch"), "doc"))), f"op9-nodes-{depth}")
        small = small.unionAll(found.where(F.col("size") <= LEAF).select("node", "doc"))
        # a child that kept most of its parent holds near copies of one text: branching on would only multiply its paths
        kept = F.col("size") >= TIGHT * F.col("parent")
        tight = tight.unionAll(found.where((F.col("size") > LEAF) & kept).select("node", "doc", "size"))
        big = found.where((F.col("size") > LEAF) & ~kept).select("node", "doc", "size")
    return small, tight.unionAll(big)


def dealt_blocks(big: DataFrame) -> DataFrame:
    """Blocks of about BLOCK vertices by a hash; the vertex of least hash is a pivot in every block of its node."""
    part = F.pmod(F.xxhash64("node", "doc"), F.ceil(F.col("size") / BLOCK)).cast("long")
    rows = big.select(F.xxhash64("node", part, F.lit("block")).alias("node"), "doc")
    pivot = big.groupBy("node", "size").agg(F.min(F.struct(F.xxhash64("doc").alias("h"), "doc")).alias("m"))
    blocks = pivot.select("node", F.col("m.doc").alias("doc"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / BLOCK).cast("long") - 1)).alias("part"))
    pivots = blocks.select(F.xxhash64("node", "part", F.lit("block")).alias("node"), "doc")
    return rows.unionAll(pivots).distinct()


def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The runs of equal ``key`` in batches sorted by it; a run may span batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        cuts = np.flatnonzero(np.diff(batch[key].to_numpy())) + 1
        if held and held[0][key].iloc[0] != batch[key].iloc[0]:
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        for a, b in zip(np.r_[0, cuts[:-1]] if len(cuts) else [], cuts, strict=True):
            run = batch.iloc[a:b]
            yield pd.concat([*held, run]) if held else run
            held = []
        held.append(batch.iloc[cuts[-1] if len(cuts) else 0 :])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def candidates(nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: a spanning forest of each node's similar vertices."""
    rows = nodes.select("node", "doc").join(reps.select("doc", "n", "sketch"), "doc")
    rows = rows.repartition("node").sortWithinPartitions("node", "doc")

    @common.lean
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = [], []
        for g in _groups(batches, "node"):
            ids, n = g["doc"].to_numpy(np.int64), g["n"].to_numpy(np.int64)
            if len(ids) < 2:
                continue
            values = np.frombuffer(b"".join(g["sketch"]), np.uint16).reshape(-1, SKETCH)
            one, two = _forest(values, n, mix(ids.astype(np.uint64)))
            a.append(ids[one])
            b.append(ids[two])
            if sum(map(len, a)) > 100_000:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})
                a, b = [], []
        if a:
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return rows.mapInPandas(pairs, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _near(values: np.ndarray, n: np.ndarray, one: np.ndarray, size: int) -> np.ndarray:
    """Equal minwise values of each row with one other, 0 where the set sizes alone rule a link out."""
    equal = (values == one).sum(1)
    return np.where(100 * np.minimum(n, size) >= 85 * np.maximum(n, size), equal, 0)


def _top(root: dict[int, int], x: int) -> int:
    while root.setdefault(x, x) != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def _forest(values: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    equal = np.stack([_near(values, n, values[k], n[k]) for k in range(len(n))])
    one, two = np.nonzero(np.triu(equal >= LEAST_EQUAL, 1))
    # very similar pairs go by a hash of the smaller-ranked vertex, so that all nodes of a group of copies choose the same
    # few hubs and their forests agree; the others by similarity
    same = equal[one, two]
    sure = same >= SURE_EQUAL
    order = np.lexsort((np.where(sure, np.minimum(rank[one], rank[two]) >> np.uint64(1), (1 << 16) - same.astype(np.uint64)), ~sure))
    root: dict[int, int] = {}
    keep = []
    for k in order.tolist():
        x, y = _top(root, int(one[k])), _top(root, int(two[k]))
        if x != y:
            root[max(x, y)] = min(x, y)
            keep.append(k)
            if len(keep) == len(n) - 1:
                break
    return one[keep], two[keep]


def tiles(large: DataFrame, reps: DataFrame, comps: DataFrame) -> DataFrame:
    """(node, doc, comp, side): pairs of a large node with one vertex outside the node's largest component, cut into tiles.

    A tile meets a bounded share of all vertices (side 0) with a bounded share of those outside (side 1); a node whose
    vertices are all in one component has no tile.
    """
    rows = large.select("node", "doc").join(reps.select("doc", "n"), "doc").join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    sums = rows.groupBy("node", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    whole = sums.groupBy("node").agg(F.sum("c").alias("c"), F.sum("w").alias("w"), F.max(F.struct("c", "w", "comp")).alias("m"))

    def parts(c: Column, w: Column) -> Column:
        return F.greatest(F.ceil(c / TILE_ROWS), F.ceil(w / TILE_SHINGLES)).cast("long")

    cut = whole.select("node", F.col("m.comp").alias("main"), parts(F.col("c"), F.col("w")).alias("p"), parts(F.col("c") - F.col("m.c"), F.col("w") - F.col("m.w")).alias("q"))
    placed = rows.join(cut.where("q > 0"), "node")
    index = lambda k: F.sequence(F.lit(0).cast("long"), F.col(k) - 1)
    every = placed.select("node", "doc", "comp", F.lit(0).alias("side"), F.pmod(F.xxhash64("doc"), "p").alias("i"), F.explode(index("q")).alias("j"))
    outside = placed.where("comp <> main").select("node", "doc", "comp", F.lit(1).alias("side"), F.explode(index("p")).alias("i"), F.pmod(F.xxhash64("doc", F.lit(1)), "q").alias("j"))
    return every.unionByName(outside).select(F.xxhash64("node", "i", "j", F.lit("tile")).alias("node"), "doc", "comp", "side")


def unsettled(small: DataFrame, large: DataFrame, reps: DataFrame, comps: DataFrame) -> DataFrame:
    """(node, doc, comp, side) of the vertices that still have a similar one of another component in their node or tile."""
    nodes = small.select("node", "doc").join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    mixed = nodes.groupBy("node").agg(F.min("comp").alias("l"), F.max("comp").alias("m")).where("l < m").select("node")
    rows = nodes.join(mixed, "node", "left_semi").withColumn("side", F.lit(2)).select("node", "doc", "comp", "side").unionAll(tiles(large, reps, comps))
    rows = rows.join(reps.select("doc", "n", "sketch"), "doc").repartition("node").sortWithinPartitions("node", "doc")

    @common.lean
    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, "node"):
            side, comp, n = g["side"].to_numpy(), g["comp"].to_numpy(np.int64), g["n"].to_numpy(np.int64)
            values = np.frombuffer(b"".join(g["sketch"]), np.uint16).reshape(-1, SKETCH)
            x, y = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            vx, nx, cx = values[x], n[x], comp[x]
            found = np.zeros(len(g), bool)
            for k in y:
                hit = (_near(vx, nx, values[k], n[k]) >= LEAST_EQUAL) & (cx != comp[k])
                found[x[hit]] = True
                found[k] |= hit.any()
            if found.any():
                yield g.loc[found, ["node", "doc", "comp", "side"]]

    return rows.mapInPandas(left, "node long, doc long, comp long, side int")


def _full_sets(ids: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, s) of the vertices in ``ids``, each once: the shingle set as bytes."""

    @common.lean
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (part for whole in batches for part in common.slices(whole, whole["text"].map(lambda t: len(t or "")))):
            yield pd.DataFrame({"doc": batch["doc"], "s": [s.tobytes() for s in shingle_sets(list(batch["text"]))]})

    wanted = common.stored(reps.join(ids.select("doc").distinct(), "doc", "left_semi").select("doc", F.col("doc_id").alias("own_id"), F.col("_v").alias("own_v"), "copies"), "op9-wanted")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "_v", "text").join(common.broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("_v") == F.col("own_v"))).select("doc", "copies", "text")
    if wanted.where("copies > 1").limit(1).count():
        rows = rows.dropDuplicates(["doc"])  # rows that agree in doc_id and text
    return rows.select("doc", "text").mapInPandas(sets, "doc long, s binary")


def _shared(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intersection sizes of the sets ``x`` with other sets ``y``, by products of 0-1 matrices over some columns at a time."""
    size = np.array([len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    own = np.repeat(np.arange(len(sets)), size)
    name = np.cumsum(times > 1) - 1
    common_col = times[col] > 1
    col, own = name[col[common_col]], own[common_col]
    order = np.argsort(col, kind="stable")
    col, own = col[order], own[order]
    n_cols = int(col[-1]) + 1 if len(col) else 0
    out = np.zeros((len(x), len(y)), np.int32)
    for begin in range(0, n_cols, TILE_COLUMNS):
        a, b = np.searchsorted(col, (begin, begin + TILE_COLUMNS))
        part = np.zeros((len(sets), min(TILE_COLUMNS, n_cols - begin)), np.float32)
        part[own[a:b], col[a:b] - begin] = 1
        out += (part[x] @ part[y].T).astype(np.int32)
    return out


def settled(rows: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links (a, b) that join different components: of each node or tile a spanning forest, on the full sets."""
    full = common.stored(_full_sets(rows, reps, docs), "op9-sets2")
    rows = rows.join(full, "doc").repartition("node").sortWithinPartitions("node", "doc")

    @common.lean
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, "node"):
            side, comp, ids = g["side"].to_numpy(), g["comp"].to_numpy(np.int64), g["doc"].to_numpy(np.int64)
            x, y = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            sets = [np.frombuffer(s, np.uint64) for s in g["s"]]
            n = np.array([len(s) for s in sets])
            same = _shared(sets, x, y).astype(np.int64)
            i, j = np.nonzero((100 * same >= 85 * (n[x][:, None] + n[y][None, :] - same)) & (comp[x][:, None] != comp[y][None, :]))
            i, j = x[i], y[j]
            _, once = np.unique(np.stack([np.minimum(comp[i], comp[j]), np.maximum(comp[i], comp[j])]), axis=1, return_index=True)
            root: dict[int, int] = {}
            keep = []
            for k in once.tolist():
                one, two = _top(root, int(comp[i[k]])), _top(root, int(comp[j[k]]))
                if one != two:
                    root[max(one, two)] = min(one, two)
                    keep.append(k)
            if keep:
                yield pd.DataFrame({"a": np.minimum(ids[i[keep]], ids[j[keep]]), "b": np.maximum(ids[i[keep]], ids[j[keep]])})

    return rows.mapInPandas(link, "a long, b long")


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    wanted = pairs.select(F.col("a").alias("doc")).unionAll(pairs.select(F.col("b").alias("doc")))
    full = common.stored(_full_sets(wanted, reps, docs), "op9-sets")

    @common.lean
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch["sa"], batch["sb"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                good.append(100 * same >= 85 * (len(x) + len(y) - same))
            yield batch.loc[good, ["a", "b"]]

    joined = pairs.join(full.select(F.col("doc").alias("a"), F.col("s").alias("sa")), "a").join(full.select(F.col("doc").alias("b"), F.col("s").alias("sb")), "b")
    return joined.select("a", "b", "sa", "sb").mapInPandas(check, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc, comp) of every vertex in a link; comp is the least vertex it reaches."""
    both = common.stored(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "op9-links")
    comps = common.stored(both.groupBy(F.col("a").alias("doc")).agg(F.least(F.min("b"), F.col("doc")).alias("comp")), "op9-comps")
    while True:
        near = both.join(comps, both["b"] == comps["doc"]).groupBy("a").agg(F.min("comp").alias("near"))
        step = comps.join(near, comps["doc"] == near["a"]).select("doc", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = comps.select(F.col("doc").alias("comp"), F.col("comp").alias("further"))
        new = common.stored(step.join(up, "comp", "left").select("doc", "old", F.least("comp", "further").alias("comp")), "op9-comps")
        changed = new.where("comp < old").limit(1).count()
        comps = new.select("doc", "comp")
        if not changed:
            return comps


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``."""
    return grouped_documents(common.keyed(docs.select("doc_id", "text"), "op9-nameless")).drop("_v")


def grouped_documents(docs: DataFrame) -> DataFrame:
    """The same per row of a table that ``common.keyed`` returned, with its ``_v``."""
    signed = common.stored(signatures(docs), "op9-signed")
    filled = signed.where("n > 0")
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_v")
    # a vertex goes by its least row; copies: the most rows of its set that agree in doc_id and text
    documents = filled.groupBy("lo", "hi", "n", "doc_id", "_v").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    vertex = documents.groupBy("lo", "hi", "n").agg(F.min("row").alias("doc"), F.min(own).alias("first"), F.max("copies").alias("copies"))
    vertex = common.stored(vertex, "op9-vertex")
    reps = common.stored(vertex.select("doc", "copies").join(filled.select(F.col("row").alias("doc"), "doc_id", "_v", "n", "sketch"), "doc"), "op9-reps")
    small, large = tree_nodes(reps)
    large = common.stored(large, "op9-large")
    tried = common.stored(candidates(small.unionAll(dealt_blocks(large)), reps), "op9-forest")
    links = common.stored(confirmed(tried, reps, docs), "op9-links1")
    comps = components(links)
    rest = common.stored(unsettled(small, large, reps, comps), "op9-rest")
    if rest.limit(1).count():
        comps = components(links.unionAll(common.stored(settled(rest, reps, docs), "op9-links2")))
    heads = comps.join(vertex.select("doc", "first"), "doc").groupBy("comp").agg(F.min("first").alias("head"))
    classes = vertex.join(comps.join(heads, "comp").select("doc", "head"), "doc", "left").select("lo", "hi", "n", F.coalesce("head", "first").alias("head"))
    out = signed.select("doc_id", "_v", "n", "lo", "hi").join(classes, ["lo", "hi", "n"], "left")
    return out.select(
        "doc_id", "_v", F.col("n").alias("n_shingles"), F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (F.col("head").isNull() | own.eqNullSafe(F.col("head"))).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS sh FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
df AS (SELECT g, count(*) AS c FROM e GROUP BY g),
-- of two linked sets some shingle lies among the n - ceil(0.85 n) + 1 least frequent of either
p AS (SELECT doc_id, n, g FROM (SELECT doc_id, n, e.g, row_number() OVER (PARTITION BY doc_id ORDER BY c, e.g) AS r FROM e JOIN df ON e.g = df.g) WHERE r <= n - ceil(0.85 * n) + 1),
pairs AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
links AS (SELECT x, y FROM pairs JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y
  WHERE 100 * len(list_intersect(a.sh, b.sh)) >= 85 * (len(a.sh) + len(b.sh) - len(list_intersect(a.sh, b.sh)))),
r AS (SELECT doc_id AS v, doc_id AS u FROM s UNION SELECT r.v, l.y FROM r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l(x, y) ON r.u = l.x)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT v, min(u) AS component_id FROM r GROUP BY v) c ON c.v = s.doc_id
"""


@query("op9_near_duplicates", SQL)
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
