"""Top lists for every customer without forming every candidate.

Order paths. A customer's scores are a weighted sum of lists: the products bought together with each product it has
(or held by each large order it reaches), less the edge-reuse terms of its own purchases. ``bounded_order_top_k``
reads only the head of each list, ordered by count. The first count left out bounds everything unseen, so a customer is
finished when no candidate that is incomplete or unseen can reach its k-th score; the others go on with longer
heads. A list that everybody shares costs its head per block of customers, not its length times the customers.
The lists are summed from whole orders and kept and sent packed, many to a row (``Lists``); ``path_lists``, ``own_terms`` and
``list_heads`` have the same in plain rows.

Ratings. ``rating_top_k`` passes best ratings on instead of pairing customers: a customer hands on its k + 1 best
products, a product keeps its 2k + 1 best of those with the best rating and the best from another customer,
and each customer reads the lists of the products it likes, leaving out what only itself handed on.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketgraph.operators import recommend as rec
from basketgraph.session import materialize, materialize_freed, task_slots

# Kinds of list: products bought together with a product; products of a large order; the customer's own edge-reuse terms.
TOGETHER, LARGE_ORDER, OWN = 0, 1, 2

# Heads of lists read in successive rounds. What is still open after the last one is scored from all term rows.
DEPTHS = (256, 4096, 65536)
# List entries that a task merges at a time, and beyond which one customer is scored from term rows instead.
BLOCK_ENTRIES = 2_000_000
CUSTOMER_ENTRIES = 1_000_000
# List entries sent to blocks before the files of the exchange leave.
ROUND_ENTRIES = 4_000_000_000
# Pairs of products that a task forms at a time; pairs of a part of the lists, and the least where there are fewer parts than partitions.
PAIR_ROWS = 1_000_000
PART_ENTRIES = 4_000_000
PART_LEAST = 100_000
# Rows of weights in a task: Spark would merge these well compressed rows into few tasks, which spill.
WEIGHT_ROWS = 2_000_000
# Rows of entries at a time where lists are taken apart.
ENTRY_ROWS = 500_000
# Stands for a line without a product.
NO_PRODUCT = 2**63 - 1
# Products handed on that a task ranks.
PASSED_ROWS = 1_000_000


# ---------------------------------------------------------------------------
# Order paths: lists, weights and own terms
# ---------------------------------------------------------------------------


def path_lists(mc: DataFrame, hot_order_products: int = rec.HOT_ORDER_PRODUCTS) -> tuple[DataFrame, DataFrame]:
    """(entries, weights) of the all-edge-triples term of ``recommend.order_path_scores``.

    entries: kind, key, product_key, n. weights: customer_key, kind, key, w. The score's first term
    for (customer, product) is the sum of ``w * n`` over the customer's lists.
    """
    size = mc.groupBy("order_key").agg(F.count(F.lit(1)).alias("n_products"))
    m = mc.join(size, "order_key")
    cold = m.where(F.col("n_products") <= hot_order_products)
    hot = m.where(F.col("n_products") > hot_order_products).select("order_key", "product_key", "m")
    w = mc.groupBy("customer_key", "product_key").agg(rec.exact_sum("m").alias("w"))

    left = cold.select("order_key", F.col("product_key").alias("key"), F.col("m").alias("mk"))
    right = cold.select("order_key", "product_key", "m")
    together = left.join(right, "order_key").groupBy("key", "product_key").agg(rec.exact_sum(F.col("mk") * F.col("m")).alias("n"))
    reach = w.join(hot, "product_key").groupBy("customer_key", "order_key").agg(rec.exact_sum(F.col("w") * F.col("m")).alias("w"))
    entries = together.select(F.lit(TOGETHER).alias("kind"), "key", "product_key", "n").unionByName(
        hot.select(F.lit(LARGE_ORDER).alias("kind"), F.col("order_key").alias("key"), "product_key", F.col("m").alias("n"))
    )
    weights = w.select("customer_key", F.lit(TOGETHER).alias("kind"), F.col("product_key").alias("key"), "w").unionByName(
        reach.select("customer_key", F.lit(LARGE_ORDER).alias("kind"), F.col("order_key").alias("key"), "w")
    )
    return entries, weights


def own_terms(mc: DataFrame) -> DataFrame:
    """customer_key, product_key, t: the edge-reuse terms of the score; all are negative."""
    size = mc.groupBy("order_key").agg(rec.exact_sum("m").alias("size"))
    deg = mc.groupBy("product_key").agg(rec.exact_sum("m").alias("deg"))
    return rec.corrections(mc, deg, size).groupBy("customer_key", "product_key").agg(rec.exact_sum("t").alias("t"))


def list_heads(entries: DataFrame, depth: int) -> DataFrame:
    """kind, key, products, counts (the first ``depth`` by count, then product), rest and rest_key: the next entry, if any."""
    place = Window.partitionBy("kind", "key").orderBy(F.col("n").desc(), F.col("product_key").asc())
    head = entries.withColumn("place", F.row_number().over(place)).where(F.col("place") <= depth + 1)
    held = head.groupBy("kind", "key").agg(F.sort_array(F.collect_list(F.struct("place", "product_key", "n"))).alias("e"))
    shown, beyond = F.slice("e", 1, depth), F.get("e", F.lit(depth))
    return held.select(
        "kind", "key", shown["product_key"].alias("products"), shown["n"].alias("counts"),
        F.coalesce(beyond["n"], F.lit(0)).alias("rest"), F.coalesce(beyond["product_key"], F.lit(0)).alias("rest_key"),
    )


# ---------------------------------------------------------------------------
# Order paths: packed lists
# ---------------------------------------------------------------------------


def _put(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, so that equal high bytes lie together; high bytes that are zero everywhere are left out."""
    codec, bits = pa.Codec("zstd", 1), np.ascontiguousarray(values, "<i8").view("<u8")
    width = (int(bits.max()).bit_length() + 7) // 8 if len(bits) else 0
    planes = [codec.compress(np.ascontiguousarray(bits.view(np.uint8)[i::8]), asbytes=True) for i in range(width)]
    return b"".join([struct.pack(f"<QB{width}I", len(bits), width, *map(len, planes)), *planes])


def _get(packed: memoryview, at: int) -> tuple[np.ndarray, int]:
    """(what ``_put`` got, where it ends)."""
    codec, (n, width) = pa.Codec("zstd", 1), struct.unpack_from("<QB", packed, at)
    at += 9 + 4 * width
    out = np.zeros(n, "<i8")
    for i, size in enumerate(struct.unpack_from(f"<{width}I", packed, at - 4 * width)):
        out.view(np.uint8)[i::8] = np.frombuffer(codec.decompress(packed[at : at + size], n), np.uint8)
        at += size
    return out, at


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences; small ones of either sign become small numbers."""
    step = np.diff(values.astype(np.int64, copy=False), prepend=np.int64(0))
    return (step << 1) ^ (step >> 63)


def _walked(steps: np.ndarray) -> np.ndarray:
    return np.cumsum((steps.view(np.uint64) >> np.uint64(1)).view(np.int64) ^ -(steps & 1))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: small steps cost little."""
    return _put(_steps(values))


def unpack(packed: bytes) -> np.ndarray:
    return _walked(_get(memoryview(packed), 0)[0])


class Lists(NamedTuple):
    """Lists by kind and key, one element for each list; their entries lie one list after the other, products in order.

    degree: edges of the product. rest, rest_key: the first entry by count, then product, that is left out of the list.
    """

    kind: np.ndarray
    key: np.ndarray
    size: np.ndarray
    degree: np.ndarray
    rest: np.ndarray
    rest_key: np.ndarray
    products: np.ndarray
    counts: np.ndarray

    def pack(self) -> bytes:
        return b"".join(_put(_steps(x) if name in ("key", "products") else x) for name, x in self._asdict().items())

    @classmethod
    def unpack(cls, packed) -> Lists:
        packed, at, out = memoryview(packed), 0, []
        for name in cls._fields:
            x, at = _get(packed, at)
            out.append(_walked(x) if name in ("key", "products") else x)
        return cls(*out)

    @classmethod
    def join(cls, parts: list[Lists]) -> Lists:
        return cls(*(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts, strict=True))) if parts else cls(*[np.zeros(0, np.int64)] * len(cls._fields))

    def take(self, at: np.ndarray) -> Lists:
        """The lists at these places."""
        entry = _entries(self.size, at)
        return Lists(*(x[at] for x in self[:6]), self.products[entry], self.counts[entry])

    def find(self, kind: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The places of lists by name."""
        order = np.lexsort((self.key, self.kind))
        out = np.zeros(len(key), np.int64)
        for of in np.unique(kind):
            among = order[slice(*np.searchsorted(self.kind[order], [of, of + 1]))]
            mine = kind == of
            out[mine] = among[np.minimum(np.searchsorted(self.key[among], key[mine]), len(among) - 1)]
        if (self.key[out] != key).any() or (self.kind[out] != kind).any():
            raise LookupError("a list is missing")
        return out

    def summed(self) -> Lists:
        """One list for each name, in order; one entry for each of its products. Only for lists that leave nothing out."""
        order, first = pair_order(self.kind, self.key)
        place = np.empty(len(order), np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        if max(self.degree.astype(float).sum(), self.counts.astype(float).sum()) >= 2**62:
            raise OverflowError("path count overflow")
        degree = np.add.reduceat(self.degree[order], first) if len(first) else self.degree
        at, products, counts = sum_entries(np.repeat(place, self.size), self.products, self.counts)
        none = np.zeros(len(first), np.int64)
        return Lists(self.kind[order][first], self.key[order][first], np.bincount(at, minlength=len(first)), degree, none, none, products, counts)

    def heads(self, depth: int) -> Lists:
        """The first ``depth`` entries of each list by count, then product."""
        rest, rest_key, kept = self.rest.copy(), self.rest_key.copy(), np.ones(len(self.products), bool)
        end = np.cumsum(self.size)
        for i in np.flatnonzero(self.size > depth):
            begin = end[i] - self.size[i]
            products, counts = self.products[begin : end[i]], self.counts[begin : end[i]]
            # entries with the count at the cut stand by product, so those above it are picked without sorting the list
            cut = np.partition(counts, len(counts) - depth - 1)[len(counts) - depth - 1]
            tied = np.flatnonzero(counts == cut)
            above = counts > cut
            last = tied[depth - int(above.sum())]
            rest[i], rest_key[i] = cut, products[last]
            kept[begin : end[i]] = above | ((counts == cut) & (np.arange(len(counts)) < last))
        return Lists(self.kind, self.key, np.minimum(self.size, depth), self.degree, rest, rest_key, self.products[kept], self.counts[kept])


def _entries(size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of the entries of the lists at ``at``, where ``size`` has the sizes of all lists."""
    length, start = size[at], (np.cumsum(size) - size)[at]
    return np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)


def _codes(groups: int, products: np.ndarray) -> tuple[np.ndarray, int, np.ndarray | None]:
    """(a number below width for each product, in the order of the products; width; the products by number, or None where the least is taken off)."""
    low, width = int(products.min(initial=0)), int(products.max(initial=0)) - int(products.min(initial=0)) + 1
    if groups * width < 2**52:
        return products - np.int64(low), width, None
    names, code = np.unique(products, return_inverse=True)
    return code, len(names), names


def pair_order(group: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by group, then product, where each distinct pair begins in it)."""
    code, width, _ = _codes(int(group.max(initial=0)) + 1, products)
    pair = group * np.int64(width) + code
    order = np.argsort(pair)
    return order, _first_of_runs(pair[order])


def _first_of_runs(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def sum_entries(group: np.ndarray, products: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each group and product, in this order, with the sum of the counts."""
    order, first = pair_order(group, products)
    at = order[first]
    return group[at], products[at], np.add.reduceat(counts[order], first) if len(first) else counts


# ---------------------------------------------------------------------------
# Order paths: lists from orders
# ---------------------------------------------------------------------------


def sized_orders(mc: DataFrame) -> DataFrame:
    """``mc`` with the size and the number of rows of each order, the rows of an order side by side in one partition.

    NO_PRODUCT stands for a line without a product: a path may end there, but none goes on, so it doesn't count in the size.
    """
    known = F.when(F.col("product_key") == NO_PRODUCT, F.raise_error(F.lit("product key out of range")).cast("long")).otherwise(F.col("product_key"))
    order = Window.partitionBy("order_key")
    named = mc.withColumn("product_key", F.coalesce(known, F.lit(NO_PRODUCT)))
    going_on = F.when(F.col("product_key") == NO_PRODUCT, F.lit(0)).otherwise(F.col("m"))
    return named.select("order_key", "customer_key", "product_key", "m", F.sum(going_on).over(order).alias("size"), F.count(F.lit(1)).over(order).alias("n_rows"))


def _part(kind, key, parts: int):
    return F.pmod(F.xxhash64(kind, key), F.lit(parts)).cast("int")


def _order_lists(order, product, m, rows, part, order_part, hot: int) -> Iterator[tuple[int, bytes]]:
    """(part, packed lists) of whole orders, whose rows lie side by side."""
    hold = product != NO_PRODUCT
    keys, first, name = np.unique(product[hold], return_index=True, return_inverse=True)
    degree = np.zeros(len(keys), np.int64)
    np.add.at(degree, name, m[hold])
    cold = rows <= hot
    begin = _first_of_runs(order[cold])
    length = np.diff(np.append(begin, int(cold.sum())))
    run = np.repeat(np.arange(len(begin)), length)[hold[cold]]
    entry = _entries(length, run)
    if float(m.max(initial=0)) ** 2 * len(entry) >= 2**62:
        raise OverflowError("path count overflow")
    counts = np.repeat(m[cold & hold], length[run]) * m[cold][entry]
    at, products, counts = sum_entries(np.repeat(name[cold[hold]], length[run]), product[cold][entry], counts)
    none = np.zeros(len(keys), np.int64)
    found, parts = [Lists(none, keys, np.bincount(at, minlength=len(keys)), degree, none, none, products, counts)], [part[hold][first]]
    if not cold.all():
        large, first, name = np.unique(order[~cold], return_index=True, return_inverse=True)
        at, products, counts = sum_entries(name, product[~cold], m[~cold])
        none = np.zeros(len(large), np.int64)
        found.append(Lists(none + LARGE_ORDER, large, np.bincount(at, minlength=len(large)), none, none, none, products, counts))
        parts.append(order_part[~cold][first])
    lists, parts = Lists.join(found), np.concatenate(parts)
    for to, places in _runs(parts):
        yield to, lists.take(places).pack()


def _runs(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, its places in order) of each distinct value."""
    order = np.argsort(values, kind="stable")
    for places in np.split(order, _first_of_runs(values[order])[1:]) if len(values) else []:
        yield int(values[places[0]]), places


STORED = "part int, lists binary"


def _store_orders(hot: int):
    """Rows of ``sized_orders`` to packed lists, one for each part and about PAIR_ROWS pairs, so that a product in many orders is summed here."""
    names = ("order_key", "product_key", "m", "n_rows", "part", "order_part")

    def slices(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        order, work = rows[0], np.cumsum(np.where(rows[3] <= hot, rows[3], 1))
        if (order[1:] < order[:-1]).any():
            raise RuntimeError("an order's rows are apart")
        if not len(order):
            return
        begin = _first_of_runs(order)
        cuts = np.unique(begin[np.searchsorted(begin, np.searchsorted(work, np.arange(0, int(work[-1]), PAIR_ROWS)), "right") - 1])
        for piece in zip(*(np.split(x, cuts[1:]) for x in rows), strict=True):
            found = [*_order_lists(*piece, hot)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["part", "lists"])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, work = [], 0
        for batch in batches:
            held.append([batch.column(x).to_numpy(zero_copy_only=False) for x in names])
            work += int(np.where(held[-1][3] <= hot, held[-1][3], 1).sum())
            if work >= PAIR_ROWS:
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                # the last order may go on in the next batch; a large one is not paired, so it may be cut
                end = len(rows[0]) if rows[3][-1] > hot else int(np.searchsorted(rows[0], rows[0][-1]))
                yield from slices([x[:end] for x in rows])
                held, work = [[x[end:] for x in rows]], int(rows[3][end:].sum())
        if held:
            yield from slices([np.concatenate(x) for x in zip(*held, strict=True)])

    return store


def _sum_part(found: pa.Table) -> pa.Table:
    """One packed row for a part, summed bit by bit, so that memory is bound by its lists and not by the orders they come from."""
    lists, waiting, n = Lists.join([]), [], 0
    for packed in found["lists"]:
        waiting.append(Lists.unpack(packed.as_buffer()))
        n += len(waiting[-1].products)
        if n >= max(PART_ENTRIES, len(lists.products)):
            lists, waiting, n = Lists.join([lists, *waiting]).summed(), [], 0
    return pa.table({"part": found["part"][:1], "lists": pa.array([Lists.join([lists, *waiting]).summed().pack()], pa.binary())})


SIZES = "kind int, key long, size long, degree long"


def _list_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("lists"):
            lists = Lists.unpack(packed.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(lists.kind, pa.int32()), *map(pa.array, (lists.key, lists.size, lists.degree))], names=["kind", "key", "size", "degree"])


ENTRIES = "kind int, key long, product_key long, n long"


def _list_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("lists"):
            lists = Lists.unpack(packed.as_buffer())
            of = np.repeat(np.arange(len(lists.size)), lists.size)
            for i in range(0, len(of), ENTRY_ROWS):
                at = slice(i, i + ENTRY_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(lists.kind[of[at]], pa.int32()), *map(pa.array, (lists.key[of[at]], lists.products[at], lists.counts[at]))], names=["kind", "key", "product_key", "n"])


SENT = "to_block long, lists binary"


def _send_heads(depth: int):
    """The heads that each block needs of a part's lists, packed together."""

    def send(wanted: pa.Table, stored: pa.Table) -> pa.Table:
        found = []
        if len(wanted):
            lists = Lists.join([Lists.unpack(x.as_buffer()) for x in stored["lists"]]).heads(depth)
            row = lists.find(wanted["kind"].to_numpy(), wanted["key"].to_numpy())
            found = [(to, lists.take(np.sort(row[places])).pack()) for to, places in _runs(wanted["block"].to_numpy())]
        return pa.table({"to_block": pa.array([x for x, _ in found], pa.int64()), "lists": pa.array([x for _, x in found], pa.binary())})

    return send


# ---------------------------------------------------------------------------
# Order paths: merging heads under bounds
# ---------------------------------------------------------------------------


def _sum_gains(customer: np.ndarray, products: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sum_entries``, where the gains are small by sorting one number for each entry."""
    n, least = int(customer.max(initial=0)) + 1, int(gain.min(initial=0))
    code, width, names = _codes(n, products)
    bits = (int(gain.max(initial=0)) - least).bit_length()
    if n * width << bits >= 2**62:
        return sum_entries(customer, products, gain)
    every = (customer * np.int64(width) + code << bits) + (gain - np.int64(least))
    every.sort()
    pair = every >> bits
    first = _first_of_runs(pair)
    total = np.add.reduceat(every & (2**bits - 1), first) + np.diff(np.append(first, len(pair))) * least if len(first) else gain
    pair = pair[first]
    owner = np.repeat(np.arange(n), np.diff(np.searchsorted(pair, np.arange(n + 1) * width)))
    code = pair - owner * width
    return owner, code + np.int64(products.min(initial=0)) if names is None else names[code], total


def merge_heads(customer: np.ndarray, products: np.ndarray, gain: np.ndarray, rest: np.ndarray, unseen: np.ndarray, unseen_key: np.ndarray, k: int):
    """Top ``k`` of several customers from entries of their lists.

    One element per entry: customer (0..n-1), product, gain (weight times count), rest (weight times the list's first
    count left out). ``unseen`` per customer: the sum of rest over its lists, which bounds any product it has not seen;
    ``unseen_key``: a product that reaches that bound has at least this key.
    Returns (customer, product, score) of the finished customers and the customers that need longer heads.
    """
    n = len(unseen)
    if np.abs(gain.astype(float)).sum() >= 2**62:
        raise OverflowError("path count overflow")
    if rest.any():
        order, first = pair_order(customer, products)
        owner, product = customer[order[first]], products[order[first]]
        low = np.add.reduceat(gain[order], first)
        high = low + unseen[owner] - np.add.reduceat(rest[order], first)
    else:
        owner, product, low = _sum_gains(customer, products, gain)
        high = low + unseen[owner]

    # candidates below a customer's k-th score leave before they are sorted
    part = np.searchsorted(owner, np.arange(n + 1))
    cut = np.ones(n, np.int64)
    for c in range(n):
        scores = low[part[c] : part[c + 1]]
        if len(scores) > k:
            cut[c] = max(np.partition(scores, len(scores) - k)[len(scores) - k], 1)
    likely = np.flatnonzero(low >= cut[owner])

    best = likely[np.lexsort((product[likely], -low[likely], owner[likely]))]
    begin = np.searchsorted(owner[best], np.arange(n))
    count = np.diff(np.append(begin, len(best)))
    full = count >= k
    kth = np.zeros(n, np.int64)
    kth_key = np.zeros(n, np.int64)
    tenth = best[(begin + k - 1)[full]]
    kth[full], kth_key[full] = low[tenth], product[tenth]

    least = np.maximum(kth, 1)
    tied_out = full & (unseen == kth) & (kth_key < unseen_key)
    open_ = (unseen >= least) & ~tied_out
    loose = (high > low) & (high >= least[owner])
    open_[owner[loose]] = True
    rank = np.arange(len(best)) - begin[owner[best]]
    kept = best[(rank < k) & ~open_[owner[best]]]
    return owner[kept], product[kept], low[kept], np.flatnonzero(open_)


def _merge_block(k: int):
    def merge(weights: pa.Table, sent: pa.Table) -> pa.Table:
        lists = Lists.join([Lists.unpack(x.as_buffer()) for x in sent["lists"]])
        who, customer = np.unique(weights["customer_key"].to_numpy(), return_inverse=True)
        kind, key, w, own = (weights[c].to_numpy() for c in ("kind", "key", "w", "own"))
        reads, owns = kind != OWN, kind != LARGE_ORDER
        row = lists.find(kind[reads], key[reads])
        c, weight, length, entry = customer[reads], w[reads], lists.size[row], _entries(lists.size, row)
        if len(row) and float(weight.max()) * max(float(x.max(initial=0)) for x in (lists.counts, lists.rest, lists.degree)) >= 2**61:
            raise OverflowError("path count overflow")
        own = own.copy()
        own[reads] -= lists.degree[row] * weight
        unseen, unseen_key = np.zeros(len(who), np.int64), np.full(len(who), -(2**63), np.int64)
        more = lists.rest[row] > 0
        np.add.at(unseen, c[more], (weight * lists.rest[row])[more])
        np.maximum.at(unseen_key, c[more], lists.rest_key[row][more])
        owner, product, score, open_ = merge_heads(
            np.concatenate([np.repeat(c, length), customer[owns]]), np.concatenate([lists.products[entry], key[owns]]),
            np.concatenate([np.repeat(weight, length) * lists.counts[entry], own[owns]]),
            np.concatenate([np.repeat(weight * lists.rest[row], length) if more.any() else np.zeros(len(entry), np.int64), np.zeros(int(owns.sum()), np.int64)]),
            unseen, unseen_key, k,
        )
        return pa.table({
            "customer_key": pa.array(np.concatenate([who[owner], who[open_]]), pa.int64()),
            "product_key": pa.concat_arrays([pa.array(product, pa.int64()), pa.nulls(len(open_), pa.int64())]),
            "score": pa.concat_arrays([pa.array(score, pa.int64()), pa.nulls(len(open_), pa.int64())]),
        })

    return merge


MERGED = "customer_key long, product_key long, score long"


def _of_customers(df: DataFrame, customers: DataFrame | None) -> DataFrame:
    return df if customers is None else df.join(customers, "customer_key", "left_semi")


def scores_from_terms(entries: DataFrame, weights: DataFrame, own: DataFrame) -> DataFrame:
    """customer_key, product_key, score from one row per term: distributed by (customer, product), for customers of any size."""
    terms = weights.join(entries, ["kind", "key"]).select("customer_key", "product_key", (F.col("w") * F.col("n")).alias("t"))
    scores = terms.unionByName(own).groupBy("customer_key", "product_key").agg(rec.exact_sum("t").alias("score"))
    return scores.where(F.col("score") > 0)


def customer_weights(sized: DataFrame, hot_order_products: int, large_orders: bool, tasks: int) -> DataFrame:
    """customer_key, kind, key, w, own: the weight of each list that a customer reads, and its edge-reuse term without the product's degree.

    The term of ``own_terms`` is ``own - degree * w``. A customer's rows lie side by side, which travels in fewer bytes, unless a customer
    has more rows than a task should get.
    """
    if sized.groupBy("customer_key").count().where(F.col("count") > WEIGHT_ROWS).isEmpty():
        sized = sized.repartition(tasks, "customer_key")
    product, m, size = F.col("product_key"), F.col("m"), F.col("size")
    ends = product == NO_PRODUCT
    reuse = F.when(ends, -m * size).otherwise(m * (F.lit(2) - size - m))
    w = sized.groupBy("customer_key", "product_key").agg(rec.exact_sum(F.when(ends, F.lit(0)).otherwise(m)).alias("w"), rec.exact_sum(reuse).alias("own"))
    weights = w.select("customer_key", F.when(ends, F.lit(OWN)).otherwise(F.lit(TOGETHER)).alias("kind"), product.alias("key"), "w", "own")
    if not large_orders:
        return weights.sortWithinPartitions("customer_key", "key")
    hot = sized.where(F.col("n_rows") > hot_order_products).select("order_key", "product_key", "m")
    reach = w.where(~ends).join(hot, "product_key").groupBy("customer_key", "order_key").agg(rec.exact_sum(F.col("w") * m).alias("w"))
    return weights.unionByName(reach.select("customer_key", F.lit(LARGE_ORDER).alias("kind"), F.col("order_key").alias("key"), "w", F.lit(0).cast("long").alias("own")))


def bounded_order_top_k(
    mc: DataFrame, k: int = rec.TOP_K, hot_order_products: int = rec.HOT_ORDER_PRODUCTS, depths: tuple[int, ...] = DEPTHS,
    block_entries: int = BLOCK_ENTRIES, customer_entries: int = CUSTOMER_ENTRIES, round_entries: int = ROUND_ENTRIES,
) -> DataFrame:
    """customer_key, product_key, score: ``top_k_per_customer(order_path_scores(mc))`` for integer keys, from heads of lists.

    Customers are dealt to blocks of about ``block_entries`` entries, and a block gets each head it needs once; blocks of about
    ``round_entries`` entries are served at a time, and the files of this exchange leave before the next.
    A customer of more than ``customer_entries`` entries, or still open after the last depth, is scored from term rows.
    """
    sized = materialize_freed(sized_orders(mc))
    is_hot = F.col("n_rows") > hot_order_products
    rows, pairs, hot_rows = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(~is_hot, F.col("n_rows"))), F.lit(0)), F.count(F.when(is_hot, 1))).first()
    parts = max(-(-(pairs + hot_rows) // PART_ENTRIES), min(int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs // PART_LEAST + 1))
    slots = 2 * task_slots(sized.sparkSession)
    named = sized.select("order_key", "product_key", "m", "n_rows", _part(F.lit(TOGETHER), F.col("product_key"), parts).alias("part"), _part(F.lit(LARGE_ORDER), F.col("order_key"), parts).alias("order_part"))
    stored = materialize_freed(named.mapInArrow(_store_orders(hot_order_products), STORED).groupBy("part").applyInArrow(_sum_part, STORED))
    weights = materialize_freed(customer_weights(sized, hot_order_products, hot_rows > 0, max(-(-rows // WEIGHT_ROWS), min(slots, rows // PART_LEAST + 1))))
    n_weights = weights.count()
    sizes = stored.mapInArrow(_list_sizes, SIZES)
    finished, large, todo = [], [], None
    for depth in depths:
        mine = _of_customers(weights, todo)
        read = sizes.select("kind", "key", F.least("size", F.lit(depth)).alias("n"), "degree")
        load = lambda of: of.join(read, ["kind", "key"]).groupBy("customer_key").agg(F.sum("n").alias("n"))  # noqa: B023, E731
        if todo is None and not hot_rows:
            # a product's list is read at most once for each of its edges, and by each customer
            lists = materialize_freed(mine.groupBy("customer_key").count())
            total = read.agg(F.sum(F.col("n") * F.least("degree", F.lit(lists.count())))).first()[0] or 0
            many = lists.where(F.col("count") > customer_entries // depth).select("customer_key")
            loads = None if many.isEmpty() else materialize_freed(load(_of_customers(mine, many)))
        else:
            loads = materialize_freed(load(mine))
            total = loads.where(F.col("n") <= customer_entries).agg(F.sum("n")).first()[0] or 0
        if loads is not None:
            large.append(loads.where(F.col("n") > customer_entries).select("customer_key"))
            mine = mine if large[-1].isEmpty() else mine.join(large[-1], "customer_key", "left_anti")
        blocks = -(-total // block_entries) or 1
        placed = mine.withColumn("block", F.pmod(F.xxhash64("customer_key"), F.lit(blocks)))
        step = max(round_entries // block_entries, 1)
        rows = n_weights * min(step, blocks) // blocks
        tasks = min(parts, max(-(-rows // WEIGHT_ROWS), slots))
        rounds = []
        for begin in range(0, blocks, step):
            now = placed.where(F.col("block").between(begin, begin + step - 1)) if blocks > step else placed
            reads = now.where(F.col("kind") != OWN).select(_part(F.col("kind"), F.col("key"), parts).alias("part"), "block", "kind", "key")
            sent = reads.repartition(tasks, "part").distinct().groupBy("part").cogroup(stored.groupBy("part")).applyInArrow(_send_heads(depth), SENT)
            merged = now.groupBy("block").cogroup(sent.groupBy("to_block")).applyInArrow(_merge_block(k), MERGED)
            rounds.append(materialize_freed(merged))
        merged = reduce(DataFrame.unionByName, rounds)
        finished.append(merged.where(F.col("product_key").isNotNull()))
        todo = merged.where(F.col("product_key").isNull()).select("customer_key")
        if todo.isEmpty():
            break
    rest = reduce(DataFrame.unionByName, [*large, todo])
    if not rest.isEmpty():
        rest = materialize_freed(rest)
        mine = materialize_freed(_of_customers(weights, rest))
        entries = stored.mapInArrow(_list_entries, ENTRIES).join(mine.select("kind", "key"), ["kind", "key"], "left_semi")
        own = mine.where(F.col("kind") != LARGE_ORDER).join(sizes, ["kind", "key"], "left")
        own = own.select("customer_key", F.col("key").alias("product_key"), (F.col("own") - F.coalesce("degree", F.lit(0)) * F.col("w")).alias("t"))
        finished.append(rec.top_k_per_customer(scores_from_terms(entries, mine.drop("own"), own), k))
    out = reduce(DataFrame.unionByName, finished)
    return out.withColumn("product_key", F.when(F.col("product_key") != NO_PRODUCT, F.col("product_key")))


# ---------------------------------------------------------------------------
# Ratings
# ---------------------------------------------------------------------------


def _first(df: DataFrame, by: str, rows: int, rating: str) -> DataFrame:
    """The ``rows`` best by rating, then product, per ``by``; cut in the map tasks first."""
    place = Window.partitionBy(by).orderBy(F.col(rating).desc(), F.col("p2").asc())
    return df.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= rows).drop("_place")


def rating_edges(feedback: DataFrame, sentiment: str = rec.POSITIVE) -> DataFrame:
    """customer_key, product_key, times, best: parallel edges of one sentiment and their best rating."""
    liked = feedback.where(F.col("sentiment") == sentiment)
    return liked.groupBy("customer_key", "product_key").agg(F.count(F.lit(1)).alias("times"), F.max("rating").alias("best"))


def own_best(edges: DataFrame, k: int = rec.TOP_K) -> DataFrame:
    """customer_key, best_products: the k + 1 products that a customer hands on."""
    each = edges.select("customer_key", F.col("product_key").alias("p2"), F.col("best").alias("rating"), "times")
    best = _first(each, "customer_key", k + 1, "rating")
    return best.groupBy("customer_key").agg(F.collect_list(F.struct("p2", "rating", "times")).alias("best_products"))


def product_lists(edges: DataFrame, best: DataFrame, k: int = rec.TOP_K) -> DataFrame:
    """product_key, list: the 2k + 1 best products handed on through it, with the giver of the best rating and the best of another giver."""
    passed = edges.join(best, "customer_key").select("customer_key", "product_key", "times", F.explode("best_products").alias("b"))
    passed = passed.where((F.col("b.p2") != F.col("product_key")) | (F.col("times") >= 2))
    passed = passed.select("product_key", F.col("b.p2").alias("p2"), F.col("b.rating").alias("rating"), "customer_key")
    # many small tasks: Spark would merge these well compressed rows into few, and sort them before the shuffle too
    tasks = max(-(-edges.count() * (k + 1) // PASSED_ROWS), int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    passed = passed.repartition(tasks, "product_key", "p2")
    givers = Window.partitionBy("product_key", "p2").orderBy(F.col("rating").desc(), F.col("customer_key").asc())
    two = passed.withColumn("_place", F.row_number().over(givers)).where(F.col("_place") <= 2)
    is_first = F.col("_place") == 1
    kept = two.groupBy("product_key", "p2").agg(
        F.max(F.when(is_first, F.col("rating"))).alias("rating"), F.max(F.when(is_first, F.col("customer_key"))).alias("giver"),
        F.max(F.when(~is_first, F.col("rating"))).alias("other_rating"), F.max(~is_first).alias("has_other"),
    )
    kept = _first(kept, "product_key", 2 * k + 1, "rating")
    return kept.groupBy("product_key").agg(F.collect_list(F.struct("p2", "rating", "giver", "other_rating", "has_other")).alias("list"))


def read_product_lists(edges: DataFrame, best: DataFrame, lists: DataFrame, k: int = rec.TOP_K) -> DataFrame:
    """customer_key, product_key, score for the customers of ``edges``; the top k of them are right, further ones may be missing."""
    mine = lambda e: e["giver"] == F.col("customer_key")
    score = lambda e: F.when(mine(e), e["other_rating"]).otherwise(e["rating"])
    offered = F.transform(F.filter("list", lambda e: ~mine(e) | e["has_other"]), lambda e: F.struct(score(e).isNull().alias("unrated"), (-score(e)).alias("low"), e["p2"].alias("p2")))
    # beyond the k best of one list, k better ones stand before any other
    read = edges.select("customer_key", "product_key").join(lists, "product_key").select("customer_key", F.explode(F.slice(F.array_sort(offered), 1, k)).alias("e"))
    read = read.select("customer_key", F.col("e.p2").alias("product_key"), (-F.col("e.low")).alias("score"))
    twice = edges.where(F.col("times") >= 2).groupBy("customer_key").agg(F.count(F.lit(1)).alias("doubles"), F.min("product_key").alias("double"))
    own = best.join(twice, "customer_key").select("customer_key", "doubles", "double", F.explode("best_products").alias("b"))
    own = own.where((F.col("doubles") >= 2) | (F.col("b.p2") != F.col("double")) | (F.col("b.times") >= 3))
    own = own.select("customer_key", F.col("b.p2").alias("product_key"), F.col("b.rating").alias("score"))
    return read.unionByName(own).groupBy("customer_key", "product_key").agg(F.max("score").alias("score"))


def rating_top_k(feedback: DataFrame, k: int = rec.TOP_K, sentiment: str = rec.POSITIVE) -> DataFrame:
    """customer_key, product_key, score for every customer over ``c -f1-> p1 <-f2- c2 -f3-> p2``: best rating of f3, top ``k``.

    All edges carry ``sentiment`` and the three are distinct. Work is linear in the edges:

    * A customer passes at most k + 1 products on to each product it likes. f3 must not be f2, which costs one product unless
      the customer likes it twice; k others of the same customer rank before anything further down.
    * A product keeps its 2k + 1 best. A reader leaves out what it handed on itself (at most k + 1) unless another
      customer handed it on too, so k full entries remain before anything further down.
    * c2 may be c itself where c likes p1 twice: then f3 is any third edge.
    """
    edges = materialize(rating_edges(feedback, sentiment))
    best = materialize(own_best(edges, k))
    lists = materialize(product_lists(edges, best, k))
    return rec.top_k_per_customer(read_product_lists(edges, best, lists, k), k)
