"""Pairs of raters in packed lists, and their sums.

Each rater of an item is a target that gets the list of the raters behind it in the order of users. A task lists the
targets of many items, deals them to cells by the blocks of the users and sends a cell its lists as one packet: differences of
user ids and ratings by their bytes, compressed. So a pair travels as some three to six bytes instead of a row.
Where each user leaves out its most common item, a cell also gets the heavy ratings of its users, packed alike.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The functions that run in Python workers travel whole: these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ratings that a task lists pairs of at a time, if no item has more.
SLICE = 1 << 19
# Pairs that are unpacked or spelled out at a time, but for those of one target or packet.
PAIRS = 1 << 20
# Pairs of a cell that are summed at a time; more are taken in parts by their right user.
PART = 1 << 22
# Bits of the filter of (user, item) in front of the search for heavy ratings.
FILTER = 1 << 20

PACKETS = "a int, b int, kind int, targets long, entries long, data binary, users binary, items binary"
_PACKETS = pa.schema(
    [("a", pa.int32()), ("b", pa.int32()), ("kind", pa.int32()), ("targets", pa.int64()), ("entries", pa.int64())]
    + [(c, pa.binary()) for c in ("data", "users", "items")]
)
LISTS, HEAVY = 0, 1


@dataclass(frozen=True)
class Listing:
    blocks: int  # of users
    grid: bool  # cells of two blocks instead of those of the target's
    cells: bool = False  # items come in cells of two blocks of their raters, [low, high, own]
    flag: str | None = None  # one user of a pair must carry it
    both: bool = False  # a target's list has the raters before it, too


# --- packing ---------------------------------------------------------------------------


def _bytes_of(x: np.ndarray) -> tuple[int, np.ndarray]:
    """(which of the 8 bytes of the values are used, these bytes by place)"""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T
    used = [i for i in range(8) if planes[i].any()]
    return sum(1 << i for i in used), np.ascontiguousarray(planes[used])


def _packed(columns: list[tuple[int, np.ndarray]], ranges: list[slice]) -> bytes:
    """The given range of each column of `_bytes_of`, compressed."""
    parts = [bytes(used for used, _ in columns)]
    parts += [planes[:, own].tobytes() for (_, planes), own in zip(columns, ranges, strict=True)]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpacked(data: bytes, sizes: list[int]) -> list[np.ndarray]:
    """Whole-number columns of these sizes."""
    raw = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    found, at = [], len(sizes)
    for used, size in zip(raw[: len(sizes)], sizes, strict=True):
        planes = np.zeros((size, 8), dtype=np.uint8)
        for i in range(8):
            if used >> i & 1:
                planes[:, i] = np.frombuffer(raw, np.uint8, size, at)
                at += size
        found.append(planes.reshape(-1).view(np.int64))
    return found


def _as_file(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([values], names=["x"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_file(data: bytes) -> list[pa.Array]:
    return pa.ipc.open_stream(data).read_all().column(0).chunks


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_PACKETS)


def _whole_numbers(kind: pa.DataType) -> bool:
    return pa.types.is_signed_integer(kind)


def _ratings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ratings, which are null)"""
    absent = np.asarray(column.is_null()) if column.null_count else np.zeros(len(column), dtype=bool)
    return pc.fill_null(column.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False), absent


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode().indices.to_numpy()


def _starts(*codes: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    change = np.zeros(max(0, len(codes[0]) - 1), dtype=bool)
    for code in codes:
        change |= code[1:] != code[:-1]
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(codes[0])), dtype=bool), change]))


def _runs(starts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first row, row behind the last) of the run of each row."""
    sizes = np.diff(np.append(starts, rows))
    return np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)


def listed(listing: Listing) -> Callable:
    """Packets of the pairs of ratings [item, user, rating, block, ...] that come in the order of items, cells and users."""
    keys = ["item", *(["low", "high"] if listing.cells else [])]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices that end where an item or cell ends."""
        held, rows, enough = [], 0, SLICE
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= enough:
                table = pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)[0]
                last = int(_starts(*(_codes(table.column(c)) for c in keys))[-1])
                if last:
                    yield table.slice(0, last)
                held, rows = [table.slice(last)], rows - last
                enough = max(SLICE, 2 * rows)
        if rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)[0]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            yield from _lists_of(batch, listing, keys)

    return lists


def _lists_of(rows: pa.RecordBatch, listing: Listing, keys: list[str]) -> Iterator[pa.RecordBatch]:
    key_codes = [_codes(rows.column(c)) for c in keys]
    names = rows.column("user")
    numbers = _whole_numbers(names.type)
    user = names.cast(pa.int64()).to_numpy() if numbers else _codes(names).astype(np.int64)
    block = rows.column("block").to_numpy().astype(np.int64)
    rating, absent = _ratings(rows.column("rating"))
    first, end = _runs(_starts(*key_codes), len(rows))
    own_first, own_end = _runs(_starts(*key_codes, user), len(rows))
    before = own_first - first if listing.both else np.zeros(len(rows), dtype=np.int64)
    counts = before + end - own_end
    targets = np.lexsort((user, block))
    targets = targets[counts[targets] > 0]
    wanted = np.asarray(rows.column(listing.flag)) if listing.flag else None
    low, high, own = (rows.column(c).to_numpy() for c in ("low", "high", "own")) if listing.cells else (None, None, None)
    ends = np.cumsum(counts[targets])
    at = 0
    while at < len(targets):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        some, at = targets[at:to], to
        sizes = counts[some]
        p = np.repeat(some, sizes)
        step = np.arange(len(p)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        q = np.where(step < before[p], first[p] + step, own_end[p] + step - before[p])
        kept = np.ones(len(p), dtype=bool)
        if wanted is not None:
            kept &= wanted[p] | wanted[q]
        if listing.cells:
            # In a cell of two blocks only pairs across them, as those within one have a cell of their own.
            kept &= (low[p] == high[p]) | (own[p] != own[q])
        p, q = p[kept], q[kept]
        cell = block[p] * listing.blocks
        if listing.grid:
            cell += block[q]
            order = np.argsort(cell, kind="stable")
            p, q, cell = p[order], q[order], cell[order]
        if not len(p):
            continue
        target = _starts(cell, p)
        row = p[target]
        packet = _starts(cell[target])
        u, v = user[row], user[q]
        # A list begins with the distance from its target, a packet with a user.
        du = np.diff(u, prepend=0)
        du[packet] = u[packet]
        dv = np.diff(v, prepend=0)
        dv[target] = v[target] - u
        sizes = np.diff(np.append(target, len(p)))
        if not numbers:
            du, dv = np.zeros_like(du), np.zeros_like(dv)
        by_target = [_bytes_of(x) for x in (du, sizes, rating[row].view(np.int64), absent[row].astype(np.int64))]
        by_entry = [_bytes_of(x) for x in (dv, rating[q].view(np.int64), absent[q].astype(np.int64))]
        packet_ends = np.append(packet[1:], len(target))
        entries = np.append(target, len(p))
        out = []
        for low_t, high_t in zip(packet.tolist(), packet_ends.tolist(), strict=True):
            low_e, high_e = int(entries[low_t]), int(entries[high_t])
            a, b = divmod(int(cell[low_e]), listing.blocks)
            ranges = [slice(low_t, high_t)] * len(by_target) + [slice(low_e, high_e)] * len(by_entry)
            text = None if numbers else _as_file(names.take(pa.array(np.concatenate([row[low_t:high_t], q[low_e:high_e]]))))
            out.append(
                {"a": a, "b": b, "kind": LISTS, "targets": high_t - low_t, "entries": high_e - low_e, "data": _packed(by_target + by_entry, ranges), "users": text}
            )
        yield _batch(out)


def heavy_packets(blocks: int) -> Callable:
    """Packets for cells of two blocks of heavy ratings [user, item, rating, top, own, others]: `own` is the block of the
    user, `others` are those it may meet."""

    def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users, items = batch.column("user"), batch.column("item")
            rating, absent = _ratings(batch.column("rating"))
            top = np.asarray(batch.column("top")).astype(np.int64)
            others = batch.column("others")
            row = np.repeat(np.arange(len(batch)), np.diff(others.offsets.to_numpy()))
            cell = batch.column("own").to_numpy().astype(np.int64)[row] * blocks + others.flatten().to_numpy()
            user, item = (c.cast(pa.int64()).to_numpy() if _whole_numbers(c.type) else None for c in (users, items))
            order = np.argsort(cell, kind="stable") if user is None else np.lexsort((user[row], cell))
            row, cell = row[order], cell[order]
            starts = _starts(cell)
            du = np.zeros(len(row), dtype=np.int64)
            if user is not None:
                du = np.diff(user[row], prepend=0)
                du[starts] = user[row[starts]]
            columns = [du, np.zeros_like(du) if item is None else item[row], rating[row].view(np.int64), absent[row].astype(np.int64), top[row]]
            columns = [_bytes_of(x) for x in columns]
            out = []
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(row)], strict=False):
                a, b = divmod(int(cell[low]), blocks)
                here = pa.array(row[low:high])
                packet = {"kind": HEAVY, "targets": high - low, "entries": 0, "data": _packed(columns, [slice(low, high)] * len(columns))}
                packet["users"] = None if user is not None else _as_file(users.take(here))
                packet["items"] = None if item is not None else _as_file(items.take(here))
                # The user may be on the left of a pair or on its right.
                out += [packet | {"a": a, "b": b}] + ([packet | {"a": b, "b": a}] if a != b else [])
            yield _batch(out)

    return packets


# --- summing ---------------------------------------------------------------------------


def summed(schema: pa.Schema, least: int) -> Callable:
    """The sums of the pairs of each cell, of packets that come in the order of cells."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        held, cell = [], None
        for batch in batches:
            for packet in batch.to_pylist():
                if cell != (packet["a"], packet["b"]):
                    if held:
                        yield held
                    held, cell = [], (packet["a"], packet["b"])
                held.append(packet)
        if held:
            yield held

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packets in cells(batches):
            lists = [p for p in packets if p["kind"] == LISTS]
            many = sum(p["entries"] for p in lists)
            if not many:
                continue
            heavy = _heavy([p for p in packets if p["kind"] == HEAVY], lists[0]["users"] is None)
            parts = -(-many // PART)
            for part in range(parts):
                yield from _sums_of(lists, heavy, part, parts, least, schema)

    return sums


def _lists(packets: list[dict], part: int, parts: int) -> tuple[pa.Array | None, list[np.ndarray]]:
    """(users by code or None where these are the ids, [u, v, r_u, r_v, absent_u, absent_v] of the pairs of a part)"""
    found, texts = [], []
    for p in packets:
        t, e = p["targets"], p["entries"]
        du, sizes, ru, au, dv, rv, av = _unpacked(p["data"], [t] * 4 + [e] * 3)
        if p["users"] is None:
            u = np.cumsum(du)
            run = np.cumsum(dv)
            ends = np.cumsum(sizes)
            start = np.where(ends > sizes, run[ends - sizes - 1], 0)
            v = run + np.repeat(u - start, sizes)
        else:
            # Taken from all users of the cell below.
            u, v = np.zeros(t, dtype=np.int64), np.zeros(e, dtype=np.int64)
            texts += _from_file(p["users"])
        pairs = [np.repeat(u, sizes), v, np.repeat(ru.view(np.float64), sizes), rv.view(np.float64), np.repeat(au, sizes) > 0, av > 0]
        if texts:
            pairs.append(sizes)
        elif parts > 1:
            kept = _mixed(v) % np.uint64(parts) == part
            pairs = [x[kept] for x in pairs]
        found.append(pairs)
    if not texts:
        return None, [np.concatenate(x) for x in zip(*found, strict=True)]
    coded = pa.chunked_array(texts).combine_chunks().dictionary_encode()
    code, at = coded.indices.to_numpy().astype(np.int64), 0
    for p, pairs in zip(packets, found, strict=True):
        sizes = pairs.pop()
        pairs[0] = np.repeat(code[at : at + p["targets"]], sizes)
        pairs[1] = code[at + p["targets"] : at + p["targets"] + p["entries"]]
        at += p["targets"] + p["entries"]
    pairs = [np.concatenate(x) for x in zip(*found, strict=True)]
    kept = _mixed(pairs[1]) % np.uint64(parts) == part
    return coded.dictionary, [x[kept] for x in pairs]


def _mixed(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


@dataclass
class Heavy:
    users: pa.Array  # sorted ids, or all users by code
    items: np.ndarray  # by row, as codes
    many: int  # items
    own: np.ndarray  # place of the user in `users`, by row
    rating: np.ndarray
    absent: np.ndarray
    top: np.ndarray  # by user: the row of the item it leaves out, -1 without one
    slots: np.ndarray  # sorted user * many + item
    order: np.ndarray  # their rows
    known: np.ndarray  # filter of the slots


def _heavy(packets: list[dict], numbers: bool) -> Heavy | None:
    if not packets:
        return None
    rows = [_unpacked(p["data"], [p["targets"]] * 5) for p in packets]
    _, item, rating, absent, top = (np.concatenate(x) for x in zip(*rows, strict=True))
    if packets[0]["items"] is None:
        item = np.unique(item, return_inverse=True)[1]
    else:
        item = _codes(pa.chunked_array([c for p in packets for c in _from_file(p["items"])]).combine_chunks()).astype(np.int64)
    if numbers:
        users, own = np.unique(np.concatenate([np.cumsum(du) for du, *_ in rows]), return_inverse=True)
        users = pa.array(users)
    else:
        coded = pa.chunked_array([c for p in packets for c in _from_file(p["users"])]).combine_chunks().dictionary_encode()
        users, own = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    many = int(item.max()) + 1
    slot = own * many + item
    order = np.argsort(slot, kind="stable")
    tops = np.full(len(users), -1)
    tops[own[top > 0]] = np.flatnonzero(top)
    known = np.zeros(FILTER, dtype=bool)
    known[_mixed(slot) % np.uint64(FILTER)] = True
    return Heavy(users, item, many, own, rating.view(np.float64), absent > 0, tops, slot[order], order, known)


def _added_back(heavy: Heavy, u: np.ndarray, v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """[(pairs, rows of u, rows of v)] of the left out items that both users of a pair rated; the users are places in `heavy`,
    -1 for others."""

    def found(user: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs where `user` has rated the item that `other` left out, its row and that of `other`."""
        drops = np.where(other >= 0, heavy.top[other], -1)
        pairs = np.flatnonzero((drops >= 0) & (user >= 0))
        wanted = user[pairs] * heavy.many + heavy.items[drops[pairs]]
        maybe = heavy.known[_mixed(wanted) % np.uint64(FILTER)]
        pairs, wanted = pairs[maybe], wanted[maybe]
        place = np.minimum(np.searchsorted(heavy.slots, wanted), len(heavy.slots) - 1)
        row = heavy.order[place]
        there = (heavy.slots[place] == wanted) & ~heavy.absent[row]
        return pairs[there], row[there], drops[pairs[there]]

    by_v, row_v, drop_u = found(v, u)
    by_u, row_u, drop_v = found(u, v)
    # An item that both left out is counted once.
    mine = heavy.top[u[by_u]]
    once = ~((mine >= 0) & (heavy.items[mine] == heavy.items[drop_v]))
    return [(by_v, drop_u, row_v), (by_u[once], row_u[once], drop_v[once])]


def _places(users: pa.Array, ids: np.ndarray, names: pa.Array | None) -> np.ndarray:
    """Where the users are among those of the heavy ratings, -1 for others."""
    if names is not None:
        place = pc.index_in(names, value_set=users).fill_null(-1).to_numpy().astype(np.int64)
        return place[ids]
    known = users.to_numpy()
    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    return np.where(known[at] == ids, at, -1)


def _sums_of(packets: list[dict], heavy: Heavy | None, part: int, parts: int, least: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    names, (u, v, *values) = _lists(packets, part, parts)
    if not len(u):
        return
    r, absent = values[:2], values[2:]
    # A pair is a number: the place of u among the left users, and v or its place.
    left, at_u = np.unique(u, return_inverse=True)
    least_v, width = int(v.min()), int(v.max()) - int(v.min()) + 1
    right = None
    if len(left) * width >= 1 << 62:
        right, at_v = np.unique(v, return_inverse=True)
        width = len(right)
    else:
        at_v = v - least_v
    key = at_u * width + at_v
    order = np.argsort(key)
    key = key[order]
    starts = _starts(key)
    n = np.diff(np.append(starts, len(key)))
    pair = key[starts]
    extra = []
    if heavy is not None:
        pu, pv = np.divmod(pair, width)
        place_u = _places(heavy.users, left, names)[pu]
        every_v, back = np.unique(pv, return_inverse=True)
        ids = every_v + least_v if right is None else right[every_v]
        extra = _added_back(heavy, place_u, _places(heavy.users, ids, names)[back])
    total = n.copy()
    for pairs, _, _ in extra:
        total[pairs] += 1
    kept = np.flatnonzero(total >= least)
    sizes = n[kept]
    at = np.repeat(np.arange(len(kept)), sizes)
    rows = order[np.repeat(starts[kept] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
    known = [~x[rows] for x in absent]
    r = [x[rows] for x in r]
    new = np.full(len(n), -1)
    new[kept] = np.arange(len(kept))
    columns = []
    for sides in ((0,), (1,), (0, 1), (0, 0), (1, 1)):
        there = np.logical_and.reduce([known[i] for i in sides])
        sums = np.bincount(at, np.where(there, np.prod([r[i] for i in sides], axis=0), 0.0), minlength=len(kept))
        missing = np.bincount(at, there, minlength=len(kept)) == 0
        for pairs, row_u, row_v in extra:
            mine = new[pairs] >= 0
            both = row_u[mine], row_v[mine]
            sums[new[pairs[mine]]] += np.prod([heavy.rating[both[s]] for s in sides], axis=0)
            missing[new[pairs[mine]]] |= np.logical_or.reduce([heavy.absent[both[s]] for s in sides])
        columns.append(pa.array(sums, mask=missing))
    pu, pv = np.divmod(pair[kept], width)
    pv = pv + least_v if right is None else right[pv]
    users = [pa.array(left[pu]), pa.array(pv)]
    if names is not None:
        users = [names.take(x) for x in users]
    columns = [*users, pa.array(total[kept]), *columns]
    table = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    for low in range(0, len(table), PAIRS // 8):
        yield table.slice(low, PAIRS // 8)
