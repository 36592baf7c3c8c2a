"""Removal of repeated substrings by prefix-free parsing.

Rolling-hash triggers cut every text into phrases. A trigger is the ``trigger``-byte
string with the least hash in a window of ``length`` bytes, so it depends on the
window's content alone, and equal windows have their trigger at the same place. A
phrase is a run of windows with one trigger; with its last window it reaches
``length - 1`` bytes into the next, which is the overlap that makes phrases prefix
free. The dictionary is the set of distinct phrases, each with its first place; the
parse is the list of phrases of every document.

No suffix array is built, neither of the dictionary nor of the parse: whether two windows
are equal matters, not their order, and a window lies within one phrase. Every occurrence
of a phrase but the first is a repeat as a whole, by the parse. The first occurrences of
different phrases with one trigger may share some of their windows; their bytes are
fetched, two hashes of each of their windows are sorted with their places, and equal
neighbours are the windows that stand earlier elsewhere. For highly repetitive text the
dictionary is small against the corpus, and only its windows are ever sorted.

Phrases travel as packed numbers by trigger range. Each task sends a phrase once, with
its first place there; further places are repeats already, so the inner phrases of a
passage in a third of all documents give one entry per task. At its edges every document
has an own phrase with the passage's first or last trigger. Such a trigger is split: a
task that sees ``MANY`` phrases of one deals them by their content and tells the
trigger's range, and windows of these phrases are compared by range of the window's hash,
after each task has kept the first place of each. Equal windows have one trigger, so
all that can be equal goes one way. Texts are shuffled only where phrases must be
fetched or bytes removed, behind a filter of bounded size; the rest passes straight
through. Phrases are told apart by 112 bits of hashes, windows by 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opsflow.llm.base import query, table
from opsflow.llm.exact_dedup import KEY, split_by_keys, with_key
from opsflow.llm.textbytes import U, byte_slices, mix64, pack_ascending, unpack_ascending
from opsflow.session import settle

BUFFER = 300_000
RANGE_PHRASES = 400_000
#: Phrases whose bytes are handed on at once.
FETCH = 20_000
#: Different phrases of one trigger, in a task's buffer or in the trigger's range, from which it is split.
MANY, MANY_IN_RANGE = 64, 1000
RANGE_WINDOWS = 1_000_000
#: Windows of split triggers that a task holds at once.
HELD_WINDOWS = 1_000_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPAN = np.dtype([("start", "<u4"), ("windows", "<u4")])
NEED = np.dtype([("start", "<u4"), ("windows", "<u2"), ("split", "<u2"), ("trigger", "<u8")])


class Rolling:
    """Polynomial hashes (mod 2**64) of any substring, from running sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << max(10, (n - 1).bit_length())
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base & ((1 << 64) - 1), np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + U(1)) * self.up[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * self.down[start])


def least_ahead(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``keys[i : i + width]`` for every ``i`` that has as many."""
    have, least = 1, keys
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def phrases(data: np.ndarray, offsets: np.ndarray, length: int, trigger: int, rolling: tuple[Rolling, Rolling]):
    """``row, start, windows, trigger hash, content hash`` of every phrase of the texts."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    one, two = rolling
    sums, other = one.sums(data), two.sums(data)
    at = np.arange(len(data) - trigger + 1)
    grams = one.of(sums, at, at + trigger)
    # the position in the low bits makes the leftmost of equal hashes the least
    low = U(max(20, len(data).bit_length()))
    keys = (grams >> low << low) | at.astype(np.uint64)
    anchor = (least_ahead(keys, length - trigger + 1) & ((U(1) << low) - U(1))).astype(np.int64)
    window = np.arange(len(anchor))
    row = np.searchsorted(offsets, window, "right") - 1
    inside = window + length <= offsets[row + 1]
    window, anchor, row = window[inside], anchor[inside], row[inside]
    if not len(window):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))))
    count = np.diff(np.append(first, len(window)))
    start = window[first]
    content = two.of(other, start, start + count + length - 1)
    # least hashes crowd at the low end: scrambled again, triggers spread over all ranges
    return row[first], start - offsets[row[first]], count, mix64(~grams[anchor[first]]), content


class Places:
    """Documents by key (id, whether it is null, hash of the text) and their order."""

    DTYPE = np.dtype([("null", "?"), ("id", "<i8"), ("hash", "<i8")])

    @staticmethod
    def order(places: np.ndarray) -> np.ndarray:
        return np.lexsort((places["hash"], places["id"], places["null"]))


PACKET_NAMES = ("places", "at", "start", "windows", "trigger", "content", "told")
PACKET = "part long, repeats boolean, " + ", ".join(f"{c} binary" for c in PACKET_NAMES)
PACKET_SCHEMA = pa.schema([("part", pa.int64()), ("repeats", pa.bool_())] + [(c, pa.binary()) for c in PACKET_NAMES])


def _parse(length: int, trigger: int, bits: int, buffer: int, many: int):
    def flush(held: list, places: np.ndarray, task_salt: int) -> Iterator[dict]:
        at, start, windows, gram, content = (np.concatenate(x) for x in zip(*held))
        content = content >> U(16)
        # rows equal in id and text are one place, also where the buffer holds both
        places, merged = np.unique(places, return_inverse=True)
        at = merged[at]
        rank = np.empty(len(places), np.int64)
        rank[Places.order(places)] = np.arange(len(places))
        order = np.lexsort((start, rank[at], content, gram))
        at, start, windows, gram, content = at[order], start[order], windows[order], gram[order], content[order]
        new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])))
        # one row that stands twice in the corpus is no repeat of itself
        same = np.concatenate(([False], (at[1:] == at[:-1]) & (start[1:] == start[:-1]) & ~new[1:]))
        part = (gram >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(gram), np.int64)

        # triggers of many phrases: these are dealt by content, the trigger's range is told
        first_of = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        distinct = np.add.reduceat(new.astype(np.int64), first_of)
        split = np.repeat(distinct >= many, np.diff(np.append(first_of, len(gram))))
        told = gram[first_of[distinct >= many]]
        told_part = (told >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(told), np.int64)
        by_content = (content >> U(48 - bits)).astype(np.int64) if bits else np.zeros(len(gram), np.int64)

        def packet(key: int, repeats: bool, some: np.ndarray, told: np.ndarray = gram[:0]) -> dict:
            used, local = np.unique(at[some], return_inverse=True)
            body = np.ascontiguousarray(content[some]).view(np.uint8).reshape(-1, 8)[:, :6]
            return {
                "part": key, "repeats": repeats, "places": places[used].tobytes(), "at": local.astype(np.uint32 if len(used) >> 16 else np.uint16).tobytes(),
                "start": start[some].astype(np.uint32).tobytes(), "windows": windows[some].astype(np.uint16).tobytes(),
                "trigger": b"" if repeats else pack_ascending(gram[some]), "content": b"" if repeats else body.tobytes(),
                "told": told.tobytes(),
            }

        firsts = np.flatnonzero(new & ~split)
        for p in np.union1d(part[firsts], told_part):
            low, high = np.searchsorted(part[firsts], [p, p + 1])
            yield packet(int(p), False, firsts[low:high], told[told_part == p])
        spread = np.flatnonzero(new & split)
        for p in np.unique(by_content[spread]):
            some = spread[by_content[spread] == p]
            yield packet(int(p), False, some, np.unique(gram[some]))
        again = np.flatnonzero(~new & ~same)
        if len(again):
            yield packet(task_salt % (1 << bits), True, again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = tuple(Rolling(b) for b in BASES)
        held, known, docs, count, turn = [], [], 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2).to_numpy()
            places = np.zeros(len(batch), Places.DTYPE)
            places["null"] = ids.is_null().to_numpy(zero_copy_only=False)
            places["id"] = ids.fill_null(0).to_numpy()
            places["hash"] = hashes
            for rows, data, offsets in byte_slices(batch.column(1)):
                row, start, windows, gram, content = phrases(data, offsets, length, trigger, rolling)
                if len(row):
                    held.append((row + docs, start, windows, gram, content))
                    count += len(row)
                known.append(places[rows])
                docs += rows.stop - rows.start
                if count > buffer:
                    yield pa.RecordBatch.from_pylist(list(flush(held, np.concatenate(known), turn)), PACKET_SCHEMA)
                    held, known, docs, count, turn = [], [], 0, 0, turn + 1
        if count:
            yield pa.RecordBatch.from_pylist(list(flush(held, np.concatenate(known), turn)), PACKET_SCHEMA)

    return run


FOUND = "bucket long, places binary, n_repeats binary, repeats binary, n_needs binary, needs binary"
FOUND_SCHEMA = pa.schema(
    [("bucket", pa.int64())] + [(c, pa.binary()) for c in ("places", "n_repeats", "repeats", "n_needs", "needs")]
)
MARKED = "id long, null boolean, hash long, repeats binary, needs binary, n_split long"
MARKED_SCHEMA = pa.schema(
    [("id", pa.int64()), ("null", pa.bool_()), ("hash", pa.int64()), ("repeats", pa.binary()), ("needs", pa.binary()), ("n_split", pa.int64())]
)


def _by_bucket(places: np.ndarray, repeats: tuple, needs: tuple, bits: int) -> pa.Table:
    """Repeated spans and needed phrases of documents, packed per bucket of documents."""
    bucket = mix64(places["hash"].view(np.uint64) ^ places["id"].astype(np.uint64)) >> U(64 - bits) if bits else np.zeros(len(places), np.uint64)
    counts, sorted_ = [], []
    for at, records in (repeats, needs):
        counts.append(np.bincount(at, minlength=len(places)).astype(np.uint32))
        sorted_.append((records[np.argsort(at, kind="stable")], np.concatenate(([0], np.cumsum(counts[-1], dtype=np.int64)))))
    has = np.flatnonzero((counts[0] > 0) | (counts[1] > 0))
    out = []
    for b in np.unique(bucket[has]):
        docs = has[bucket[has] == b]
        row = {"bucket": int(b), "places": places[docs].tobytes()}
        for name, count, (records, first) in zip(("repeats", "needs"), counts, sorted_):
            row[f"n_{name}"] = count[docs].tobytes()
            row[name] = b"".join(records[first[d] : first[d + 1]].tobytes() for d in docs.tolist())
        out.append(row)
    return pa.Table.from_pylist(out, FOUND_SCHEMA)


def _by_place(group: pa.Table) -> pa.Table:
    """One row per document of a bucket: its repeated spans and the phrases needed."""
    out: dict[bytes, list[list[bytes]]] = {}
    width = Places.DTYPE.itemsize
    for r in group.to_pylist():
        places = r["places"]
        keys = [places[i : i + width] for i in range(0, len(places), width)]
        for column, (name, kind) in enumerate((("repeats", SPAN), ("needs", NEED))):
            at = 0
            for key, n in zip(keys, np.frombuffer(r[f"n_{name}"], np.uint32).tolist()):
                out.setdefault(key, [[], []])[column].append(r[name][at : at + n * kind.itemsize])
                at += n * kind.itemsize
    own = np.frombuffer(b"".join(out), Places.DTYPE)
    needed = [np.frombuffer(b"".join(v[1]), NEED) for v in out.values()]
    return pa.Table.from_arrays(
        [
            pa.array(own["id"]), pa.array(own["null"]), pa.array(own["hash"]),
            pa.array([b"".join(v[0]) for v in out.values()], pa.binary()), pa.array([b"".join(v[1]) for v in out.values()], pa.binary()),
            pa.array([int(x["windows"][x["split"] > 0].sum(dtype=np.int64)) for x in needed], pa.int64()),
        ],
        schema=MARKED_SCHEMA,
    )


def _spans(start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), SPAN)
    out["start"], out["windows"] = start, windows
    return out


def _dictionary(bits: int, many: int):
    """First and further places of the phrases of one trigger range."""
    return lambda group: _sorted_phrases(group, bits, many)


def _sorted_phrases(group: pa.Table, bits: int, many: int) -> pa.Table:
    rows = group.to_pylist()
    opened, base, all_places = {True: [], False: []}, 0, []
    for r in rows:
        places = np.frombuffer(r["places"], Places.DTYPE)
        at = np.frombuffer(r["at"], np.uint32 if len(places) >> 16 else np.uint16).astype(np.int64) + base
        start, windows = np.frombuffer(r["start"], np.uint32), np.frombuffer(r["windows"], np.uint16)
        if r["repeats"]:
            gram = content = np.zeros(0, np.uint64)
        else:
            gram = unpack_ascending(r["trigger"])
            wide = np.zeros((len(gram), 8), np.uint8)
            wide[:, :6] = np.frombuffer(r["content"], np.uint8).reshape(-1, 6)
            content = wide.view(np.uint64).ravel()
        opened[r["repeats"]].append((at, start, windows, gram, content))
        all_places.append(places)
        base += len(places)
    # the same document may come in several packets
    places, merged = np.unique(np.concatenate(all_places), return_inverse=True)
    rank = np.empty(len(places), np.int64)
    rank[Places.order(places)] = np.arange(len(places))

    def joined(kind: bool) -> list[np.ndarray]:
        if not opened[kind]:
            return [np.zeros(0, t) for t in (np.int64, np.uint32, np.uint16, np.uint64, np.uint64)]
        at, *rest = (np.concatenate(x) for x in zip(*opened[kind]))
        return [merged[at], *rest]

    at, start, windows, gram, content = joined(False)
    order = np.lexsort((start, rank[at], content, gram))
    at, start, windows, gram, content = at[order], start[order], windows[order], gram[order], content[order]
    n = len(at)
    trigger_new = np.ones(n, bool)
    trigger_new[1:] = gram[1:] != gram[:-1]
    first = trigger_new.copy()
    first[1:] |= content[1:] != content[:-1]
    same = np.zeros(n, bool)
    same[1:] = ~first[1:] & (at[1:] == at[:-1]) & (start[1:] == start[:-1])
    again = ~first & ~same
    distinct = np.add.reduceat(first.astype(np.int64), np.flatnonzero(trigger_new)) if n else np.zeros(0, np.int64)
    times = np.diff(np.append(np.flatnonzero(trigger_new), n)) if n else distinct
    # only a range that is dealt by trigger sees all its phrases that no task has split
    told = np.isin(gram, np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["told"], np.uint64) for r in rows)]))
    split = told | np.repeat(distinct >= many, times)
    need = first & (split | np.repeat(distinct > 1, times))
    needs = np.zeros(int(need.sum()), NEED)
    needs["start"], needs["windows"], needs["split"], needs["trigger"] = start[need], windows[need], split[need], gram[need]
    more_at, more_start, more_windows, _, _ = joined(True)
    repeats = _spans(np.concatenate((start[again], more_start)), np.concatenate((windows[again], more_windows)))
    return _by_bucket(places, (np.concatenate((at[again], more_at)), repeats), (at[need], needs), bits)


FETCHED = (
    "part long, trigger long, id long, null boolean, hash long, start long, windows long, bytes binary, "
    "places binary, at binary, where binary, high binary, low binary"
)
FETCHED_NAMES = [f.split()[0] for f in FETCHED.split(", ")]
FETCHED_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 6]


def _window_hashes(data: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Phrase, place within it and two hashes of every window of phrases that stand in a row in ``data``."""
    begin = np.concatenate(([0], np.cumsum(windows + length - 1)[:-1]))
    which = np.repeat(np.arange(len(windows)), windows)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    position = begin[which] + inner
    one, two = (Rolling(b) for b in BASES)
    return which, inner, one.of(one.sums(data), position, position + length), two.of(two.sums(data), position, position + length)


def _first_windows(high: np.ndarray, low: np.ndarray, at: np.ndarray, where: np.ndarray, places: np.ndarray):
    """Order by hashes and place, whether a row begins a run of equal windows, and whether it stands elsewhere."""
    rank = np.empty(len(places), np.int64)
    rank[Places.order(places)] = np.arange(len(places))
    order = np.lexsort((where, rank[at], low, high))
    h, l = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    return order, new, _not_first(new, at[order], where[order])


def _fetch(length: int, bits: int, window_bits: int):
    """Phrases with their bytes by trigger range, and windows of split triggers by range of their hash.

    Of equal windows of split triggers a task sends the first by hash; the others are
    repeats already and go along without hashes.
    """

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * len(FETCHED_TYPES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FETCHED_TYPES)], names=FETCHED_NAMES)

    def packets(held: list[tuple]) -> list[tuple]:
        keys, starts, windows, raw = zip(*held)
        places = np.array(list(keys), Places.DTYPE)
        places, own = np.unique(places, return_inverse=True)
        which, inner, high, low = _window_hashes(np.frombuffer(b"".join(raw), np.uint8), np.array(windows), length)
        at, where = own[which], np.array(starts)[which] + inner
        order, new, later = _first_windows(high, low, at, where, places)
        at, where, high, low = at[order], where[order], high[order], low[order]

        def packet(part: int, some: np.ndarray, hashed: bool) -> tuple:
            used, local = np.unique(at[some], return_inverse=True)
            hashes = (high[some].tobytes(), low[some].tobytes()) if hashed else (b"", b"")
            return (
                (1 << bits) + part, 0, 0, False, 0, 0, 0, None,
                places[used].tobytes(), local.astype(np.uint32).tobytes(), where[some].astype(np.uint32).tobytes(), *hashes,
            )

        firsts = np.flatnonzero(new)
        part = (high[firsts] >> U(64 - window_bits)).astype(np.int64) if window_bits else np.zeros(len(firsts), np.int64)
        edges = np.searchsorted(part, np.append(np.unique(part), part[-1] + 1))
        out = [packet(int(part[a]), firsts[a:b], True) for a, b in zip(edges[:-1], edges[1:])]
        again = np.flatnonzero(later)
        if len(again):
            spread = int(low[0] % U(1 << window_bits))
            out.append(packet(spread, again[np.lexsort((where[again], at[again]))], False))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[tuple] = []
        n_held = 0
        for batch in batches:
            for id_, null, hash_, text, lists in zip(*(batch.column(i) for i in range(5))):
                own, data = (id_.as_py(), null.as_py(), hash_.as_py()), (text.as_py() or "").encode()
                for needs in lists.as_py():
                    for start, windows, split, gram in np.frombuffer(needs, NEED).tolist():
                        body = data[start : start + windows + length - 1]
                        if split:
                            held.append(((own[1], own[0], own[2]), start, windows, body))
                            n_held += windows
                        else:
                            part = gram >> (64 - bits) if bits else 0
                            signed = gram - (1 << 64) if gram >> 63 else gram
                            out.append((part, signed, *own, start, windows, body, *[None] * 5))
                    if len(out) >= FETCH:
                        yield rows(out)
                        out = []
                    if n_held >= HELD_WINDOWS:
                        yield rows(packets(held))
                        held, n_held = [], 0
        if held:
            yield rows(packets(held))
        yield rows(out)

    return run


def _not_first(new: np.ndarray, at: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Rows of sorted runs (each begins at ``new``) at another place than the run's first row."""
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (at != at[head]) | (where != where[head])


def _sorted_windows(length: int, bits: int):
    """Windows of one trigger range, or of one range of window hashes, that stand earlier elsewhere."""

    def found(places: np.ndarray, doc: np.ndarray, where: np.ndarray) -> pa.Table:
        # a row that stands twice has each place twice
        doc, where = np.unique(np.stack((doc.astype(np.int64), where.astype(np.int64))), axis=1) if len(doc) else (doc, where)
        edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (where[1:] != where[:-1] + 1)))) if len(doc) else np.zeros(0, int)
        spans = _spans(where[edge], np.diff(np.append(edge, len(doc))))
        return _by_bucket(places, (doc[edge], spans), (np.zeros(0, np.int64), np.zeros(0, NEED)), bits)

    def of_phrases(group: pa.Table) -> pa.Table:
        places = np.zeros(len(group), Places.DTYPE)
        places["null"] = group.column("null").to_numpy()
        places["id"], places["hash"] = group.column("id").to_numpy(), group.column("hash").to_numpy()
        places, at = np.unique(places, return_inverse=True)
        start, windows = group.column("start").to_numpy(), group.column("windows").to_numpy()
        data = np.frombuffer(b"".join(group.column("bytes").to_pylist()), np.uint8)
        # equal windows have equal triggers
        which, inner, high, low = _window_hashes(data, windows, length)
        at, where = at[which], start[which] + inner
        order, _, later = _first_windows(high, low, at, where, places)
        return found(places, at[order][later], where[order][later])

    def of_split(group: pa.Table) -> pa.Table:
        hashed, again, all_places, base = [], [], [], 0
        for r in group.select(FETCHED_NAMES[8:]).to_pylist():
            places = np.frombuffer(r["places"], Places.DTYPE)
            own = np.frombuffer(r["at"], np.uint32).astype(np.int64) + base, np.frombuffer(r["where"], np.uint32)
            if r["high"]:
                hashed.append((*own, np.frombuffer(r["high"], np.uint64), np.frombuffer(r["low"], np.uint64)))
            else:
                again.append(own)
            all_places.append(places)
            base += len(places)
        places, merged = np.unique(np.concatenate(all_places), return_inverse=True)
        none = np.zeros(0, np.int64)
        doc, where = (np.concatenate(x) for x in zip(*again)) if again else (none, none)
        doc = merged[doc]
        if hashed:
            at, starts, high, low = (np.concatenate(x) for x in zip(*hashed))
            at = merged[at]
            order, _, later = _first_windows(high, low, at, starts, places)
            doc, where = np.concatenate((doc, at[order][later])), np.concatenate((where, starts[order][later]))
        return found(places, doc, where)

    return lambda group: (of_split if group.column("part")[0].as_py() >> bits else of_phrases)(group.combine_chunks())


def _cut(data: np.ndarray, spans: np.ndarray, length: int) -> tuple[np.ndarray, int, int]:
    """Remaining bytes, number of bytes removed, number of maximal runs removed."""
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, spans["start"].astype(np.int64), 1)
    np.add.at(change, spans["start"].astype(np.int64) + spans["windows"] + length - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
    return data[~gone], int(gone.sum()), runs


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _remove(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, text, copy, lists in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in (1, 2, 3))):
                raw = (text.as_py() or "").encode()
                data = np.frombuffer(raw, np.uint8)
                if copy.as_py() > 1:  # the same row once more: every window stands earlier
                    spans = _spans(np.array([0]), np.array([len(raw) - length + 1]))[: int(len(raw) >= length)]
                else:
                    spans = np.concatenate([np.zeros(0, SPAN), *(np.frombuffer(x, SPAN) for x in lists.as_py() or ())])
                kept, removed, runs = _cut(data, spans, length) if len(spans) else (data, 0, 0)
                rest = kept.tobytes() if removed else raw
                shown = rest.decode("utf-8", "replace") if with_text else None
                out.append((id_, len(raw), removed, runs, hashlib.sha256(rest).hexdigest(), shown))
            columns = list(zip(*out)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in RESULT.split(", ")])

    return run


def remove_repeats(
    docs: DataFrame, length: int = 100, trigger: int = 40, buffer: int = BUFFER, with_text: bool = False,
    many: int = MANY, many_in_range: int = MANY_IN_RANGE,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` per row of ``docs``.

    Texts are UTF-8 bytes, null is empty. Every byte in a ``length``-byte string that
    also starts earlier in the corpus is removed; earlier is a smaller doc_id (null
    last; of several texts with one id, the smaller hash of the text) or an earlier
    start in the same text, overlaps included. Matches never cross documents. Of rows
    that agree in id and text, one is the first and the others are repeats of it.
    Texts shorter than ``length`` stay. ``kept`` is the rest where ``with_text`` asks
    for it (bytes of a character cut in two are shown as U+FFFD), else null. An
    empty table gives an empty result; other columns are ignored.
    """
    keyed = with_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    places = {"id": "_id", "null": "_null", "hash": "_text"}
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, total * 2 // (length - trigger + 2) // RANGE_PHRASES)
    bits = (parts - 1).bit_length()
    parsed = keyed.select("doc_id", "text", "_text").mapInArrow(_parse(length, trigger, bits, buffer, many), PACKET)
    found = parsed.groupBy("part").applyInArrow(_dictionary(bits, many_in_range), FOUND).groupBy("bucket").applyInArrow(_by_place, MARKED)
    found = settle(found, "phrases").withColumnsRenamed(places)

    needs = found.where(F.length("needs") > 0).groupBy(*KEY).agg(
        F.collect_list("needs").alias("needs"), F.sum("n_split").alias("n_split")
    )
    needs = settle(needs, "needed")
    n_split = needs.agg(F.sum("n_split")).first()[0] or 0
    window_bits = (max(1, n_split // RANGE_WINDOWS) - 1).bit_length()
    some, _ = split_by_keys(keyed, needs)
    fetched = some.join(needs, KEY).select(*KEY, "text", "needs").mapInArrow(_fetch(length, bits, window_bits), FETCHED)
    shared = fetched.groupBy("part").applyInArrow(_sorted_windows(length, bits), FOUND).groupBy("bucket")
    shared = shared.applyInArrow(_by_place, MARKED).withColumnsRenamed(places)
    spans = found.where(F.length("repeats") > 0).select(*KEY, "repeats").unionByName(shared.select(*KEY, "repeats"))
    spans = settle(spans.groupBy(*KEY).agg(F.collect_list("repeats").alias("repeats")), "repeats")
    twice = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*KEY)
    touched, free = split_by_keys(keyed, spans.select(*KEY).unionByName(settle(twice, "twice")))
    copies = F.row_number().over(Window.partitionBy(*KEY).orderBy("doc_id"))
    cut = touched.withColumn("copy", copies).join(spans, KEY, "left").select("doc_id", "text", "copy", "repeats")
    whole = free.select("doc_id", "text", F.lit(1).alias("copy"), F.lit(None).cast("array<binary>").alias("repeats"))
    return cut.mapInArrow(_remove(length, with_text), RESULT).unionByName(whole.mapInArrow(_remove(length, with_text), RESULT))


@query("op3_suffix_array_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("kept")
