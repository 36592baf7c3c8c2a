"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A document's full windows are cut
off first; the rest goes into the open window with the least room that holds it
(best fit). Where none does and no more may be opened, the fullest is emitted. What
is open at a task's end is left over; leftovers of ``MERGE`` tasks at a time are put
end to end and cut anew, level by level, until one task has the last. A level holds
at most ``open_windows`` windows per task, so a merge is bounded however long the
corpus is. Only leftover pieces carry their ids along.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.llm.base import query, table
from opsflow.session import settle

MERGE = 32
#: Bytes of remembered words, about, after which a worker forgets them.
REMEMBER = 96_000_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, task long, ids binary"
)
NAMES = [field.split()[0] for field in PIECES.split(",")]
SCHEMA = pa.schema([(name, pa.binary() if name == "ids" else pa.int64()) for name in NAMES])

# The parts that the vocabulary's own splitter makes of lower-case Latin text.
# \s there: tab to return, blank, next line, no-break space.
PLAIN = re.compile("[\t-\r\x20-\x84\x86-įı-ňŊ-ſ]*")
PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^\t-\r\x20\x85\xa0a-z0-9\xaa\xb5\xba\xb2\xb3\xb9\xbc-\xbe\xdf-\xf6\xf8-ſ]+"
)


SEPARATORS = re.compile("[\x1c-\x1f]")


class Words(dict):
    """Ids of words, and of the parts that the splitter makes of them, as little-endian
    bytes, made when first asked for.

    Bounded by bytes: when they are used up, all is forgotten.
    """

    def __init__(self, model, room: int = REMEMBER):
        super().__init__()
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        self.shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.model, self.room, self.used = model, room, 0

    def __missing__(self, word: str) -> bytes:
        parts = [word] if word.isalpha() else PARTS.findall(word)
        if len(parts) == 1:
            ids = array("I", [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.shown))])
            if sys.byteorder == "big":
                ids.byteswap()
            found = ids.tobytes()
        else:
            found = b"".join(map(self.__getitem__, parts))
        self.used += len(word) + len(found) + 160  # both objects and the entry
        if self.used > self.room:
            self.clear()
            self.used = 0
        self[word] = found
        return found


class WordBpe:
    """Ids of a ``tokenizers`` file, remembered word by word.

    The vocabulary's splitter cuts at white space and never looks beyond a part. Words of
    plain Latin texts go to the merge model directly, as the parts that its splitter
    makes; every other text, and every text that holds a special token's string, takes
    the library's whole way. ``forget`` drops what is remembered; a worker outlives its tasks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words = Words(self.whole.model)

    def forget(self) -> None:
        self.words = Words(self.whole.model)

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not PLAIN.fullmatch(text) or any(s in text for s in self.special) or SEPARATORS.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, text.lower().split()))


@cache
def _loaded(path: str) -> WordBpe:
    return WordBpe(path)


class Windows:
    """A fixed number of open windows of ``room`` tokens, kept by fill."""

    def __init__(self, room: int, open_windows: int):
        self.room, self.most = room, open_windows
        self.order: list[tuple[int, int]] = []  # (fill, number), ascending
        self.held: dict[int, list] = {}
        self.made = 0

    def place(self, length: int, item: list) -> list[list] | None:
        """Put an item in; gives the items of a window that had to be emitted or is full."""
        emitted = None
        at = bisect_left(self.order, (self.room - length + 1, -1)) - 1
        if at >= 0:
            fill, number = self.order.pop(at)
        else:
            if len(self.order) >= self.most:
                _, full = self.order.pop()
                emitted = self.held.pop(full)
            fill, number, self.made = 0, self.made, self.made + 1
            self.held[number] = []
        item[5], item[6] = number, fill
        self.held[number].append(item)
        if fill + length == self.room:
            return (emitted or []) + self.held.pop(number)
        insort(self.order, (fill + length, number))
        return emitted


def _rows(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def _piece(doc, start: int, ids: bytes, tokens: int, task: int) -> list:
    return [doc, start, len(ids) // 4, zlib.crc32(ids), tokens, None, 0, task, ids]


def _pack(tokenizer: str, end_id: int, room: int, open_windows: int):
    last = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task = _loaded(tokenizer), TaskContext.get().partitionId()
        windows, first = Windows(room, open_windows), task << 40
        out: list[list] = []

        def close(rows: list[list] | None) -> None:
            for row in rows or ():
                row[5] += first
                row[8] = None
                out.append(row)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = model.ids(text.as_py() or "") + last
                tokens = len(ids) // 4
                for start in range(0, tokens - tokens % room, room):
                    piece = _piece(doc, start, ids[start * 4 : (start + room) * 4], tokens, task)
                    piece[5], windows.made = windows.made, windows.made + 1
                    close([piece])
                if tokens % room:
                    start = tokens - tokens % room
                    close(windows.place(tokens - start, _piece(doc, start, ids[start * 4 :], tokens, task)))
            if out:
                yield _rows(out)
                out.clear()
        model.forget()
        rows = [row for held in windows.held.values() for row in held]
        for row in rows:
            row[5] += first
        if rows:
            yield _rows(rows)

    return run


def _merge(room: int):
    """Leftover windows of several tasks end to end, cut into full ones."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.select(NAMES).sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        numbers = sorted(set(rows.column("sequence_id").to_pylist()))
        task = rows.column("task")[0].as_py()
        made: list[list[list]] = [[]]
        fill = 0
        for row in zip(*[rows.column(name).to_pylist() for name in NAMES]):
            doc, start, ids, tokens = row[0], row[1], row[8], row[4]
            while ids:
                part, ids = ids[: (room - fill) * 4], ids[(room - fill) * 4 :]
                piece = _piece(doc, start, part, tokens, task)
                piece[5], piece[6] = numbers[len(made) - 1], fill
                made[-1].append(piece)
                start += piece[2]
                fill += piece[2]
                if fill == room:
                    made.append([])
                    fill = 0
        for full in made[:-1]:
            for piece in full:
                piece[8] = None
        return pa.Table.from_batches([_rows([piece for window in made for piece in window])])

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, room: int = 4096, open_windows: int = 64) -> DataFrame:
    """Pieces of documents and their places: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``.

    Every id of every row (text's ids, then ``end_id``) lies in exactly one piece, and
    pieces fill a sequence from offset 0 without gaps. A text longer than a window
    gives full windows and a rest; a leftover may be cut once more. Null text counts
    as empty, so it is ``end_id`` alone. Repeated rows are packed each. An empty table
    gives no pieces; other columns are ignored. All but the last sequence of a merge
    hold little or no padding; the last one of the whole corpus may be short.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    state = settle(narrow.mapInArrow(_pack(tokenizer, end_id, room, open_windows), PIECES), "packed")
    closed, left = state.where("ids IS NULL"), state.where("ids IS NOT NULL")
    last = left.agg(F.max("task")).first()[0] or 0
    while last > 0:
        last //= MERGE
        regrouped = left.withColumn("task", F.expr(f"task div {MERGE}"))
        merged = settle(regrouped.groupBy("task").applyInArrow(_merge(room), PIECES), "merged")
        closed = closed.unionByName(merged.where("ids IS NULL"))
        left = merged.where("ids IS NOT NULL")
    if_one = left.withColumn("task", F.lit(0).cast("long")).groupBy("task").applyInArrow(_merge(room), PIECES)
    return closed.unionByName(if_one).select(*NAMES[:7])


@query("op2_packing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
