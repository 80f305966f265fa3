"""Operator 2: sum-of-squares online packing of token sequences into windows.

Each task packs the documents of its partition as they stream past, so nothing is shuffled and memory holds only
the open windows. A level array counts the partially filled windows by fill. The part of a document that is left
after whole windows goes to the level where the sum of the squared counts ends up smallest; a window that becomes
full is closed. At the end of a partition the windows still open are cut and joined into full ones, and the rest
is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import defaultdict

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import SPLIT, codec
from .common import map_rows

OPEN_WINDOWS = 4096
LONG_WHITE = 10_000
WHITE = re.compile(rf"\s{{{LONG_WHITE}}}")


@functools.lru_cache(2)
def encoder(vocab_path: str) -> tiktoken.Encoding:
    """The tokenizers file's vocabulary as a tiktoken encoding; the ids are the same and come about faster."""
    c = codec(vocab_path)
    first = c.starts.tolist()
    special = set(c.special.values())
    ranks = {c.blob[a:b]: i for i, (a, b) in enumerate(zip(first, first[1:])) if i not in special and b > a}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=c.special)


def tokens(vocab_path: str, text: str) -> np.ndarray:
    """Ids of the whole text. The fast encoder's pattern can't pass very long white space; such texts take the codec of operator 6."""
    if len(text) > LONG_WHITE and WHITE.search(text):
        return codec(vocab_path).encode(text)
    return encoder(vocab_path).encode_to_numpy(text, allowed_special="all")


class Packer:
    """Sum-of-squares packing into windows of `size` ids; rows of finished pieces gather in `rows`.

    A piece is (doc_id, start, ids, doc_tokens).
    """

    def __init__(self, size: int, first_sequence: int):
        self.size, self.next = size, first_sequence
        self.counts = np.zeros(size + 1, np.int64)  # counts[h]: open windows of fill h; 0 and size stay 0
        self.windows: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, size = len(ids), self.size
        whole = n - n % size
        for start in range(0, whole, size):
            self.close([(doc_id, start, ids[start : start + size], n)])
        rest = n - whole
        if not rest:
            return
        piece = (doc_id, whole, ids[whole:], n)
        # Moving a window from h to h + rest changes the sum of squares by 2 * (counts[h + rest] - counts[h] + 1);
        # a new window, by 2 * counts[rest] + 1; filling one up, by 1 - 2 * counts[h].
        counts = self.counts
        change = 2 * (counts[rest:] - counts[: size - rest + 1] + 1)
        change[-1] -= 1
        change[1:][counts[1 : size - rest + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * counts[rest] + 1
        best = len(change) - 1 - int(np.argmin(change[::-1]))  # of equals, the fullest
        window = []
        if best:
            window = self.windows[best].pop()
            counts[best] -= 1
            self.n_open -= 1
        window.append(piece)
        if best + rest == size:
            self.close(window)
        else:
            self.windows[best + rest].append(window)
            counts[best + rest] += 1
            self.n_open += 1
            if self.n_open > OPEN_WINDOWS:
                self.join_open(last=False)

    def join_open(self, last: bool) -> None:
        """Cuts open windows into full ones; what is left stays open, or is cut at powers of two."""
        window, fill = [], 0
        for level in sorted(self.windows, reverse=True):
            for pieces in self.windows[level]:
                for doc_id, start, ids, total in pieces:
                    while fill + len(ids) >= self.size:
                        n = self.size - fill
                        self.close([*window, (doc_id, start, ids[:n], total)])
                        window, fill, start, ids = [], 0, start + n, ids[n:]
                    if len(ids):
                        window.append((doc_id, start, ids, total))
                        fill += len(ids)
        self.windows.clear()
        self.counts[:] = 0
        self.n_open = 0
        if fill and not last:
            self.windows[fill].append(window)
            self.counts[fill] = self.n_open = 1
            return
        while fill:
            n = 1 << (fill.bit_length() - 1)
            head, room = [], n
            while room:
                doc_id, start, ids, total = window.pop(0)
                head.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    window.insert(0, (doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            self.close(head)
            fill -= n


PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocab_path: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text, then end_id. Null or empty text gives the end id alone. Repeated
    rows are packed each for itself; other columns are ignored; an empty table gives no piece. A sequence has
    `size` ids or a power of two, so none is padded. sequence_id has the partition in its upper bits.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        packer = Packer(size, part << 40)

        def rows():
            out = dict(zip(PIECE, map(list, zip(*packer.rows))))
            packer.rows = []
            return out

        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                packer.add(doc_id, np.append(tokens(vocab_path, text or ""), np.uint32(end_id)))
                if len(packer.rows) >= 4096:
                    yield rows()
        packer.join_open(last=True)
        if packer.rows:
            yield rows()

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)
