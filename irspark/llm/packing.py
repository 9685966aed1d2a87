"""Packing token sequences by best-fit decreasing.

Documents are tokenised, ended and cut: full windows first, then one shorter piece.  Best-fit
decreasing takes the longest piece first and puts it into the open window with the least room that
still holds it.  Pieces of one length are alike to it, so the whole placing follows from how many
pieces there are of each length: at most ``window`` counts, whatever the corpus.  A segment tree over
the remaining capacities finds the tightest open windows, and runs of equal pieces are placed at once
with the result of placing them one by one.  Each piece then finds its window from its rank among the
pieces of its length.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .frames import cut, map_batches
from .text import slices

WINDOW = 2048
END_ID = 1                           # closes every document
BLOCK = 1 << 19                      # characters tokenised at once; longer texts go block by block
REMEMBERED = 1 << 20                 # units whose ids a worker keeps; beyond it forgets and starts again
LONGEST = 48                         # characters of the longest unit that is remembered
# A space before a word character or a printable ASCII character always begins a token of the
# byte-level pre-tokeniser, so a text may be cut there and its parts tokenised apart.
_CUT = re.compile(r"(?= [\w!-~])")
_SAFE = re.compile(r"[\w!-~]")
_UNSAFE = re.compile(r" (?![\w!-~])")


class Tokens:
    """Ids of whole texts by the ``tokenizers`` library, which is asked once per unit.

    A unit is a space and what follows up to the next space.  Texts whose units can't all be told
    apart so (runs of spaces, spaces before control characters) are cut by ``_CUT`` instead.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t.content: t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = tuple(special)
        # one character of a byte-level vocabulary entry is one byte
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(special.get(token, token))
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """Ids of new units, each as after a space; a unit that a cut may not precede gets none."""
        line = " " + " ".join(units)
        if _UNSAFE.search(line) or any(s in line for s in self.special):
            units = [u for u in units if _SAFE.match(u) and not any(s in u for s in self.special)]
        learnt = {}
        groups = [units[i:i + 64] for i in range(0, len(units), 64)]
        lines = [" " + " ".join(g) for g in groups]
        for some, line, ids in zip(groups, lines, self._ids(lines)):
            raw = line.encode()
            ends = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)[1:], len(raw))
            at = (4 * np.searchsorted(np.cumsum(self.width[ids]), ends) + 4).tolist()
            raw = ids.tobytes()
            learnt.update(zip(some, [raw[i:j] for i, j in zip([0, *at], at)]))
        return learnt

    def _pieces(self, text: str):
        """The text in blocks of about ``BLOCK`` characters."""
        at = 0
        while len(text) - at > BLOCK:
            to = _CUT.search(text, at + BLOCK)
            if to is None:
                break
            yield text[at:to.start()]
            at = to.start()
        yield text[at:] if at else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        blocks = [(i, b) for i, t in enumerate(texts) for b in self._pieces(t)]
        split = [b.split(" ") for _, b in blocks]
        heads = self._ids([s[0] for s in split])
        found = [[b"", *map(self.known.get, s[1:])] for s in split]
        lacking = {u for s, f in zip(split, found) if None in f for u, x in zip(s, f) if x is None}
        new = self._learn(list(lacking))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        self.known.update(new if max(map(len, new), default=0) <= LONGEST else
                          {u: x for u, x in new.items() if len(u) <= LONGEST})
        out: list[list[bytes]] = [[] for _ in texts]
        for (i, text), units, ids, head in zip(blocks, split, found, heads):
            if None in ids:
                ids = [new.get(u) if x is None else x for u, x in zip(units, ids)]
            if None not in ids:
                ids[0] = head.tobytes()
                out[i].append(b"".join(ids))
            else:                                       # cut apart where a cut is safe
                out[i] += [x.tobytes() for x in self._ids(_CUT.split(text))]
        return [b"".join(x) for x in out]


_READY: dict[str, Tokens] = {}


def _tokens(path: str) -> Tokens:
    """The tokenizer of a file, made once in each Python worker."""
    if path not in _READY:
        _READY[path] = Tokens(path)
    return _READY[path]


def _cut_up(path: str, window: int, end_id: int):
    def run(batches):
        tokens, end = _tokens(path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            raw = [x + end for x in tokens.encode(texts)]
            total = np.array([len(x) // 4 for x in raw], np.int64)
            pieces = -(-total // window)
            row = np.repeat(np.arange(len(raw)), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(total[row] - start, window)
            ids = [raw[r][4 * a:4 * (a + n)] for r, a, n in zip(row.tolist(), start.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(total[row]),
                 pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, doc_tokens, ids: every document's ids and ``end_id`` in full windows and a rest.

    ``tokenizer`` is the path of a ``tokenizers`` file that every executor can read (without one, the
    public byte-level one).  ``ids`` holds little-endian unsigned 32-bit ids, ``start`` counts the
    document's ids before them.  A null text counts as empty and gives the end alone.  Rows that repeat
    an id are documents of their own, null ids too.  Other columns are ignored.  No rows give no rows.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _cut_up(str(tokenizer), window, end_id),
                       "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary")


class Rooms:
    """Open windows by remaining capacity, under a segment tree that finds the tightest fit."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)                 # runs of open windows below each tree node
        self.runs: dict[int, list[tuple[int, int]]] = {}    # capacity: (first window, windows)

    def _count(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.open[node] += by
            node //= 2

    def add(self, capacity: int, first: int, n: int) -> None:
        if capacity and n:
            self.runs.setdefault(capacity, []).append((first, n))
            self._count(capacity, 1)

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least ``least`` that an open window has."""
        node = self.leaves + least
        if not self.open[node]:
            while node > 1 and (node % 2 or not self.open[node + 1]):   # up, until a right sibling has some
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:                                   # down, leftmost first
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, capacity: int) -> tuple[int, int]:
        self._count(capacity, -1)
        return self.runs[capacity].pop()


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first, sequence, each, offset) of every run of equal pieces, in order of length and first.

    ``counts`` says how many pieces there are of each length (1 to ``window``).  The pieces of a length
    are numbered from 0; number r of a run lies in ``sequence + (r - first) // each`` at ``offset +
    (r - first) % each * length``.  Windows that a run fills keep less room than half of what they had,
    and a length splits at most two runs, so there are at most about 4 * window * log2(window) runs.
    """
    rooms, plan, opened = Rooms(window), [], 0
    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, first, n = window, opened, -(-left // (window // length))
                opened += n
            else:
                first, n = rooms.take(room)
            each = room // length
            whole = min(n, left // each)
            if whole:
                plan.append((length, placed, first, each, window - room))
                rooms.add(room - each * length, first, whole)
                placed, left = placed + whole * each, left - whole * each
            if left and whole < n:                          # the last ones share one more window
                plan.append((length, placed, first + whole, left, window - room))
                rooms.add(room - left * length, first + whole, 1)
                placed, left, whole = placed + left, 0, whole + 1
            rooms.add(room, first + whole, n - whole)
    return sorted(plan)


def _placed(shared, fields: list[str], length_at: int, rank_at: int):
    def run(batches):
        plan = shared.value
        keys = plan[:, 0] << 44 | plan[:, 1]
        for batch in batches:
            length = batch.column(length_at).to_numpy(zero_copy_only=False)
            rank = batch.column(rank_at).to_numpy(zero_copy_only=False) - 1
            _, first, sequence, each, offset = plan[np.searchsorted(keys, length << 44 | rank, "right") - 1].T
            at = rank - first
            kept = [c for i, c in enumerate(batch.columns) if i != rank_at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence + at // each), pa.array(offset + at % each * length)],
                [*fields, "sequence_id", "offset"])
    return run


def pack_windows(pieces: DataFrame, window: int = WINDOW, length_col: str = "length",
                 order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """``pieces`` with sequence_id and offset: best-fit decreasing into sequences of ``window`` tokens.

    ``length_col`` must be from 1 to ``window`` in every row.  Pieces of one length are placed in the
    order of ``order`` (nulls first) and then of their other columns; rows alike in all are exchangeable.  Sequences
    are numbered from 0 without gaps, and so are the tokens of each.  Columns of ``pieces`` that are named
    sequence_id or offset are replaced.  No rows give no rows.
    """
    pieces = cut(pieces.drop("sequence_id", "offset").withColumn(length_col, F.col(length_col).cast("bigint")))
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).agg(F.count(F.lit(1))).collect()}   # at most window rows
    wrong = [n for n in counts if n is None or not 1 <= n <= window]
    if wrong:
        raise ValueError(f"lengths must be from 1 to {window}, not {wrong[:5]}")
    plan = np.array(best_fit_decreasing(counts, window), np.int64).reshape(-1, 5)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)
    others = [c for c in pieces.columns if c not in order and c != length_col]
    ranked = global_rank(pieces, [length_col], [*order, *others], "_rank")
    at = [f.name for f in ranked.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_batches(ranked, _placed(shared, pieces.columns, at.index(length_col), at.index("_rank")),
                       f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, doc_tokens, ids, sequence_id, offset of every piece of every document.

    ``token_pieces`` says how texts are cut and what nulls and repeated rows give, ``pack_windows`` how
    the pieces are placed.
    """
    return pack_windows(token_pieces(docs, tokenizer, window, end_id, id_col, text_col), window)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the pieces of each sequence in order (at most one window of them)."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), inside.alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"])).alias("ids")))
